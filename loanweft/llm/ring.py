"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of a ring; a row's key hashes to a place on the
ring and belongs to the next point clockwise. No shard takes more than its
capacity: rows that find a full shard go on clockwise to the next point. With
capacities that add up to the number of rows, counts differ by one at most;
with some slack fewer rows move when shards are added.

How many rows of an arc go where follows from the rows per arc alone, a table
as small as the ring, whatever the data. The driver fills the shards from it
and gets a list of segments: the rows of an arc with ranks from a to b go to
shard s, from slot t on. The rows themselves are ranked within their arcs, by a
shuffle of a few numbers a row (texts stay where they are), and look up their
segment.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweft.llm.common import in_order, pick
from loanweft.session import literal_table

SHARDS = 40
POINTS = 128  # of each shard on the ring


def place(*columns) -> F.Column:
    """Place on the ring: 52 bits of a hash, so that a double holds it exactly."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 12)


def points(spark: SparkSession, shards: int, per_shard: int) -> list[tuple[int, int]]:
    """The ring: (place, shard) in order. A place that two shards share belongs to the smaller number."""
    grid = spark.range(shards * per_shard).select((F.col("id") % shards).alias("shard"), F.floor(F.col("id") / shards).alias("copy"))
    ring: dict[int, int] = {}
    for row in sorted(grid.select(place(F.lit("point"), "shard", "copy").alias("place"), "shard").collect()):
        ring.setdefault(row.place, row.shard)
    return sorted(ring.items())


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows each shard may take: equal to one row without slack, else ``1 + slack`` times the mean."""
    if slack:
        return [max(1, int(-(-rows * (1 + slack) // shards)))] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def fill(counts: dict[int, int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Segments (arc, first rank, end rank, shard, first slot) for ``counts`` rows per arc.

    In each round every arc's remaining rows ask the next point; a shard takes
    rows while it has room. A row so passes full shards only.
    """
    room, left, taken, segments = list(room), dict(counts), defaultdict(int), []
    step = 0
    while left:
        if step > len(owners):
            raise ValueError("the shards have less room than there are rows")
        for arc in sorted(left):
            shard = owners[(arc + step) % len(owners)]
            if moved := min(left[arc], room[shard]):
                first = counts[arc] - left[arc]
                segments.append((arc, first, first + moved, shard, taken[shard]))
                taken[shard] += moved
                room[shard] -= moved
                left[arc] -= moved
            if not left[arc]:
                del left[arc]
        step += 1
    return segments


def assign(df: DataFrame, shards: int = SHARDS, slack: float = 0.0, per_shard: int = POINTS) -> DataFrame:
    """``df`` (doc_id, text) as doc_id, size, text_crc32, shard and slot.

    A slot numbers the rows of a shard from 0 without gaps. size is the UTF-8
    length plus 16; a null text is empty. Rows are placed by doc_id, those
    without one by their text's checksum; rows with the same id and text may go
    to different shards once one is full. An empty table gives an empty one.
    Other columns are left out.
    """
    spark = df.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = pick(df, doc_id="bigint", text="string").select(
        "doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("place", F.when(F.col("doc_id").isNull(), place(F.lit("none"), "text_crc32")).otherwise(place("doc_id")))
    ring = points(spark, shards, per_shard)
    # an arc ends at its point: places up to and including it; beyond the last point the first arc goes on
    split = Bucketizer(splits=[float("-inf"), *[float(at) + 0.5 for at, _ in ring], float("inf")], inputCol="at", outputCol="arc")
    on_arcs = split.transform(rows.withColumn("at", F.col("place").cast("double"))).withColumn(
        "arc", F.col("arc").cast("int") % len(ring)).drop("at")
    counts = {row.arc: row.n for row in on_arcs.groupBy("arc").agg(F.count("*").alias("n")).collect()}
    segments = fill(counts, [shard for _, shard in ring], capacities(sum(counts.values()), shards, slack))
    plan = literal_table(spark, segments, "arc int, low bigint, high bigint, shard int, base bigint")
    # ranked by ranges inside an arc, so that rows that share one place are many tasks
    ranked = in_order(on_arcs, F.col("arc"), *[F.col(name) for name in ("place", "doc_id", "text_crc32", "size")]).withColumnRenamed("position", "rank")
    # at most a segment per arc and per filled shard and arc: the ring's size bounds it, not the data's
    found = ranked.join(F.broadcast(plan), "arc").filter((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    return found.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("low")).alias("slot"))
