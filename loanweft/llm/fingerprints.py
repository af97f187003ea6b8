"""Document fingerprints: the k smallest hashes of a text's distinct shingles.

The sketch of a union of parts is the k smallest hashes of the parts' sketches
together, so sketches of pieces merge in any order. From two sketches the
resemblance, the containment and the number of distinct shingles are estimated;
with at most k shingles they are exact. Shingles are five words (see
``common.word_hashes``); a shorter text is one shingle, an empty one none.

``with_neighbours`` sorts the texts by id in ranges. What the last text of a
range needs from the next range is sent along: of each range, the texts with
its largest id. A text is thus moved once. The ranges' bounds and largest ids
are all that the driver sees; their number is bounded.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanweft.llm.common import bucketizer, over_batches, pick, raw, shingle_hashes, slices

K = 256
BITS = 48  # of each hash
WORDS = 5
ROWS_PER_RANGE = 20_000
MOST_RANGES = 10_000  # bounds the driver's list; larger ranges are sorted on disk and streamed
TOGETHER = 0.5  # MB of text whose shingles are held at once


def sketches(data: np.ndarray, offsets: np.ndarray, k: int = K, words: int = WORDS) -> list[np.ndarray]:
    """For each text the ``k`` smallest distinct shingle hashes, ascending."""
    hashes, at = shingle_hashes(data, offsets, words)
    hashes >>= np.uint64(64 - BITS)
    return [np.unique(hashes[low:high])[:k] for low, high in zip(at[:-1].tolist(), at[1:].tolist())]


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of common among all distinct shingles; 1.0 for two empty texts."""
    union = merged(a, b, k)
    if not len(union):
        return 1.0
    return float(np.intersect1d(np.intersect1d(a, b, assume_unique=True), union, assume_unique=True).size / len(union))


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0 ** BITS / (float(a[k - 1]) + 1.0)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the first text's distinct shingles that the second has too; 1.0 for an empty first text."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merged(a, b, k), k) / distinct(a, k))


def packed(sketch: np.ndarray) -> str:
    """Six bytes a hash (big-endian) in base64, ascending."""
    return base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def unpacked(text: str) -> np.ndarray:
    six = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    return np.concatenate([np.zeros((len(six), 2), np.uint8), six], axis=1).reshape(-1).view(">u8").astype(np.uint64)


def fingerprints(df: DataFrame, k: int = K, words: int = WORDS) -> DataFrame:
    """(doc_id, hashes array<bigint>) of (doc_id, text): the sketch's hashes, ascending.

    Null texts count as empty and have no hashes; every row gives one row, also
    with a null or repeated id. Other columns are left out.
    """

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        made = [s.astype(np.int64) for s in sketches(*raw(piece.column(1)), k, words)]
        return pa.RecordBatch.from_pydict({"doc_id": piece.column(0), "hashes": pa.array(made, pa.list_(pa.int64()))})

    return over_batches(pick(df, doc_id="bigint", text="string"), run, "doc_id bigint, hashes array<bigint>", TOGETHER)


def merge_parts(parts: DataFrame, key: str, k: int = K) -> DataFrame:
    """(key, hashes) of sketches (key, hashes) of parts: the k smallest distinct hashes of each key.

    The ranking keeps k hashes per key before the shuffle too, so a key with
    very many parts sends little. Keys whose parts are all empty give no row.
    """
    each = parts.select(key, F.explode("hashes").alias("h")).distinct()
    order = Window.partitionBy(key).orderBy("h")
    best = each.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)
    return best.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("n", "h"))).alias("s")).select(
        key, F.col("s.h").alias("hashes"))


def in_ranges(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``part``, the number of an id range, and ``carried``; sorted by part, carried and falling id.

    Each range also gets, as carried rows, the texts with the largest id of the
    next lower range that has rows; the lowest range those of the highest.
    """
    spark = docs.sparkSession
    number = F.coalesce(F.col("doc_id").cast("double"), F.lit(-1e300))  # null ids come last in falling order
    ids = docs.select(number.alias("number"))
    rows = ids.count()
    ranges = int(min(MOST_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // ROWS_PER_RANGE)))
    cuts = sorted(set(ids.approxQuantile("number", [i / ranges for i in range(1, ranges)], 0.25 / ranges))) if rows else []
    split = bucketizer(cuts, "number", "part")
    largest = sorted(split.transform(ids).groupBy(F.col("part").cast("int").alias("part")).agg(F.max("number").alias("top")).collect())
    carry = [(a.top, b.part) for a, b in zip(largest, [*largest[1:], largest[0]])] if largest else []
    own = split.transform(docs.withColumn("number", number)).withColumn("part", F.col("part").cast("int"))
    by_top = F.create_map(*[F.lit(x) for pair in carry for x in pair]) if carry else F.create_map(F.lit(0.0), F.lit(0))
    to = F.when(F.col("number").isin([top for top, _ in carry]), F.array(F.col("part"), by_top[F.col("number")])).otherwise(F.array("part"))
    spread = own.select("doc_id", "text", F.posexplode(to).alias("carried", "part"))
    return spread.repartitionById(ranges + 2, F.col("part")).sortWithinPartitions(
        "part", "carried", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text"))


def with_neighbours(df: DataFrame, k: int = K, words: int = WORDS) -> DataFrame:
    """Every text's sketch, that of its edited text, and their likenesses.

    The edited text is the text whose last third (rounded down, in code points)
    is replaced by as many code points of the text that follows by falling
    doc_id (after the last comes the first); a single text follows itself. Rows
    with the same id follow each other by text, null ids come last. A null text
    is empty. Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, distinct_estimate. Other
    columns of ``df`` are left out.
    """
    schema = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, distinct_estimate double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # a row waits for the one that follows it
        for batch in batches:
            for piece in slices(batch, ["text"], int(TOGETHER * (1 << 20))):
                texts = [t or "" for t in piece.column(1).to_pylist()]
                rows = held + list(zip(piece.column(0).to_pylist(), texts, piece.column(2).to_pylist(), piece.column(3).to_pylist(),
                                       sketches(*raw(piece.column(1)), k, words)))
                pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[2] and a[3] == b[3]]
                held = rows[-1:]
                if pairs:
                    yield made(pairs)

    def made(pairs: list[tuple[tuple, tuple]]) -> pa.RecordBatch:
        edited = [a[1][:len(a[1]) - len(a[1]) // 3] + b[1][:len(a[1]) // 3] for a, b in pairs]
        coded = pa.array(edited, pa.string())
        other = sketches(*raw(coded), k, words)
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array([a[0] for a, _ in pairs], pa.int64()),
            "n_chars": pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
            "edited_sha256": [hashlib.sha256(text.encode()).hexdigest() for text in edited],
            "fingerprint": [packed(a[4]) for a, _ in pairs],
            "edited_fingerprint": [packed(s) for s in other],
            "near_edited": [resemblance(a[4], s, k) for (a, _), s in zip(pairs, other)],
            "near_next": [resemblance(a[4], b[4], k) for a, b in pairs],
            "distinct_estimate": [distinct(a[4], k) for a, _ in pairs]})

    return in_ranges(pick(df, doc_id="bigint", text="string")).select("doc_id", "text", "carried", "part").mapInArrow(run, schema)
