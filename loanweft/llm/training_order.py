"""Training order: token sequences at pseudo-random places, written as shards of fixed stride.

Every text's ids and an end mark are cut into sequences of ``LENGTH`` tokens,
the last filled up. A text of n bytes has at most n tokens, so its length alone
reserves enough numbers for its sequences; a running sum of them over rising
doc_id, on lengths only, gives each sequence its number. A keyed Feistel
network permutes the numbers 0 to M - 1: it permutes the next even power of two,
and results beyond M are sent through it again (cycle walking). No table of the
order is kept, and any task can place any sequence.

The permuted numbers are cut into ranges, one per shard. Each range is sorted
and written through Spark's text writer, one file per shard and one record of
``stride`` bytes per sequence, so record k begins at byte k * stride. Shards
follow each other: a sequence's global slot is its record number plus those of
the shards before. The counts, a number per shard, follow from the files'
lengths. A reader resumes at any slot by a division and a seek.

Texts are encoded once and their sequences shuffled once; the order of records
depends on ids, texts and the key, not on how the input is partitioned.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanweft.llm.common import MIX, bucketizer, forget, materialize, mixed, release, shared_path, slices
from loanweft.llm.substrings import join_by_key, numbered
from loanweft.llm.token_ids import content_of, loaded

LENGTH = 256
ROUNDS = 6
NUMBERS_PER_SHARD = 60_000  # reserved numbers; a third of them or so become records
HEAD = 16  # bytes: doc_id, number within the text, tokens that count
NO_ID = np.uint32(1 << 31)  # set in the tokens of a row without doc_id
TOGETHER = 2
MOST_RANGES = 10_000


def stride(length: int = LENGTH) -> int:
    """Bytes of a record: head, two bytes a token, and the writer's line end."""
    return HEAD + 2 * length + 1


class Permutation:
    """Keyed bijection of 0 to ``size`` - 1."""

    def __init__(self, size: int, key: int, rounds: int = ROUNDS):
        if not 0 < size <= 1 << 62:
            raise ValueError("from 1 to 2^62 numbers can be permuted")
        self.size, self.half = size, max(1, -(-(size - 1).bit_length() // 2))
        self.keys = mixed(np.arange(1, rounds + 1, dtype=np.uint64) * MIX ^ mixed(np.array([key % (1 << 64)], np.uint64)))

    def once(self, x: np.ndarray) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for key in self.keys:
            left, right = right, left ^ (mixed(right ^ key) & mask)
        return (left << half) | right

    def back(self, x: np.ndarray) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for key in self.keys[::-1]:
            left, right = right ^ (mixed(left ^ key) & mask), left
        return (left << half) | right

    def walked(self, x: np.ndarray, step) -> np.ndarray:
        found = step(np.asarray(x).astype(np.uint64))
        while (over := np.flatnonzero(found >= np.uint64(self.size))).size:
            found[over] = step(found[over])
        return found.astype(np.int64)

    def place(self, numbers: np.ndarray) -> np.ndarray:
        return self.walked(numbers, self.once)

    def number(self, places: np.ndarray) -> np.ndarray:
        return self.walked(places, self.back)


def reserved(docs: DataFrame, length: int) -> tuple[DataFrame, int]:
    """(doc, copy, base): the first of each text's numbers, by rising doc and copy; and how many numbers there are."""
    spark = docs.sparkSession
    need = F.ceil((F.coalesce(F.octet_length("text"), F.lit(0)) + 1) / length)
    rows = docs.select("doc", "copy", need.alias("need"), F.col("doc").cast("double").alias("at"))
    n = rows.count()
    ranges = int(min(MOST_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // 500_000)))
    cuts = sorted(set(rows.approxQuantile("at", [i / ranges for i in range(1, ranges)], 0.25 / ranges))) if n else []
    split = bucketizer(cuts, "at", "part")
    parted = split.transform(rows)
    totals = sorted((row.part, row.need) for row in parted.groupBy("part").agg(F.sum("need").alias("need")).collect())
    before, so_far = {}, 0
    for part, total in totals:
        before[part] = so_far
        so_far += total
    if not before:
        return parted.select("doc", "copy", F.lit(0).cast("bigint").alias("base")), 0
    offset = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col("part")]
    order = Window.partitionBy("part").orderBy("doc", "copy").rowsBetween(Window.unboundedPreceding, -1)
    base = parted.withColumn("base", (offset + F.coalesce(F.sum("need").over(order), F.lit(0))).cast("bigint"))
    return materialize(base.select("doc", "copy", "base"), "bases"), so_far


def write(df: DataFrame, path: str, tokenizer: str, key: int, length: int = LENGTH) -> None:
    """Write (doc_id, text) as shards below ``path``, in the order that ``key`` gives.

    A null or empty text is a sequence that holds the end mark only. Rows with
    one id are numbered by their text, rows without id come first; a record
    holds its row's own doc_id, or that there is none. An empty table writes no shard. Other
    columns are left out. The vocabulary must fit two bytes.
    """
    content = content_of(tokenizer)
    coder = loaded(content)
    if len(coder.pieces) > 1 << 16 or len(coder.special) != 1:
        raise ValueError("a vocabulary of at most 65,536 tokens with one special token, the end mark, is needed")
    end = next(iter(coder.special.values()))
    docs = numbered(df)
    base, total = reserved(docs, length)
    order, shards = Permutation(max(1, total), key), max(1, -(-total // NUMBERS_PER_SHARD))
    placed = join_by_key(docs, base, "inner").select("doc_id", "base", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(content)
        for batch in batches:
            for piece in slices(batch, ["text"], TOGETHER << 20):
                ids, at = coder.encode(piece.column(2).to_pylist())
                tokens = np.diff(at) + 1  # with the end mark
                made = -(-tokens // length)
                row = np.repeat(np.arange(len(made)), made)
                number = np.arange(len(row)) - np.repeat(np.cumsum(made) - made, made)
                grid = np.full((len(row), length), end, np.uint16)
                start = np.repeat(np.cumsum(made) - made, tokens - 1) * length + np.arange(len(ids)) - np.repeat(at[:-1], tokens - 1)
                grid.reshape(-1)[start] = ids
                head = np.zeros(len(row), np.dtype([("doc", "<i8"), ("number", "<u4"), ("tokens", "<u4")]))
                head["doc"], head["number"] = np.asarray(piece.column(0).fill_null(0))[row], number
                head["tokens"] = np.minimum(length, tokens[row] - number * length)
                head["tokens"] |= np.where(np.asarray(piece.column(0).is_null())[row], NO_ID, 0).astype(np.uint32)
                place = order.place(np.asarray(piece.column(1))[row] + number)
                records = np.concatenate([head.view(np.uint8).reshape(len(row), HEAD), grid.astype("<u2").view(np.uint8)], axis=1)
                ends = pa.array(np.arange(len(row) + 1) * records.shape[1], pa.int32()).buffers()[1]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array((place.astype(object) * shards // order.size).astype(np.int32) if order.size > 1 << 40 else (place * shards // order.size).astype(np.int32)),
                    "place": pa.array(place), "value": pa.Array.from_buffers(pa.binary(), len(row), [None, ends, pa.py_buffer(records)])})
            batch = piece = ids = start = grid = records = None
            release()  # the worker lives on while the shards are written

    rows = placed.mapInArrow(run, "shard int, place bigint, value binary")
    ordered = rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "place")
    ordered.select("shard", F.col("value").cast("string").alias("value")).write.partitionBy("shard").option("lineSep", "\n").text(path)


def manifest(spark: SparkSession, path: str, length: int = LENGTH) -> list[tuple[int, str, int, int]]:
    """(shard, file, first slot, records) of every shard, from the files' lengths."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    made, slot = [], 0
    for file, size in sorted(((row.path, row.length) for row in files.select("path", "length").collect()), key=lambda f: shard_of(f[0])):
        made.append((shard_of(file), file, slot, size // stride(length)))
        slot += size // stride(length)
    return made


def shard_of(file: str) -> int:
    return int(re.search(r"shard=(\d+)/", file)[1])


def locate(known: list[tuple[int, str, int, int]], slot: int, length: int = LENGTH) -> tuple[str, int]:
    """(file, byte) at which the record of a global slot begins: where a reader goes on."""
    at = bisect_right([first for _, _, first, _ in known], slot) - 1
    _, file, first, records = known[at]
    if slot < 0 or slot >= first + records:
        raise ValueError(f"there is no slot {slot}")
    return file, (slot - first) * stride(length)


def read(spark: SparkSession, path: str, length: int = LENGTH) -> DataFrame:
    """(slot, shard, doc_id, sequence, n_tokens, tokens array<int>) of every record; tokens that only fill up are left out."""
    known = manifest(spark, path, length)
    first = {file: slot for _, file, slot, _ in known}
    size, per_batch = stride(length), 4_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                records = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, size)
                for low in range(0, len(records), per_batch):
                    part = records[low:low + per_batch]
                    head = np.ascontiguousarray(part[:, :HEAD]).view(np.dtype([("doc", "<i8"), ("number", "<u4"), ("tokens", "<u4")])).reshape(-1)
                    grid = np.ascontiguousarray(part[:, HEAD:-1]).view("<u2").astype(np.int32)
                    used, no_id = (head["tokens"] & ~NO_ID).astype(np.int64), head["tokens"] >= NO_ID
                    offsets = np.r_[0, np.cumsum(used)].astype(np.int32)
                    flat = grid[np.arange(grid.shape[1]) < used[:, None]]
                    yield pa.RecordBatch.from_pydict({
                        "slot": pa.array(first[file] + low + np.arange(len(part))), "shard": pa.array(np.full(len(part), shard_of(file), np.int32)),
                        "doc_id": pa.array(head["doc"], pa.int64(), mask=no_id), "sequence": pa.array(head["number"].astype(np.int32)),
                        "n_tokens": pa.array(used.astype(np.int32)), "tokens": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))})
            batch = content = records = part = None
            release()

    schema = "slot bigint, shard int, doc_id bigint, sequence int, n_tokens int, tokens array<int>"
    if not known:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, schema)


def materialised(df: DataFrame, tokenizer: str, key: int, length: int = LENGTH) -> DataFrame:
    """Write the shards in the shared folder and read them back."""
    path = shared_path(df.sparkSession, "training-order")
    write(df, path, tokenizer, key, length)
    return read(df.sparkSession, path, length)
