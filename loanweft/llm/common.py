"""What the operators share: picking columns by place, sizes of partitions, batches in tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanweft.session import discard, materialize, shared_folder, shared_path  # noqa: F401

MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """The columns named in ``wanted`` cast to their types; all others are left out.

    A column is found by its exact name, its first place counts. So neither
    repeated names nor names that differ in case only are ambiguous.
    """
    names = df.columns
    missing = [name for name in wanted if name not in names]
    if missing:
        raise ValueError(f"no column {missing}")
    apart = df.toDF(*[f"_{i}" for i in range(len(names))])
    return apart.select(*[F.col(f"_{names.index(name)}").cast(kind).alias(name) for name, kind in wanted.items()])


def over_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, mb: float = 4,
                 sizes: Sequence[str] = ("text",), prepare: Callable[[], object] | None = None) -> DataFrame:
    """``mapInArrow`` that hands ``function`` at most about ``mb`` MB of the columns ``sizes`` at a time (one row at least)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        state = prepare() if prepare else None
        for batch in batches:
            for piece in slices(batch, sizes, int(mb * (1 << 20))):
                made = function(piece, state) if prepare else function(piece)
                if made is not None and made.num_rows:
                    yield made
        release()

    return df.mapInArrow(run, schema)


FORGET: list[Callable[[], None]] = []  # what empties the memories that other operators keep in a worker


def forget() -> None:
    """Empty them; a task calls it by name, as a function inside another one is sent with a copy of the list."""
    for clear in FORGET:
        clear()


def release() -> None:
    """Give what a task held back to the system, its powers too: its worker lives on, idle or with other work."""
    POWERS.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU library only
        trim(0)


def slices(batch: pa.RecordBatch, sizes: Sequence[str], most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows of ``batch`` whose columns ``sizes`` hold about ``most`` bytes together."""
    if not batch.num_rows:
        return
    lengths = np.zeros(batch.num_rows, np.int64)
    for name in sizes:
        column = batch.column(batch.schema.get_field_index(name))
        lengths += np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
    group = (np.cumsum(lengths) - lengths) // most
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    for low, high in zip(starts, np.r_[starts[1:], batch.num_rows]):
        yield batch.slice(low, high - low)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without copying, and the n + 1 offsets; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def mixed(values: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit values (splitmix64)."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


BASE = 0x9E3779B97F4A7C15 | 1


POWERS: dict[bool, np.ndarray] = {}  # of this worker process, grown as needed until ``release``: those of BASE, and of its inverse


def powers(size: int, inverse: bool = False) -> np.ndarray:
    if len(POWERS.get(inverse, ())) < size:
        base = np.full(size, pow(BASE, -1, 1 << 64) if inverse else BASE, np.uint64)
        base[0] = 1
        with np.errstate(over="ignore"):
            POWERS[inverse] = np.cumprod(base, dtype=np.uint64)
    return POWERS[inverse][:size]


def polynomial(data: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function (starts, ends) to 64-bit polynomial hashes of those ranges of ``data``; equal contents have equal hashes."""
    size = 1 << max(16, len(data).bit_length())
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(size)[:len(data)], out=sums[1:])

    def of(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (sums[ends] - sums[starts]) * powers(size, True)[starts]

    return of


def bucketizer(cuts: Sequence[float], column: str, name: str) -> Bucketizer:
    """``name``: in which of the ranges between ``cuts`` the double ``column`` lies; two ranges at least."""
    return Bucketizer(splits=[float("-inf"), *(cuts or [0.0]), float("inf")], inputCol=column, outputCol=name)


def parts_of(df: DataFrame, rows_per_part: int, rows: int | None = None) -> int:
    """Number of partitions that holds ``rows_per_part`` rows each; at least the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-(df.count() if rows is None else rows) // rows_per_part))


ROWS_PER_PART = 200_000  # of narrow rows that are put in order


def in_order(rows: DataFrame, tree: Column, *order: Column) -> DataFrame:
    """``rows`` with tree, position (from 0 by ``order`` within the tree) and total.

    One range sort over trees, order and row; a range's rows are counted where
    they lie, and the offsets of a tree's ranges are added up.
    """
    keys = ["tree", *[f"_{i}" for i in range(len(order))], "row"]
    keyed = rows.withColumns({"tree": tree, "row": F.monotonically_increasing_id(), **{f"_{i}": column for i, column in enumerate(order)}})
    ranges = keyed.repartitionByRange(parts_of(rows, ROWS_PER_PART), *[F.asc_nulls_first(key) for key in keys])
    sorted_ = ranges.sortWithinPartitions(*[F.asc_nulls_first(key) for key in keys])
    kept = materialize(sorted_.withColumn("row", F.monotonically_increasing_id()).drop(*keys[1:-1]), "ordered-leaves")
    part = F.shiftright("row", 33)
    by_tree = Window.partitionBy("tree")
    ahead = by_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = kept.groupBy("tree", part.alias("part")).agg(F.min("row").alias("first"), F.count("*").alias("n")).select(
        F.col("tree").alias("of"), "part", "first", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"), F.sum("n").over(by_tree).alias("total"))
    placed = kept.withColumn("part", part).join(offsets.withColumnRenamed("part", "in"), F.col("tree").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")))
    return placed.withColumn("position", F.col("before") + F.col("row") - F.col("first")).drop("row", "part", "in", "of", "first", "before")


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_spans(low: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes of each text for which ``between`` is false."""
    inside = ~between[low]
    first = np.zeros(len(low) + 1, bool)
    first[offsets] = True
    before = np.r_[False, inside[:-1]] & ~first[:-1]
    after = np.r_[inside[1:], False] & ~first[1:]
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of texts (A-Z lower-cased), and the texts' offsets in them."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = LOWER[data]
    starts, ends = word_spans(low, offsets)
    return mixed(polynomial(low)(starts, ends)), np.searchsorted(starts, offsets)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of each text, with the texts' offsets in them.

    A text of fewer words has one shingle, the whole sequence; one without words has none.
    """
    words, at = word_hashes(data, offsets)
    counts = np.diff(at)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out = np.zeros(len(at), np.int64)
    np.cumsum(made, out=out[1:])
    if not out[-1]:
        return np.zeros(0, np.uint64), out
    start = np.repeat(at[:-1] - out[:-1], made) + np.arange(out[-1])
    reach = np.repeat(np.minimum(counts, width), made)
    total = reach.astype(np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            more = j < reach
            total = np.where(more, total * MIX + words[np.where(more, start + j, 0)], total)
    return mixed(total), out
