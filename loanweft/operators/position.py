"""Exact positions in a total order, one way for every number of rows and groups.

``keys_at_ranks`` and ``exact_quantile_buckets`` want the rows at a few ranks,
so nothing is sorted as a whole. A mergeable sketch of the first order column
cuts each group into bins, one pass counts the bins exactly, and only rows of
the bins that hold a wanted rank go on. A value that very many rows share is a
bin of its own and is told apart by the next order column. Bins are cut again
until one fits in a task; their distinct keys are then ordered and counted. The
sketch only says where to cut: the result is exact whatever its error.

``running_totals`` gives prefix sums over rows that are already grouped to
distinct keys: cut points from the same sketch number the ranges, so that the
totals of earlier ranges are known before rows move, and one shuffle by that
number puts every range where it is sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanweft.session import materialize

ROWS_PER_PART = 1_000_000  # keys in a range, and rows in a bin that is not cut any more
CUTS = 64  # bins into which one is cut
SKETCH = 1_000  # size of the sketches that say where, at least
MOST_RANGES = 10_000  # cut points that running totals use at most; larger ranges are sorted on disk

Group = tuple
Key = tuple


@dataclass(frozen=True)
class Order:
    """One column of a sort order."""

    name: str
    ascending: bool = True

    def sort(self) -> Column:
        return F.col(self.name).asc() if self.ascending else F.col(self.name).desc()


def _same(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal names, where NULL equals NULL; the columns of ``left`` stay."""
    renamed = right.withColumnsRenamed({name: f"_r_{name}" for name in names})
    test = F.lit(True)
    for name in names:
        test = test & F.col(name).eqNullSafe(F.col(f"_r_{name}"))
    return left.join(renamed, test, how).drop(*[f"_r_{name}" for name in names])


def _in_ranges(df: DataFrame, by: Sequence[str], orders: Sequence[Order], rows_per_part: int) -> DataFrame:
    """``df`` (one row per group and key) written in range order, with ``_part``, the number of the range."""
    kept = materialize(df, "distinct-keys")
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-kept.count() // rows_per_part))
    placed = kept.repartitionByRange(parts, *by, *[order.sort() for order in orders])
    return materialize(placed.withColumn("_part", F.spark_partition_id()), "ranges")


def _exclusive(window, column: str) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _offsets(ranged: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Per group and range the totals ``_<sum>_part`` and those of the group's earlier ranges, ``_<sum>_offset``."""
    per_part = ranged.groupBy(*by, "_part").agg(*[F.sum(s).alias(f"_{s}_part") for s in sums])
    across = Window.partitionBy(*by).orderBy("_part")
    return per_part.select(*by, "_part", *[f"_{s}_part" for s in sums],
                           *[_exclusive(across, f"_{s}_part").alias(f"_{s}_offset") for s in sums])


def running_totals(df: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = (), ascending: bool = True,
                   rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Add ``<sum>_before``: totals of the group's rows that come earlier in ``order``.

    ``df`` has one row per group and ``order`` value, so no key repeats.
    """
    orders = [Order(order, ascending)]
    image = _all_images(df, orders)[0]
    kept = materialize(df.withColumn("_x", image), "distinct-keys")
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(MOST_RANGES, max(least, -(-kept.count() // rows_per_part)))
    cuts = sorted(kept.agg(_cut_points(F.col("_x"), parts).alias("cuts")).first().cuts)
    # the number of a row's range follows from its value, so the ranges' totals need no order
    split = Bucketizer(splits=[float("-inf"), *(cuts or [0.0]), float("inf")], inputCol="_x", outputCol="_part", handleInvalid="keep")
    ranged = split.transform(kept).withColumn("_part", F.col("_part").cast("int"))
    offsets = _offsets(ranged, by, sums)
    placed = ranged.drop("_x").repartitionById(len(cuts or [0.0]) + 2, F.col("_part"))
    # a group's rows of one range are in one partition already, so the window moves nothing
    inside = Window.partitionBy("_part", *by).orderBy(orders[0].sort())
    before = placed.withColumns({f"_{s}_inside": _exclusive(inside, s) for s in sums})
    joined = _same(before, offsets, [*by, "_part"])
    return joined.select(*df.columns, *[(F.col(f"_{s}_inside") + F.col(f"_{s}_offset")).alias(f"{s}_before") for s in sums])


def row_positions(df: DataFrame, orders: Sequence[Order], by: Sequence[str] = (), name: str = "position",
                  rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``df``, whose rows have different keys, with each row's place in its group, from 1; a group may span any number of tasks."""
    if bad := df.where(_unusable(df, orders)).count():
        raise ValueError(f"{bad} rows have no usable order key")
    ranged = _in_ranges(df.withColumn("_n", F.lit(1).cast("bigint")), by, orders, rows_per_part)
    window = Window.partitionBy(*by, "_part").orderBy(*[order.sort() for order in orders])
    joined = _same(ranged, _offsets(ranged, by, ["_n"]), [*by, "_part"])
    return joined.select(*df.columns, (_exclusive(window, "_n") + F.col("__n_offset") + 1).alias(name))


def _unusable(df: DataFrame, orders: Sequence[Order]) -> Column:
    """True for rows that have no place in the order."""
    unusable = F.lit(False)
    for order in orders:
        column, kind = F.col(order.name), df.schema[order.name].dataType
        if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)):
            raise TypeError(f"cannot order by {order.name} of type {kind.simpleString()}; cast it to date or timestamp")
        unusable = unusable | column.isNull()
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            unusable = unusable | F.isnan(column) | (F.abs(column) == float("inf"))
    return unusable


def _image_count(df: DataFrame, orders: Sequence[Order]) -> int:
    return len(_all_images(df, orders))


def _images(kind: T.DataType, column: Column) -> list[Column]:
    """Doubles that order rows as ``column`` does, each deciding between rows that are equal in those before it.

    They say where to cut only; values that they do not tell apart stay in one bin.
    """
    high = 1 << 32
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return [column.cast("double") + F.lit(0.0)]
    if isinstance(kind, T.DecimalType):
        first = column.cast("double")
        wide = column.cast("decimal(38,0)") if kind.scale == 0 else column
        return [first, F.coalesce((wide - first.cast(f"decimal(38,{kind.scale})")).cast("double"), F.lit(0.0))]
    if isinstance(kind, T.IntegralType):
        whole = column.cast("bigint")
        return [F.shiftright(whole, 32).cast("double"), whole.bitwiseAND(F.lit(high - 1)).cast("double")]
    if isinstance(kind, T.DateType):
        return [F.unix_date(column).cast("double")]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        micros = F.unix_micros(column.cast("timestamp"))
        return [F.shiftright(micros, 32).cast("double"), micros.bitwiseAND(F.lit(high - 1)).cast("double")]
    digits = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 24)), 48, "0")
    return [F.conv(F.substring(digits, 12 * i + 1, 12), 16, 10).cast("double") for i in range(4)]


def _all_images(df: DataFrame, orders: Sequence[Order]) -> list[Column]:
    made = []
    for order in orders:
        images = _images(df.schema[order.name].dataType, F.col(order.name))
        made += images if order.ascending else [-image for image in images]
    return made


def _cut_points(image: Column, pieces: int) -> Column:
    """Distinct cut points of about equal parts, from a sketch; an aggregate."""
    shares = F.array(*[F.lit(i / pieces) for i in range(1, pieces)])
    points = F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(image, F.lit(min(32_768, max(SKETCH, 4 * pieces)))), shares)
    return F.when(F.count(image) > 0, F.array_distinct(points)).otherwise(F.array().cast("array<double>"))


def keys_at_ranks(df: DataFrame, orders: Sequence[Order], ranks: Callable[[Column], Column], by: Sequence[str] = (),
                  rows_per_part: int = ROWS_PER_PART) -> tuple[DataFrame, DataFrame]:
    """(by, _rank, order columns) of the rows at 1-based ranks, and (by, _total), the rows per group; both written.

    ``ranks`` makes an array of wanted ranks from a group's row count; those
    outside 1 to the count are left out. With several order columns the key at
    a wanted rank must belong to one row, or its position is not defined.
    """
    names = [order.name for order in orders]
    unusable = _unusable(df, orders)
    images = F.array(*_all_images(df, orders))
    # bins: every group is one at first, known by "" and cut by the first image
    rows = df.select(*dict.fromkeys([*by, *names]), images.alias("_x"), unusable.alias("_bad"), F.lit("").alias("_bin"), F.lit(0).alias("_level"))
    keys = [*by, "_bin"]

    def measured(rows: DataFrame) -> DataFrame:
        image = F.get("_x", F.col("_level"))
        return rows.groupBy(*keys, "_level").agg(F.count(F.lit(1)).alias("_total"), F.count_if("_bad").alias("_bad"), _cut_points(image, CUTS).alias("_cuts"))

    stats = materialize(measured(rows), "bins")
    few = (F.col("_total") <= rows_per_part) | (F.col("_level") >= F.lit(_image_count(df, orders)))
    bad, to_cut = stats.agg(F.sum("_bad"), F.count_if(~few)).first()
    if bad:
        raise ValueError(f"{bad} rows have no usable order key")
    totals = stats.select(*by, "_total")
    wanted = F.filter(F.array_distinct(ranks(F.col("_total"))), lambda k: (k > 0) & (k <= F.col("_total")))
    bins = stats.withColumn("_ranks", F.transform(wanted, lambda k: F.struct(k.cast("bigint").alias("rank"), k.cast("bigint").alias("at")))).where(F.size("_ranks") > 0)
    settled: list[tuple[DataFrame, DataFrame]] = []
    settled.append((rows, bins.where(few).select(*keys, "_ranks")))
    while to_cut:
        wide = bins.where(~few).select(*keys, "_cuts", "_ranks")
        binned = _same(rows, wide.drop("_ranks"), keys).withColumn("_x0", F.get("_x", F.col("_level")))
        below = F.size(F.filter("_cuts", lambda cut: cut < F.col("_x0")))
        binned = binned.withColumn("_of", 2 * below + F.array_contains("_cuts", F.col("_x0")).cast("int"))
        # only counted: an array among the aggregates would have every task sort its rows
        counted = binned.groupBy(*keys, "_of").agg(F.count(F.lit(1)).alias("_n"))
        before = _exclusive(Window.partitionBy(*keys).orderBy("_of"), "_n")  # a bin's parts are few
        inside = F.filter("_ranks", lambda k: (k["at"] > F.col("_before")) & (k["at"] <= F.col("_before") + F.col("_n")))
        moved = F.transform(inside, lambda k: F.struct(k["rank"].alias("rank"), (k["at"] - F.col("_before")).alias("at")))
        parts = _same(counted.withColumn("_before", before), wide.drop("_cuts"), keys).withColumn("_ranks", moved).where(F.size("_ranks") > 0)
        parts = materialize(parts.select(*keys, "_of", "_ranks"), "bins")
        rows = _same(binned.drop("_cuts", "_x0"), parts.drop("_ranks"), [*keys, "_of"])
        # a value with a bin of its own is told apart by the next image
        next_bin, next_level = F.concat_ws(".", "_bin", F.col("_of").cast("string")), F.col("_level") + F.col("_of") % 2
        rows = materialize(rows.withColumns({"_bin": next_bin, "_level": next_level.cast("int")}).drop("_of"), "bin-rows")
        bins = _same(measured(rows), parts.withColumn("_bin", next_bin).select(*keys, F.col("_ranks").alias("_of_bin")), keys)
        bins = materialize(bins.withColumnRenamed("_of_bin", "_ranks"), "bins")
        settled.append((rows, bins.where(few).select(*keys, "_ranks")))
        to_cut = bins.where(~few).count()
    found = None
    for rows, done in settled:
        inside = _same(rows, done.drop("_ranks"), keys).select(*dict.fromkeys([*keys, *names]))
        window = Window.partitionBy(*keys).orderBy(*[order.sort() for order in orders])
        if len(orders) > 1:  # keys that should not repeat: neighbours tell
            own_key, one = F.struct(*names), F.lit(1).cast("bigint")
            twice = own_key.eqNullSafe(F.lag(own_key).over(window)) | own_key.eqNullSafe(F.lead(own_key).over(window))
            counted = inside.withColumns({"_before": F.row_number().over(window).cast("bigint") - 1, "_twice": twice, "_n": one})
            repeats = F.when(F.col("_twice"), F.lit(2)).otherwise(F.lit(1)).cast("bigint")
        else:
            distinct = inside.groupBy(*dict.fromkeys([*keys, *names])).agg(F.count(F.lit(1)).alias("_n"))
            counted, repeats = distinct.withColumn("_before", _exclusive(window, "_n")), F.col("_n")
        own = F.filter("_ranks", lambda k: (k["at"] > F.col("_before")) & (k["at"] <= F.col("_before") + F.col("_n")))
        one = _same(counted, done, keys).select(*dict.fromkeys([*by, *names]), repeats.alias("_owners"), F.explode(F.transform(own, lambda k: k["rank"])).alias("_rank"))
        found = one if found is None else found.unionByName(one)
    found = materialize(found, "ranks")
    if len(orders) > 1 and (repeated := found.where("_owners > 1").limit(1).collect()):
        raise ValueError(f"order key {tuple(repeated[0][name] for name in names)} is not unique")
    return found.drop("_owners"), totals


def rows_at_ranks(df: DataFrame, orders: Sequence[Order], ranks: Callable[[Column], Column], by: Sequence[str] = (),
                  rows_per_part: int = ROWS_PER_PART) -> tuple[dict[Group, dict[int, Key]], dict[Group, int]]:
    """``keys_at_ranks`` as values, for groups that are few by nature, such as columns: keys by group and rank, rows by group."""
    found, totals = keys_at_ranks(df, orders, ranks, by, rows_per_part)
    sizes = {tuple(row[name] for name in by): row["_total"] for row in totals.collect() if row["_total"]}
    keys: dict[Group, dict[int, Key]] = {group: {} for group in sizes}
    for row in found.collect():
        keys[tuple(row[name] for name in by)][row["_rank"]] = tuple(row[order.name] for order in orders)
    return keys, sizes


def is_after(orders: Sequence[Order], key: Sequence[Column | None]) -> Column:
    """True for rows that come strictly after the key in the order; a None ends the comparison."""
    test = F.lit(False)
    for order, value in reversed(list(zip(orders, key))):
        if value is None:
            test = F.lit(False)
            continue
        column = F.col(order.name)
        beyond = column > value if order.ascending else column < value
        test = beyond | ((column == value) & test)
    return test


def bucket_number(orders: Sequence[Order], cuts: Sequence[Key]) -> Column:
    """How many of a few cut keys lie before the row: 0 for the first bucket."""
    passed = F.lit(0)
    for key in cuts:
        passed = passed + is_after(orders, [None if value is None else F.lit(value) for value in key]).cast("int")
    return passed


def exact_quantile_buckets(df: DataFrame, orders: Sequence[Order], buckets: int, by: Sequence[str] = (), name: str = "bucket",
                           rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Quantile cut on position, buckets 1..n from the front of the order.

    Row i of n (from 0) goes to ``max(1, ceil(i * buckets / (n - 1)))``. The
    groups' cut keys are a table, at most one row per group, that is joined to
    the rows.
    """

    def ends(total: Column) -> Column:
        def end(d: Column) -> Column:
            steps = d * (total - 1)
            return ((steps - steps % buckets) / buckets).cast("bigint") + 1

        return F.transform(F.sequence(F.lit(1), F.lit(buckets - 1)), end)

    found, totals = keys_at_ranks(df, orders, ends, by, rows_per_part)
    if short := totals.where(F.col("_total") < buckets).limit(1).collect():
        raise ValueError(f"{short[0]['_total']} rows cannot fill {buckets} buckets {tuple(short[0][n] for n in by)}")
    key = F.struct(*[F.col(order.name).alias(f"k{i}") for i, order in enumerate(orders)])
    cuts = found.groupBy(*by).agg(F.collect_list(key).alias("_cuts"))
    placed = _same(df, cuts, by, "left") if by else df.withColumn("_cuts", cuts.select("_cuts").scalar())
    passed = F.filter("_cuts", lambda cut: is_after(orders, [cut[f"k{i}"] for i in range(len(orders))]))
    return placed.withColumn(name, (F.coalesce(F.size(passed), F.lit(0)) + F.lit(1)).cast("int")).drop("_cuts")
