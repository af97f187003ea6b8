"""Feature preparation as one saved ``PipelineModel`` of built-in stages.

Statistics are exact: medians by rank, population deviation, categories in
code-point order. The fitted numbers go into a ``SQLTransformer``, so nothing
custom is needed to load the pipeline elsewhere.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from loanweft.functions.checks import DataCheckError, require_columns
from loanweft.operators.position import Order, row_positions, rows_at_ranks
from loanweft.session import literal_table, materialize

MISSING_CATEGORY = "Missing"
SKETCH = 2_000  # size of the sketch that says where a column's middle lies
BRACKET = 0.01  # share of the rows on either side of the middle that are ranked


@dataclass(frozen=True)
class NumericStatistics:
    median: float
    mean: float
    scale: float


def _middle_ranks(rows: Column) -> Column:
    half = ((rows - rows % 2) / 2).cast("bigint")
    return F.array(half + rows % 2, half + 1)


def _sketched(df: DataFrame, columns: Sequence[str], more: Sequence[Column] = ()) -> tuple[list[Column], Row]:
    """The columns as doubles, and one row of one scan: per column its values and two cut points around the middle, then ``more``."""
    doubles = [F.col(f"`{name}`").cast("double") for name in columns]
    shares = F.array(F.lit(0.5 - BRACKET), F.lit(0.5 + BRACKET))
    cuts = [F.when(F.count(value) > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(value, F.lit(SKETCH)), shares)) for value in doubles]
    return doubles, df.agg(*[F.struct(F.count(value).alias("n"), cut.alias("cuts")).alias(f"c{i}") for i, (value, cut) in enumerate(zip(doubles, cuts))], *more).first()


def exact_medians(df: DataFrame, columns: Sequence[str], **tuning: int) -> dict[str, float]:
    """Median of the non-missing values per column, mean of the middle two for an even count.

    One aggregation over the wide rows sketches every column; the next counts,
    exactly, the values below and between two cut points around each middle.
    Only the values between them, a small share, are made rows of their own,
    ranked and picked from. A column whose cut points miss the middle is ranked
    whole.
    """
    if not columns:
        return {}
    return _medians(df, columns, *_sketched(df, columns), **tuning)


def _medians(df: DataFrame, columns: Sequence[str], doubles: Sequence[Column], sketched: Row, **tuning: int) -> dict[str, float]:
    present = [i for i in range(len(columns)) if sketched[i].n]
    if not present:
        return {}
    cuts = {i: tuple(sketched[i].cuts) for i in present}
    counted = df.agg(*[F.struct(F.count_if(doubles[i] < cuts[i][0]).alias("below"), F.count_if(doubles[i].between(*cuts[i])).alias("between")).alias(f"c{i}")
                       for i in present]).first()
    offsets = {}
    for i, found in zip(present, counted):
        first, last = (sketched[i].n + 1) // 2, sketched[i].n // 2 + 1
        if not (found.below < first and last <= found.below + found.between):
            cuts[i], offsets[i] = (-math.inf, math.inf), 0
        else:
            offsets[i] = found.below
    cells = F.array(*[F.when(doubles[i].between(*cuts[i]), F.struct(F.lit(i).alias("_column"), doubles[i].alias("_value"))) for i in present])
    inside = materialize(df.select(F.inline(F.array_compact(cells))), "middles")
    total, offset = (F.element_at(F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair]), F.col("_column"))
                     for numbers in ({i: sketched[i].n for i in present}, offsets))
    found, _ = rows_at_ranks(inside, [Order("_value")], lambda _: F.transform(_middle_ranks(total), lambda k: k - offset), ["_column"], **tuning)
    return {columns[group[0]]: sum(key[0] for key in keys.values()) / len(keys) for group, keys in found.items()}


def numeric_statistics(df: DataFrame, columns: Sequence[str], **tuning: int) -> dict[str, NumericStatistics]:
    """M1. Median, and mean and population deviation after the median has filled the gaps.

    The moments of the filled column follow from those of the present values,
    so the scan that sketches the columns takes them too. A column with one
    value is divided by 1.
    """
    if not columns:
        return {}
    measures = [F.count(F.lit(1)).alias("_rows")]
    for i, name in enumerate(columns):
        column = F.col(f"`{name}`").cast("double")
        measures += [F.avg(column).alias(f"m{i}"), F.var_pop(column).alias(f"v{i}"), F.min(column).alias(f"low{i}"), F.max(column).alias(f"high{i}")]
    doubles, row = _sketched(df, columns, measures)
    if empty := [name for i, name in enumerate(columns) if not row[i].n]:
        raise DataCheckError(f"numeric columns without values: {empty}")
    medians = _medians(df, columns, doubles, row, **tuning)
    result = {}
    for i, name in enumerate(columns):
        rows, present, mean, variance = row["_rows"], row[i].n, row[f"m{i}"], row[f"v{i}"]
        gaps, median = rows - present, medians[name]
        if row[f"low{i}"] == row[f"high{i}"]:
            result[name] = NumericStatistics(median, median, 1.0)
            continue
        filled_mean = (present * mean + gaps * median) / rows
        filled_variance = (present * variance + present * gaps / rows * (mean - median) ** 2) / rows
        result[name] = NumericStatistics(median, filled_mean, math.sqrt(filled_variance))
    return result


def categories(df: DataFrame, columns: Sequence[str], max_categories: int | None = None) -> dict[str, list[str]]:
    """M2. Categories per column in code-point order, missing values as one of them.

    Every category is a slot of the vectors and so is listed; ``max_categories``
    refuses a column with more of them.
    """
    if not columns:
        return {}
    filled = df.select(*[filled_category(name).alias(name) for name in columns])
    long = filled.unpivot([], list(columns), "column_name", "value").groupBy("column_name", "value").count()
    if max_categories is not None and (wide := long.groupBy("column_name").agg(F.count("*").alias("n")).where(
            F.col("n") > max_categories).collect()):
        raise DataCheckError(f"more than {max_categories} categories in {sorted(row.column_name for row in wide)}")
    rows = long.select("column_name", "value").collect()
    listed: dict[str, list[str]] = {name: [] for name in columns}
    for row in rows:
        listed[row.column_name].append(row.value)
    return {name: sorted(values) for name, values in listed.items()}


def category_dictionary(df: DataFrame, columns: Sequence[str], first_slot: int = 0, **tuning: int) -> DataFrame:
    """M2 without a list on the driver: (column_name, value, slot) of every category, slots by column and code point.

    For columns with as many categories as a table has keys; ``slotted`` joins
    it to rows. Slots begin at ``first_slot``, after those of the numbers.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("column_number"), filled_category(name).alias("value")) for i, name in enumerate(columns)])
    found = df.select(F.inline(cells)).distinct()
    placed = row_positions(found, [Order("column_number"), Order("value")], name="place", **tuning)
    names = F.get(F.array(*[F.lit(name) for name in columns]), F.col("column_number"))
    return placed.select(names.alias("column_name"), "value", (F.col("place") - 1 + first_slot).cast("bigint").alias("slot"))


def slotted(df: DataFrame, key: str, columns: Sequence[str], dictionary: DataFrame) -> DataFrame:
    """(key, slots): of every row the slots that are 1, ascending: a sparse vector of zeros and ones.

    A category that the dictionary lacks has no slot. ``key`` must be unique.
    """
    cells = F.array(*[F.struct(F.lit(name).alias("column_name"), filled_category(name).alias("value")) for name in columns])
    long = df.select(key, F.inline(cells)).join(dictionary, ["column_name", "value"], "left")
    return long.groupBy(key).agg(F.array_sort(F.collect_list("slot")).alias("slots"))  # one a column at most; a missing slot is left out


def filled_category(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(MISSING_CATEGORY))


def scaled_value(name: str, statistics: NumericStatistics) -> Column:
    filled = F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(statistics.median))
    return (filled - F.lit(statistics.mean)) / F.lit(statistics.scale)


@dataclass(frozen=True)
class FeatureColumns:
    """Features by treatment, each in its order, and those left out."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    excluded: tuple[str, ...] = ()

    @property
    def used(self) -> list[str]:
        return [*self.numeric, *self.categorical]


@dataclass(frozen=True)
class FittedFeatures:
    """Fitted preparation: pipeline and names of the vector slots."""

    pipeline: PipelineModel
    names: tuple[str, ...]
    statistics: Mapping[str, NumericStatistics]
    categories: Mapping[str, Sequence[str]]

    def transform(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        return self.pipeline.transform(df).select(*keep, "features")


def feature_names(columns: FeatureColumns, found: Mapping[str, Sequence[str]]) -> list[str]:
    """M4. Slot names, values verbatim."""
    numeric = [f"numeric__{name}" for name in columns.numeric]
    return numeric + [f"categorical__{name}_{value}" for name in columns.categorical for value in found[name]]


def _statement(columns: FeatureColumns, statistics: Mapping[str, NumericStatistics]) -> str:
    parts = ["*"]
    for i, name in enumerate(columns.numeric):
        s = statistics[name]
        parts.append(f"(coalesce(cast(`{name}` as double), {s.median!r}D) - ({s.mean!r}D)) / ({s.scale!r}D) AS _num{i}")
    for i, name in enumerate(columns.categorical):
        parts.append(f"coalesce(cast(`{name}` as string), '{MISSING_CATEGORY}') AS _cat{i}")
    return f"SELECT {', '.join(parts)} FROM __THIS__"


def fit_features(train: DataFrame, columns: FeatureColumns, **tuning: int) -> FittedFeatures:
    """M1 to M4. Fit on the training rows only.

    A category not seen in training has no slot and is all zeros: the indexer
    sends it to an extra index, which is the one the encoder drops.
    """
    require_columns(train, columns.used)
    if not columns.used:
        raise ValueError("no features")
    statistics = numeric_statistics(train, columns.numeric, **tuning)
    found = categories(train, columns.categorical)
    stages = [SQLTransformer(statement=_statement(columns, statistics))]
    inputs = [f"_num{i}" for i in range(len(columns.numeric))]
    if columns.categorical:
        numbers = range(len(columns.categorical))
        for i in numbers:
            stages.append(StringIndexerModel.from_labels(
                list(found[columns.categorical[i]]), inputCol=f"_cat{i}", outputCol=f"_idx{i}", handleInvalid="keep"))
        encoder = OneHotEncoder(inputCols=[f"_idx{i}" for i in numbers], outputCols=[f"_hot{i}" for i in numbers],
                                dropLast=True)
        # sizes come from the indexer's column metadata, so no row is read here
        stages.append(encoder.fit(PipelineModel(stages).transform(train)))
        inputs += [f"_hot{i}" for i in numbers]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return FittedFeatures(PipelineModel(stages), tuple(feature_names(columns, found)), statistics, found)


def nonzero_counts(df: DataFrame, split: str, vector: str = "features") -> DataFrame:
    """(split, nonzeros): nonzero values per split, summed per slot without making the vectors dense."""
    per_slot = df.groupBy(split).agg(Summarizer.metrics("numNonZeros").summary(F.col(vector)).alias("m"))
    total = F.aggregate(vector_to_array(F.col("m.numNonZeros")), F.lit(0.0), lambda a, b: a + b)
    return per_slot.select(split, total.cast("bigint").alias("nonzeros"))


def preprocessing_summary(inputs: DataFrame, prepared: DataFrame, columns: FeatureColumns, names: Sequence[str],
                          split: str = "modeling_split",
                          splits: Sequence[str] = ("train", "validation", "test")) -> DataFrame:
    """A22. Metric and value rows: rows in and out, features by kind, nonzero values."""
    counted = inputs.agg(*[F.count_if(F.col(split) == s).alias(f"{s}_input_rows") for s in splits])
    counts = prepared.groupBy(split).agg(F.count(F.lit(1)).alias("rows")).join(nonzero_counts(prepared, split), split)
    made = counts.agg(*[F.coalesce(F.sum(F.when(F.col(split) == s, F.col(value))), F.lit(0).cast("long")).alias(f"{s}_{name}")
                        for value, name in (("rows", "preprocessed_rows"), ("nonzeros", "nonzero_values")) for s in splits])
    spark = inputs.sparkSession
    fixed = literal_table(spark,
        [("preprocessed_feature_count", len(names)), ("numeric_feature_count", len(columns.numeric)),
         ("categorical_feature_count", len(columns.categorical)), ("excluded_feature_count", len(columns.excluded))],
        "metric string, value long")
    rows = counted.unpivot([], counted.columns, "metric", "value").unionByName(
        made.unpivot([], made.columns, "metric", "value")).unionByName(fixed)
    order = [f"{s}_input_rows" for s in splits] + [f"{s}_preprocessed_rows" for s in splits] + [
        "preprocessed_feature_count", "numeric_feature_count", "categorical_feature_count",
        "excluded_feature_count"] + [f"{s}_nonzero_values" for s in splits]
    position = F.array_position(F.array(*[F.lit(name) for name in order]), F.col("metric"))
    return rows.orderBy(position)
