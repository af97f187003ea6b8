"""Per-column statistics and feature-type inference.

Distinct values are counted by a 128-bit hash, combined map-side, so a shuffle
carries a few numbers per distinct value whatever its length. Date rates and
integer flags come from the scan itself. Sample values are chosen from the same
hashes by their first row; only the few chosen ones are read again as text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanweft.functions.checks import require_columns
from loanweft.functions.dates import FALLBACK_FORMATS, MONTH_FORMAT, parse_month
from loanweft.functions.text import non_blank
from loanweft.operators.quality import count_missing, missing_counts, per_column
from loanweft.session import literal_table, materialize

DATE_FORMATS = (MONTH_FORMAT, *FALLBACK_FORMATS)

# Thresholds of the type rules.
LOW_CARDINALITY = 20
DISCRETE_DISTINCT = 50
DISCRETE_RATIO = 0.02
DATE_SUCCESS = 0.90
HIGH_MISSINGNESS = 0.40

SKETCH_BITS = 16  # registers of a distinct-value sketch, as a power of two

# Columns of a feature-type profile, in order.
PROFILE_COLUMNS = (
    "column_name", "inferred_feature_type", "recommended_preprocessing_group", "needs_manual_review",
    "issue_flags", "dtype", "total_count", "non_missing_count", "missing_count", "missing_percentage",
    "unique_non_missing_count", "unique_non_missing_ratio", "is_numeric", "is_integer_like",
    "date_parse_success_rate", "sample_values",
)


def is_numeric_type(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType))


def _as_text(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        column = column + F.lit(0.0)  # -0.0 and 0.0 are one value
    return column.cast("string")


def _with_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``_t0``, ...: trimmed text of the columns that are no numbers, NULL when blank.

    A projection of its own, so that a text is trimmed once however often it is used.
    """
    return df.select("*", *[non_blank(_as_text(df, name)).alias(f"_t{i}") for i, name in enumerate(columns)
                            if not is_numeric_type(df.schema[name].dataType)])


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _cells(df: DataFrame, columns: Sequence[str], row_key: str | None = None) -> DataFrame:
    """Number of the column and two hashes of every non-missing cell; with ``row_key`` also the key and those of its trimmed text.

    Numbers are hashed as they are: they are distinct as their texts are. The
    hashes of a trimmed text are NULL where nothing had to be trimmed, and
    ``_blank`` says that nothing is left.
    """
    prepared = df.select(*[_hashable(df, name).alias(f"_v{i}") for i, name in enumerate(columns)],
                         *[non_blank(F.col(f"`{name}`")).alias(f"_t{i}") for i, name in enumerate(columns) if row_key and _is_text(df, name)],
                         *([F.col(f"`{row_key}`").alias("_key")] if row_key else []))

    def hashes(column: Column, name: str) -> list[Column]:
        return [F.when(column.isNotNull(), F.xxhash64(F.lit(seed), column)).alias(f"{name}{seed}") for seed in (1, 2)]

    def cell(number: int, name: str) -> Column:
        value, more = F.col(f"_v{number}"), []
        if row_key:
            text = F.col(f"_t{number}")
            trimmed = F.when(text != value, text) if _is_text(df, name) else F.lit(None).cast("string")
            more = [(value.isNotNull() & text.isNull() if _is_text(df, name) else F.lit(False)).alias("_blank"), *hashes(trimmed, "_trim")]
        return F.struct(F.lit(number).alias("_column"), *hashes(value, "_hash"), *more)

    listed = F.array(*[cell(number, name) for number, name in enumerate(columns)])
    return prepared.select(*(["_key"] if row_key else []), F.inline(listed)).where(F.col("_hash1").isNotNull())


def _hashable(df: DataFrame, name: str) -> Column:
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return column + F.lit(0.0)  # -0.0 and 0.0 are one value
    if isinstance(kind, (T.StringType, T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return column
    return column.cast("string")


def _named(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in columns]), F.col("_column") + 1).alias("column_name")


def _counted(values: DataFrame, columns: Sequence[str]) -> DataFrame:
    return values.groupBy("_column").agg(F.count(F.lit(1)).alias("unique_non_missing_count")).select(
        _named(values, columns), "unique_non_missing_count")


def distinct_counts(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """(column_name, unique_non_missing_count), exact or by sketch."""
    if exact:
        return _counted(_cells(df, columns).distinct(), columns)
    sketches = F.array(*[F.approx_count_distinct(_as_text(df, name)) for name in columns])
    names = F.array(*[F.lit(name) for name in columns])
    one = df.agg(sketches.alias("counts"))
    return one.select(F.inline(F.arrays_zip(
        names.alias("column_name"), F.col("counts").alias("unique_non_missing_count"))))


def distinct_cells(df: DataFrame, columns: Sequence[str], row_key: str) -> DataFrame:
    """Every column's distinct values by hash, each with the hash of its trimmed text and its first row; written.

    One shuffle, from which counts and samples follow.
    """
    per_value = _cells(df, columns, row_key).groupBy("_column", "_hash1", "_hash2").agg(
        F.max("_blank").alias("_blank"), F.max("_trim1").alias("_trim1"), F.max("_trim2").alias("_trim2"), F.min("_key").alias("_key"))
    return materialize(per_value, "distinct-cells")


def column_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """A8. Distinct values, missingness and constant flag per column, fewest distinct first."""
    distinct = distinct_counts(df, df.columns, exact)
    unique = F.coalesce("unique_non_missing_count", F.lit(0).cast("long"))
    share = F.coalesce(F.try_divide("missing_count", "total_count"), F.lit(0.0))
    return (
        count_missing(df).join(distinct, "column_name", "left")
        .select("column_name", "dtype", unique.alias("unique_non_missing_count"), "missing_count",
                share.alias("missing_percentage"), (unique <= 1).alias("is_constant_non_missing"))
        .orderBy("unique_non_missing_count", "column_name")
    )


def profile_state(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A8. One row per column that merges with those of later loads: counts, moments, extremes and a sketch of the distinct values.

    Columns: column_name, total_count, missing_count, low, high (as text for
    texts, else as numbers), total, squares and sketch.
    """
    measures = []
    for name in columns:
        column, number = F.col(f"`{name}`"), is_numeric_type(df.schema[name].dataType)
        value = column.cast("double") if number else F.lit(None).cast("double")
        text = _as_text(df, name)
        measures.append(F.struct(
            F.lit(name).alias("column_name"), F.count(F.lit(1)).alias("total_count"), F.count_if(column.isNull()).alias("missing_count"),
            F.min(value).alias("low"), F.max(value).alias("high"), F.sum(value).alias("total"), F.sum(value * value).alias("squares"),
            F.hll_sketch_agg(text, F.lit(SKETCH_BITS)).alias("sketch")))
    return df.agg(F.array(*measures).alias("states")).select(F.inline("states"))


def merged_states(states: DataFrame) -> DataFrame:
    """States of several loads, in one table, merged per column."""
    return states.groupBy("column_name").agg(
        F.sum("total_count").alias("total_count"), F.sum("missing_count").alias("missing_count"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.hll_union_agg("sketch").alias("sketch"))


def profile_of_state(states: DataFrame) -> DataFrame:
    """The column profile that a state gives; distinct values are estimated, with a standard error of 0.4 %."""
    present = F.col("total_count") - F.col("missing_count")
    distinct, mean = F.least(F.hll_sketch_estimate("sketch"), present), F.try_divide("total", present)
    return states.select(
        "column_name", "total_count", "missing_count", F.coalesce(F.try_divide("missing_count", "total_count"), F.lit(0.0)).alias("missing_percentage"),
        distinct.alias("unique_non_missing_estimate"), "low", "high", mean.alias("mean"),
        F.when(mean.isNotNull(), F.sqrt(F.greatest(F.try_divide("squares", present) - mean * mean, F.lit(0.0)))).alias("deviation"))


def _integer_flags(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    flags = []
    for name in columns:
        kind = df.schema[name].dataType
        column = F.col(f"`{name}`")
        if isinstance(kind, T.BooleanType):
            column = column.cast("int")
        if not is_numeric_type(kind):
            flags.append(F.bool_and(F.lit(False)))
            continue
        whole = F.coalesce(F.try_mod(column, F.lit(1)) == F.lit(0), F.lit(False))
        flags.append(F.bool_and(F.when(column.isNotNull(), whole)))
    return [F.coalesce(flag, F.lit(False)) for flag in flags]


def integer_like(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A13. Whether all non-missing values of a numeric column are whole numbers."""
    return per_column(df, columns, is_integer_like=_integer_flags(df, columns)).select("column_name", "is_integer_like")


def looks_like_date(value: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    return parse_month(value, formats).isNotNull()


def _date_rates(df: DataFrame, columns: Sequence[str], formats: Sequence[str]) -> list[Column]:
    """Aggregates over ``_with_texts``."""
    return [F.max(F.lit(None).cast("double")) if is_numeric_type(df.schema[name].dataType)
            else F.avg(F.when(F.col(f"_t{i}").isNotNull(), looks_like_date(F.col(f"_t{i}"), formats).cast("int"))) for i, name in enumerate(columns)]


def date_parse_rates(df: DataFrame, columns: Sequence[str], formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """A14. Share of non-blank values that read as dates."""
    return per_column(_with_texts(df, columns), columns, date_parse_success_rate=_date_rates(df, columns, formats)).select(
        "column_name", "date_parse_success_rate")


def sample_values(df: DataFrame, columns: Sequence[str], row_key: str, limit: int = 5, cells: DataFrame | None = None) -> DataFrame:
    """A15. First distinct non-blank values by row key, joined; ``cells`` are the columns' ``distinct_cells`` if they are known already.

    Of each column the first few distinct values by row key are taken, which
    Spark picks before it shuffles. Texts that differ by blanks only are one
    value, so a column that shows too few of them gives ten times as many, until
    it has enough or no more. The chosen rows, ``limit`` a column at most, are
    read again as text.
    """
    cells = distinct_cells(df, columns, row_key) if cells is None else cells
    window = Window.partitionBy("_column").orderBy("_key", "_trim1", "_trim2")
    chosen, open_columns, most = [], list(range(len(columns))), 10 * limit
    while open_columns:
        shown = cells.where(~F.col("_blank") & F.col("_column").isin(open_columns))
        shown = shown.withColumns({f"_trim{seed}": F.coalesce(f"_trim{seed}", f"_hash{seed}") for seed in (1, 2)})
        shown = shown.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= most)
        first = shown.groupBy("_column", "_trim1", "_trim2").agg(F.min("_key").alias("_key"))
        first = first.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= limit)
        counted = shown.groupBy("_column").agg(F.count(F.lit(1)).alias("shown"))
        rows = first.join(counted, "_column").collect()  # limit rows a column
        per = {column: [row for row in rows if row["_column"] == column] for column in open_columns}
        open_columns = [column for column, found in per.items() if 0 < len(found) < limit and found[0].shown == most]
        chosen += [(row["_column"], row["_rank"], row["_key"]) for column, found in per.items() if column not in open_columns for row in found]
        most *= 10
    keys, kind = sorted({key for _, _, key in chosen}), df.schema[row_key].dataType
    first = df.sparkSession.createDataFrame(chosen, T.StructType([T.StructField("_column", T.IntegerType()), T.StructField("_rank", T.IntegerType()),
                                                                  T.StructField("_key", kind)]))
    rows = df.where(F.col(f"`{row_key}`").isin(keys))
    listed = F.array(*[F.struct(F.lit(number).alias("_column"), non_blank(_as_text(df, name)).alias("text"), F.col(f"`{row_key}`").alias("_key"))
                       for number, name in enumerate(columns)])
    texts = rows.select(F.inline(listed)).where(F.col("text").isNotNull())
    found = texts.join(first, ["_column", "_key"]).groupBy("_column", "_rank").agg(F.min("text").alias("text"))
    in_order = F.array_sort(F.collect_list(F.struct("_rank", "text")))
    return found.groupBy("_column").agg(in_order.alias("listed")).select(
        _named(df, columns), F.array_join(F.transform("listed", lambda item: item["text"]), ", ").alias("sample_values"))


def column_statistics(df: DataFrame, columns: Sequence[str], row_key: str,
                      formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """A12 with A13 to A15: one row per column, ``position`` keeps the given order."""
    require_columns(df, [*columns, row_key])
    listed = literal_table(df.sparkSession, [(i, name, is_numeric_type(df.schema[name].dataType))
                                             for i, name in enumerate(columns)],
                           "position int, column_name string, is_numeric boolean")
    cells = distinct_cells(df, columns, row_key)
    scanned = per_column(_with_texts(df, columns), columns, missing_count=missing_counts(columns), is_integer_like=_integer_flags(df, columns),
                         date_parse_success_rate=_date_rates(df, columns, formats))
    rows = (
        listed.join(scanned, "column_name")
        .join(_counted(cells, columns), "column_name", "left")
        .join(sample_values(df, columns, row_key, cells=cells), "column_name", "left")
    )
    zero = F.lit(0).cast("long")
    non_missing = F.col("total_count") - F.col("missing_count")
    distinct = F.coalesce("unique_non_missing_count", zero)
    return rows.select(
        "position", "column_name", "dtype", "total_count", non_missing.alias("non_missing_count"), "missing_count",
        F.coalesce(F.try_divide("missing_count", "total_count"), F.lit(0.0)).alias("missing_percentage"),
        distinct.alias("unique_non_missing_count"),
        F.coalesce(F.try_divide(distinct, non_missing), F.lit(0.0)).alias("unique_non_missing_ratio"),
        "is_numeric", "is_integer_like", "date_parse_success_rate",
        F.coalesce("sample_values", F.lit("")).alias("sample_values"),
    )


def infer_feature_types(statistics: DataFrame, low_cardinality: int = LOW_CARDINALITY,
                        discrete_distinct: int = DISCRETE_DISTINCT, discrete_ratio: float = DISCRETE_RATIO,
                        date_success: float = DATE_SUCCESS,
                        high_missingness: float = HIGH_MISSINGNESS) -> DataFrame:
    """A16. Feature type, group and flags from the statistics table."""
    distinct, ratio = F.col("unique_non_missing_count"), F.col("unique_non_missing_ratio")
    empty = F.col("non_missing_count") == 0
    discrete = F.col("is_integer_like") & ((distinct <= discrete_distinct) | (ratio <= discrete_ratio))
    dated = F.coalesce(F.col("date_parse_success_rate") >= date_success, F.lit(False))
    kind = (
        F.when(empty, "all_missing")
        .when(distinct == 1, "constant")
        .when(distinct == 2, "binary_or_two_value")
        .when(F.col("is_numeric") & discrete, "numeric_discrete_or_count")
        .when(F.col("is_numeric"), "numeric_continuous")
        .when(dated, "date_like")
        .when(distinct <= low_cardinality, "categorical_low_cardinality")
        .otherwise("categorical_high_cardinality_or_text")
    )
    typed = statistics.withColumn("inferred_feature_type", kind)
    inferred = F.col("inferred_feature_type")
    group = (
        F.when(inferred.isin("all_missing", "constant"), "problem_column")
        .when(inferred == "binary_or_two_value", "binary")
        .otherwise(inferred)
    )
    flags = F.array_compact(F.array(
        F.when(F.col("missing_percentage") >= high_missingness, "high_missingness"),
        F.when(inferred == "all_missing", "all_missing"),
        F.when(inferred == "constant", "constant_non_missing_value"),
        F.when(inferred == "categorical_high_cardinality_or_text", "high_cardinality_or_text"),
    ))
    # the rate is measured only where no earlier rule has decided
    measured = (~F.col("is_numeric")) & (distinct > 2)
    return typed.select(
        "*", group.alias("recommended_preprocessing_group"), F.array_join(flags, ", ").alias("issue_flags"),
        ((group == "problem_column") | (F.size(flags) > 0)).alias("needs_manual_review"),
    ).withColumn("date_parse_success_rate", F.when(measured, F.col("date_parse_success_rate")))


def feature_type_profile(df: DataFrame, columns: Sequence[str], row_key: str, **thresholds) -> DataFrame:
    """A17. Types of all given columns, those to review first."""
    profile = infer_feature_types(column_statistics(df, columns, row_key), **thresholds)
    return profile.select(*PROFILE_COLUMNS).orderBy(
        F.desc("needs_manual_review"), "recommended_preprocessing_group", "column_name")


def missingness_profile(profile: DataFrame) -> DataFrame:
    """A18. The missingness part of a feature-type profile, most missing first."""
    return profile.select(
        "column_name", "missing_count", "missing_percentage", "non_missing_count", "inferred_feature_type",
        "recommended_preprocessing_group", "needs_manual_review", "issue_flags",
    ).orderBy(F.desc("missing_percentage"), "column_name")


def count_by(df: DataFrame, column: str, count: str = "column_count") -> DataFrame:
    """A11. Rows per value of a catalog column, sorted by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(count)).orderBy(column)
