"""Checks and integrity reports over one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanweft.functions.checks import DataCheckError, require_columns, require_no_duplicate_columns
from loanweft.functions.dates import MONTH_FORMAT, month_text, parse_month
from loanweft.operators.labels import add_target



def labeled_table_check(df: DataFrame, target: str = "bad_loan", expected_rows: int | None = None) -> DataFrame:
    """A5, A20. Row count, missing and foreign labels, classes present."""
    require_columns(df, [target])
    require_no_duplicate_columns(df)
    y = F.col(target)
    count = F.count(F.lit(1))
    matches = count == F.lit(expected_rows) if expected_rows is not None else count > 0
    has_good, has_bad = F.count_if(y == 0) > 0, F.count_if(y == 1) > 0
    foreign = F.count_if(~y.isin(0, 1))
    return df.agg(
        count.alias("row_count"),
        matches.alias("row_count_as_expected"),
        F.count_if(y.isNull()).alias("missing_target_count"),
        foreign.alias("unexpected_target_count"),
        (has_good & has_bad & (foreign == 0)).alias("target_values_are_0_and_1"),
    )


def enforce_labeled_table(df: DataFrame, target: str = "bad_loan", expected_rows: int | None = None,
                          both_classes: bool = True) -> None:
    row = labeled_table_check(df, target, expected_rows).first()
    if not row.row_count_as_expected:
        raise DataCheckError(f"{row.row_count} rows, expected {expected_rows or 'at least one'}")
    if row.missing_target_count:
        raise DataCheckError(f"{row.missing_target_count} rows without {target}")
    if row.unexpected_target_count or (both_classes and not row.target_values_are_0_and_1):
        raise DataCheckError(f"{target} must hold the values 0 and 1")


def per_column(df: DataFrame, columns: Sequence[str], **measures: Sequence[Column]) -> DataFrame:
    """One row per column with its aggregates, all computed in one scan without a shuffle of rows."""
    counts = df.agg(F.count(F.lit(1)).alias("total_count"),
                    *[F.array(*columns_of).alias(name) for name, columns_of in measures.items()])
    kinds = dict(df.dtypes)
    zipped = F.arrays_zip(
        F.array(*[F.lit(name) for name in columns]).alias("column_name"),
        F.array(*[F.lit(kinds[name]) for name in columns]).alias("dtype"),
        *[F.col(name) for name in measures])
    return counts.select(F.inline(zipped), F.col("total_count")).select("column_name", "dtype", "total_count", *measures)


def missing_counts(columns: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(f"`{name}`").isNull()) for name in columns]


def count_missing(df: DataFrame) -> DataFrame:
    """Rows (column_name, dtype, total_count, missing_count)."""
    return per_column(df, df.columns, missing_count=missing_counts(df.columns))


def missingness_report(df: DataFrame) -> DataFrame:
    """A6. Missing count and share per column, most missing first."""
    share = F.coalesce(F.try_divide("missing_count", "total_count"), F.lit(0.0))
    return (
        count_missing(df)
        .select("column_name", "dtype", "missing_count", share.alias("missing_percentage"))
        .orderBy(F.desc("missing_percentage"), "column_name")
    )


def _row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of the row. The null flags keep (1, NULL) and (NULL, 1) apart."""
    values = [F.col(f"`{name}`") for name in columns]
    flags = [value.isNull() for value in values]
    return [F.xxhash64(F.lit(seed), *values, *flags).alias(f"_hash{seed}") for seed in (1, 2)]


def duplicate_groups(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Size of every group of equal rows, as (group_size, groups).

    Rows are first counted by hash, which shuffles 16 bytes a row. Those whose
    hash repeats are confirmed by their smallest and largest row, which are the
    same; where not, they are grouped by all their columns, so equal hashes of
    different rows do no harm.
    """
    columns = list(columns or df.columns)
    df = df.select(*[F.col(f"`{name}`") for name in columns])
    sized = F.count(F.lit(1)).alias("group_size")
    keys = ["_hash1", "_hash2"]
    hashed = df.select("*", *_row_hashes(columns))
    per_hash = hashed.groupBy(*keys).agg(sized)
    repeated = hashed.join(per_hash.where("group_size > 1").select(*keys), keys, "left_semi")
    whole = F.struct(*[F.col(f"`{name}`") for name in columns])
    found = repeated.groupBy(*keys).agg(sized, F.min(whole).alias("_low"), F.max(whole).alias("_high"))
    alike = F.col("_low").eqNullSafe(F.col("_high"))
    several = repeated.join(found.where(~alike).select(*keys), keys, "left_semi").groupBy(
        *[F.col(f"`{name}`") for name in columns]).agg(sized)
    sizes = per_hash.where("group_size = 1").select("group_size").unionByName(
        found.where(alike).select("group_size")).unionByName(several.select("group_size"))
    return sizes.groupBy("group_size").agg(F.count(F.lit(1)).alias("groups"))


def duplicate_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A7. Exact duplicate rows, NULL equal to NULL."""
    size, groups = F.col("group_size"), F.col("groups")
    zero = F.lit(0).cast("long")
    total = F.coalesce(F.sum(size * groups), zero)
    redundant = F.coalesce(F.sum((size - 1) * groups), zero)
    return duplicate_groups(df, columns).agg(
        total.alias("total_rows"),
        F.coalesce(F.sum(F.when(size > 1, size * groups)), zero).alias("rows_in_duplicate_groups"),
        redundant.alias("redundant_duplicate_rows"),
        (total - redundant).alias("unique_rows_after_deduplication"),
        F.coalesce(F.try_divide(redundant, total), F.lit(0.0)).alias("redundant_duplicate_percentage"),
    )


def identifier_integrity(df: DataFrame, identifier: str = "id") -> DataFrame:
    """A9. Missing and repeated identifiers. Missing ones count as equal to each other."""
    require_columns(df, [identifier])
    key = F.col(identifier)
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    # groups of one size are folded before the final step, keyed only by size and nullness
    folded = per_key.groupBy("n", key.isNull().alias("missing")).agg(F.count(F.lit(1)).alias("groups"))
    zero = F.lit(0).cast("long")
    n, groups, missing = F.col("n"), F.col("groups"), F.col("missing")
    return folded.agg(
        F.coalesce(F.sum(n * groups), zero).alias("total_rows"),
        F.coalesce(F.sum(F.when(missing, n * groups)), zero).alias("missing_identifier_count"),
        F.coalesce(F.sum(F.when(~missing, groups)), zero).alias("unique_identifier_count"),
        F.coalesce(F.sum(F.when(n > 1, n * groups)), zero).alias("rows_in_duplicate_identifier_groups"),
        F.coalesce(F.sum((n - 1) * groups), zero).alias("redundant_duplicate_identifier_count"),
    ).select(
        F.lit(identifier).alias("identifier_column"), "*",
        (F.col("missing_identifier_count") == 0).alias("identifier_is_complete"),
        (F.col("redundant_duplicate_identifier_count") == 0).alias("identifier_is_unique"),
    )


def issue_date_integrity(df: DataFrame, column: str = "issue_d",
                         formats: Sequence[str] = (MONTH_FORMAT,)) -> DataFrame:
    """A10. Missing and unreadable months, range of months.

    Rows are folded to distinct raw strings first, so the parser runs once per
    distinct month after the map-side combine.
    """
    require_columns(df, [column])
    raw = df.groupBy(F.col(column).alias("raw")).agg(F.count(F.lit(1)).alias("n"))
    parsed = raw.withColumn("month", parse_month(F.col("raw"), formats))
    per_month = parsed.groupBy("month").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("raw").isNull(), F.col("n")).otherwise(0)).alias("missing"))
    zero = F.lit(0).cast("long")
    return per_month.agg(
        F.coalesce(F.sum("n"), zero).alias("total_rows"),
        F.coalesce(F.sum("missing"), zero).alias("missing_raw_issue_date_count"),
        F.coalesce(F.sum(F.when(F.col("month").isNull(), F.col("n") - F.col("missing"))), zero)
        .alias("invalid_issue_date_count"),
        F.count("month").alias("unique_issue_month_count"),
        month_text(F.min("month")).alias("earliest_issue_month"),
        month_text(F.max("month")).alias("latest_issue_month"),
    ).select(
        F.lit(column).alias("date_column"), "*",
        (F.col("missing_raw_issue_date_count") == 0).alias("issue_dates_are_complete"),
        (F.col("invalid_issue_date_count") == 0).alias("issue_dates_are_parseable"),
    )


def enforce_identifier(report: DataFrame) -> None:
    row = report.first()
    if not row.identifier_is_complete:
        raise DataCheckError(f"{row.identifier_column}: {row.missing_identifier_count} missing values")
    if not row.identifier_is_unique:
        raise DataCheckError(f"{row.identifier_column}: {row.redundant_duplicate_identifier_count} redundant duplicates")


def enforce_issue_dates(report: DataFrame) -> None:
    row = report.first()
    if not row.issue_dates_are_complete:
        raise DataCheckError(f"{row.date_column}: {row.missing_raw_issue_date_count} missing values")
    if not row.issue_dates_are_parseable:
        raise DataCheckError(f"{row.date_column}: {row.invalid_issue_date_count} unreadable values")


def labeled_counts(df: DataFrame, status: str = "loan_status", target: str = "bad_loan") -> DataFrame:
    """Rows before labeling, rows kept, rows left out."""
    y = add_target(df, status, target)
    return y.agg(
        F.count(F.lit(1)).alias("raw_row_count"),
        F.count(target).alias("labeled_row_count"),
        F.count_if(F.col(target).isNull()).alias("excluded_row_count"),
    )
