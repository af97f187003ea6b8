"""Loan outcome from status: 0 good, 1 bad, NULL unresolved."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanweft.functions.checks import require_columns
from loanweft.functions.text import strip
from loanweft.session import literal_table

# Statuses with a resolved outcome, and those left out on purpose.
GOOD_STATUSES = (
    "Fully Paid",
    "Does not meet the credit policy. Status:Fully Paid",
)
BAD_STATUSES = (
    "Charged Off",
    "Default",
    "Does not meet the credit policy. Status:Charged Off",
    "Late (31-120 days)",
)
UNRESOLVED_STATUSES = (
    "Current",
    "In Grace Period",
    "Late (16-30 days)",
)


def add_target(df: DataFrame, status: str = "loan_status", target: str = "bad_loan",
               good: Sequence[str] = GOOD_STATUSES, bad: Sequence[str] = BAD_STATUSES) -> DataFrame:
    """P1. Outcome column from the trimmed status."""
    require_columns(df, [status])
    cleaned = strip(F.col(status))
    return df.withColumn(target, F.when(cleaned.isin(*good), 0).when(cleaned.isin(*bad), 1).cast("int"))


def keep_labeled(df: DataFrame, target: str = "bad_loan") -> DataFrame:
    """P2. Rows with a resolved outcome, as integer."""
    require_columns(df, [target])
    return df.where(F.col(target).isNotNull()).withColumn(target, F.col(target).cast("int"))


def with_share(counts: DataFrame, count: str = "count", share: str = "percentage") -> DataFrame:
    """Add each row's share of the summed counts, for any number of rows.

    The total is a scalar subquery over the same aggregation, whose exchange
    Spark reuses.
    """
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(share, F.coalesce(F.try_divide(F.col(count), total), F.lit(0.0)))


def with_domain_share(table: DataFrame, count: str, share: str) -> DataFrame:
    """Add shares to a table with one row per value of a fixed, short domain
    (outcome, split, decision); its few rows are summed in one window."""
    total = F.sum(count).over(Window.partitionBy())
    return table.withColumn(share, F.coalesce(F.try_divide(F.col(count), total), F.lit(0.0)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """A1. Rows per value; NULL is a value of its own."""
    require_columns(df, [column])
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def status_distribution(df: DataFrame, status: str = "loan_status") -> DataFrame:
    """A2. Count and share of all rows per raw status, missing shown as ``MISSING``."""
    shown = df.select(F.coalesce(F.col(status).cast("string"), F.lit("MISSING")).alias(status))
    return with_share(value_counts(shown, status), share="percentage_of_total_rows").orderBy(status)


def target_counts(df: DataFrame, target: str = "bad_loan") -> DataFrame:
    """A3. Value, count, share."""
    return with_share(value_counts(df, target))


def target_summary(df: DataFrame, target: str = "bad_loan") -> DataFrame:
    """A4. Good, bad and missing in that order, zero where absent."""
    value = F.coalesce(F.col(target).cast("int").cast("string"), F.lit("MISSING"))
    counts = df.select(value.alias(target)).groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    domain = literal_table(df.sparkSession,
        [(0, "0", "good_loan"), (1, "1", "bad_loan"), (2, "MISSING", "excluded_or_unmapped")],
        f"_order int, {target} string, target_label string")
    filled = domain.join(counts, target, "left").withColumn("count", F.coalesce("count", F.lit(0).cast("long")))
    return (
        with_domain_share(filled, "count", "percentage_of_total_rows").orderBy("_order")
        .select(target, "target_label", "count", "percentage_of_total_rows")
    )


def status_categories(df: DataFrame, status: str = "loan_status", good: Sequence[str] = GOOD_STATUSES,
                      bad: Sequence[str] = BAD_STATUSES,
                      unresolved: Sequence[str] = UNRESOLVED_STATUSES) -> DataFrame:
    """Rows per kind of status, so that an unknown status does not pass unseen."""
    cleaned = strip(F.col(status))
    kind = (
        F.when(cleaned.isNull(), "missing").when(cleaned.isin(*good), "good").when(cleaned.isin(*bad), "bad")
        .when(cleaned.isin(*unresolved), "unresolved").otherwise("unmapped")
    )
    return value_counts(df.select(kind.alias("status_category")), "status_category")
