"""Chronological splits. Rows are ordered by (date, key); the key must be unique.

A split is fitted to at most a few boundary rows and then applied as a
comparison with them: no row is sorted or moved.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanweft.functions.checks import DataCheckError, require_columns, require_fractions
from loanweft.functions.dates import parse_month_or_fallback
from loanweft.operators.labels import with_domain_share
from loanweft.operators.position import Order, bucket_number, rows_at_ranks
from loanweft.session import literal_table

SPLIT_NAMES = ("train", "validation", "test")
SPLIT_COLUMN = "modeling_split"


def add_parsed_month(df: DataFrame, column: str = "issue_d", parsed: str = "issue_month") -> DataFrame:
    """F5. Month string as date; month form first, then the fallback formats."""
    require_columns(df, [column])
    return df.withColumn(parsed, parse_month_or_fallback(F.col(column)))


def enforce_parsed_months(df: DataFrame, column: str = "issue_d", parsed: str = "issue_month") -> None:
    """Fail on rows without a usable month; missing and unreadable ones are told apart."""
    unread = df.where(F.col(parsed).isNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    rows = unread.orderBy(F.col(column).asc_nulls_first()).limit(11).collect()
    if rows:
        missing = sum(row.n for row in rows if row[column] is None)
        examples = [row[column] for row in rows if row[column] is not None][:10]
        raise DataCheckError(f"{column}: {missing} missing, unreadable values such as {examples}")


@dataclass(frozen=True)
class PositionSplit:
    """Boundary keys between consecutive parts."""

    orders: tuple[Order, ...]
    boundaries: tuple[tuple, ...]
    names: tuple[str, ...]

    def part(self) -> Column:
        number = bucket_number(self.orders, self.boundaries)
        return F.element_at(F.array(*[F.lit(name) for name in self.names]), number + F.lit(1))

    def apply(self, df: DataFrame, column: str = SPLIT_COLUMN) -> DataFrame:
        return df.withColumn(column, self.part())


def _fit(df: DataFrame, date: str, key: str, names: Sequence[str], ends, whole_months: bool, **tuning) -> PositionSplit:
    orders = (Order(date), Order(key))
    found, sizes = rows_at_ranks(df, orders, lambda n: F.array(*ends(n)), **tuning)
    keys = found.get((), {})
    if len(keys) != len(names) - 1:
        raise DataCheckError("too few rows: every part of the split needs at least one row")
    boundaries = [keys[k] for k in sorted(keys)]
    if whole_months:
        boundaries = [(boundary[0], None) for boundary in boundaries]
    return PositionSplit(orders, tuple(boundaries), tuple(names))


def fit_time_split(df: DataFrame, date: str = "issue_month", key: str = "id", train: float = 0.70,
                   validation: float = 0.15, test: float = 0.15, whole_months: bool = False,
                   **tuning: int) -> PositionSplit:
    """W1. First ``int(n * train)`` rows, next ``int(n * validation)``, the rest.

    ``whole_months`` moves each boundary to the end of its month.
    """
    require_fractions(train=train, validation=validation, test=test)

    def ends(rows: Column) -> list[Column]:
        first = F.floor(rows * F.lit(train)).cast("bigint")
        return [first, first + F.floor(rows * F.lit(validation)).cast("bigint")]

    return _fit(df, date, key, SPLIT_NAMES, ends, whole_months, **tuning)


def fit_halving(df: DataFrame, date: str = "issue_month", key: str = "id", fraction: float = 0.5,
                names: Sequence[str] = ("calibration_fit", "calibration_comparison"), **tuning: int) -> PositionSplit:
    """W3. First ``int(n * fraction)`` rows in time order against the rest."""
    if not 0 < fraction < 1:
        raise ValueError("fraction must lie between 0 and 1")
    return _fit(df, date, key, names, lambda rows: [F.floor(rows * F.lit(fraction)).cast("bigint")], False, **tuning)


def split_summary(df: DataFrame, date: str = "issue_month", target: str = "bad_loan", split: str = SPLIT_COLUMN,
                  names: Sequence[str] = SPLIT_NAMES) -> DataFrame:
    """A21. Rows, share, date range and outcomes per split, in the given order."""
    domain = literal_table(df.sparkSession, list(enumerate(names)), "_order int, split string")
    y = F.col(target)
    parts = df.groupBy(F.col(split).alias("split")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min(date).alias("date_min"), F.max(date).alias("date_max"),
        F.count_if(y == 0).alias("good_loan_count"), F.count_if(y == 1).alias("bad_loan_count"))
    zero = F.lit(0).cast("long")
    filled = domain.join(parts, "split", "left").select(
        "_order", "split", *[F.coalesce(name, zero).alias(name)
                             for name in ("row_count", "good_loan_count", "bad_loan_count")], "date_min", "date_max")
    return with_domain_share(filled, "row_count", "row_percentage").orderBy("_order").select(
        "split", "row_count", "row_percentage", "date_min", "date_max", "good_loan_count", "bad_loan_count",
        F.coalesce(F.try_divide("bad_loan_count", "row_count"), F.lit(0.0)).alias("bad_loan_rate"))
