"""Guards. A check yields rows (rule, offender); ``enforce`` turns rows into an error."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VIOLATION_SCHEMA = "rule string, offender string"


class DataCheckError(ValueError):
    """Raised when a check found offending rows."""


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "table") -> None:
    """Fail on absent columns, looking at the schema only."""
    present = set(df.columns)
    missing = [name for name in columns if name not in present]
    if missing:
        raise ValueError(f"{what} lacks required columns: {missing}")


def require_no_duplicate_columns(df: DataFrame, what: str = "table") -> None:
    repeated = sorted({name for name in df.columns if df.columns.count(name) > 1})
    if repeated:
        raise ValueError(f"{what} repeats columns: {repeated}")


def require_fractions(**fractions: float) -> None:
    """Each fraction positive, together 1 within 1e-9."""
    bad = [name for name, value in fractions.items() if value <= 0]
    if bad:
        raise ValueError(f"fractions must be positive: {bad}")
    total = sum(fractions.values())
    if abs(total - 1.0) > 1e-9:
        raise ValueError(f"fractions must add up to 1, got {total}")


def fraction_fault(*names: str) -> Column:
    """W2 for rows: what is wrong with the fractions in these columns, or "fine"."""
    total = reduce(lambda a, b: a + b, [F.col(name) for name in names])
    return (F.when(F.least(*names) <= 0, "fractions must be positive").when(F.abs(total - F.lit(1.0)) > 1e-9, "fractions must add up to 1")
            .otherwise("fine"))


def absent_names(df: DataFrame, fields: str, names: Sequence[str]) -> DataFrame:
    """P5 for records whose fields are a map: the rows that lack required names, with those (``absent``, in the given order)."""
    absent = F.array_except(F.array(*[F.lit(name) for name in names]), F.map_keys(fields))
    return df.withColumn("absent", absent).where(F.size("absent") > 0)


def violations(df: DataFrame, rule: str, offender: Column, where: Column) -> DataFrame:
    return df.where(where).select(F.lit(rule).alias("rule"), offender.cast("string").alias("offender"))


def union_violations(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def duplicate_values(df: DataFrame, column: str, rule: str) -> DataFrame:
    """Values that occur more than once, as violations."""
    repeated = df.groupBy(column).count().where(F.col("count") > 1)
    return violations(repeated, rule, F.col(column), F.lit(True))


def enforce(found: DataFrame, what: str, shown: int = 10) -> None:
    """Raise if the violations table has rows; the message lists a few of them."""
    rows = found.orderBy("rule", "offender").limit(shown).collect()
    if rows:
        detail = "; ".join(f"{row.rule}: {row.offender}" for row in rows)
        raise DataCheckError(f"{what}: {detail}")


def score_check(df: DataFrame, score: str = "p", label: str = "bad_loan", by: Sequence[str] = ()) -> DataFrame:
    """One row per group: rows, unusable scores, unusable labels, number of classes."""
    p, y = F.col(score), F.col(label)
    bad_score = p.isNull() | F.isnan(p) | (p < 0) | (p > 1)
    known = y.isin(0, 1)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(bad_score).alias("invalid_score_count"),
        F.count_if(y.isNull() | ~known).alias("invalid_label_count"),
        (F.max((y == 0).cast("int")) + F.max((y == 1).cast("int"))).cast("int").alias("class_count"),
    )


def enforce_scores(df: DataFrame, score: str = "p", label: str = "bad_loan", by: Sequence[str] = ()) -> None:
    """Fail unless there are rows, scores are finite in [0, 1] and both classes occur."""
    rows = score_check(df, score, label, by).collect()
    if not rows or all(row.row_count == 0 for row in rows):
        raise DataCheckError("no scored rows")
    for row in rows:
        group = {name: row[name] for name in by}
        if row.invalid_score_count:
            raise DataCheckError(f"{row.invalid_score_count} scores missing, not finite or outside [0, 1] {group}")
        if row.invalid_label_count:
            raise DataCheckError(f"{row.invalid_label_count} labels are not 0 or 1 {group}")
        if row.class_count != 2:
            raise DataCheckError(f"both classes are needed {group}")
