"""Cohort monitoring, risk bands, drift and plausibility.

The documents this library follows name these reports without fixing their
formulas; the formulas are ours.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanweft.operators.evaluation import probability_metrics
from loanweft.operators.position import Order, rows_at_ranks

# Upper edges of the default risk bands; a band holds its upper edge.
BAND_EDGES = (0.05, 0.10, 0.20, 0.35)
BAND_NAMES = ("A", "B", "C", "D", "E")
SMALLEST_SHARE = 1e-6  # stands in for an empty bin, whose logarithm does not exist


def cohort_report(df: DataFrame, cohort: str, exposure: str, score: str = "p", label: str = "bad_loan",
                  decided: str = "decision") -> DataFrame:
    """D1. Loans, exposure, predicted and observed risk, simulated approval rate per cohort."""
    return df.groupBy(cohort).agg(
        F.count(F.lit(1)).alias("loan_count"), F.sum(exposure).alias("total_exposure"),
        F.avg(score).alias("mean_predicted_risk"),
        F.avg((F.col(decided) == "approve").cast("double")).alias("simulated_approval_rate"),
        F.avg(label).alias("observed_bad_loan_rate")).orderBy(cohort)


def risk_score(p: Column, lowest: int = 0, highest: int = 1000) -> Column:
    """D2. Whole-number score, higher for lower risk."""
    return F.round(F.lit(lowest) + (F.lit(highest - lowest)) * (F.lit(1.0) - p)).cast("int")


def risk_band(p: Column, edges: Sequence[float] = BAND_EDGES, names: Sequence[str] = BAND_NAMES) -> Column:
    """D2. Band by upper edge, from a configurable table."""
    if len(names) != len(edges) + 1 or list(edges) != sorted(edges):
        raise ValueError("edges must rise and be one fewer than names")
    band = F.when(p <= F.lit(edges[0]), F.lit(names[0]))
    for edge, name in zip(edges[1:], names[1:]):
        band = band.when(p <= F.lit(edge), F.lit(name))
    return band.when(p.isNotNull(), F.lit(names[-1]))


def band_mix(df: DataFrame, cohort: str, band: str = "risk_band", label: str = "bad_loan") -> DataFrame:
    """D3. Rows, share of the cohort and observed rate per cohort and band."""
    counted = df.groupBy(cohort, band).agg(
        F.count(F.lit(1)).alias("loan_count"), F.avg(label).alias("observed_bad_loan_rate"))
    share = F.col("loan_count") / F.sum("loan_count").over(Window.partitionBy(cohort))
    return counted.withColumn("cohort_share", share).orderBy(cohort, band)


def quantile_edges(df: DataFrame, column: str, bins: int = 10, **tuning: int) -> list[float]:
    """D4. Exact upper edges of equal-frequency bins: values at ranks ``ceil(i n / bins)``."""

    def ranks(rows: Column) -> Column:
        over = [F.lit(i) * rows + (bins - 1) for i in range(1, bins)]
        return F.array(*[((x - x % bins) / bins).cast("bigint") for x in over])

    found, _ = rows_at_ranks(df.where(F.col(column).isNotNull()), [Order(column)], ranks, **tuning)
    return sorted({float(key[0]) for key in found.get((), {}).values()})


def stability_index(df: DataFrame, column: str, cohort: str, reference: DataFrame, edges: Sequence[float]) -> DataFrame:
    """D4. Population stability index of each cohort against the reference rows."""
    value = F.col(column)
    index = F.lit(0)
    for edge in edges:
        index = index + (value > F.lit(float(edge))).cast("int")
    bins = len(edges) + 1
    counted = df.where(value.isNotNull()).groupBy(cohort).agg(
        F.array(*[F.count_if(index == i) for i in range(bins)]).alias("n"), F.count(F.lit(1)).alias("loan_count"))
    base = reference.where(value.isNotNull()).agg(
        F.array(*[F.count_if(index == i) / F.count(F.lit(1)) for i in range(bins)]).alias("base"))
    floor = F.lit(SMALLEST_SHARE)
    actual = F.transform("n", lambda n: F.greatest(n / F.col("loan_count"), floor))
    expected = F.transform("base", lambda share: F.greatest(share, floor))
    terms = F.zip_with("actual", "expected", lambda a, e: (a - e) * F.ln(a / e))
    return (
        counted.withColumn("base", base.scalar())
        .select(cohort, "loan_count", actual.alias("actual"), expected.alias("expected"))
        .select(cohort, "loan_count", F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
                .alias("population_stability_index"))
        .orderBy(cohort)
    )


@dataclass(frozen=True)
class Rule:
    """One plausibility rule: ``holds`` must be true, NULL counts as a breach."""

    name: str
    holds: Column


def required(column: str) -> Rule:
    return Rule(f"{column}_present", F.col(column).isNotNull())


def between(column: str, lower: float | None = None, upper: float | None = None) -> Rule:
    """Range test; a missing value passes."""
    value = F.col(column)
    inside = F.lit(True)
    if lower is not None:
        inside = inside & (value >= F.lit(lower))
    if upper is not None:
        inside = inside & (value <= F.lit(upper))
    return Rule(f"{column}_in_range", value.isNull() | inside)


def positive(column: str) -> Rule:
    value = F.col(column)
    return Rule(f"{column}_positive", value.isNull() | (value > 0))


def plausibility_violations(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """D5. (key, rule) per breach, from one pass over the rows."""
    broken = F.array_compact(F.array(*[
        F.when(~F.coalesce(rule.holds, F.lit(False)), F.lit(rule.name)) for rule in rules]))
    return df.select(key, F.explode(broken).alias("rule"))


def training_ranges(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """D6. Smallest and largest training value per feature."""
    row = train.agg(*[F.min(f"`{c}`").cast("double").alias(f"low{i}") for i, c in enumerate(columns)],
                    *[F.max(f"`{c}`").cast("double").alias(f"high{i}") for i, c in enumerate(columns)]).first()
    return {c: (row[f"low{i}"], row[f"high{i}"]) for i, c in enumerate(columns) if row[f"low{i}"] is not None}


def flag_out_of_range(df: DataFrame, ranges: Mapping[str, tuple[float, float]],
                      output: str = "out_of_range_features") -> DataFrame:
    """D6. Names of the features outside their training range, per row."""
    flags = [F.when((F.col(c) < F.lit(low)) | (F.col(c) > F.lit(high)), F.lit(c)) for c, (low, high) in ranges.items()]
    return df.withColumn(output, F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>"))


def credit_history_months(issued: Column, earliest: Column) -> Column:
    """D7. Months from the first credit line to the loan; NULL if either date is missing."""
    return F.months_between(issued, earliest)


def cohort_metrics(df: DataFrame, cohort: str, score: str = "p", label: str = "bad_loan") -> DataFrame:
    """D9. Ranking and probability measures per cohort."""
    return probability_metrics(df, score, label, [cohort]).orderBy(cohort)
