"""Recalibration of log-odds: intercept shift, Platt scaling, isotonic steps.

The parametric fits are Newton iterations over the distinct log-odds, written
once; the sums are one aggregation per step and only two or six numbers reach
the driver. Sums of many rows are exact to some digits only, so no step is
judged by a smaller change of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanweft.functions.checks import DataCheckError
from loanweft.functions.numeric import clip, sigmoid
from loanweft.session import literal_table, materialize

MAX_STEPS = 100
TOLERANCE = 1e-12
SURE = 0.5  # a Newton step that moves no row's log-odds farther lowers the loss
NEAR = 1e-6  # of log-odds: from here on Newton steps shrink at once, unless they are rounding errors


def enforce_log_odds(df: DataFrame, log_odds: str = "z", label: str = "bad_loan") -> None:
    """Fail unless log-odds are finite and both classes occur."""
    z, y = F.col(log_odds), F.col(label)
    row = df.agg(
        F.count_if(z.isNull() | F.isnan(z) | (F.abs(z) == float("inf"))).alias("unusable"),
        F.count_if(y.isNull() | ~y.isin(0, 1)).alias("foreign"),
        F.count_if(y == 0).alias("good"), F.count_if(y == 1).alias("bad")).first()
    if row.unusable:
        raise DataCheckError(f"{row.unusable} log-odds are missing or not finite")
    if row.foreign or not row.good or not row.bad:
        raise DataCheckError("labels must hold the classes 0 and 1, and nothing else")


def check_reconstruction(df: DataFrame, log_odds: str = "z", score: str = "p", relative: float = 1e-10,
                         absolute: float = 1e-12) -> DataFrame:
    """F7. Rows whose probability is not the logistic function of their log-odds."""
    p = F.col(score)
    return df.where(~(F.abs(sigmoid(F.col(log_odds)) - p) <= F.lit(absolute) + F.lit(relative) * F.abs(p)))


def _distinct_log_odds(df: DataFrame, log_odds: str, label: str) -> DataFrame:
    """(z, rows, bad) of each distinct log-odds, written: every step of a fit reads them again."""
    points = df.groupBy(F.col(log_odds).cast("double").alias("z")).agg(
        F.count(F.lit(1)).cast("double").alias("rows"), F.sum(F.col(label).cast("double")).alias("bad"))
    return materialize(points, "log-odds")


def fit_intercept_shift(df: DataFrame, log_odds: str = "z", label: str = "bad_loan", lower: float = -10.0,
                        upper: float = 10.0) -> float:
    """M11. Shift of the log-odds with least log loss, within bounds.

    The loss is convex, so a sign change of its slope brackets the minimum and
    a Newton step that leaves the bracket is replaced by halving it.
    """
    if not lower < upper:
        raise ValueError("lower must be below upper")
    enforce_log_odds(df, log_odds, label)
    points = _distinct_log_odds(df, log_odds, label)
    z, rows, bad = F.col("z"), F.col("rows"), F.col("bad")
    low, high, shift = lower, upper, min(max(0.0, lower), upper)
    for _ in range(MAX_STEPS):
        p = sigmoid(z + F.lit(shift))
        row = points.agg((F.sum(rows * p - bad) / F.sum(rows)).alias("slope"),
                         (F.sum(rows * p * (F.lit(1.0) - p)) / F.sum(rows)).alias("curve")).first()
        if row.slope > 0:
            high = shift
        else:
            low = shift
        step = row.slope / row.curve if row.curve > 0 else math.inf
        after = shift - step
        if not low <= after <= high:
            after = (low + high) / 2.0
        if abs(after - shift) <= TOLERANCE:
            return after
        shift = after
    raise DataCheckError(f"the intercept shift did not converge in {MAX_STEPS} steps")


def apply_intercept_shift(log_odds: Column, shift: float) -> Column:
    """M12."""
    if not math.isfinite(shift):
        raise ValueError("shift must be finite")
    return sigmoid(log_odds + F.lit(shift))


@dataclass(frozen=True)
class PlattScaling:
    """M13. Probability from ``scale * z + intercept``."""

    scale: float
    intercept: float

    def probability(self, log_odds: Column) -> Column:
        return sigmoid(F.lit(self.scale) * log_odds + F.lit(self.intercept))


def _platt_sums(points: DataFrame, scale: float, intercept: float):
    z, rows, bad = F.col("z"), F.col("rows"), F.col("bad")
    t = F.lit(scale) * z + F.lit(intercept)
    p = sigmoid(t)
    gap, weight = rows * p - bad, rows * p * (F.lit(1.0) - p)
    # log(1 + exp(t)) - y t, written so that exp never overflows
    loss = rows * (F.greatest(t, F.lit(0.0)) + F.log1p(F.exp(-F.abs(t)))) - bad * t
    sums = {"g1": gap * z, "g0": gap, "h11": weight * z * z, "h10": weight * z, "h00": weight, "loss": loss}
    return points.agg(*[(F.sum(value) / F.sum(rows)).alias(name) for name, value in sums.items()]).first()


def fit_platt(df: DataFrame, log_odds: str = "z", label: str = "bad_loan") -> PlattScaling:
    """M13. Unpenalized logistic fit of the label on the log-odds.

    The third derivative of a row's loss is at most its second, so a step that
    moves no log-odds by more than ``SURE`` lowers the loss; only longer ones
    are halved until it does not rise. The fit ends when a step is within
    ``TOLERANCE`` or, near the minimum, does not shrink any more: it then
    consists of rounding errors, which grow with the rows.
    """
    enforce_log_odds(df, log_odds, label)
    points = _distinct_log_odds(df, log_odds, label)
    widest = points.agg(F.max(F.abs("z"))).first()[0]
    scale = intercept = 0.0
    before = math.inf
    row = _platt_sums(points, scale, intercept)
    for _ in range(MAX_STEPS):
        determinant = row.h11 * row.h00 - row.h10 * row.h10
        if determinant <= 0:
            raise DataCheckError("log-odds do not vary or separate the classes; no finite Platt scaling exists")
        d1 = (row.h00 * row.g1 - row.h10 * row.g0) / determinant
        d0 = (row.h11 * row.g0 - row.h10 * row.g1) / determinant
        moved = abs(d1) * widest + abs(d0)  # by which a row's log-odds change at most
        if not math.isfinite(moved):
            raise DataCheckError("Platt scaling is not finite")
        if max(abs(d1), abs(d0)) <= TOLERANCE or before / 2.0 < moved <= NEAR:
            break
        before = moved
        fraction = 1.0
        while True:
            tried = _platt_sums(points, scale - fraction * d1, intercept - fraction * d0)
            if tried.loss <= row.loss or fraction * moved <= SURE:
                break
            fraction /= 2.0
        scale, intercept, row = scale - fraction * d1, intercept - fraction * d0, tried
    else:
        raise DataCheckError(f"Platt scaling did not converge in {MAX_STEPS} steps")
    if not math.isfinite(scale) or not math.isfinite(intercept):
        raise DataCheckError("Platt scaling is not finite")
    return PlattScaling(scale, intercept)


def fit_isotonic(df: DataFrame, log_odds: str = "z", label: str = "bad_loan") -> IsotonicRegressionModel:
    """M14. Non-decreasing step fit of the label on the log-odds.

    Rows are folded to one weighted point per distinct log-odds first, which is
    exact because tied inputs share one fitted value, and keeps a frequent
    value from filling one partition.
    """
    enforce_log_odds(df, log_odds, label)
    points = df.groupBy(F.col(log_odds).alias("z")).agg(
        F.avg(F.col(label).cast("double")).alias("rate"), F.count(F.lit(1)).cast("double").alias("weight"))
    return IsotonicRegression(featuresCol="z", labelCol="rate", weightCol="weight", isotonic=True).fit(points)


def apply_isotonic(model: IsotonicRegressionModel, df: DataFrame, log_odds: str = "z",
                   output: str = "p_isotonic") -> DataFrame:
    """M14. Interpolated probability, constant beyond the fitted range."""
    fitted = model.copy().setFeaturesCol(log_odds).setPredictionCol(output).transform(df)
    return fitted.withColumn(output, clip(F.col(output), 0.0, 1.0))


def isotonic_steps(model: IsotonicRegressionModel, df: DataFrame) -> DataFrame:
    """Boundaries and fitted values of the model as a table."""
    rows = list(zip([float(b) for b in model.boundaries], [float(v) for v in model.predictions]))
    return literal_table(df.sparkSession, rows, "boundary double, fitted double")


@dataclass(frozen=True)
class Calibrators:
    """The three fitted recalibrations."""

    shift: float
    platt: PlattScaling
    isotonic: IsotonicRegressionModel

    def apply(self, df: DataFrame, log_odds: str = "z") -> DataFrame:
        z = F.col(log_odds)
        scored = df.withColumn("p_intercept", apply_intercept_shift(z, self.shift)).withColumn(
            "p_platt", self.platt.probability(z))
        return apply_isotonic(self.isotonic, scored, log_odds)


def fit_calibrators(df: DataFrame, log_odds: str = "z", label: str = "bad_loan") -> Calibrators:
    return Calibrators(fit_intercept_shift(df, log_odds, label), fit_platt(df, log_odds, label),
                       fit_isotonic(df, log_odds, label))
