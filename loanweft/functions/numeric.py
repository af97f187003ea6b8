"""Numeric expressions shared by models, calibration and policy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 2.220446049250313e-16  # fixed value: double machine epsilon


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def log_odds(p: Column) -> Column:
    return F.ln(p / (F.lit(1.0) - p))


def clip(column: Column, lower: float, upper: float) -> Column:
    return F.greatest(F.lit(lower), F.least(F.lit(upper), column))


def row_log_loss(label: Column, p: Column) -> Column:
    """Negative log likelihood of one outcome, with p kept away from 0 and 1."""
    safe = clip(p, EPSILON, 1.0 - EPSILON)
    return -(label * F.ln(safe) + (F.lit(1.0) - label) * F.log1p(-safe))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def direction_label(coefficient: Column) -> Column:
    return (
        F.when(coefficient > 0, "increases_bad_loan_risk")
        .when(coefficient < 0, "decreases_bad_loan_risk")
        .otherwise("neutral")
    )
