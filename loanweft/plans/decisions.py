"""Decisions for scored and for new loans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweft.functions.checks import enforce_scores
from loanweft.operators.calibration import apply_isotonic
from loanweft.operators.models import score_logistic
from loanweft.operators.monitoring import risk_band
from loanweft.operators.policy import Policy, apply_policy, decision, expected_value
from loanweft.sources.writers import write_report


def write_policy(spark: SparkSession, policy: Policy, path: str) -> None:
    """M17."""
    write_report(policy.table(spark), path)


def evaluate_policy(scored: DataFrame, policy: Policy, score: str = "p_isotonic",
                    path: str | None = None) -> DataFrame:
    """M18. Check the scores, decide, summarize."""
    enforce_scores(scored, score)
    outcomes = apply_policy(scored, policy, score)
    if path:
        write_report(outcomes, path)
    return outcomes


def score_loans(profiles: DataFrame, preprocessing: PipelineModel, logistic: LogisticRegressionModel,
                isotonic: IsotonicRegressionModel, policy: Policy = Policy(),
                keep: Sequence[str] = ("id",)) -> DataFrame:
    """D8. Batch scoring with the saved stages: one narrow pass, no shuffle."""
    features = preprocessing.transform(profiles).select(*keep, "features")
    calibrated = apply_isotonic(isotonic, score_logistic(logistic, features, keep))
    p = F.col("p_isotonic")
    return calibrated.select(
        *keep, F.col("p").alias("uncalibrated_probability"), p.alias("calibrated_probability"),
        risk_band(p).alias("risk_band"),
        decision(p, F.lit(policy.approve_boundary), F.lit(policy.decline_boundary)).alias("decision"),
        expected_value(p, F.lit(policy.good_return_rate), F.lit(policy.bad_loss_rate))
        .alias("expected_value_per_dollar"))
