"""From calibrated probability to approve, review or decline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweft.operators.labels import with_domain_share
from loanweft.session import literal_table

# Policy defaults.
GOOD_RETURN_RATE = 0.10
BAD_LOSS_RATE = 0.60
REVIEW_MARGIN = 0.015


def breakeven(good_return: Column, bad_loss: Column) -> Column:
    """P8. Probability at which the expected value is zero; NULL outside (0, 1]."""
    usable = (good_return > 0) & (good_return <= 1) & (bad_loss > 0) & (bad_loss <= 1)
    return F.when(usable, good_return / (good_return + bad_loss))


def boundaries(break_even: Column, margin: Column) -> tuple[Column, Column]:
    """P9. Approve below the first, decline above the second."""
    return F.greatest(F.lit(0.0), break_even - margin), F.least(F.lit(1.0), break_even + margin)


def expected_value(p: Column, good_return: Column, bad_loss: Column) -> Column:
    """P10. Value per unit lent."""
    return (F.lit(1) - p) * good_return - p * bad_loss


def decision(p: Column, approve: Column, decline: Column) -> Column:
    """P7. Both edges of the review band are closed; NULL for an unusable probability."""
    usable = p.isNotNull() & ~F.isnan(p) & (p >= 0) & (p <= 1)
    return F.when(usable, F.when(p < approve, "approve").when(p <= decline, "review").otherwise("decline"))


@dataclass(frozen=True)
class Policy:
    """M17. Parameters of one decision policy."""

    good_return_rate: float = GOOD_RETURN_RATE
    bad_loss_rate: float = BAD_LOSS_RATE
    review_margin: float = REVIEW_MARGIN

    def __post_init__(self) -> None:
        if not 0 < self.good_return_rate <= 1 or not 0 < self.bad_loss_rate <= 1:
            raise ValueError("return and loss rate must lie in (0, 1]")
        if not 0 <= self.review_margin < 1:
            raise ValueError("review margin must lie in [0, 1)")

    @property
    def breakeven(self) -> float:
        return self.good_return_rate / (self.good_return_rate + self.bad_loss_rate)

    @property
    def approve_boundary(self) -> float:
        return max(0.0, self.breakeven - self.review_margin)

    @property
    def decline_boundary(self) -> float:
        return min(1.0, self.breakeven + self.review_margin)

    def table(self, spark: SparkSession) -> DataFrame:
        """The configuration as one row."""
        row = (self.good_return_rate, self.bad_loss_rate, self.breakeven, self.review_margin,
               self.approve_boundary, self.decline_boundary)
        return literal_table(spark, [row], "good_loan_return_rate double, bad_loan_loss_rate double, "
                                     "breakeven_probability double, review_margin double, "
                                     "approve_boundary double, decline_boundary double")


def evaluation_table(df: DataFrame, policy: Policy, score: str = "p", label: str = "bad_loan",
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """P11. Label, probability, decision and expected value per row."""
    p = F.col(score)
    return df.select(
        *keep, F.col(label).cast("int").alias("bad_loan"), p.alias("calibrated_probability"),
        decision(p, F.lit(policy.approve_boundary), F.lit(policy.decline_boundary)).alias("decision"),
        expected_value(p, F.lit(policy.good_return_rate), F.lit(policy.bad_loss_rate))
        .alias("expected_value_per_dollar"))


def policy_summary(rows: DataFrame) -> DataFrame:
    """A23. Risk and value by decision, from ``evaluation_table``."""
    return with_domain_share(rows.groupBy("decision").agg(
        F.count(F.lit(1)).alias("row_count"), F.avg("bad_loan").alias("observed_bad_loan_rate"),
        F.avg("calibrated_probability").alias("mean_predicted_bad_loan_probability"),
        F.avg("expected_value_per_dollar").alias("mean_expected_value_per_dollar"),
    ), "row_count", "portfolio_share")


def decision_outcomes(rows: DataFrame) -> DataFrame:
    """A24. ``policy_summary`` with outcome counts and their shares."""
    counted = rows.groupBy("decision").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("bad_loan").cast("long")).alias("bad_loan_count"),
        F.avg("bad_loan").alias("observed_bad_loan_rate"),
        F.avg("calibrated_probability").alias("mean_predicted_bad_loan_probability"),
        F.avg("expected_value_per_dollar").alias("mean_expected_value_per_dollar"),
    ).withColumn("good_loan_count", F.col("row_count") - F.col("bad_loan_count"))
    shared = with_domain_share(counted, "row_count", "portfolio_share")
    shared = with_domain_share(shared, "bad_loan_count", "share_of_all_bad_loans")
    return with_domain_share(shared, "good_loan_count", "share_of_all_good_loans")


def apply_policy(df: DataFrame, policy: Policy, score: str = "p", label: str = "bad_loan") -> DataFrame:
    """M18. Scored rows to decision outcomes as one job."""
    return decision_outcomes(evaluation_table(df, policy, score, label))
