"""Baseline models and their reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanweft.functions.checks import DataCheckError
from loanweft.functions.numeric import direction_label
from loanweft.session import literal_table, shared_path

PENALTY_C = 1.0  # fixed value: inverse penalty weight of the baseline
MAX_ITERATIONS = 1000


def prior_rate(train: DataFrame, label: str = "bad_loan") -> DataFrame:
    """M6. Bad rate of the training rows, as one row."""
    return train.agg(F.avg(label).alias("p"))


def apply_prior(df: DataFrame, prior: DataFrame, output: str = "p_prior") -> DataFrame:
    """M6. The same probability for every row."""
    return df.withColumn(output, prior.scalar())


def fit_logistic(train: DataFrame, label: str = "bad_loan", features: str = "features",
                 penalty_c: float = PENALTY_C, max_iterations: int = MAX_ITERATIONS, tolerance: float = 1e-9,
                 aggregation_depth: int = 2) -> LogisticRegressionModel:
    """M7. L2-penalized logistic regression with the penalty on the summed loss.

    Spark averages the loss, so the weight ``1 / C`` becomes ``1 / (C n)``. The
    intercept is free and the features keep their own scale.
    """
    rows = train.agg(F.count(F.lit(1)), F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).first()
    if not rows[1] or not rows[2]:
        raise DataCheckError("training needs both classes")
    estimator = LogisticRegression(
        featuresCol=features, labelCol="_label", regParam=1.0 / (penalty_c * rows[0]), elasticNetParam=0.0,
        standardization=False, fitIntercept=True, family="binomial", maxIter=max_iterations, tol=tolerance,
        aggregationDepth=aggregation_depth)
    fitted = estimator.fit(train.select(features, F.col(label).cast("double").alias("_label")))
    # read back from disk the model has no training summary, which would travel with every task
    path = shared_path(train.sparkSession, "logistic")
    fitted.write().save(path)
    return LogisticRegressionModel.load(path)


def score_logistic(model: LogisticRegressionModel, df: DataFrame, keep: Sequence[str], score: str = "p",
                   log_odds: str = "z") -> DataFrame:
    """M8. Log-odds and probability of class 1."""
    if model.numClasses != 2:
        raise DataCheckError("the model must know exactly the classes 0 and 1")
    scored = model.transform(df)
    return scored.select(*keep, F.get(vector_to_array("rawPrediction"), F.lit(1)).alias(log_odds),
                         F.get(vector_to_array("probability"), F.lit(1)).alias(score))


def coefficient_table(model: LogisticRegressionModel, names: Sequence[str], df: DataFrame) -> DataFrame:
    """Feature names with their coefficients."""
    values = [float(value) for value in model.coefficients.toArray()]
    if len(values) != len(names):
        raise DataCheckError(f"{len(names)} feature names for {len(values)} coefficients")
    return literal_table(df.sparkSession, list(zip(names, values)), "feature_name string, coefficient double")


def coefficient_report(coefficients: DataFrame) -> DataFrame:
    """M9, W6, F9. Coefficients ranked by size, ties by name. One row per vector slot."""
    size = F.abs("coefficient")
    rank = F.row_number().over(Window.partitionBy().orderBy(F.desc("absolute_coefficient"), "feature_name"))
    return (
        coefficients.withColumn("absolute_coefficient", size)
        .select(rank.alias("coefficient_rank"), "feature_name", "coefficient", "absolute_coefficient",
                direction_label(F.col("coefficient")).alias("coefficient_direction"))
        .orderBy("coefficient_rank")
    )
