"""Prepared features and baseline models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweft.functions.checks import enforce_scores
from loanweft.operators.evaluation import (
    calibration_bins, probability_metrics, score_deciles, threshold_metrics, unpivot_candidates)
from loanweft.operators.features import FeatureColumns, FittedFeatures, fit_features, preprocessing_summary
from loanweft.operators.models import (
    apply_prior, coefficient_report, coefficient_table, fit_logistic, prior_rate, score_logistic)
from loanweft.session import materialize
from loanweft.sources.writers import save_model, write_features, write_report

CARRIED = ("id", "issue_month", "bad_loan", "modeling_split")


def prepare_features(splits: DataFrame, columns: FeatureColumns, folder: str,
                     keep: tuple[str, ...] = CARRIED) -> tuple[FittedFeatures, DataFrame]:
    """M5. Fit on train, transform all splits in one job, save table, names, pipeline and summary."""
    fitted = fit_features(splits.where(F.col("modeling_split") == "train"), columns)
    prepared = write_features(fitted.transform(splits, keep), fitted.names, f"{folder}/features",
                              f"{folder}/feature_names")
    save_model(fitted.pipeline, f"{folder}/preprocessing")
    write_report(preprocessing_summary(splits, prepared, columns, fitted.names), f"{folder}/preprocessing_summary")
    return fitted, prepared


@dataclass(frozen=True)
class Baselines:
    logistic: LogisticRegressionModel
    reports: dict[str, DataFrame]


def train_baselines(prepared: DataFrame, feature_names: list[str], folder: str | None = None) -> Baselines:
    """M10. Prior and logistic baseline, judged side by side on the validation rows."""
    split = F.col("modeling_split")
    train, validation = prepared.where(split == "train"), prepared.where(split == "validation")
    logistic = fit_logistic(train)
    scored = materialize(
        apply_prior(score_logistic(logistic, validation, ["id", "bad_loan"]), prior_rate(train)), "baselines")
    long = unpivot_candidates(
        scored, {"dummy_prior_baseline": "p_prior", "logistic_regression_baseline": "p"}, "dummy_prior_baseline"
    ).withColumnRenamed("method", "model_name")
    by = ["method_order", "model_name"]
    enforce_scores(long, by=by)
    reports = {
        "validation_performance": probability_metrics(long, by=by).orderBy("method_order"),
        "validation_calibration": calibration_bins(long, by=by).orderBy("method_order", "bin_index"),
        "validation_thresholds": threshold_metrics(long, by=by).orderBy("method_order", "threshold"),
        "validation_deciles": score_deciles(long, by=by).orderBy("method_order", "score_decile"),
        "logistic_coefficients": coefficient_report(coefficient_table(logistic, feature_names, prepared)),
    }
    reports = {
        name: report.drop("method_order").withColumn("dataset_name", F.lit("validation"))
        if "method_order" in report.columns else report
        for name, report in reports.items()}
    if folder:
        save_model(logistic, f"{folder}/logistic")
        for name, report in reports.items():
            write_report(report, f"{folder}/{name}")
    return Baselines(logistic, reports)
