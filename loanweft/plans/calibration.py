"""Choice and final fit of the recalibration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweft.functions.checks import DataCheckError
from loanweft.operators.calibration import (
    Calibrators, apply_isotonic, check_reconstruction, fit_calibrators, fit_isotonic)
from loanweft.operators.evaluation import compare_candidates
from loanweft.operators.models import score_logistic
from loanweft.operators.splits import fit_halving
from loanweft.session import materialize
from loanweft.sources.writers import load_model, save_model, write_comparison_reports

CANDIDATES = {"uncalibrated": "p", "intercept": "p_intercept", "platt": "p_platt", "isotonic": "p_isotonic"}


def _scores(model: LogisticRegressionModel, rows: DataFrame, name: str) -> DataFrame:
    scored = materialize(score_logistic(model, rows, ["id", "issue_month", "bad_loan"]), name)
    if not check_reconstruction(scored).isEmpty():
        raise DataCheckError("probabilities do not follow from the log-odds")
    return scored


@dataclass(frozen=True)
class Comparison:
    calibrators: Calibrators
    reports: dict[str, DataFrame]


def compare_scored(scored: DataFrame, date: str = "issue_month", key: str = "id",
                   fraction: float = 0.5, **tuning: int) -> Comparison:
    """M15 from scored rows (key, date, bad_loan, z, p): fit on the earlier part, compare on the later."""
    halving = fit_halving(scored, date, key, fraction, **tuning)
    parted = halving.apply(scored, "calibration_part")
    earlier = parted.where(F.col("calibration_part") == "calibration_fit")
    later = parted.where(F.col("calibration_part") == "calibration_comparison")
    fitted = fit_calibrators(earlier)
    candidates = materialize(fitted.apply(later).select(key, "bad_loan", *CANDIDATES.values()), "candidates")
    return Comparison(fitted, compare_candidates(candidates, CANDIDATES, key=key, **tuning))


def compare_calibrations(model: LogisticRegressionModel, prepared: DataFrame, folder: str | None = None,
                         fraction: float = 0.5) -> Comparison:
    """M15. Score the validation rows, then compare four ways to read a probability off them."""
    validation = prepared.where(F.col("modeling_split") == "validation")
    comparison = compare_scored(_scores(model, validation, "validation-scores"), fraction=fraction)
    if folder:
        write_comparison_reports(comparison.reports, folder)
    return comparison


@dataclass(frozen=True)
class FinalCalibration:
    isotonic: IsotonicRegressionModel
    test_scores: DataFrame
    reports: dict[str, DataFrame]


def finalize_calibration(model: LogisticRegressionModel, prepared: DataFrame,
                         folder: str | None = None) -> FinalCalibration:
    """M16. Isotonic fit on all validation rows, frozen, judged on the test rows."""
    split = F.col("modeling_split")
    return finalize_scored(_scores(model, prepared.where(split == "validation"), "validation-scores"),
                           _scores(model, prepared.where(split == "test"), "test-scores"), folder)


def finalize_scored(validation: DataFrame, test: DataFrame, folder: str | None = None) -> FinalCalibration:
    """M16 from scored rows (id, bad_loan, z, p). With a folder the model is saved, and it is the loaded one that is judged."""
    isotonic = fit_isotonic(validation)
    if folder:
        save_model(isotonic, f"{folder}/isotonic")
        isotonic = load_model(test.sparkSession, f"{folder}/isotonic", "isotonic")
    calibrated = materialize(apply_isotonic(isotonic, test), "calibrated-test-scores")
    reports = compare_candidates(calibrated, {"uncalibrated": "p", "isotonic": "p_isotonic"})
    if folder:
        write_comparison_reports(reports, folder)
    return FinalCalibration(isotonic, calibrated, reports)
