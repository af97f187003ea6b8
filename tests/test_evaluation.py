"""Measures against direct formulas in numpy and pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanweft.functions.checks import DataCheckError
from loanweft.operators import evaluation
from loanweft.operators.policy import Policy, apply_policy, breakeven, decision


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    p = np.round(rng.beta(2, 5, 1500), 2)
    p[:500] = 0.3  # a third of all rows share one score
    return pd.DataFrame({"id": range(1500), "p": p, "bad_loan": (rng.random(1500) < p).astype(int)})


def auc(p, y):
    wins = (p[y == 1][:, None] > p[y == 0][None, :]).sum() + 0.5 * (p[y == 1][:, None] == p[y == 0][None, :]).sum()
    return wins / ((y == 1).sum() * (y == 0).sum())


def average_precision(p, y):
    total, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        recall, precision = y[hit].sum() / y.sum(), y[hit].mean()
        total, last = total + (recall - last) * precision, recall
    return total


def expected(p, y):
    q = np.clip(p, np.finfo(float).eps, 1 - np.finfo(float).eps)
    return {"row_count": len(p), "observed_bad_loan_rate": y.mean(), "mean_predicted_bad_loan_probability": p.mean(),
            "roc_auc": auc(p, y), "average_precision": average_precision(p, y),
            "log_loss": -np.mean(y * np.log(q) + (1 - y) * np.log(1 - q)), "brier_score": np.mean((p - y) ** 2),
            "gini": 2 * auc(p, y) - 1}


def test_probability_metrics(spark, frame):
    got = evaluation.probability_metrics(spark.createDataFrame(frame)).first().asDict()
    assert got == pytest.approx(expected(frame.p.to_numpy(), frame.bad_loan.to_numpy()))


def test_metrics_by_group_and_by_bucket(spark, frame, monkeypatch):
    frame = frame.assign(m=frame.id % 2)
    original = evaluation.running_totals
    monkeypatch.setattr(evaluation, "running_totals", lambda *a, **k: original(*a, **{**k, "rows_per_part": 7}))
    rows = evaluation.probability_metrics(spark.createDataFrame(frame), by=["m"]).collect()
    assert len(rows) == 2
    for row in rows:
        part = frame[frame.m == row.m]
        got = row.asDict()
        got.pop("m")
        assert got == pytest.approx(expected(part.p.to_numpy(), part.bad_loan.to_numpy()))


def test_auc_does_not_change_under_a_monotone_map(spark, frame):
    df = spark.createDataFrame(frame).withColumn("q", F.pow("p", F.lit(3.0)) / 2)
    assert evaluation.probability_metrics(df, "q").first().roc_auc == pytest.approx(
        evaluation.probability_metrics(df).first().roc_auc)


def test_constant_and_certain_scores(spark):
    constant = spark.createDataFrame([(0.4, 0), (0.4, 1), (0.4, 0), (0.4, 0)], "p double, bad_loan int")
    row = evaluation.probability_metrics(constant).first()
    assert (row.roc_auc, row.average_precision) == (0.5, 0.25)
    certain = spark.createDataFrame([(0.0, 0), (1.0, 1)], "p double, bad_loan int")
    assert evaluation.probability_metrics(certain).first().log_loss == pytest.approx(0, abs=1e-12)
    single = evaluation.probability_metrics(constant.where("bad_loan = 0")).first()
    assert single.roc_auc is None and single.average_precision is None


def test_bins_are_right_closed(spark):
    edges = [0.0, 0.1, 0.3, 0.30000000000000004, 1.0]
    df = spark.createDataFrame([(p, 0) for p in edges], "p double, bad_loan int")
    got = {row.bin_index: row.row_count for row in evaluation.calibration_bins(df).collect()}
    assert got == {0: 2, 2: 2, 9: 1}
    cut = pd.cut(edges, np.linspace(0, 1, 11), include_lowest=True).codes
    assert got == pd.Series(cut).value_counts().to_dict()


def test_bins_and_weighted_gap(spark, frame):
    bins = evaluation.calibration_bins(spark.createDataFrame(frame))
    cut = pd.cut(frame.p, np.linspace(0, 1, 11), include_lowest=True)
    table = frame.groupby(cut, observed=True).agg(n=("p", "size"), p=("p", "mean"), y=("bad_loan", "mean"))
    rows = bins.orderBy("bin_index").collect()
    assert [row.row_count for row in rows] == table.n.tolist()
    assert [row.calibration_gap for row in rows] == pytest.approx((table.y - table.p).tolist())
    gap = evaluation.weighted_calibration_gap(bins).first()[0]
    assert gap == pytest.approx(np.average((table.y - table.p).abs(), weights=table.n))


def test_thresholds(spark, frame):
    rows = evaluation.threshold_metrics(spark.createDataFrame(frame), thresholds=(0.9, 0.3, 1.0)).orderBy("threshold").collect()
    for row in rows:
        hit, y = frame.p >= row.threshold, frame.bad_loan == 1
        assert (row.true_positive, row.false_positive) == ((hit & y).sum(), (hit & ~y).sum())
        assert row.recall == pytest.approx((hit & y).sum() / y.sum())
    assert (rows[-1].true_positive, rows[-1].precision) == (0, 0.0)
    with pytest.raises(ValueError):
        evaluation.threshold_metrics(spark.createDataFrame(frame), thresholds=())


def test_deciles(spark, frame):
    got = evaluation.score_deciles(spark.createDataFrame(frame), rows_per_part=20).orderBy("score_decile").toPandas()
    local = frame.sort_values(["p", "id"], ascending=[False, True]).reset_index(drop=True)
    local["d"] = pd.qcut(local.index, 10, labels=range(1, 11)).astype(int)
    table = local.groupby("d").agg(n=("p", "size"), bad=("bad_loan", "sum"), low=("p", "min"), high=("p", "max"))
    assert got.row_count.tolist() == table.n.tolist()
    assert got.bad_loan_count.tolist() == table.bad.tolist()
    assert got.minimum_predicted_bad_loan_probability.tolist() == table.low.tolist()
    assert got.cumulative_bad_loan_share.tolist() == pytest.approx((table.bad.cumsum() / table.bad.sum()).tolist())


def test_rank_correlation(spark, frame):
    frame = frame.assign(q=frame.p.round(1), flat=0.5)
    df = spark.createDataFrame(frame)
    got = evaluation.rank_correlation(df, "p", "q").first()[0]
    assert got == pytest.approx(frame.p.rank().corr(frame.q.rank()))
    assert evaluation.rank_correlation(df, "p", "flat").first()[0] is None
    assert evaluation.rank_correlation(df, "flat", "p").first()[0] is None


def test_comparison_of_candidates(spark, frame):
    df = spark.createDataFrame(frame.assign(half=frame.p / 2))
    reports = evaluation.compare_candidates(df, {"uncalibrated": "p", "half": "half"})
    summary = reports["discrimination_summary"].collect()
    assert [row.calibration_method for row in summary] == ["uncalibrated", "half"]
    assert [row.spearman_rank_correlation_to_uncalibrated for row in summary] == pytest.approx([1.0, 1.0])
    assert summary[0].roc_auc == pytest.approx(summary[1].roc_auc)
    deciles = reports["discrimination_deciles"].collect()
    assert [(row.score_decile, row.calibration_method) for row in deciles][:3] == [(1, "uncalibrated"), (1, "half"), (2, "uncalibrated")]
    assert sum(row.row_count for row in deciles) == 2 * len(frame)
    with pytest.raises(DataCheckError):
        evaluation.compare_candidates(df.where("bad_loan = 0"), {"uncalibrated": "p"})


def test_policy_edges(spark):
    policy = Policy()
    assert policy.breakeven == pytest.approx(1 / 7)
    low, high = policy.approve_boundary, policy.decline_boundary
    rows = [(0.0,), (low,), (high,), (float(np.nextafter(high, 1)),), (1.0,), (float("nan"),), (None,)]
    got = [r.d for r in spark.createDataFrame(rows, "p double").select(
        decision(F.col("p"), F.lit(low), F.lit(high)).alias("d")).collect()]
    assert got == ["approve", "review", "review", "decline", "decline", None, None]
    assert Policy(review_margin=0.9).approve_boundary == 0.0
    for wrong in ({"good_return_rate": 0}, {"bad_loss_rate": 1.1}, {"review_margin": 1.0}):
        with pytest.raises(ValueError):
            Policy(**wrong)
    row = spark.range(1).select(breakeven(F.lit(0.0), F.lit(0.5)).alias("x"), breakeven(F.lit(0.5), F.lit(0.5)).alias("y")).first()
    assert (row.x, row.y) == (None, 0.5)


def test_policy_outcomes(spark, frame):
    rows = apply_policy(spark.createDataFrame(frame), Policy(0.3, 0.6, 0.05)).collect()
    assert sum(row.row_count for row in rows) == len(frame)
    for share in ("portfolio_share", "share_of_all_bad_loans", "share_of_all_good_loans"):
        assert sum(row[share] for row in rows) == pytest.approx(1.0)
    assert sum(row.bad_loan_count for row in rows) == frame.bad_loan.sum()
