"""Measures of scored rows (label, probability), for any number of groups at once.

``by`` names grouping columns such as the method or the cohort. Scores must
have passed ``enforce_scores``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanweft.functions.checks import enforce_scores
from loanweft.functions.numeric import ratio, row_log_loss
from loanweft.operators.position import Order, exact_quantile_buckets, running_totals
from loanweft.session import materialize

# Default probability thresholds.
THRESHOLDS = (0.10, 0.20, 0.30, 0.40, 0.50, 0.60, 0.70, 0.80, 0.90)


def distinct_scores(df: DataFrame, score: str = "p", label: str = "bad_loan", by: Sequence[str] = ()) -> DataFrame:
    """Rows and bad rows per distinct score, with the totals of all higher scores.

    Equal scores are combined map-side, so a score shared by many rows is one
    row here.
    """
    grouped = df.groupBy(*by, F.col(score).alias("p")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("long")).alias("bad"))
    return running_totals(grouped, "p", ("rows", "bad"), by, ascending=False)


def probability_metrics(df: DataFrame, score: str = "p", label: str = "bad_loan", by: Sequence[str] = ()) -> DataFrame:
    """E1 with E2 to E5 and E11: ranking and probability quality per group.

    ROC AUC counts, for every good row, the bad rows with a higher score and
    half of those with the same. Average precision is the step sum over distinct
    scores. Both are NULL unless the group holds both classes.
    """
    p, rows, bad = F.col("p"), F.col("rows"), F.col("bad")
    good = rows - bad
    one = F.lit(1.0)
    pairs_won = good.cast("double") * (F.col("bad_before").cast("double") + bad.cast("double") / 2.0)
    reached_bad = (F.col("bad_before") + bad).cast("double")
    reached = (F.col("rows_before") + rows).cast("double")
    return distinct_scores(df, score, label, by).groupBy(*by).agg(
        F.sum(rows).alias("row_count"),
        (F.sum(bad) / F.sum(rows)).alias("observed_bad_loan_rate"),
        (F.sum(p * rows) / F.sum(rows)).alias("mean_predicted_bad_loan_probability"),
        F.try_divide(F.sum(pairs_won), F.sum(bad).cast("double") * F.sum(good).cast("double")).alias("roc_auc"),
        F.when(F.sum(good) > 0, F.try_divide(F.sum(bad * reached_bad / reached), F.sum(bad).cast("double")))
        .alias("average_precision"),
        (F.sum(bad * row_log_loss(one, p) + good * row_log_loss(F.lit(0.0), p)) / F.sum(rows)).alias("log_loss"),
        (F.sum(bad * (p - one) * (p - one) + good * p * p) / F.sum(rows)).alias("brier_score"),
    ).withColumn("gini", F.lit(2.0) * F.col("roc_auc") - one)


def bin_edges(bins: int) -> list[float]:
    """Upper edges of equal-width bins, as multiples of the width in doubles."""
    width = 1.0 / bins
    return [k * width for k in range(1, bins)] + [1.0]


def bin_index(p: Column, bins: int) -> Column:
    """0-based right-closed bin; the first one also holds 0."""
    edges = bin_edges(bins)
    index = F.when(p <= F.lit(edges[0]), F.lit(0))
    for number, edge in enumerate(edges[1:], start=1):
        index = index.when(p <= F.lit(edge), F.lit(number))
    return index


def calibration_bins(df: DataFrame, score: str = "p", label: str = "bad_loan", by: Sequence[str] = (),
                     bins: int = 10) -> DataFrame:
    """E6. Predicted against observed rate per probability bin; empty bins are absent."""
    if bins < 2:
        raise ValueError("at least 2 bins")
    p, y = F.col(score), F.col(label)
    grouped = df.groupBy(*by, bin_index(p, bins).alias("bin_index")).agg(
        F.count(F.lit(1)).alias("row_count"), F.avg(p).alias("mean_predicted_bad_loan_probability"),
        F.avg(y).alias("observed_bad_loan_rate"))
    edges = F.array(*[F.lit(edge) for edge in [0.0, *bin_edges(bins)]])
    gap = F.col("observed_bad_loan_rate") - F.col("mean_predicted_bad_loan_probability")
    return grouped.select(
        *by, "bin_index", F.get(edges, F.col("bin_index")).alias("bin_lower"),
        F.get(edges, F.col("bin_index") + 1).alias("bin_upper"), "row_count",
        "mean_predicted_bad_loan_probability", "observed_bad_loan_rate", gap.alias("calibration_gap"),
        F.abs(gap).alias("absolute_calibration_gap"))


def weighted_calibration_gap(bins: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """E10. Mean absolute gap, weighted by rows."""
    weight = F.col("row_count")
    return bins.groupBy(*by).agg(
        (F.sum(weight * F.col("absolute_calibration_gap")) / F.sum(weight))
        .alias("weighted_mean_absolute_calibration_gap"))


def threshold_metrics(df: DataFrame, score: str = "p", label: str = "bad_loan", by: Sequence[str] = (),
                      thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """E7. Confusion counts and rates where ``p >= threshold`` predicts bad.

    Each row is counted once, by how many thresholds it reaches; the rows per
    threshold are then sums over that short table.
    """
    ordered = sorted(float(t) for t in thresholds)
    if not ordered or not all(0 <= t <= 1 for t in ordered):
        raise ValueError("thresholds must lie in [0, 1], at least one")
    p = F.col(score)
    reached = F.lit(0)
    for threshold in ordered:
        reached = reached + (p >= F.lit(threshold)).cast("int")
    counted = df.groupBy(*by, reached.alias("reached")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("long")).alias("bad"))
    steps = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(t).alias("threshold"))
                      for i, t in enumerate(ordered, start=1)])
    positive = F.col("reached") >= F.col("step")
    zero = F.lit(0).cast("long")
    good = F.col("rows") - F.col("bad")
    per = counted.select("*", F.inline(steps)).groupBy(*by, "step", "threshold").agg(
        F.sum("rows").alias("row_count"), F.sum("bad").alias("all_bad"),
        F.sum(F.when(~positive, good).otherwise(zero)).alias("true_negative"),
        F.sum(F.when(positive, good).otherwise(zero)).alias("false_positive"),
        F.sum(F.when(~positive, F.col("bad")).otherwise(zero)).alias("false_negative"),
        F.sum(F.when(positive, F.col("bad")).otherwise(zero)).alias("true_positive"))
    tn, fp, fn, tp = (F.col(c) for c in ("true_negative", "false_positive", "false_negative", "true_positive"))
    return per.select(
        *by, "threshold", "row_count", (F.col("all_bad") / F.col("row_count")).alias("observed_bad_loan_rate"),
        ((tp + fp) / F.col("row_count")).alias("predicted_bad_loan_rate"),
        "true_negative", "false_positive", "false_negative", "true_positive",
        ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(fp, fp + tn).alias("false_positive_rate"))


def score_deciles(df: DataFrame, score: str = "p", label: str = "bad_loan", key: str = "id",
                  by: Sequence[str] = (), deciles: int = 10, **tuning: int) -> DataFrame:
    """E8, W4, W5. Outcome by score decile, 1 for the highest scores; ties go by ``key``."""
    if deciles < 2:
        raise ValueError("at least 2 deciles")
    narrow = df.select(*by, key, F.col(score).alias("p"), F.col(label).alias("y"))
    placed = exact_quantile_buckets(narrow, (Order("p", ascending=False), Order(key)), deciles, by,
                                    "score_decile", **tuning)
    table = placed.groupBy(*by, "score_decile").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("y").cast("long")).alias("bad_loan_count"),
        F.min("p").alias("minimum_predicted_bad_loan_probability"),
        F.avg("p").alias("mean_predicted_bad_loan_probability"),
        F.max("p").alias("maximum_predicted_bad_loan_probability"),
        F.avg("y").alias("observed_bad_loan_rate"))
    # at most `deciles` rows per group from here on
    whole = Window.partitionBy(*by)
    so_far = whole.orderBy("score_decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_bad = F.sum("bad_loan_count").over(whole)
    return table.select(
        "*", F.try_divide("bad_loan_count", all_bad).alias("share_of_all_bad_loans"),
        F.try_divide(F.sum("bad_loan_count").over(so_far), all_bad).alias("cumulative_bad_loan_share"))


def rank_correlation(df: DataFrame, left: str, right: str, by: Sequence[str] = ()) -> DataFrame:
    """E12. Spearman correlation with average ranks; NULL for constant input.

    Rows are folded to distinct pairs. Ranks of ``left`` are joined to the pairs
    and summed per distinct ``right``, whose own ranks come from a running
    total, so that only one join of distinct values is needed. A value of
    ``left`` that meets very many values of ``right`` is one join key; adaptive
    execution splits such a key over several tasks.
    """
    keys = list(by)
    present = df.where(F.col(left).isNotNull() & F.col(right).isNotNull())
    pairs = present.groupBy(*keys, F.col(left).alias("l"), F.col(right).alias("r")).agg(F.count(F.lit(1)).alias("n"))
    pairs = materialize(pairs, "score-pairs")  # read for the ranks and for the join
    middle = F.col("n_before") + (F.col("n") + F.lit(1)) / F.lit(2.0)
    left_ranks = running_totals(pairs.groupBy(*keys, "l").agg(F.sum("n").alias("n")), "l", ("n",), keys).select(*keys, "l", middle.alias("left_rank"))
    per_right = pairs.join(left_ranks, [*keys, "l"]).groupBy(*keys, "r").agg(
        F.sum(F.col("n") * F.col("left_rank")).alias("left_sum"),
        F.sum(F.col("n") * F.col("left_rank") * F.col("left_rank")).alias("left_square"), F.sum("n").alias("n"))
    ranked = running_totals(per_right, "r", ("n",), keys).withColumn("right_rank", middle)
    n, rr = F.col("n").cast("double"), F.col("right_rank")
    total = F.sum(n)
    mean = (total + F.lit(1.0)) / F.lit(2.0)
    covariance = F.sum(F.col("left_sum") * rr) / total - mean * mean
    left_variance = F.sum("left_square") / total - mean * mean
    right_variance = F.sum(n * rr * rr) / total - mean * mean
    value = F.when((left_variance > 0) & (right_variance > 0), covariance / F.sqrt(left_variance * right_variance))
    return ranked.groupBy(*keys).agg(value.alias("spearman_rank_correlation"))


def evaluate_scores(df: DataFrame, score: str = "p", label: str = "bad_loan", key: str = "id",
                    by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """E9. All four reports. The few columns that they read are written once."""
    df = materialize(df.select(*by, key, score, label), "scored")
    enforce_scores(df, score, label, by)
    return {
        "probability_metrics": probability_metrics(df, score, label, by),
        "calibration_summary": calibration_bins(df, score, label, by),
        "threshold_summary": threshold_metrics(df, score, label, by),
        "decile_summary": score_deciles(df, score, label, key, by),
    }


def unpivot_candidates(df: DataFrame, candidates: Mapping[str, str], reference: str, key: str = "id",
                       label: str = "bad_loan") -> DataFrame:
    """One row per (row, method): columns method, method_order, p, reference_p.

    ``candidates`` maps a method to its probability column, in report order.
    """
    listed = F.array(*[
        F.struct(F.lit(number).alias("method_order"), F.lit(method).alias("method"), F.col(column).alias("p"))
        for number, (method, column) in enumerate(candidates.items())])
    return df.select(key, label, F.col(candidates[reference]).alias("reference_p"), F.inline(listed))


COMPARISONS = ("calibration_summary", "calibration_bands", "discrimination_summary", "discrimination_deciles")


def compare_candidates(df: DataFrame, candidates: Mapping[str, str], reference: str = "uncalibrated", key: str = "id",
                       label: str = "bad_loan", reports: Sequence[str] = COMPARISONS, **tuning: int) -> dict[str, DataFrame]:
    """E13. Reports for several probability columns of the same rows, in method order; only those asked for are computed.

    The columns that they read are written once, one row per row and method.
    """
    if unknown := set(reports) - set(COMPARISONS):
        raise ValueError(f"no such reports: {sorted(unknown)}")
    long = materialize(unpivot_candidates(df, candidates, reference, key, label), "scored")
    by = ["method_order", "method"]
    enforce_scores(long, "p", label, by)
    named = F.col("method").alias("calibration_method")
    made: dict[str, DataFrame] = {}
    if {"calibration_summary", "discrimination_summary"} & set(reports):
        metrics = materialize(probability_metrics(long, "p", label, by), "metrics")
    if {"calibration_summary", "calibration_bands"} & set(reports):
        bins = materialize(calibration_bins(long, "p", label, by), "bins")
    if "calibration_summary" in reports:
        made["calibration_summary"] = metrics.join(weighted_calibration_gap(bins, by), by).orderBy("method_order").select(
            named, "observed_bad_loan_rate", "mean_predicted_bad_loan_probability",
            "weighted_mean_absolute_calibration_gap", "log_loss", "brier_score")
    if "calibration_bands" in reports:
        made["calibration_bands"] = bins.orderBy("bin_index", "method_order").select(
            named, "bin_index", "bin_lower", "bin_upper", "row_count", "mean_predicted_bad_loan_probability",
            "observed_bad_loan_rate", "calibration_gap", "absolute_calibration_gap")
    if "discrimination_summary" in reports:
        correlation = rank_correlation(long, "reference_p", "p", by)
        made["discrimination_summary"] = metrics.join(correlation, by).orderBy("method_order").select(
            named, "roc_auc", "gini", "average_precision",
            F.col("spearman_rank_correlation").alias("spearman_rank_correlation_to_uncalibrated"))
    if "discrimination_deciles" in reports:
        made["discrimination_deciles"] = score_deciles(long, "p", label, key, by, **tuning).orderBy(
            "score_decile", "method_order").select(
            named, "score_decile", "row_count", "mean_predicted_bad_loan_probability", "observed_bad_loan_rate",
            "share_of_all_bad_loans", "cumulative_bad_loan_share")
    return made
