"""Evaluation, policy and monitoring over scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.views import CANDIDATE_ROWS, CANDIDATES, SCORED, loans, rounded, scored, table
from loanweft.functions.checks import score_check
from loanweft.functions.numeric import clip, direction_label, log_odds, sigmoid
from loanweft.operators import evaluation, monitoring, policy

QUERIES: dict = {}


def register(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = (function, sql)
        return function
    return keep


POLICY = policy.Policy(good_return_rate=0.4, bad_loss_rate=0.6, review_margin=0.1)
# the boundaries in doubles, as the policy computes them
_A, _D = f"({POLICY.approve_boundary!r}::double)", f"({POLICY.decline_boundary!r}::double)"
_DECISION = f"CASE WHEN p < {_A} THEN 'approve' WHEN p <= {_D} THEN 'review' ELSE 'decline' END"
_VALUE = "(1 - p) * 0.4e0 - p * 0.6e0"

# --- policy ------------------------------------------------------------------


@register("p6_score_check", SCORED + """
SELECT count(*) AS row_count, count(*) FILTER (p IS NULL OR isnan(p) OR p < 0 OR p > 1) AS invalid_score_count,
  count(*) FILTER (bad_loan NOT IN (0, 1)) AS invalid_label_count, cast(count(DISTINCT bad_loan) AS integer) AS class_count
FROM (SELECT CASE WHEN id % 89 = 0 THEN NULL WHEN id % 83 = 0 THEN 'nan'::double WHEN id % 79 = 0 THEN p + 1.5e0 ELSE p END AS p,
  bad_loan FROM scored)""")
def p6_score_check(spark, folder):
    key, p = F.col("id"), F.col("p")
    broken = (F.when(key % 89 == 0, F.lit(None)).when(key % 83 == 0, F.lit(float("nan")))
              .when(key % 79 == 0, p + F.lit(1.5)).otherwise(p))
    return score_check(scored(spark, folder).withColumn("p", broken))


@register("p7_decision", SCORED + f"SELECT id, {_DECISION} AS decision FROM scored")
def p7_decision(spark, folder):
    return scored(spark, folder).select("id", policy.decision(
        F.col("p"), F.lit(POLICY.approve_boundary), F.lit(POLICY.decline_boundary)).alias("decision"))


# return and loss rate of each order line: its discount and its tax
_RATES = "SELECT l_orderkey, l_linenumber, l_partkey, l_discount AS r, l_tax + 0.5e0 AS l FROM lineitem"


@register("p8_breakeven", f"""
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN r > 0 THEN round(r / (r + l), 9) END AS breakeven FROM ({_RATES})""")
def p8_breakeven(spark, folder):
    value = policy.breakeven(F.col("l_discount"), F.col("l_tax") + F.lit(0.5))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(value, 9).alias("breakeven"))


@register("p9_boundaries", f"""
SELECT l_orderkey, l_linenumber, l_partkey, round(greatest(0e0, r / (r + l) - 0.05e0), 9) AS approve_boundary,
  round(least(1e0, r / (r + l) + 0.05e0), 9) AS decline_boundary FROM ({_RATES}) WHERE r > 0""")
def p9_boundaries(spark, folder):
    value = policy.breakeven(F.col("l_discount"), F.col("l_tax") + F.lit(0.5))
    approve, decline = policy.boundaries(value, F.lit(0.05))
    return table(spark, folder, "lineitem").where("l_discount > 0").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(approve, 9).alias("approve_boundary"),
        F.round(decline, 9).alias("decline_boundary"))


@register("p10_expected_value", SCORED + f"SELECT id, round({_VALUE}, 9) AS expected_value FROM scored")
def p10_expected_value(spark, folder):
    value = policy.expected_value(F.col("p"), F.lit(0.4), F.lit(0.6))
    return scored(spark, folder).select("id", F.round(value, 9).alias("expected_value"))


EVALUATED = SCORED + f""", evaluated AS (SELECT id, bad_loan, p AS calibrated_probability, {_DECISION} AS decision,
  {_VALUE} AS expected_value_per_dollar FROM scored)"""


@register("p11_evaluation_table", EVALUATED + """
SELECT id, bad_loan, calibrated_probability, decision, round(expected_value_per_dollar, 9) AS expected_value_per_dollar
FROM evaluated""")
def p11_evaluation_table(spark, folder):
    rows = policy.evaluation_table(scored(spark, folder), POLICY, keep=("id",))
    return rounded(rows, "expected_value_per_dollar", digits=9)


_SUMMARY = """SELECT decision, count(*) AS row_count, round(avg(bad_loan), 6) AS observed_bad_loan_rate,
  round(avg(calibrated_probability), 6) AS mean_predicted_bad_loan_probability,
  round(avg(expected_value_per_dollar), 6) AS mean_expected_value_per_dollar,
  round(count(*) / (SELECT count(*) FROM evaluated), 6) AS portfolio_share"""
_MEANS = ("observed_bad_loan_rate", "mean_predicted_bad_loan_probability", "mean_expected_value_per_dollar")


@register("a23_policy_summary", EVALUATED + _SUMMARY + " FROM evaluated GROUP BY decision")
def a23_policy_summary(spark, folder):
    rows = policy.evaluation_table(scored(spark, folder), POLICY)
    return rounded(policy.policy_summary(rows), *_MEANS, "portfolio_share")


A24_SQL = EVALUATED + _SUMMARY + """, cast(sum(bad_loan) AS bigint) AS bad_loan_count,
  cast(sum(1 - bad_loan) AS bigint) AS good_loan_count,
  round(cast(sum(bad_loan) AS bigint) / (SELECT cast(sum(bad_loan) AS bigint) FROM evaluated), 6) AS share_of_all_bad_loans,
  round(cast(sum(1 - bad_loan) AS bigint) / (SELECT cast(sum(1 - bad_loan) AS bigint) FROM evaluated), 6) AS share_of_all_good_loans
FROM evaluated GROUP BY decision"""
_SHARES = ("portfolio_share", "share_of_all_bad_loans", "share_of_all_good_loans")


@register("a24_decision_outcomes", A24_SQL)
def a24_decision_outcomes(spark, folder):
    rows = policy.evaluation_table(scored(spark, folder), POLICY)
    return rounded(policy.decision_outcomes(rows), *_MEANS, *_SHARES)


@register("m18_policy_evaluation", A24_SQL)
def m18_policy_evaluation(spark, folder):
    from loanweft.plans.decisions import evaluate_policy
    return rounded(evaluate_policy(scored(spark, folder), POLICY, "p"), *_MEANS, *_SHARES)


@register("m17_policy_per_segment", """
SELECT p_brand, round(r, 6) AS good_loan_return_rate, round(l, 6) AS bad_loan_loss_rate,
  round(r / (r + l), 6) AS breakeven_probability, round(greatest(0e0, r / (r + l) - 0.015e0), 6) AS approve_boundary,
  round(least(1e0, r / (r + l) + 0.015e0), 6) AS decline_boundary
FROM (SELECT p_brand, avg(l_discount) AS r, avg(l_tax) * 10 AS l FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)""")
def m17_policy_per_segment(spark, folder):
    """Policy parameters of each brand, with rates measured on its order lines."""
    rates = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy(
        "p_brand").agg(F.avg("l_discount").alias("r"), (F.avg("l_tax") * 10).alias("l"))
    even = policy.breakeven(F.col("r"), F.col("l"))
    approve, decline = policy.boundaries(even, F.lit(policy.REVIEW_MARGIN))
    return rates.select(
        "p_brand", F.round("r", 6).alias("good_loan_return_rate"), F.round("l", 6).alias("bad_loan_loss_rate"),
        F.round(even, 6).alias("breakeven_probability"), F.round(approve, 6).alias("approve_boundary"),
        F.round(decline, 6).alias("decline_boundary"))


@register("m17_policy_table", """
SELECT round(r, 6) AS good_loan_return_rate, round(l, 6) AS bad_loan_loss_rate, round(r / (r + l), 6) AS breakeven_probability,
  0.015e0 AS review_margin, round(greatest(0e0, r / (r + l) - 0.015e0), 6) AS approve_boundary,
  round(least(1e0, r / (r + l) + 0.015e0), 6) AS decline_boundary
FROM (SELECT avg(l_discount) AS r, avg(l_tax) * 10 AS l FROM lineitem)""")
def m17_policy_table(spark, folder):
    """A policy with rates measured on the order lines, written as a report and read back."""
    from loanweft.plans.decisions import write_policy
    from loanweft.session import shared_path
    rates = table(spark, folder, "lineitem").agg(F.avg("l_discount").alias("r"), (F.avg("l_tax") * 10).alias("l")).first()
    path = shared_path(spark, "query")
    write_policy(spark, policy.Policy(rates.r, rates.l, 0.015), path)
    names = ("good_loan_return_rate", "bad_loan_loss_rate", "breakeven_probability", "review_margin", "approve_boundary", "decline_boundary")
    back = spark.read.option("header", True).csv(path)
    return back.select(*[F.round(F.col(name).cast("double"), 6).alias(name) for name in names])


# --- evaluation ---------------------------------------------------------------

def metrics_sql(rows: str, by: str = "", digits: int = 6) -> str:
    """Common table expressions that end in ``metrics``, with the mid-rank form of the area under the curve."""
    g = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f""", sc AS (SELECT {g}p, count(*)::double AS n, sum(bad_loan)::double AS b FROM {rows} GROUP BY {g}p
), cum AS (SELECT *, sum(n) OVER ({part}ORDER BY p) - n AS nb, sum(b) OVER ({part}ORDER BY p DESC) AS tp,
  sum(n) OVER ({part}ORDER BY p DESC) AS pp, sum(b) OVER ({part}) AS bb, sum(n) OVER ({part}) AS nn FROM sc
), metrics AS (SELECT {g}cast(sum(n) AS bigint) AS row_count, round(sum(b) / sum(n), {digits}) AS observed_bad_loan_rate,
  round(sum(p * n) / sum(n), {digits}) AS mean_predicted_bad_loan_probability,
  round((sum(b * (nb + (n + 1) / 2)) - any_value(bb) * (any_value(bb) + 1) / 2)
    / nullif(any_value(bb) * (any_value(nn) - any_value(bb)), 0), {digits}) AS roc_auc,
  CASE WHEN any_value(nn) > any_value(bb) THEN round(sum(b / nullif(bb, 0) * tp / pp), {digits}) END AS average_precision,
  round(sum(-b * ln(greatest(least(p, 1 - 2.220446049250313e-16), 2.220446049250313e-16))
    - (n - b) * ln(1 - greatest(least(p, 1 - 2.220446049250313e-16), 2.220446049250313e-16))) / sum(n), {digits}) AS log_loss,
  round(sum(b * (1 - p) * (1 - p) + (n - b) * p * p) / sum(n), {digits}) AS brier_score,
  round(2 * ((sum(b * (nb + (n + 1) / 2)) - any_value(bb) * (any_value(bb) + 1) / 2)
    / nullif(any_value(bb) * (any_value(nn) - any_value(bb)), 0)) - 1, {digits}) AS gini FROM cum {group})"""


METRICS = ("observed_bad_loan_rate", "mean_predicted_bad_loan_probability", "roc_auc", "average_precision", "log_loss",
           "brier_score", "gini")


@register("e1_probability_metrics", SCORED + metrics_sql("scored") + "SELECT * FROM metrics")
def e1_probability_metrics(spark, folder):
    return rounded(evaluation.probability_metrics(scored(spark, folder)), *METRICS)


@register("e2_roc_auc_many_scores", SCORED + ", fine AS (SELECT bad_loan, p_fine AS p FROM scored)" + metrics_sql("fine")
          + "SELECT roc_auc, gini FROM metrics")
def e2_roc_auc_many_scores(spark, folder):
    return rounded(evaluation.probability_metrics(scored(spark, folder), "p_fine"), *METRICS).select("roc_auc", "gini")


@register("e3_average_precision", SCORED + ", fine AS (SELECT bad_loan, p_fine AS p FROM scored)" + metrics_sql("fine")
          + "SELECT average_precision FROM metrics")
def e3_average_precision(spark, folder):
    return rounded(evaluation.probability_metrics(scored(spark, folder), "p_fine"), *METRICS).select("average_precision")


@register("e4_log_loss_and_e5_brier", CANDIDATE_ROWS + metrics_sql("long", "method") + """
SELECT method, log_loss, brier_score FROM metrics""")
def e4_log_loss_and_e5_brier(spark, folder):
    return rounded(evaluation.probability_metrics(_long(spark, folder), by=["method"]), *METRICS).select(
        "method", "log_loss", "brier_score")


def _long(spark, folder):
    return evaluation.unpivot_candidates(scored(spark, folder), CANDIDATES, "uncalibrated")


def bins_sql(rows: str, by: str = "") -> str:
    """Right-closed bins against explicit double edges."""
    g = f"{by}, " if by else ""
    edges = " ".join(f"WHEN p <= {k}::double * 0.1e0 THEN {k - 1}" for k in range(1, 10))
    return f""", bins AS (SELECT {g}bin_index, CASE WHEN bin_index = 0 THEN 0e0 ELSE bin_index::double * 0.1e0 END AS bin_lower,
  CASE WHEN bin_index = 9 THEN 1e0 ELSE (bin_index + 1)::double * 0.1e0 END AS bin_upper, row_count,
  round(mp, 6) AS mean_predicted_bad_loan_probability, round(ob, 6) AS observed_bad_loan_rate,
  round(ob - mp, 6) AS calibration_gap, round(abs(ob - mp), 6) AS absolute_calibration_gap, abs(ob - mp) AS raw_gap
FROM (SELECT {g}CASE {edges} ELSE 9 END AS bin_index, count(*) AS row_count, avg(p) AS mp, avg(bad_loan) AS ob
  FROM {rows} GROUP BY ALL))"""


BIN_VALUES = ("mean_predicted_bad_loan_probability", "observed_bad_loan_rate", "calibration_gap", "absolute_calibration_gap")


@register("e6_calibration_bins", SCORED + bins_sql("scored") + "SELECT * EXCLUDE (raw_gap) FROM bins")
def e6_calibration_bins(spark, folder):
    return rounded(evaluation.calibration_bins(scored(spark, folder)), *BIN_VALUES)


def thresholds_sql(rows: str, by: str = "") -> str:
    g = f"{by}, " if by else ""
    values = ", ".join(f"({t}::double)" for t in evaluation.THRESHOLDS)
    return f"""SELECT {g}threshold, count(*) AS row_count, avg(bad_loan) AS observed_bad_loan_rate,
  count(*) FILTER (p >= threshold) / count(*) AS predicted_bad_loan_rate,
  count(*) FILTER (p < threshold AND bad_loan = 0) AS true_negative,
  count(*) FILTER (p >= threshold AND bad_loan = 0) AS false_positive,
  count(*) FILTER (p < threshold AND bad_loan = 1) AS false_negative,
  count(*) FILTER (p >= threshold AND bad_loan = 1) AS true_positive,
  coalesce(count(*) FILTER (p >= threshold AND bad_loan = 1) / nullif(count(*) FILTER (p >= threshold), 0), 0e0) AS "precision",
  coalesce(count(*) FILTER (p >= threshold AND bad_loan = 1) / nullif(count(*) FILTER (bad_loan = 1), 0), 0e0) AS recall,
  coalesce(count(*) FILTER (p >= threshold AND bad_loan = 0) / nullif(count(*) FILTER (bad_loan = 0), 0), 0e0) AS false_positive_rate
FROM {rows}, (VALUES {values}) t(threshold) GROUP BY ALL"""


def _wrapped(sql: str, prefix: str) -> str:
    return prefix + "SELECT * REPLACE (round(observed_bad_loan_rate, 6) AS observed_bad_loan_rate) FROM (" + sql + ")"


@register("e7_threshold_metrics", _wrapped(thresholds_sql("scored"), SCORED))
def e7_threshold_metrics(spark, folder):
    return rounded(evaluation.threshold_metrics(scored(spark, folder)), "observed_bad_loan_rate")


def deciles_sql(rows: str, by: str = "") -> str:
    g = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f""", pos AS (SELECT *, row_number() OVER ({part}ORDER BY p DESC, id) - 1 AS i, count(*) OVER ({part}) AS n FROM {rows}
), dec AS (SELECT {g}cast(greatest(1, (i * 10 + n - 2) // (n - 1)) AS integer) AS score_decile, count(*) AS row_count,
  cast(sum(bad_loan) AS bigint) AS bad_loan_count, min(p) AS minimum_predicted_bad_loan_probability,
  round(avg(p), 6) AS mean_predicted_bad_loan_probability, max(p) AS maximum_predicted_bad_loan_probability,
  round(avg(bad_loan), 6) AS observed_bad_loan_rate FROM pos GROUP BY ALL
), deciles AS (SELECT *, bad_loan_count / cast(sum(bad_loan_count) OVER ({part}) AS bigint) AS share_of_all_bad_loans,
  cast(sum(bad_loan_count) OVER ({part}ORDER BY score_decile) AS bigint) / cast(sum(bad_loan_count) OVER ({part}) AS bigint)
    AS cumulative_bad_loan_share FROM dec)"""


DECILE_VALUES = ("mean_predicted_bad_loan_probability", "observed_bad_loan_rate")


@register("e8_score_deciles", SCORED + deciles_sql("scored") + "SELECT * FROM deciles")
def e8_score_deciles(spark, folder):
    return rounded(evaluation.score_deciles(scored(spark, folder)), *DECILE_VALUES)


@register("e8_constant_score_deciles", SCORED + ", flat AS (SELECT id, bad_loan, 0.3e0 AS p FROM scored)"
          + deciles_sql("flat") + "SELECT * FROM deciles")
def e8_constant_score_deciles(spark, folder):
    """One score for all rows: the key alone decides."""
    rows = scored(spark, folder).withColumn("p", F.lit(0.3))
    return rounded(evaluation.score_deciles(rows), *DECILE_VALUES)


# more groups than a list on the driver should hold, and keys beyond the whole numbers of a double
_GROUPED = ", grouped AS (SELECT id, p_fine AS p, bad_loan, abs(id * 7919) % 1009 AS g, 1152921504606846976 + id AS key FROM scored)"


@register("e8_deciles_of_many_groups", SCORED + _GROUPED + """
, pos AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY p DESC, key) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM grouped)
SELECT g, cast(greatest(1, (i * 3 + n - 2) // (n - 1)) AS integer) AS score_decile, count(*) AS row_count FROM pos WHERE n >= 3 GROUP BY ALL""")
def e8_deciles_of_many_groups(spark, folder):
    rows = scored(spark, folder).select("id", F.col("p_fine").alias("p"), "bad_loan", (F.abs(F.col("id") * 7919) % 1009).alias("g"),
                                        (F.col("id") + F.lit(1 << 60)).alias("key"))
    enough = rows.groupBy("g").agg(F.count("*").alias("n")).where("n >= 3").select("g")
    return evaluation.score_deciles(rows.join(enough, "g"), key="key", by=["g"], deciles=3).select("g", "score_decile", "row_count")


@register("e8_deciles_by_wide_keys", SCORED + """
, pos AS (SELECT id, row_number() OVER (ORDER BY 1152921504606846976 + id DESC) - 1 AS i, count(*) OVER () AS n FROM scored)
SELECT id, cast(greatest(1, (i * 10 + n - 2) // (n - 1)) AS integer) AS bucket FROM pos""")
def e8_deciles_by_wide_keys(spark, folder):
    from loanweft.operators.position import Order, exact_quantile_buckets
    rows = scored(spark, folder).select("id", (F.col("id") + F.lit(1 << 60)).alias("key"))
    return exact_quantile_buckets(rows, (Order("key", False),), 10).select("id", "bucket")


# near-unique scores of order lines
_LINES = """WITH long AS (SELECT 'lines' AS method, l_extendedprice AS reference_p, l_extendedprice * (1 - l_discount) AS value,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS bad_loan FROM lineitem)"""


@register("e12_rank_correlation_of_lines", _LINES.replace("AS value", "AS p") + """, ranked AS (SELECT method, rank() OVER (PARTITION BY method ORDER BY reference_p)
    + (count(*) OVER (PARTITION BY method, reference_p) - 1) / 2e0 AS a,
  rank() OVER (PARTITION BY method ORDER BY p) + (count(*) OVER (PARTITION BY method, p) - 1) / 2e0 AS b FROM long
) SELECT method, round(corr(a, b), 6) AS spearman_rank_correlation FROM ranked GROUP BY method""")
def e12_rank_correlation_of_lines(spark, folder):
    rows = table(spark, folder, "lineitem").select(F.lit("lines").alias("method"), F.col("l_extendedprice").alias("l"),
                                                   (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    return rounded(evaluation.rank_correlation(rows, "l", "r", ["method"]), "spearman_rank_correlation")


@register("e2_roc_auc_of_lines", """
WITH s AS (SELECT l_extendedprice AS v, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem),
  r AS (SELECT y, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2e0 AS k FROM s)
SELECT round((sum(CASE WHEN y = 1 THEN k END) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2e0)
  / (cast(count(*) FILTER (y = 1) AS double) * count(*) FILTER (y = 0)), 6) AS roc_auc FROM r""")
def e2_roc_auc_of_lines(spark, folder):
    rows = table(spark, folder, "lineitem").select(F.col("l_extendedprice").alias("p"), (F.col("l_returnflag") == "R").cast("int").alias("bad_loan"))
    return rounded(evaluation.probability_metrics(rows), "roc_auc").select("roc_auc")


@register("w4_decile_of_row", SCORED + deciles_sql("scored") + """
SELECT id, cast(greatest(1, (i * 10 + n - 2) // (n - 1)) AS integer) AS score_decile FROM pos""")
def w4_decile_of_row(spark, folder):
    from loanweft.operators.position import Order, exact_quantile_buckets
    rows = scored(spark, folder).select("id", "p")
    return exact_quantile_buckets(rows, (Order("p", False), Order("id")), 10, name="score_decile").select("id", "score_decile")


@register("w5_cumulative_share", CANDIDATE_ROWS + deciles_sql("long", "method") + """
SELECT method, score_decile, cumulative_bad_loan_share FROM deciles""")
def w5_cumulative_share(spark, folder):
    return evaluation.score_deciles(_long(spark, folder), by=["method"]).select(
        "method", "score_decile", "cumulative_bad_loan_share")


@register("e9_all_reports", SCORED + metrics_sql("scored") + bins_sql("scored") + deciles_sql("scored") + f"""
SELECT 'probability_metrics' AS report, 0 AS line, row_count, observed_bad_loan_rate AS value FROM metrics
UNION ALL SELECT 'calibration_summary', bin_index, row_count, observed_bad_loan_rate FROM bins
UNION ALL SELECT 'threshold_summary', cast(round(threshold * 10) AS integer), row_count, round(predicted_bad_loan_rate, 6)
  FROM ({thresholds_sql("scored")})
UNION ALL SELECT 'decile_summary', score_decile, row_count, observed_bad_loan_rate FROM deciles""")
def e9_all_reports(spark, folder):
    reports = evaluation.evaluate_scores(scored(spark, folder))
    lines = {"probability_metrics": (F.lit(0), "observed_bad_loan_rate"),
             "calibration_summary": (F.col("bin_index"), "observed_bad_loan_rate"),
             "threshold_summary": (F.round(F.col("threshold") * 10).cast("int"), "predicted_bad_loan_rate"),
             "decile_summary": (F.col("score_decile"), "observed_bad_loan_rate")}
    from loanweft.operators.sets import union_reports
    return union_reports([reports[name].select(
        F.lit(name).alias("report"), line.alias("line"), "row_count", F.round(value, 6).alias("value"))
        for name, (line, value) in lines.items()])


@register("e10_weighted_gap", CANDIDATE_ROWS + bins_sql("long", "method") + """
SELECT method, round(sum(row_count * raw_gap) / sum(row_count), 6) AS weighted_mean_absolute_calibration_gap
FROM bins GROUP BY method""")
def e10_weighted_gap(spark, folder):
    bins = evaluation.calibration_bins(_long(spark, folder), by=["method"])
    return rounded(evaluation.weighted_calibration_gap(bins, ["method"]), "weighted_mean_absolute_calibration_gap")


@register("e11_gini", CANDIDATE_ROWS + metrics_sql("long", "method") + "SELECT method, gini FROM metrics")
def e11_gini(spark, folder):
    return rounded(evaluation.probability_metrics(_long(spark, folder), by=["method"]), *METRICS).select("method", "gini")


SPEARMAN = """, ranked AS (SELECT method, rank() OVER (PARTITION BY method ORDER BY reference_p)
    + (count(*) OVER (PARTITION BY method, reference_p) - 1) / 2e0 AS a,
  rank() OVER (PARTITION BY method ORDER BY p) + (count(*) OVER (PARTITION BY method, p) - 1) / 2e0 AS b FROM long
), spearman AS (SELECT method, round(corr(a, b), 6) AS spearman_rank_correlation FROM ranked GROUP BY method)"""


@register("e12_rank_correlation", CANDIDATE_ROWS + SPEARMAN + "SELECT * FROM spearman")
def e12_rank_correlation(spark, folder):
    return rounded(evaluation.rank_correlation(_long(spark, folder), "reference_p", "p", ["method"]),
                   "spearman_rank_correlation")


def _comparison(spark, folder, report):
    return evaluation.compare_candidates(scored(spark, folder), CANDIDATES, reports=[report])[report]


@register("e13_calibration_summary", CANDIDATE_ROWS + metrics_sql("long", "method") + bins_sql("long", "method") + """
SELECT m.method AS calibration_method, observed_bad_loan_rate, mean_predicted_bad_loan_probability,
  weighted_mean_absolute_calibration_gap, log_loss, brier_score FROM metrics m JOIN (
    SELECT method, round(sum(row_count * raw_gap) / sum(row_count), 6) AS weighted_mean_absolute_calibration_gap
    FROM bins GROUP BY method) USING (method)""")
def e13_calibration_summary(spark, folder):
    return rounded(_comparison(spark, folder, "calibration_summary"), "observed_bad_loan_rate", "log_loss", "brier_score",
                   "mean_predicted_bad_loan_probability", "weighted_mean_absolute_calibration_gap")


@register("e13_calibration_bands", CANDIDATE_ROWS + bins_sql("long", "method") + """
SELECT * EXCLUDE (raw_gap, method), method AS calibration_method FROM bins""")
def e13_calibration_bands(spark, folder):
    return rounded(_comparison(spark, folder, "calibration_bands"), *BIN_VALUES)


@register("e13_discrimination_summary", CANDIDATE_ROWS + metrics_sql("long", "method") + SPEARMAN + """
SELECT method AS calibration_method, roc_auc, gini, average_precision,
  spearman_rank_correlation AS spearman_rank_correlation_to_uncalibrated FROM metrics JOIN spearman USING (method)""")
def e13_discrimination_summary(spark, folder):
    return rounded(_comparison(spark, folder, "discrimination_summary"), "roc_auc", "gini", "average_precision",
                   "spearman_rank_correlation_to_uncalibrated")


@register("e13_discrimination_deciles", CANDIDATE_ROWS + deciles_sql("long", "method") + """
SELECT method AS calibration_method, score_decile, row_count, mean_predicted_bad_loan_probability,
  observed_bad_loan_rate, share_of_all_bad_loans, cumulative_bad_loan_share FROM deciles""")
def e13_discrimination_deciles(spark, folder):
    return rounded(_comparison(spark, folder, "discrimination_deciles"), *DECILE_VALUES)


@register("u1_threshold_reports", _wrapped(thresholds_sql("long", "method"), CANDIDATE_ROWS))
def u1_threshold_reports(spark, folder):
    """Threshold reports of several methods in one table."""
    return rounded(evaluation.threshold_metrics(_long(spark, folder), by=["method"]), "observed_bad_loan_rate")


# --- scalar functions on scores ----------------------------------------------

@register("f7_logistic_and_log_odds", SCORED + """
SELECT id, round(1 / (1 + exp(-z)), 9) AS probability,
  CASE WHEN p > 0 AND p < 1 THEN round(ln(p / (1 - p)), 9) END AS log_odds FROM scored""")
def f7_logistic_and_log_odds(spark, folder):
    p = F.col("p")
    return scored(spark, folder).select(
        "id", F.round(sigmoid(F.col("z")), 9).alias("probability"),
        F.when((p > 0) & (p < 1), F.round(log_odds(p), 9)).alias("log_odds"))


@register("f8_clip_and_logs", SCORED + """
SELECT id, greatest(0.05e0, least(0.95e0, p)) AS clipped, round(ln(greatest(0.05e0, least(0.95e0, p))), 9) AS l,
  round(ln(1 + p), 9) AS l1, abs(z) AS size FROM scored""")
def f8_clip_and_logs(spark, folder):
    clipped = clip(F.col("p"), 0.05, 0.95)
    return scored(spark, folder).select(
        "id", clipped.alias("clipped"), F.round(F.ln(clipped), 9).alias("l"), F.round(F.log1p("p"), 9).alias("l1"),
        F.abs("z").alias("size"))


@register("f9_direction_label", SCORED + """
SELECT id, CASE WHEN z > 0 THEN 'increases_bad_loan_risk' WHEN z < 0 THEN 'decreases_bad_loan_risk' ELSE 'neutral' END
  AS direction FROM scored""")
def f9_direction_label(spark, folder):
    return scored(spark, folder).select("id", direction_label(F.col("z")).alias("direction"))


# --- reports named in the documents ------------------------------------------

@register("d1_cohort_report", EVALUATED + """
SELECT month_no, count(*) AS loan_count, round(sum(loan_amnt), 2) AS total_exposure, round(avg(p), 6) AS mean_predicted_risk,
  round(avg(CASE WHEN decision = 'approve' THEN 1e0 ELSE 0e0 END), 6) AS simulated_approval_rate,
  round(avg(s.bad_loan), 6) AS observed_bad_loan_rate
FROM scored s JOIN evaluated e USING (id) GROUP BY month_no""")
def d1_cohort_report(spark, folder):
    rows = scored(spark, folder).withColumn("decision", policy.decision(
        F.col("p"), F.lit(POLICY.approve_boundary), F.lit(POLICY.decline_boundary)))
    report = monitoring.cohort_report(rows, "month_no", "loan_amnt")
    return rounded(rounded(report, "total_exposure", digits=2), "mean_predicted_risk", "simulated_approval_rate",
                   "observed_bad_loan_rate")


_BAND = "CASE WHEN p <= 0.05e0 THEN 'A' WHEN p <= 0.1e0 THEN 'B' WHEN p <= 0.2e0 THEN 'C' WHEN p <= 0.35e0 THEN 'D' ELSE 'E' END"


@register("d2_risk_bands", SCORED + f"""
SELECT id, cast(round(1000 * (1 - p_fine)) AS integer) AS risk_score, {_BAND} AS risk_band FROM scored""")
def d2_risk_bands(spark, folder):
    return scored(spark, folder).select(
        "id", monitoring.risk_score(F.col("p_fine")).alias("risk_score"), monitoring.risk_band(F.col("p")).alias("risk_band"))


@register("d3_band_mix", SCORED + f"""
SELECT month_no, risk_band, count(*) AS loan_count, round(avg(bad_loan), 6) AS observed_bad_loan_rate,
  round(count(*) / cast(sum(count(*)) OVER (PARTITION BY month_no) AS bigint), 6) AS cohort_share
FROM (SELECT *, {_BAND} AS risk_band FROM scored) GROUP BY month_no, risk_band""")
def d3_band_mix(spark, folder):
    rows = scored(spark, folder).withColumn("risk_band", monitoring.risk_band(F.col("p")))
    return rounded(monitoring.band_mix(rows, "month_no"), "observed_bad_loan_rate", "cohort_share")


DRIFT_END = 1998 * 12  # months before are the reference period


@register("d4_stability_index", SCORED + f""", base AS (SELECT loan_amnt AS v FROM scored WHERE month_no < {DRIFT_END}
), numbered AS (SELECT v, row_number() OVER (ORDER BY v) AS k, count(*) OVER () AS n FROM base
), edges AS (SELECT DISTINCT v AS e FROM numbered, range(1, 10) r(i) WHERE k = (i * n + 9) // 10
), binned AS (SELECT month_no, (SELECT count(*) FROM edges WHERE loan_amnt > e) AS bin FROM scored
), shares AS (SELECT m.month_no, b.bin, greatest(count(x.bin) / any_value(m.n), 1e-6) AS a FROM
    (SELECT month_no, count(*) AS n FROM scored GROUP BY 1) m CROSS JOIN range(0, 10) b(bin)
    LEFT JOIN binned x ON x.month_no = m.month_no AND x.bin = b.bin GROUP BY 1, 2
), expected AS (SELECT b.bin, greatest(count(x.bin) / (SELECT count(*) FROM base), 1e-6) AS e FROM range(0, 10) b(bin)
    LEFT JOIN binned x ON x.bin = b.bin AND x.month_no < {DRIFT_END} GROUP BY 1)
SELECT month_no, (SELECT count(*) FROM scored c WHERE c.month_no = shares.month_no) AS loan_count,
  round(sum((a - e) * ln(a / e)), 6) AS population_stability_index FROM shares JOIN expected USING (bin) GROUP BY 1""")
def d4_stability_index(spark, folder):
    """Drift of the loan amount against the first years."""
    rows = scored(spark, folder)
    base = rows.where(F.col("month_no") < DRIFT_END)
    edges = monitoring.quantile_edges(base, "loan_amnt")
    return rounded(monitoring.stability_index(rows, "loan_amnt", "month_no", base, edges), "population_stability_index")


@register("d5_plausibility", """
SELECT c_custkey AS id, unnest(list_filter([CASE WHEN c_acctbal < 0 THEN 'annual_inc_in_range' END,
  CASE WHEN NOT c_acctbal > 1000 THEN 'spare_positive' END,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'purpose_present' END], lambda x: x IS NOT NULL)) AS rule FROM customer""")
def d5_plausibility(spark, folder):
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("annual_inc"), (F.col("c_acctbal") - 1000).alias("spare"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("purpose"))
    return monitoring.plausibility_violations(rows, "id", [
        monitoring.between("annual_inc", 0.0), monitoring.positive("spare"), monitoring.required("purpose")])


@register("d6_out_of_range", """
WITH train AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM orders WHERE o_orderdate < TIMESTAMP '1995-02-01')
SELECT o_orderkey, CASE WHEN o_totalprice < a OR o_totalprice > b THEN 'o_totalprice' ELSE '' END AS flags FROM orders, train""")
def d6_out_of_range(spark, folder):
    """Orders whose price lies outside what the first month showed."""
    orders = table(spark, folder, "orders")
    ranges = monitoring.training_ranges(orders.where(F.col("o_orderdate") < F.lit("1995-02-01").cast("timestamp_ntz")),
                                        ["o_totalprice"])
    return monitoring.flag_out_of_range(orders, ranges).select(
        "o_orderkey", F.array_join("out_of_range_features", ",").alias("flags"))


@register("d7_credit_history", None)
def d7_credit_history(spark, folder):
    from loanweft.functions.dates import parse_month
    months = monitoring.credit_history_months(parse_month(F.col("issue_d")), parse_month(F.col("earliest_cr_line")))
    return loans(spark, folder).select("id", months.cast("long").alias("months"))


@register("d9_cohort_metrics", SCORED + metrics_sql("scored", "month_no", 10) + """
SELECT * FROM metrics""")
def d9_cohort_metrics(spark, folder):
    return rounded(monitoring.cohort_metrics(scored(spark, folder), "month_no"), *METRICS, digits=10)


from driver_queries.views import LOANS, month_sql  # noqa: E402

QUERIES["d7_credit_history"] = (d7_credit_history, LOANS + f"""
SELECT id, date_diff('month', {month_sql('earliest_cr_line')}, {month_sql('issue_d')}) AS months FROM loans""")
