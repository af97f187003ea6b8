"""The trained chain on labels that depend on the features: its metrics, decisions and bands themselves are compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.data_queries import scratch
from driver_queries.model_queries import KEEP, _recursive, _splits, interpolated_sql
from driver_queries.score_queries import METRICS, metrics_sql
from driver_queries.views import LOANS, rounded
from loanweft.operators import calibration, features, models
from loanweft.operators.monitoring import BAND_EDGES, BAND_NAMES
from loanweft.operators.policy import Policy
from loanweft.plans.calibration import finalize_calibration
from loanweft.plans.decisions import evaluate_policy, score_loans
from loanweft.plans.training import train_baselines
from loanweft.sources import writers

QUERIES: dict = {}
COLUMNS = features.FeatureColumns(("loan_amnt", "open_acc"), ())
POLICY = Policy(good_return_rate=0.35, review_margin=0.04)


def register(name: str, sql: str):
    def keep(function):
        QUERIES[name] = (function, sql)
        return function
    return keep


def _rows(spark, folder):
    """Split loans whose risk rises with the amount and the region's number."""
    chance = ((F.col("id") * 104729) % 997).cast("double") / F.lit(996.0)
    risk = F.lit(0.05) + F.lit(0.5) * F.least(F.col("loan_amnt") / F.lit(400000.0), F.lit(1.0)) + F.lit(0.08) * F.col("open_acc")
    return _splits(spark, folder).withColumn("bad_loan", F.when(chance < risk, 1).otherwise(0))


def _trained(spark, folder):
    rows = _rows(spark, folder)
    fitted = features.fit_features(rows.where(F.col("modeling_split") == "train"), COLUMNS)
    return rows, fitted, writers.write_table(fitted.transform(rows, KEEP), scratch(spark), ["modeling_split"])


RISKY = LOANS + """, risky AS (SELECT * REPLACE (CASE WHEN cast((id * 104729) % 997 AS double) / 996e0
    < 0.05e0 + 0.5e0 * least(loan_amnt / 400000e0, 1e0) + 0.08e0 * open_acc THEN 1 ELSE 0 END AS bad_loan) FROM splits
), moments AS (SELECT avg(loan_amnt) AS m1, stddev_pop(loan_amnt) AS s1, avg(open_acc) AS m2, stddev_pop(open_acc) AS s2
  FROM risky WHERE modeling_split = 'train'
), x AS (SELECT id, modeling_split, bad_loan, (loan_amnt - m1) / s1 AS x1, (open_acc - m2) / s2 AS x2 FROM risky, moments
), train AS (SELECT x1, x2, bad_loan::double AS y FROM x WHERE modeling_split = 'train')"""
# penalized logistic regression on two features: Newton steps, each solved by determinants
MODEL = _recursive(RISKY + """, fit_it(k, w1, w2, w0) AS (SELECT 0, 0e0, 0e0, 0e0 UNION ALL
  SELECT k + 1, w1 - (u * (f * h - g * g) - c * (v * h - g * t) + e * (v * g - f * t)) / (a * (f * h - g * g) - c * (c * h - g * e) + e * (c * g - f * e)),
    w2 - (a * (v * h - g * t) - u * (c * h - g * e) + e * (c * t - v * e)) / (a * (f * h - g * g) - c * (c * h - g * e) + e * (c * g - f * e)),
    w0 - (a * (f * t - v * g) - c * (c * t - v * e) + u * (c * g - f * e)) / (a * (f * h - g * g) - c * (c * h - g * e) + e * (c * g - f * e))
  FROM (SELECT k, w1, w2, w0, sum(q * x1 * x1) + 1 AS a, sum(q * x1 * x2) AS c, sum(q * x1) AS e, sum(q * x2 * x2) + 1 AS f, sum(q * x2) AS g,
      sum(q) AS h, sum(r * x1) + w1 AS u, sum(r * x2) + w2 AS v, sum(r) AS t
    FROM (SELECT *, p - y AS r, p * (1 - p) AS q FROM (
      SELECT k, w1, w2, w0, x1, x2, y, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + w0))) AS p FROM fit_it, train WHERE k < 25)) GROUP BY k, w1, w2, w0)
), fit AS (SELECT w1, w2, w0 FROM fit_it ORDER BY k DESC LIMIT 1
), risk AS MATERIALIZED (SELECT id, modeling_split, bad_loan, w1 * x1 + w2 * x2 + w0 AS z, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + w0))) AS p FROM x, fit)""")
# max-min form of the isotonic fit on the validation rows
STEPS = MODEL + """, iso_d AS (SELECT z AS x, sum(bad_loan)::double AS s, count(*)::double AS n FROM risk WHERE modeling_split = 'validation' GROUP BY z
), iso_c AS (SELECT x, s, n, row_number() OVER (ORDER BY x) AS k, sum(s) OVER (ORDER BY x) AS cs, sum(n) OVER (ORDER BY x) AS cn FROM iso_d
), iso_low AS (SELECT b.x, a.k, min((b.cs - a.cs + a.s) / (b.cn - a.cn + a.n)) OVER (PARTITION BY a.k ORDER BY b.k DESC ROWS UNBOUNDED PRECEDING) AS low
  FROM iso_c a JOIN iso_c b ON b.k >= a.k
), iso AS (SELECT x, max(low) AS fitted FROM iso_low GROUP BY x)"""


def _decided(rows: str) -> str:
    return STEPS + interpolated_sql("iso_at", "iso", rows) + f""", decided AS (SELECT r.*, value AS p_isotonic,
  CASE WHEN value < {POLICY.approve_boundary!r}e0 THEN 'approve' WHEN value <= {POLICY.decline_boundary!r}e0 THEN 'review' ELSE 'decline' END AS decision,
  CASE {" ".join(f"WHEN value <= {edge!r}e0 THEN '{name}'" for edge, name in zip(BAND_EDGES, BAND_NAMES))} ELSE '{BAND_NAMES[-1]}' END AS risk_band
  FROM {rows} r JOIN iso_at USING (z))"""


@register("m10_two_feature_baselines", MODEL + """, long AS (
  SELECT 'dummy_prior_baseline' AS model_name, bad_loan, (SELECT avg(y) FROM train) AS p FROM risk WHERE modeling_split = 'validation'
  UNION ALL SELECT 'logistic_regression_baseline', bad_loan, p FROM risk WHERE modeling_split = 'validation')"""
          + metrics_sql("long", "model_name", 4) + "SELECT *, 'validation' AS dataset_name FROM metrics")
def m10_two_feature_baselines(spark, folder):
    """Both baselines fitted, saved and judged, all metrics."""
    _, fitted, prepared = _trained(spark, folder)
    return rounded(train_baselines(prepared, list(fitted.names), scratch(spark)).reports["validation_performance"], *METRICS, digits=4)


@register("m16_trained_decisions", _decided("(SELECT * FROM risk WHERE modeling_split = 'test')") + """
SELECT decision, count(*) AS row_count, cast(sum(bad_loan) AS bigint) AS bad_loan_count, count(*) - cast(sum(bad_loan) AS bigint) AS good_loan_count,
  round(avg(p_isotonic), 4) AS mean_predicted_bad_loan_probability FROM decided GROUP BY decision""")
def m16_trained_decisions(spark, folder):
    """Prepare, fit, calibrate on validation, judge and decide on test."""
    _, _, prepared = _trained(spark, folder)
    model = models.fit_logistic(prepared.where(F.col("modeling_split") == "train"))
    final = finalize_calibration(model, prepared, scratch(spark))
    outcomes = evaluate_policy(final.test_scores, POLICY, "p_isotonic")
    return rounded(outcomes.select("decision", "row_count", "bad_loan_count", "good_loan_count", "mean_predicted_bad_loan_probability"),
                   "mean_predicted_bad_loan_probability", digits=4)


@register("d8_bands_and_decisions", _decided("risk") + """
SELECT risk_band, decision, count(*) AS loan_count, round(avg(p), 4) AS uncalibrated, round(avg(p_isotonic), 4) AS calibrated
FROM decided GROUP BY risk_band, decision""")
def d8_bands_and_decisions(spark, folder):
    """All loans scored, banded and decided by the saved and loaded stages."""
    path = scratch(spark)
    rows, fitted, prepared = _trained(spark, folder)
    model = models.fit_logistic(prepared.where(F.col("modeling_split") == "train"))
    validation = models.score_logistic(model, prepared.where(F.col("modeling_split") == "validation"), ["id", "bad_loan"])
    made = {"pipeline": fitted.pipeline, "logistic": model, "isotonic": calibration.fit_isotonic(validation)}
    for kind, stage in made.items():
        writers.save_model(stage, f"{path}/{kind}")
    scores = score_loans(rows, *[writers.load_model(spark, f"{path}/{kind}", kind) for kind in made], policy=POLICY)
    return rounded(scores.groupBy("risk_band", "decision").agg(
        F.count(F.lit(1)).alias("loan_count"), F.avg("uncalibrated_probability").alias("uncalibrated"),
        F.avg("calibrated_probability").alias("calibrated")), "uncalibrated", "calibrated", digits=4)
