"""Feature preparation, baseline models and recalibration."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from driver_queries.data_queries import scratch
from driver_queries.score_queries import METRICS, bins_sql, metrics_sql
from driver_queries.views import LOANS, SCORED, rounded, scored, split_loans
from loanweft.operators import calibration, evaluation, features, models
from loanweft.operators.splits import fit_time_split
from loanweft.sources import readers, writers
from loanweft.session import literal_table

QUERIES: dict = {}


def register(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = (function, sql)
        return function
    return keep


NUMERIC = ("loan_amnt", "annual_inc", "dti", "open_acc", "il_util")
CATEGORICAL = ("emp_length", "purpose", "term", "application_type")
COLUMNS = features.FeatureColumns(NUMERIC, CATEGORICAL, ("title", "addr_state"))
ONE_COLUMN = features.FeatureColumns(("loan_amnt",), ())
KEEP = ["id", "issue_month", "bad_loan", "modeling_split"]

TRAIN = LOANS + ", train AS (SELECT * FROM splits WHERE modeling_split = 'train')"
STATISTICS = TRAIN + ", numbers AS (" + " UNION ALL ".join(
    f"SELECT {i} AS i, '{c}' AS column_name, m AS median, avg(coalesce({c}, m)) AS mean, stddev_pop(coalesce({c}, m)) AS scale "
    f"FROM train, (SELECT median({c}) AS m FROM train) GROUP BY m" for i, c in enumerate(NUMERIC)) + ")"
SLOTS = STATISTICS + ", cats AS (" + " UNION ALL ".join(
    f"SELECT DISTINCT {i} AS c, '{c}' AS column_name, coalesce({c}, 'Missing') AS v FROM train"
    for i, c in enumerate(CATEGORICAL)) + f"""), slots AS (
  SELECT i AS slot, 'numeric__' || column_name AS feature_name FROM numbers
  UNION ALL SELECT {len(NUMERIC)} + row_number() OVER (ORDER BY c, v) - 1, 'categorical__' || column_name || '_' || v FROM cats)"""
# per row: sum of the scaled numbers, and number of categories known from training
PREPARED = SLOTS + ", prepared AS (SELECT id, modeling_split, bad_loan, " + " + ".join(
    f"(coalesce({c}, (SELECT median FROM numbers WHERE i = {i})) - (SELECT mean FROM numbers WHERE i = {i})) "
    f"/ (SELECT scale FROM numbers WHERE i = {i})" for i, c in enumerate(NUMERIC)) + " AS number_sum, " + " + ".join(
    f"CASE WHEN coalesce({c}, 'Missing') IN (SELECT v FROM cats WHERE c = {i}) THEN 1 ELSE 0 END"
    for i, c in enumerate(CATEGORICAL)) + " AS known FROM splits)"


def _splits(spark, folder):
    """The split loans as the written table that the fitting steps read several times."""
    return writers.write_splits(split_loans(spark, folder), scratch(spark), temporary=())


def _train(spark, folder):
    return _splits(spark, folder).where(F.col("modeling_split") == "train")


def _prepared(spark, folder, columns=COLUMNS):
    rows = _splits(spark, folder)
    fitted = features.fit_features(rows.where(F.col("modeling_split") == "train"), columns)
    return rows, fitted, writers.write_table(fitted.transform(rows, KEEP), scratch(spark), ["modeling_split"])


@register("m1_numeric_statistics", STATISTICS + """
SELECT column_name, round(median, 6) AS median, round(mean, 6) AS mean, round(scale, 6) AS scale FROM numbers""")
def m1_numeric_statistics(spark, folder):
    found = features.numeric_statistics(_train(spark, folder), NUMERIC)
    rows = [(name, s.median, s.mean, s.scale) for name, s in found.items()]
    return rounded(literal_table(spark, rows, "column_name string, median double, mean double, scale double"),
                   "median", "mean", "scale")


@register("m1_exact_medians_by_rank", "SELECT " + ", ".join(
    f"round(median({c}), 6) AS {c}" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")) + " FROM lineitem")
def m1_exact_medians_by_rank(spark, folder):
    """The counting method, as used for columns with very many values."""
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    medians = features.exact_medians(spark.read.parquet(f"{folder}/lineitem.parquet"), names)
    return rounded(literal_table(spark, [tuple(medians[n] for n in names)], ", ".join(f"{n} double" for n in names)), *names)


@register("m2_one_hot_counts", SLOTS + """, counted AS (""" + " UNION ALL ".join(
    f"SELECT 'categorical__{c}_' || coalesce({c}, 'Missing') AS feature_name, count(*) AS n FROM splits GROUP BY 1"
    for c in CATEGORICAL) + """) SELECT feature_name, n FROM counted WHERE feature_name IN (SELECT feature_name FROM slots)""")
def m2_one_hot_counts(spark, folder):
    _, fitted, prepared = _prepared(spark, folder)
    sums = prepared.agg(Summarizer.sum(F.col("features")).alias("s"))
    names = F.array(*[F.lit(name) for name in fitted.names])
    both = F.arrays_zip(names.alias("feature_name"), vector_to_array("s").alias("n"))
    return sums.select(F.inline(both)).where(F.startswith("feature_name", F.lit("categorical__"))).select(
        "feature_name", F.round("n").cast("long").alias("n"))


@register("m2_categories_without_a_list", """
WITH cats AS (SELECT c, v, row_number() OVER (ORDER BY c, v) + 9 AS slot FROM (
  SELECT DISTINCT 0 AS c, cast(o_custkey AS varchar) AS v FROM orders WHERE o_orderkey % 10 <> 0 UNION
  SELECT DISTINCT 1, o_orderpriority FROM orders WHERE o_orderkey % 10 <> 0))
SELECT o_orderkey, concat_ws(',', p.slot, m.slot) AS slots
FROM orders LEFT JOIN cats p ON p.c = 0 AND p.v = cast(o_custkey AS varchar) LEFT JOIN cats m ON m.c = 1 AND m.v = o_orderpriority""")
def m2_categories_without_a_list(spark, folder):
    """As many categories as there are customers, fitted on nine tenths of the orders."""
    rows, columns = spark.read.parquet(f"{folder}/orders.parquet"), ["o_custkey", "o_orderpriority"]
    known = features.category_dictionary(rows.where("o_orderkey % 10 <> 0"), columns, first_slot=10)
    made = features.slotted(rows, "o_orderkey", columns, known)
    return made.select("o_orderkey", F.concat_ws(",", F.col("slots").cast("array<string>")).alias("slots"))


@register("m3_assembled_vectors", PREPARED + """
SELECT id, cast((SELECT count(*) FROM slots) AS integer) AS size, round(number_sum + known, 6) AS total, known AS known
FROM prepared""")
def m3_assembled_vectors(spark, folder):
    _, fitted, prepared = _prepared(spark, folder)
    values = vector_to_array("features")
    hot = F.slice(values, len(NUMERIC) + 1, len(fitted.names) - len(NUMERIC))
    plus = lambda a, b: a + b
    return prepared.select(
        "id", F.size(values).alias("size"), F.round(F.aggregate(values, F.lit(0.0), plus), 6).alias("total"),
        F.aggregate(hot, F.lit(0.0), plus).cast("int").alias("known"))


@register("m4_feature_names", SLOTS + "SELECT cast(slot AS integer) AS slot, feature_name FROM slots")
def m4_feature_names(spark, folder):
    fitted = features.fit_features(_train(spark, folder), COLUMNS)
    return literal_table(spark, list(enumerate(fitted.names)), "slot int, feature_name string")


@register("m5_prepared_splits", PREPARED + """
SELECT modeling_split, count(*) AS row_count, round(sum(number_sum + known), 3) AS total, cast(sum(bad_loan) AS bigint) AS bad
FROM prepared GROUP BY 1""")
def m5_prepared_splits(spark, folder):
    """Everything written: vectors by split, names, fitted stages, summary."""
    from loanweft.plans.training import prepare_features
    _, prepared = prepare_features(_splits(spark, folder), COLUMNS, scratch(spark))
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, b: a + b)
    return prepared.groupBy("modeling_split").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.sum(total), 3).alias("total"),
        F.sum(F.col("bad_loan").cast("long")).alias("bad"))


A22_ROWS = " UNION ALL ".join(
    [f"SELECT '{s}_{kind}_rows' AS metric, count(*) AS value FROM splits WHERE modeling_split = '{s}'"
     for s in ("train", "validation", "test") for kind in ("input", "preprocessed")]
    + ["SELECT 'preprocessed_feature_count', count(*) FROM slots", f"SELECT 'numeric_feature_count', {len(NUMERIC)}",
       f"SELECT 'categorical_feature_count', {len(CATEGORICAL)}", "SELECT 'excluded_feature_count', 2"]
    + [f"SELECT '{s}_nonzero_values', cast(sum({len(NUMERIC)} + known) AS bigint) FROM prepared WHERE modeling_split = '{s}'"
       for s in ("train", "validation", "test")])


@register("a22_preprocessing_summary", PREPARED + A22_ROWS)
def a22_preprocessing_summary(spark, folder):
    rows, fitted, prepared = _prepared(spark, folder)
    return features.preprocessing_summary(rows, prepared, COLUMNS, fitted.names)


@register("s7_feature_names_file", SLOTS + "SELECT cast(slot AS integer) AS slot, feature_name FROM slots")
def s7_feature_names_file(spark, folder):
    path = scratch(spark)
    _, fitted, prepared = _prepared(spark, folder)
    writers.write_features(prepared, fitted.names, f"{path}/features", f"{path}/names")
    return literal_table(spark, list(enumerate(readers.read_feature_names(spark, f"{path}/names"))),
                                 "slot int, feature_name string")


@register("s8_checked_features", PREPARED + """
SELECT id, cast((SELECT count(*) FROM slots) AS integer) AS size, bad_loan FROM prepared""")
def s8_checked_features(spark, folder):
    """Vectors and labels read back with their checks (also J5, S12)."""
    path = scratch(spark)
    _, fitted, prepared = _prepared(spark, folder)
    writers.write_features(prepared, fitted.names, f"{path}/features", f"{path}/names")
    checked = readers.read_features(spark, f"{path}/features", names=fitted.names)
    return checked.select("id", F.size(vector_to_array("features")).alias("size"), "bad_loan")


@register("s14_saved_preparation", PREPARED + "SELECT id, round(number_sum + known, 6) AS total FROM prepared")
def s14_saved_preparation(spark, folder):
    """Rows prepared by the saved and loaded stages."""
    path = scratch(spark)
    rows = _splits(spark, folder)
    fitted = features.fit_features(rows.where(F.col("modeling_split") == "train"), COLUMNS)
    writers.save_model(fitted.pipeline, path)
    loaded = writers.load_model(spark, path, "pipeline")
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, b: a + b)
    return loaded.transform(rows).select("id", F.round(total, 6).alias("total"))


# --- baselines ----------------------------------------------------------------

@register("m6_prior_baseline", LOANS + """
SELECT id, round((SELECT avg(bad_loan) FROM splits WHERE modeling_split = 'train'), 6) AS p FROM splits
WHERE modeling_split = 'validation'""")
def m6_prior_baseline(spark, folder):
    rows = split_loans(spark, folder, "bad_loan")
    prior = models.prior_rate(rows.where(F.col("modeling_split") == "train"))
    return rounded(models.apply_prior(rows.where(F.col("modeling_split") == "validation"), prior, "p").select("id", "p"), "p")


# penalized one-feature logistic regression by Newton steps
ONE_FEATURE = TRAIN + """, moments AS (SELECT avg(loan_amnt) AS m, stddev_pop(loan_amnt) AS s FROM train
), points AS (SELECT (loan_amnt - m) / s AS x, bad_loan::double AS y FROM train, moments
)"""


def newton_sql(name: str, points: str, penalty: str, steps: int = 30) -> str:
    """Recursive common table expressions ending in ``name`` with slope w and intercept b."""
    return f""", {name}_it(k, w, b) AS (SELECT 0, 0e0, 0e0 UNION ALL
  SELECT k + 1, w - (h00 * g1 - h10 * g0) / (h11 * h00 - h10 * h10), b - (h11 * g0 - h10 * g1) / (h11 * h00 - h10 * h10)
  FROM (SELECT k, w, b, sum((p - y) * x) + {penalty} * w AS g1, sum(p - y) AS g0, sum(p * (1 - p) * x * x) + {penalty} AS h11,
      sum(p * (1 - p) * x) AS h10, sum(p * (1 - p)) AS h00
    FROM (SELECT k, w, b, x, y, 1 / (1 + exp(-(w * x + b))) AS p FROM {name}_it, {points} WHERE k < {steps}) GROUP BY k, w, b)
), {name} AS (SELECT w, b FROM {name}_it ORDER BY k DESC LIMIT 1)"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


FITTED = _recursive(ONE_FEATURE + newton_sql("fit", "points", "1e0"))


def _one_feature(spark, folder):
    rows, fitted, prepared = _prepared(spark, folder, ONE_COLUMN)
    return fitted, prepared, models.fit_logistic(prepared.where(F.col("modeling_split") == "train"))


@register("m7_logistic_one_feature", FITTED + "SELECT round(w, 5) AS slope, round(b, 5) AS intercept FROM fit")
def m7_logistic_one_feature(spark, folder):
    _, _, model = _one_feature(spark, folder)
    return rounded(literal_table(spark, [(float(model.coefficients[0]), float(model.intercept))],
                                         "slope double, intercept double"), "slope", "intercept", digits=5)


@register("m7_logistic_all_features", SLOTS + "SELECT feature_name, 0e0 AS penalized_slope FROM slots")
def m7_logistic_all_features(spark, folder):
    """Slope of the penalized loss at the fitted point, per slot: zero at the optimum."""
    _, fitted, prepared = _prepared(spark, folder)
    train = prepared.where(F.col("modeling_split") == "train")
    model = models.fit_logistic(train)
    residual = F.get(vector_to_array("probability"), F.lit(1)) - F.col("bad_loan")
    scored_rows = model.transform(train).select(residual.alias("r"), "features")
    # weights must not be negative: the two signs are summed apart
    sums = scored_rows.groupBy((F.col("r") > 0).alias("above")).agg(
        Summarizer.metrics("sum").summary(F.col("features"), F.abs("r")).alias("m")).select(
        F.posexplode(F.transform(vector_to_array("m.sum"), lambda v: F.when(F.col("above"), v).otherwise(-v))).alias("slot", "v"))
    slopes = sums.groupBy("slot").agg(F.sum("v").alias("loss_slope"))
    weights = literal_table(spark, [(i, name, float(model.coefficients[i])) for i, name in enumerate(fitted.names)],
                                    "slot int, feature_name string, coefficient double")
    return weights.join(slopes, "slot").select(
        "feature_name", F.abs(F.round(F.col("loss_slope") + F.col("coefficient"), 1)).alias("penalized_slope"))


@register("m8_validation_probabilities", FITTED + """
SELECT purpose, count(*) AS n, round(avg(1 / (1 + exp(-(w * (loan_amnt - m) / s + b)))), 5) AS mean_p
FROM splits, moments, fit WHERE modeling_split = 'validation' GROUP BY purpose""")
def m8_validation_probabilities(spark, folder):
    rows, _, prepared = _prepared(spark, folder, ONE_COLUMN)
    model = models.fit_logistic(prepared.where(F.col("modeling_split") == "train"))
    scores = models.score_logistic(model, prepared.where(F.col("modeling_split") == "validation"), ["id"])
    return scores.join(rows.select("id", "purpose"), "id").groupBy("purpose").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("p"), 5).alias("mean_p"))


@register("m9_coefficient_report", LOANS + """, effects AS (SELECT addr_state AS feature_name,
  round(avg(bad_loan) - (SELECT avg(bad_loan) FROM labeled), 4) AS coefficient FROM labeled GROUP BY 1)
SELECT cast(row_number() OVER (ORDER BY abs(coefficient) DESC, feature_name) AS integer) AS coefficient_rank, feature_name,
  coefficient, abs(coefficient) AS absolute_coefficient, CASE WHEN coefficient > 0 THEN 'increases_bad_loan_risk'
  WHEN coefficient < 0 THEN 'decreases_bad_loan_risk' ELSE 'neutral' END AS coefficient_direction FROM effects""")
def m9_coefficient_report(spark, folder):
    """The report over one coefficient per state: its distance from the mean bad rate."""
    from driver_queries.views import labeled
    rows = labeled(spark, folder)
    mean = rows.agg(F.avg("bad_loan")).scalar()
    effects = rows.groupBy(F.col("addr_state").alias("feature_name")).agg(F.avg("bad_loan").alias("rate")).select(
        "feature_name", F.round(F.col("rate") - mean, 4).alias("coefficient"))
    return models.coefficient_report(effects)


@register("m9_fitted_coefficients", FITTED + """SELECT cast(1 AS integer) AS coefficient_rank, 'numeric__loan_amnt' AS feature_name,
  round(w, 5) AS coefficient, round(abs(w), 5) AS absolute_coefficient, CASE WHEN w > 0 THEN 'increases_bad_loan_risk'
  WHEN w < 0 THEN 'decreases_bad_loan_risk' ELSE 'neutral' END AS coefficient_direction FROM fit""")
def m9_fitted_coefficients(spark, folder):
    """The report of a fitted model."""
    fitted, _, model = _one_feature(spark, folder)
    table_of = models.coefficient_table(model, list(fitted.names), spark.range(0))
    return rounded(models.coefficient_report(table_of), "coefficient", "absolute_coefficient", digits=5)


BASELINE_ROWS = FITTED + """, long AS (
  SELECT 'dummy_prior_baseline' AS model_name, bad_loan, (SELECT avg(bad_loan) FROM train) AS p FROM splits
    WHERE modeling_split = 'validation'
  UNION ALL SELECT 'logistic_regression_baseline', bad_loan, 1 / (1 + exp(-(w * (loan_amnt - m) / s + b)))
    FROM splits, moments, fit WHERE modeling_split = 'validation')"""


@register("m10_baseline_performance", BASELINE_ROWS + metrics_sql("long", "model_name", 4) + """
SELECT *, 'validation' AS dataset_name FROM metrics""")
def m10_baseline_performance(spark, folder):
    from loanweft.plans.training import train_baselines
    _, fitted, prepared = _prepared(spark, folder, ONE_COLUMN)
    reports = train_baselines(prepared, list(fitted.names), scratch(spark)).reports
    return rounded(reports["validation_performance"], *METRICS, digits=4)


@register("m10_baseline_rows", LOANS + """
SELECT model_name, count(*) AS row_count, round(avg(bad_loan), 6) AS observed_bad_loan_rate, 'validation' AS dataset_name
FROM splits, (VALUES ('dummy_prior_baseline'), ('logistic_regression_baseline')) m(model_name)
WHERE modeling_split = 'validation' GROUP BY model_name""")
def m10_baseline_rows(spark, folder):
    """What both baselines, fitted on all features, were judged on."""
    from loanweft.plans.training import train_baselines
    _, fitted, prepared = _prepared(spark, folder)
    reports = train_baselines(prepared, list(fitted.names)).reports
    return rounded(reports["validation_performance"].select("model_name", "row_count", "observed_bad_loan_rate", "dataset_name"),
                   "observed_bad_loan_rate")


@register("m10_all_features")
def m10_all_features(spark, folder):
    from loanweft.plans.training import train_baselines
    _, fitted, prepared = _prepared(spark, folder)
    reports = train_baselines(prepared, list(fitted.names)).reports
    return rounded(reports["validation_performance"], *METRICS, digits=3)


# --- recalibration -------------------------------------------------------------

def shift_sql(name: str, points: str, steps: int = 30) -> str:
    return f""", {name}_it(k, c) AS (SELECT 0, 0e0 UNION ALL
  SELECT k + 1, c - sum(p - y) / sum(p * (1 - p)) FROM (
    SELECT k, c, y, 1 / (1 + exp(-(x + c))) AS p FROM {name}_it, {points} WHERE k < {steps}) GROUP BY k, c
), {name} AS (SELECT c FROM {name}_it ORDER BY k DESC LIMIT 1)"""


def isotonic_sql(name: str, points: str) -> str:
    """Max-min form of the isotonic fit over distinct x."""
    return f""", {name}_d AS (SELECT x, sum(y) AS s, count(*)::double AS n FROM {points} GROUP BY x
), {name}_c AS (SELECT x, row_number() OVER (ORDER BY x) AS k, sum(s) OVER (ORDER BY x) AS cs, sum(n) OVER (ORDER BY x) AS cn, s, n
  FROM {name}_d
), {name} AS (SELECT x, max(low) AS fitted FROM (
    SELECT i.x, a.k, min((b.cs - a.cs + a.s) / (b.cn - a.cn + a.n)) AS low
    FROM {name}_c i JOIN {name}_c a ON a.k <= i.k JOIN {name}_c b ON b.k >= i.k GROUP BY i.x, a.k) GROUP BY x)"""


def interpolated_sql(name: str, fit: str, rows: str) -> str:
    """Fitted value at every distinct z of ``rows``, linear between fitted points, constant outside."""
    return f""", {name} AS (SELECT z, CASE WHEN lo IS NULL THEN fhi WHEN hi IS NULL THEN flo WHEN lo = hi THEN flo
    ELSE flo + (fhi - flo) * (z - lo) / (hi - lo) END AS value FROM (
  SELECT z, max(x) FILTER (x <= z) AS lo, min(x) FILTER (x >= z) AS hi, max(fitted) FILTER (x <= z) AS flo,
    min(fitted) FILTER (x >= z) AS fhi FROM (SELECT DISTINCT z FROM {rows}), {fit} GROUP BY z))"""


POINTS = SCORED + ", points AS (SELECT z AS x, bad_loan::double AS y FROM scored)"
SHIFT = _recursive(POINTS + shift_sql("shift", "points"))


@register("m11_intercept_shift", SHIFT + "SELECT round(c, 6) AS shift FROM shift")
def m11_intercept_shift(spark, folder):
    shift = calibration.fit_intercept_shift(scored(spark, folder))
    return rounded(literal_table(spark, [(shift,)], "shift double"), "shift")


@register("m12_shifted_probability", SHIFT + "SELECT id, round(1 / (1 + exp(-(z + c))), 6) AS p_intercept FROM scored, shift")
def m12_shifted_probability(spark, folder):
    rows = scored(spark, folder)
    shift = calibration.fit_intercept_shift(rows)
    return rounded(rows.select("id", calibration.apply_intercept_shift(F.col("z"), shift).alias("p_intercept")), "p_intercept")


PLATT = _recursive(POINTS + newton_sql("platt", "points", "0e0"))


@register("m13_platt_scaling", PLATT + "SELECT round(w, 6) AS scale, round(b, 6) AS intercept FROM platt")
def m13_platt_scaling(spark, folder):
    platt = calibration.fit_platt(scored(spark, folder))
    return rounded(literal_table(spark, [(platt.scale, platt.intercept)], "scale double, intercept double"), "scale", "intercept")


@register("m13_platt_probability", PLATT + "SELECT id, round(1 / (1 + exp(-(w * z + b))), 6) AS p_platt FROM scored, platt")
def m13_platt_probability(spark, folder):
    rows = scored(spark, folder)
    return rounded(rows.select("id", calibration.fit_platt(rows).probability(F.col("z")).alias("p_platt")), "p_platt")


@register("m14_isotonic_probability", POINTS + isotonic_sql("iso", "points") + """
SELECT id, round(fitted, 6) AS p_isotonic FROM scored JOIN iso ON z = x""")
def m14_isotonic_probability(spark, folder):
    rows = scored(spark, folder)
    return rounded(calibration.apply_isotonic(calibration.fit_isotonic(rows), rows).select("id", "p_isotonic"), "p_isotonic")


HALVES = SCORED + """, halved AS (SELECT *, row_number() OVER (ORDER BY month_no, id) <= cast(floor(count(*) OVER () * 0.5e0) AS bigint)
  AS early FROM scored
), points AS (SELECT z AS x, bad_loan::double AS y FROM halved WHERE early
), later AS (SELECT * FROM halved WHERE NOT early)"""
COMPARED = _recursive(HALVES + shift_sql("shift", "points") + newton_sql("platt", "points", "0e0") + isotonic_sql("iso", "points")
                      + interpolated_sql("iso_at", "iso", "later")) + """, long AS (
  SELECT 'uncalibrated' AS method, bad_loan, p FROM later
  UNION ALL SELECT 'intercept', bad_loan, 1 / (1 + exp(-(z + c))) FROM later, shift
  UNION ALL SELECT 'platt', bad_loan, 1 / (1 + exp(-(w * z + b))) FROM later, platt
  UNION ALL SELECT 'isotonic', bad_loan, value FROM later JOIN iso_at USING (z))"""
_SUMMARY_SQL = """
SELECT m.method AS calibration_method, observed_bad_loan_rate, mean_predicted_bad_loan_probability,
  weighted_mean_absolute_calibration_gap, log_loss, brier_score FROM metrics m JOIN (
    SELECT method, round(sum(row_count * raw_gap) / sum(row_count), 5) AS weighted_mean_absolute_calibration_gap
    FROM bins GROUP BY method) USING (method)"""
_SUMMARY_VALUES = ("observed_bad_loan_rate", "mean_predicted_bad_loan_probability", "weighted_mean_absolute_calibration_gap",
                   "log_loss", "brier_score")


@register("m15_calibration_comparison", COMPARED + metrics_sql("long", "method", 5) + bins_sql("long", "method") + _SUMMARY_SQL)
def m15_calibration_comparison(spark, folder):
    from loanweft.plans.calibration import compare_scored
    comparison = compare_scored(scored(spark, folder), date="month_no")
    return rounded(comparison.reports["calibration_summary"], *_SUMMARY_VALUES, digits=5)


@register("m15_discrimination_comparison", COMPARED + metrics_sql("long", "method", 5) + """
SELECT method AS calibration_method, roc_auc, gini, average_precision FROM metrics""")
def m15_discrimination_comparison(spark, folder):
    from loanweft.plans.calibration import compare_scored
    comparison = compare_scored(scored(spark, folder), date="month_no")
    return rounded(comparison.reports["discrimination_summary"].drop("spearman_rank_correlation_to_uncalibrated"),
                   "roc_auc", "gini", "average_precision", digits=5)


FINAL = SCORED + """, ordered AS (SELECT *, row_number() OVER (ORDER BY month_no, id) AS k, count(*) OVER () AS n FROM scored
), parts AS (SELECT *, CASE WHEN k <= cast(floor(n * 0.7e0) AS bigint) THEN 'train'
   WHEN k <= cast(floor(n * 0.7e0) AS bigint) + cast(floor(n * 0.15e0) AS bigint) THEN 'validation' ELSE 'test' END AS part FROM ordered
), points AS (SELECT z AS x, bad_loan::double AS y FROM parts WHERE part = 'validation'
), test AS (SELECT * FROM parts WHERE part = 'test')""" + isotonic_sql("iso", "points") + interpolated_sql("iso_at", "iso", "test") + """
, long AS (SELECT 'uncalibrated' AS method, bad_loan, p FROM test
  UNION ALL SELECT 'isotonic', bad_loan, value FROM test JOIN iso_at USING (z))"""


@register("m16_final_calibration", FINAL + metrics_sql("long", "method", 5) + bins_sql("long", "method") + _SUMMARY_SQL)
def m16_final_calibration(spark, folder):
    """Isotonic fit on the validation part, saved, loaded and judged on the test part."""
    from loanweft.plans.calibration import finalize_scored
    rows = scored(spark, folder)
    parted = fit_time_split(rows, "month_no").apply(rows, "part")
    final = finalize_scored(parted.where("part = 'validation'"), parted.where("part = 'test'"), scratch(spark))
    return rounded(final.reports["calibration_summary"], *_SUMMARY_VALUES, digits=5)


@register("s13_comparison_reports", FINAL + metrics_sql("long", "method", 5) + bins_sql("long", "method") + """
SELECT 'calibration_summary' AS report, count(*) AS row_count FROM metrics
UNION ALL SELECT 'calibration_bands', count(*) FROM bins
UNION ALL SELECT 'discrimination_summary', count(*) FROM metrics
UNION ALL SELECT 'discrimination_deciles', 10 * count(*) FROM metrics""")
def s13_comparison_reports(spark, folder):
    """The four reports of the final calibration as files, read back."""
    from loanweft.operators.sets import union_reports
    from loanweft.plans.calibration import finalize_scored
    rows = scored(spark, folder)
    parted = fit_time_split(rows, "month_no").apply(rows, "part")
    path = scratch(spark)
    finalize_scored(parted.where("part = 'validation'"), parted.where("part = 'test'"), path)
    return union_reports([spark.read.option("header", True).csv(f"{path}/{name}").agg(
        F.lit(name).alias("report"), F.count(F.lit(1)).alias("row_count")) for name in evaluation.COMPARISONS])


@register("m16_training_to_decisions")
def m16_training_to_decisions(spark, folder):
    """All stages on the loans: prepare, fit, calibrate, judge on test, decide (also M15, M18, S13)."""
    from loanweft.operators.policy import Policy
    from loanweft.plans.calibration import compare_calibrations, finalize_calibration
    from loanweft.plans.decisions import evaluate_policy
    path = scratch(spark)
    _, _, written = _prepared(spark, folder)
    model = models.fit_logistic(written.where(F.col("modeling_split") == "train"))
    compare_calibrations(model, written, f"{path}/comparison")
    final = finalize_calibration(model, written, f"{path}/final")
    outcomes = evaluate_policy(final.test_scores, Policy(good_return_rate=0.4), "p_isotonic")
    return outcomes.select("decision", "row_count", "bad_loan_count")


@register("m16_decided_rows", LOANS + """
SELECT count(*) AS row_count, cast(sum(bad_loan) AS bigint) AS bad_loan_count FROM splits WHERE modeling_split = 'test'""")
def m16_decided_rows(spark, folder):
    """Every test row ends in one decision of the trained, calibrated and judged model."""
    decided = m16_training_to_decisions(spark, folder).where("decision in ('approve', 'review', 'decline')")
    return decided.agg(F.sum("row_count").alias("row_count"), F.sum("bad_loan_count").alias("bad_loan_count"))


@register("d8_scored_loans", LOANS + """
SELECT count(*) AS loan_count, true AS all_banded FROM splits""")
def d8_scored_loans(spark, folder):
    """Every loan gets a band and a decision from the saved stages."""
    return d8_batch_scoring(spark, folder).agg(
        F.sum("loan_count").alias("loan_count"), F.bool_and(F.col("risk_band").isNotNull() & F.col("decision").isNotNull()).alias("all_banded"))


@register("d8_batch_scoring")
def d8_batch_scoring(spark, folder):
    """Every loan scored, banded and decided with saved stages."""
    from loanweft.operators.policy import Policy
    from loanweft.plans.decisions import score_loans
    path = scratch(spark)
    rows, fitted, prepared = _prepared(spark, folder)
    model = models.fit_logistic(prepared.where(F.col("modeling_split") == "train"))
    validation = models.score_logistic(model, prepared.where(F.col("modeling_split") == "validation"), ["id", "bad_loan"])
    writers.save_model(fitted.pipeline, f"{path}/preparation")
    writers.save_model(model, f"{path}/logistic")
    writers.save_model(calibration.fit_isotonic(validation), f"{path}/isotonic")
    stages = [writers.load_model(spark, f"{path}/{name}", kind) for name, kind in (
        ("preparation", "pipeline"), ("logistic", "logistic"), ("isotonic", "isotonic"))]
    scores = score_loans(rows, *stages, policy=Policy(good_return_rate=0.4))
    return scores.groupBy("risk_band", "decision").agg(F.count(F.lit(1)).alias("loan_count"))
