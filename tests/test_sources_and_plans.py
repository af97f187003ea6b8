import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanweft import sources
from loanweft.functions.checks import DataCheckError
from loanweft.operators import governance, monitoring, splits
from loanweft.operators.policy import Policy
from loanweft.operators.profile import column_profile
from loanweft.plans import calibration, decisions, ingest, modeling, training
from loanweft.streaming import label_new_files

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("home_ownership", T.StringType()),
                       T.StructField("dti", T.DoubleType()), T.StructField("term", T.StringType())])


def test_raw_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('id,home_ownership,dti,term,more\n1,NONE,NaN, 36 months,x\n2,NA,1.5,"a,""b""",x\n3,None,oops,null,x\n4,OWN,inf,,x\n')
    rows = sources.read_raw_loans(spark, str(path), SCHEMA).orderBy("id").collect()
    assert [row.home_ownership for row in rows] == ["NONE", None, None, "OWN"]
    assert [row.dti for row in rows] == [None, 1.5, None, float("inf")]
    assert [row.term for row in rows] == [" 36 months", 'a,"b"', None, None]
    assert sources.read_raw_loans(spark, str(path), limit=2).count() == 2
    with pytest.raises(ValueError, match="lacks"):
        sources.read_raw_loans(spark, str(path), T.StructType([T.StructField("gone", T.LongType())]))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sources.read_raw_loans(spark, str(tmp_path / "nothing.csv"))


def test_projection_reads_only_its_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.lit("x").alias("a"), F.lit(1.0).alias("b")).write.parquet(path)
    df = sources.read_projection(spark, path, ["b", "id"])
    assert df.columns == ["b", "id"] and sources.read_columns(spark, path) == ["id", "a", "b"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,b:double>" in plan
    with pytest.raises(ValueError, match="lacks"):
        sources.read_projection(spark, path, ["c"])


def test_split_folders_are_pruned(spark, tmp_path):
    df = spark.range(10).withColumn("modeling_split", F.when(F.col("id") < 7, "train").otherwise("test")).withColumn("issue_month", F.lit(1))
    written = sources.write_splits(df, str(tmp_path / "s"))
    assert "issue_month" not in written.columns
    part = sources.read_split(spark, str(tmp_path / "s"), "test")
    assert part.count() == 3
    assert "PartitionFilters: [isnotnull(modeling_split" in part._jdf.queryExecution().executedPlan().toString()


def test_reports_refuse_to_be_empty(spark, tmp_path):
    with pytest.raises(DataCheckError, match="no rows"):
        sources.write_report(spark.range(0), str(tmp_path / "r"))
    sources.write_report(spark.range(0), str(tmp_path / "r"), allow_empty=True)
    sources.write_report(spark.range(3), str(tmp_path / "z"), compression="gzip")
    assert len(list((tmp_path / "z").glob("*.csv.gz"))) == 1


def test_metadata_keeps_file_order(spark, tmp_path):
    path = tmp_path / "catalog.csv"
    path.write_text("column_name,primary_purpose,additional_use_cases\n z ,modeling,\nid, identifier,\" reporting, time_split\"\n")
    rows = sources.read_catalog(spark, str(path)).orderBy("position").collect()
    assert [(row.column_name, row.primary_purpose, row.additional_use_cases) for row in rows] == [
        ("z", "modeling", ""), ("id", "identifier", "reporting, time_split")]


def test_feature_files_are_checked(spark, tmp_path):
    def written(rows, name):
        df = spark.createDataFrame([(i, y, Vectors.dense(v), "train") for i, (y, v) in enumerate(rows)],
                                   ["id", "bad_loan", "features", "modeling_split"])
        sources.write_features(df, ["a", "b"], str(tmp_path / name), str(tmp_path / f"{name}-names"))
        return str(tmp_path / name)

    good = written([(0, [1.0, 2.0]), (1, [0.0, 0.0])], "good")
    names = sources.read_feature_names(spark, f"{good}-names")
    assert names == ["a", "b"] and sources.read_features(spark, good, names=names).count() == 2
    with pytest.raises(DataCheckError, match="size"):
        sources.read_features(spark, good, names=["a"])
    with pytest.raises(DataCheckError, match="not 0 or 1"):
        sources.read_features(spark, written([(2, [1.0, 2.0])], "label"))
    with pytest.raises(DataCheckError, match="finite"):
        sources.read_features(spark, written([(0, [1.0, float("nan")])], "nan"))
    with pytest.raises(DataCheckError, match="not a vector"):
        sources.read_features(spark, good, vector="id")


def test_new_files_are_labeled_once(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("loan_status", T.StringType())])
    for arrival in range(2):
        spark.createDataFrame([(arrival, "Fully Paid"), (arrival + 10, "Current")], schema).write.mode("append").parquet(str(tmp_path / "in"))
        label_new_files(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "state"))
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()
    assert [(row.id, row.bad_loan) for row in rows] == [(0, 0), (1, 0)]


def test_split_sizes_and_ties(spark):
    df = spark.range(101).select("id", F.when(F.col("id") < 90, "Jan-2015").otherwise("Feb-2015").alias("issue_d"),
                                 (F.col("id") % 2).cast("int").alias("bad_loan"))
    dated = splits.add_parsed_month(df)
    split = splits.fit_time_split(dated, rows_per_part=3)
    summary = splits.split_summary(split.apply(dated)).collect()
    assert [row.row_count for row in summary] == [70, 15, 16]
    assert {row.id for row in split.apply(dated).where("modeling_split = 'train'").collect()} == set(range(70))
    whole = splits.fit_time_split(dated, whole_months=True).apply(dated)
    assert whole.groupBy("issue_d").agg(F.count_distinct("modeling_split").alias("n")).where("n > 1").isEmpty()
    halves = splits.fit_halving(dated).apply(dated, "part").groupBy("part").count().collect()
    assert {row.part: row["count"] for row in halves} == {"calibration_fit": 50, "calibration_comparison": 51}
    with pytest.raises(DataCheckError):
        splits.fit_halving(dated.limit(1))
    with pytest.raises(DataCheckError, match="1 missing.*soon"):
        splits.enforce_parsed_months(splits.add_parsed_month(
            spark.createDataFrame([("soon",), (None,), ("Jan-2015",)], "issue_d string")))
    one_split = splits.split_summary(split.apply(dated).where("modeling_split = 'train'")).collect()
    assert [(row.split, row.row_count, row.bad_loan_rate) for row in one_split[1:]] == [("validation", 0, 0.0), ("test", 0, 0.0)]


def test_monitoring(spark):
    df = spark.createDataFrame([(1, 0.05, 0), (1, 0.06, 1), (2, 0.9, 1), (2, None, 0)], "m int, p double, bad_loan int")
    bands = [row.b for row in df.select(monitoring.risk_band(F.col("p")).alias("b")).collect()]
    assert bands == ["A", "B", "E", None]
    reference = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    edges = monitoring.quantile_edges(reference, "v", rows_per_part=10)
    assert edges == [99.0 + 100 * i for i in range(9)]
    drift = monitoring.stability_index(reference.withColumn("m", F.lit(1)).union(
        reference.select(F.col("v") / 10, F.lit(2))), "v", "m", reference, edges).collect()
    assert drift[0].population_stability_index == pytest.approx(0.0) and drift[1].population_stability_index > 1
    flagged = monitoring.flag_out_of_range(spark.createDataFrame([(5.0,), (-1.0,), (None,)], "v double"),
                                           monitoring.training_ranges(reference, ["v"])).collect()
    assert [row.out_of_range_features for row in flagged] == [[], ["v"], []]
    found = monitoring.plausibility_violations(df, "m", [monitoring.between("p", 0.0, 0.5), monitoring.required("p")]).collect()
    assert {(row.m, row.rule) for row in found} == {(2, "p_in_range"), (2, "p_present")}


@pytest.fixture(scope="module")
def raw(spark):
    rng = random.Random(1)
    rows = []
    for i in range(1500):
        income, grade = rng.gauss(60, 20), rng.choice(["A", "B", "C", None])
        risk = 0.15 + 0.5 * (income < 55) + 0.2 * (grade == "C")
        status = "Current" if i % 10 == 0 else "Charged Off" if rng.random() < risk else "Fully Paid"
        rows.append((i, f"u{i}", status, f"{'Jan Feb Mar Apr May Jun'.split()[i * 6 // 1500]}-2016",
                     None if i % 13 == 0 else round(income, 1), grade, float(i % 4), 3.0, "N"))
    return spark.createDataFrame(rows, "id long, url string, loan_status string, issue_d string, annual_inc double, "
                                 "home string, open_acc double, policy_code double, hardship_flag string")


def test_from_raw_loans_to_decisions(spark, raw, tmp_path):
    folder = str(tmp_path)
    ingest.raw_reports(raw, f"{folder}/raw")
    labeled, counts = ingest.label_table(raw, f"{folder}/labeled")
    assert counts == {"raw_row_count": 1500, "labeled_row_count": 1350, "excluded_row_count": 150}
    ingest.quality_reports(labeled, f"{folder}/quality", expected_rows=1350)

    inventory = governance.review_inventory(column_profile(labeled))
    review = spark.createDataFrame([("annual_inc", "modeling", ""), ("home", "modeling", "reporting"), ("open_acc", "modeling", "")],
                                   "column_name string, primary_purpose string, additional_use_cases string")
    catalog = governance.with_position(governance.build_catalog(inventory, review))
    base = modeling.build_modeling_base(spark, f"{folder}/labeled", catalog, f"{folder}/base", f"{folder}/selection")
    assert base.columns == ["id", "url", "issue_d", "annual_inc", "home", "open_acc", "bad_loan"]
    profile = modeling.feature_type_reports(spark, f"{folder}/base", catalog, f"{folder}/types")
    columns = governance.feature_columns(profile, governance.modeling_columns(catalog))
    assert (columns.numeric, columns.categorical) == (("annual_inc", "open_acc"), ("home",))

    parted = modeling.build_splits(spark, f"{folder}/base", catalog, f"{folder}/splits", f"{folder}/split_summary")
    fitted, prepared = training.prepare_features(parted, columns, f"{folder}/prepared")
    checked = sources.read_features(spark, f"{folder}/prepared/features", names=fitted.names)
    baselines = training.train_baselines(checked, list(fitted.names), f"{folder}/baselines")
    performance = {row.model_name: row for row in baselines.reports["validation_performance"].collect()}
    assert performance["dummy_prior_baseline"].roc_auc == 0.5
    assert performance["logistic_regression_baseline"].roc_auc > 0.65

    comparison = calibration.compare_calibrations(baselines.logistic, checked, f"{folder}/comparison")
    methods = [row.calibration_method for row in comparison.reports["calibration_summary"].collect()]
    assert methods == ["uncalibrated", "intercept", "platt", "isotonic"]
    final = calibration.finalize_calibration(baselines.logistic, checked, f"{folder}/final")
    outcomes = decisions.evaluate_policy(final.test_scores, Policy(0.3, 0.6, 0.05), path=f"{folder}/outcomes").collect()
    assert sum(row.row_count for row in outcomes) == 1350 - int(1350 * 0.7) - int(1350 * 0.15)
    decisions.write_policy(spark, Policy(), f"{folder}/policy")

    models = [sources.load_model(spark, f"{folder}/{name}", kind) for name, kind in (
        ("prepared/preprocessing", "pipeline"), ("baselines/logistic", "logistic"), ("final/isotonic", "isotonic"))]
    scored = decisions.score_loans(raw.drop("loan_status"), *models)
    assert scored.count() == 1500 and scored.where("decision is null or risk_band is null").isEmpty()
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_broken_identifiers_are_reported_before_they_fail(spark, raw, tmp_path):
    from loanweft.operators.labels import add_target, keep_labeled
    doubled = keep_labeled(add_target(raw)).withColumn("id", F.col("id") % 700)
    with pytest.raises(DataCheckError, match="redundant"):
        ingest.quality_reports(doubled, str(tmp_path))
    assert (tmp_path / "identifier_integrity").exists() and not (tmp_path / "issue_date_integrity").exists()
