import pytest
from pyspark.sql import functions as F

from loanweft.functions.checks import DataCheckError
from loanweft.operators import governance

ROWS = [
    ("id", "identifier", "data_quality_check"),
    ("issue_d", "monitoring", "portfolio_segmentation,reporting,time_split"),
    ("term", "modeling", "portfolio_segmentation"),
    ("dti", "modeling", ""),
    ("total_pymnt", "post_application_leakage", ""),
    ("loan_status", "target_source", "reporting"),
    ("bad_loan", "target", "reporting"),
]
AVAILABLE = [row[0] for row in ROWS]


def catalog(spark, rows=ROWS):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)],
                                 "position int, column_name string, primary_purpose string, additional_use_cases string")


def rules(df):
    return {(row.rule, row.offender) for row in df.collect()}


def test_roles_follow_precedence(spark):
    names = ["bad_loan", "loan_status", "id", "issue_d", "hardship_x", "settlement_x", "recoveries", "empty", "flat", "dti",
             "hardshipless"]
    profile = spark.createDataFrame(
        [(n, 0 if n == "empty" else 1 if n == "flat" else 9, n in ("empty", "flat", "hardship_x")) for n in names],
        "column_name string, unique_non_missing_count long, is_constant_non_missing boolean")
    got = {row.column_name: row.column_role for row in governance.assign_roles(profile).collect()}
    leak, flat, review = "post_application_leakage", "constant_or_empty", "requires_review"
    assert [got[n] for n in names] == ["target", "target_source", "identifier", "monitoring_only", leak, leak, leak, flat, flat,
                                       review, review]
    inventory = governance.review_inventory(profile)
    assert inventory.where("reason is null or recommended_action is null").isEmpty()
    assert governance.unknown_roles(inventory, governance.role_table(spark)).isEmpty()
    stray = inventory.withColumn("column_role", F.lit("odd"))
    assert rules(governance.unknown_roles(stray, governance.role_table(spark))) == {("unknown_role", "odd")}


def test_final_catalog(spark):
    inventory = spark.createDataFrame([("id", "identifier"), ("dti", "requires_review"), ("x", "requires_review")],
                                      "column_name string, column_role string")
    schema = "column_name string, primary_purpose string, additional_use_cases string"
    decisions = spark.createDataFrame([("dti", "modeling", "reporting, benchmarking"), ("id", "modeling", "")], schema)
    assert rules(governance.review_coverage(inventory, decisions)) == {("missing_decision", "x"), ("extra_decision", "id")}
    with pytest.raises(DataCheckError, match="missing_decision: x"):
        governance.build_catalog(inventory, decisions)
    complete = decisions.union(spark.createDataFrame([("x", "monitoring", None)], schema))
    final = {row.column_name: (row.primary_purpose, row.additional_use_cases)
             for row in governance.build_catalog(inventory, complete, 3).collect()}
    assert final == {"id": ("identifier", "data_quality_check"), "dti": ("modeling", "benchmarking,reporting"), "x": ("monitoring", "")}
    with pytest.raises(DataCheckError, match="extra_decision"):
        governance.build_catalog(inventory, complete, fail_on_extra=True)
    with pytest.raises(DataCheckError, match="unexpected_row_count"):
        governance.build_catalog(inventory, complete, 4)
    with pytest.raises(DataCheckError, match="unknown_use_case"):
        governance.build_catalog(inventory, complete.withColumn("additional_use_cases", F.lit("gossip")))


def test_catalog_violations(spark):
    bad = [("id", "identifier", "gossip"), ("id", "identifier", ""), ("", "modeling", ""), ("a", " ", ""), ("b", "nonsense", ""),
           ("c", "modeling", "reporting,reporting")]
    found = rules(governance.catalog_violations(catalog(spark, bad)))
    assert found == {("unknown_use_case", "gossip"), ("duplicate_column_name", "id"), ("blank_column_name", ""),
                     ("blank_primary_purpose", "a"), ("unknown_primary_purpose", "nonsense"), ("repeated_use_case", "reporting,reporting")}
    governance.enforce_catalog(catalog(spark))
    with pytest.raises(DataCheckError, match="empty"):
        governance.enforce_catalog(catalog(spark).where("false"))


def test_column_lists(spark):
    table = catalog(spark)
    assert governance.names(governance.modeling_columns(table)) == ["term", "dti"]
    assert governance.names(governance.columns_by_use(table, ["benchmarking", "time_split"])) == ["issue_d"]
    assert governance.names(governance.excluded_columns(table)) == ["id", "issue_d", "total_pymnt", "loan_status", "bad_loan"]
    for call in (lambda: governance.columns_by_purpose(table, "nonsense"), lambda: governance.columns_by_use(table, "nonsense")):
        with pytest.raises(ValueError, match="unknown"):
            call()
    order = governance.selected_columns(table).orderBy("modeling_base_column_order").collect()
    assert [row.column_name for row in order] == ["id", "issue_d", "term", "dti", "bad_loan"]
    report = governance.selection_report(table).collect()
    assert [row.column_name for row in report] == ["id", "issue_d", "term", "dti", "bad_loan", "loan_status", "total_pymnt"]
    assert report[1].role_in_modeling_base == "time_split" and report[-1].modeling_base_column_order is None


def test_selection_violations(spark):
    assert governance.selection_violations(catalog(spark), AVAILABLE).isEmpty()
    twice = catalog(spark, [*ROWS, ("extra", "target", "time_split")])
    found = rules(governance.selection_violations(twice, AVAILABLE))
    assert {("missing_from_data", "extra"), ("wrong_column_count", "target=2"), ("wrong_column_count", "time_split=2")} <= found
    none = catalog(spark, [row for row in ROWS if row[1] not in ("modeling", "identifier")])
    assert {("wrong_column_count", "model_feature=0"), ("wrong_column_count", "identifier_tracking=0")} <= rules(
        governance.selection_violations(none, AVAILABLE))


def test_feature_columns(spark):
    schema = "column_name string, inferred_feature_type string, needs_manual_review boolean, recommended_preprocessing_group string"
    rows = [("a", "numeric_continuous", False, "numeric_continuous"), ("b", "numeric_discrete_or_count", True, "numeric_discrete_or_count"),
            ("c", "binary_or_two_value", False, "binary"), ("d", "date_like", False, "date_like"), ("e", "constant", True, "problem_column"),
            ("f", "all_missing", True, "problem_column"), ("unused", "nonsense", False, "x")]
    profile = spark.createDataFrame(rows, schema)
    approved = spark.createDataFrame([(c,) for c in "abcdef"], "column_name string")
    got = governance.feature_columns(profile, approved)
    assert (got.numeric, got.categorical, got.excluded) == (("b", "a"), ("c",), ("e", "f", "d"))
    more = approved.union(spark.createDataFrame([("unused",), ("gone",)], "column_name string"))
    found = rules(governance.feature_group_violations(profile.union(profile.limit(1)), more))
    assert found == {("duplicate_feature", "a"), ("feature_without_profile", "gone"), ("unexpected_feature_type", "nonsense")}
