import pytest
from pyspark.sql import functions as F

from loanweft.functions.checks import DataCheckError
from loanweft.operators import labels, profile, quality


def test_labels_and_summary(spark):
    statuses = ["Fully Paid", " Fully Paid\t", "Does not meet the credit policy. Status:Fully Paid", "Charged Off", "Default",
                "Does not meet the credit policy. Status:Charged Off", "Late (31-120 days)", "Current", None, "Strange"]
    df = spark.createDataFrame([(s,) for s in statuses], "loan_status string")
    got = [row.bad_loan for row in labels.add_target(df).collect()]
    assert got == [0, 0, 0, 1, 1, 1, 1, None, None, None]
    summary = [tuple(row) for row in labels.target_summary(labels.add_target(df)).collect()]
    assert summary == [("0", "good_loan", 3, 0.3), ("1", "bad_loan", 4, 0.4), ("MISSING", "excluded_or_unmapped", 3, 0.3)]
    kinds = {row.status_category: row["count"] for row in labels.status_categories(df).collect()}
    assert kinds == {"good": 3, "bad": 4, "unresolved": 1, "missing": 1, "unmapped": 1}
    distribution = [(r.loan_status, r["count"]) for r in labels.status_distribution(df).collect()]
    assert distribution == sorted(distribution) and ("MISSING", 1) in distribution


def test_target_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "bad_loan int")
    assert [row["count"] for row in labels.target_summary(empty).collect()] == [0, 0, 0]


def test_labeled_table_check(spark):
    df = spark.createDataFrame([(0,), (1,), (1,)], "bad_loan int")
    quality.enforce_labeled_table(df, expected_rows=3)
    with pytest.raises(DataCheckError, match="expected 4"):
        quality.enforce_labeled_table(df, expected_rows=4)
    with pytest.raises(DataCheckError, match="without"):
        quality.enforce_labeled_table(df.union(spark.createDataFrame([(None,)], "bad_loan int")))
    with pytest.raises(DataCheckError, match="0 and 1"):
        quality.enforce_labeled_table(df.where("bad_loan = 1"))


@pytest.mark.parametrize("padding", [0, 20])
def test_duplicates_keep_nulls_apart(spark, padding):
    """(1, NULL) and (NULL, 1) differ, NULL equals NULL; with padding the hash way is taken."""
    rows = [(1, None), (None, 1), (1, None), (None, None), (None, None), (None, None), (2, 2)]
    df = spark.createDataFrame(rows, "a int, b int").select(
        "a", "b", *[F.lit(None).cast("string").alias(f"c{i}") for i in range(padding)])
    row = quality.duplicate_summary(df).first()
    assert row.asDict() == {
        "total_rows": 7, "rows_in_duplicate_groups": 5, "redundant_duplicate_rows": 3,
        "unique_rows_after_deduplication": 4, "redundant_duplicate_percentage": 3 / 7}


def test_one_copied_row_fills_half_the_table(spark):
    wide = [F.lit("x").alias(f"c{i}") for i in range(20)]
    df = spark.range(2000).select(F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), *wide)
    row = quality.duplicate_summary(df).first()
    assert (row.rows_in_duplicate_groups, row.redundant_duplicate_rows) == (1000, 999)


def test_identifier_integrity(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "id long")
    report = quality.identifier_integrity(df)
    row = report.first()
    assert (row.total_rows, row.missing_identifier_count, row.unique_identifier_count) == (5, 2, 2)
    assert (row.rows_in_duplicate_identifier_groups, row.redundant_duplicate_identifier_count) == (4, 2)
    with pytest.raises(DataCheckError, match="missing"):
        quality.enforce_identifier(report)
    quality.enforce_identifier(quality.identifier_integrity(spark.range(5)))


def test_issue_date_integrity(spark):
    df = spark.createDataFrame([("Jun-2007",), ("Dec-2018",), ("Dec-2018",), (None,), ("soon",)], "issue_d string")
    row = quality.issue_date_integrity(df).first()
    assert (row.missing_raw_issue_date_count, row.invalid_issue_date_count, row.unique_issue_month_count) == (1, 1, 2)
    assert (row.earliest_issue_month, row.latest_issue_month) == ("2007-06", "2018-12")
    empty = quality.issue_date_integrity(df.where("false")).first()
    assert (empty.total_rows, empty.earliest_issue_month) == (0, None)


def test_missingness_order(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None)], "a int, b string, c double")
    assert [(r.column_name, r.missing_count, r.missing_percentage) for r in quality.missingness_report(df).collect()] == [
        ("c", 2, 1.0), ("b", 1, 0.5), ("a", 0, 0.0)]


def test_column_profile_zero_signs(spark):
    df = spark.createDataFrame([(0.0, None), (-0.0, "a"), (1.0, "a")], "v double, t string")
    got = {r.column_name: (r.unique_non_missing_count, r.is_constant_non_missing) for r in profile.column_profile(df).collect()}
    assert got == {"v": (2, False), "t": (1, True)}
    approx = {r.column_name: r.unique_non_missing_count for r in profile.column_profile(df, exact=False).collect()}
    assert approx == {"v": 2, "t": 1}


CASES = {
    "empty": ([None] * 200, "all_missing", "problem_column", "high_missingness, all_missing"),
    "flat": (["x"] * 200, "constant", "problem_column", "constant_non_missing_value"),
    "pair": (["x", "y"] * 100, "binary_or_two_value", "binary", ""),
    "few": ([str(i % 20) for i in range(200)], "categorical_low_cardinality", "categorical_low_cardinality", ""),
    "many": ([f"w{i % 21}" for i in range(200)], "categorical_high_cardinality_or_text",
             "categorical_high_cardinality_or_text", "high_cardinality_or_text"),
    "month": ([f"Jan-{2000 + i % 30}" for i in range(180)] + ["soon"] * 20, "date_like", "date_like", ""),
    "half": ([None] * 80 + [f"c{i % 3}" for i in range(120)], "categorical_low_cardinality", "categorical_low_cardinality",
             "high_missingness"),
}
NUMBERS = {
    "whole": ([float(i % 50) for i in range(200)], "numeric_discrete_or_count"),
    "wide": ([float(i) for i in range(200)], "numeric_continuous"),
    "broken": ([i / 3 for i in range(200)], "numeric_continuous"),
}


def test_feature_types(spark):
    names = [*CASES, *NUMBERS]
    columns = [case[0] for case in [*CASES.values(), *NUMBERS.values()]]
    schema = "id int, " + ", ".join(f"{n} string" for n in CASES) + ", " + ", ".join(f"{n} double" for n in NUMBERS)
    df = spark.createDataFrame([(i, *[column[i] for column in columns]) for i in range(200)], schema)
    got = {row.column_name: row for row in profile.feature_type_profile(df, names, "id").collect()}
    for name, (_, kind, group, flags) in CASES.items():
        row = got[name]
        assert (row.inferred_feature_type, row.recommended_preprocessing_group, row.issue_flags) == (kind, group, flags)
        assert row.needs_manual_review == bool(flags)
    for name, (_, kind) in NUMBERS.items():
        assert got[name].inferred_feature_type == kind
    assert got["month"].date_parse_success_rate == pytest.approx(0.9)
    assert got["few"].sample_values == "0, 1, 2, 3, 4"
    order = [(not row.needs_manual_review, row.recommended_preprocessing_group, row.column_name)
             for row in profile.feature_type_profile(df, names, "id").collect()]
    assert order == sorted(order)


def test_discrete_by_ratio(spark):
    df = spark.range(6000).select("id", (F.col("id") % 100).cast("double").alias("n"))
    row = profile.feature_type_profile(df, ["n"], "id").first()
    assert (row.unique_non_missing_count, row.inferred_feature_type) == (100, "numeric_discrete_or_count")
