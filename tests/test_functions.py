import pytest
from pyspark.sql import functions as F

from loanweft.functions import numeric, text
from loanweft.functions.checks import (
    DataCheckError, enforce, enforce_scores, require_columns, require_fractions, score_check, violations)
from loanweft.functions.dates import month_text, parse_month
from loanweft.operators.sets import map_lookup, repeated_values, same_values


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first().r


@pytest.mark.parametrize("raw", ["  a b ", "\t a\xa0", "a　", "\x1c a \r\n", "", "   ", "a"])
def test_strip_is_pythons(spark, raw):
    assert one(spark, text.strip(F.col("v")), raw) == raw.strip()


@pytest.mark.parametrize("raw, items", [(None, []), ("", []), (" , ,", []), ("b, a ,b", ["b", "a", "b"])])
def test_parse_list(spark, raw, items):
    assert one(spark, text.parse_list(F.col("v")), raw) == items


def test_normalize_list(spark):
    assert one(spark, text.normalize_list(F.col("v")), " reporting , benchmarking") == "benchmarking,reporting"
    assert one(spark, text.unknown_items(F.col("v"), ["reporting"]), "x,reporting,a") == ["a", "x"]
    assert one(spark, text.has_repeated_items(F.col("v")), "a, a") is True


@pytest.mark.parametrize("raw, month", [("Dec-2015", "2015-12"), ("bad", None), (None, None), ("2015-12", None), ("Foo-2015", None), ("DEC-2015", "2015-12"), ("dec-2015", "2015-12")])
def test_strict_month(spark, raw, month):
    assert one(spark, month_text(parse_month(F.col("v"))), raw) == month


def test_numeric_helpers(spark):
    assert one(spark, numeric.sigmoid(F.lit(0.0)), "x") == 0.5
    assert one(spark, numeric.sigmoid(F.lit(-800.0)), "x") == 0.0
    assert one(spark, numeric.ratio(F.lit(1.0), F.lit(0.0)), "x") == 0.0
    labels = [one(spark, numeric.direction_label(F.lit(v)), "x") for v in (1.0, -1.0, 0.0)]
    assert labels == ["increases_bad_loan_risk", "decreases_bad_loan_risk", "neutral"]
    assert one(spark, numeric.row_log_loss(F.lit(1.0), F.lit(0.0)), "x") == pytest.approx(36.04365338911715)


def test_argument_checks(spark):
    with pytest.raises(ValueError, match="positive"):
        require_fractions(train=0.7, validation=0.3, test=0.0)
    with pytest.raises(ValueError, match="add up"):
        require_fractions(train=0.7, validation=0.15, test=0.1)
    require_fractions(train=0.7, validation=0.15, test=0.15)
    with pytest.raises(ValueError, match="lacks"):
        require_columns(spark.range(1), ["id", "other"])


def test_violations_are_raised(spark):
    found = violations(spark.range(3), "too_big", F.col("id"), F.col("id") > 1)
    with pytest.raises(DataCheckError, match="too_big: 2"):
        enforce(found, "ids")
    enforce(found.where("false"), "ids")


def test_score_check_counts(spark):
    rows = [(0.1, 0), (None, 1), (float("nan"), 1), (1.5, 0), (-0.1, 0), (0.0, 1), (1.0, 2)]
    row = score_check(spark.createDataFrame(rows, "p double, bad_loan int")).first()
    assert (row.row_count, row.invalid_score_count, row.invalid_label_count, row.class_count) == (7, 4, 1, 2)


@pytest.mark.parametrize("rows, message", [
    ([(0.1, 0), (0.2, 0)], "both classes"), ([(0.1, 0), (1.2, 1)], "outside"), ([(0.1, 0), (0.1, 3), (0.1, 1)], "not 0 or 1")])
def test_scores_are_refused(spark, rows, message):
    with pytest.raises(DataCheckError, match=message):
        enforce_scores(spark.createDataFrame(rows, "p double, bad_loan int"))
    with pytest.raises(DataCheckError, match="no scored rows"):
        enforce_scores(spark.createDataFrame([], "p double, bad_loan int"))


def test_sets(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",)], "v string")
    right = spark.createDataFrame([("b",), ("c",), (None,)], "v string")
    assert same_values(left, right, "v").first().asDict() == {"only_left": 1, "only_right": 1, "in_both": 1, "equal": False}
    assert [tuple(r) for r in repeated_values(left, "v").collect()] == [("b", 2)]
    assert one(spark, map_lookup(F.col("v"), {"a": 1}), "a") == 1
    assert one(spark, map_lookup(F.col("v"), {"a": 1}), "z") is None
