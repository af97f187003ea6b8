"""Raw texts, reports in order, row positions, dictionaries and the shared folder."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanweft import session
from loanweft.functions.checks import DataCheckError
from loanweft.operators import calibration, quality, sets
from loanweft.operators.position import Order, row_positions
from loanweft.sources import readers, writers

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()), T.StructField("amount", T.DoubleType())])
RAW = 'id,note,amount\n1,"two\nlines, a ""quote""",5\n2,plain,1.5x\n3,NA,1.5x\nx,,NaN\n'


@pytest.fixture
def raw_file(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(RAW)
    return str(path)


def test_quoted_line_breaks_stay_in_their_cell(spark, raw_file):
    rows = readers.read_raw_loans(spark, raw_file, SCHEMA).collect()
    assert [tuple(r) for r in rows] == [(1, 'two\nlines, a "quote"', 5.0), (2, "plain", None), (3, None, None), (None, None, None)]


def test_unreadable_cells_are_listed(spark, raw_file):
    found = {tuple(r) for r in readers.unreadable_values(spark, raw_file, SCHEMA).collect()}
    assert found == {("amount", "1.5x", 2), ("id", "x", 1)}
    text_only = T.StructType([SCHEMA["note"]])
    assert readers.unreadable_values(spark, raw_file, text_only).count() == 0


def test_columns_and_projection_of_a_csv(spark, raw_file):
    assert readers.read_columns(spark, raw_file, "csv") == ["id", "note", "amount"]
    assert [r.note for r in readers.read_projection(spark, raw_file, ["note"], "csv").collect()][1] == "plain"
    with pytest.raises(ValueError):
        readers.read_projection(spark, raw_file, ["other"], "csv")


def test_reports_of_many_partitions_keep_their_order(spark, tmp_path):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("k"))
    writers.write_report(df.repartitionByRange(9, F.desc("k")).sortWithinPartitions(F.desc("k")), str(tmp_path / "report"))
    (file,) = glob.glob(str(tmp_path / "report" / "part-*"))
    with open(file) as lines:
        assert lines.read().split() == ["k", *map(str, range(4999, -1, -1))]


@pytest.mark.parametrize("rows_per_part", [3, 10_000])
def test_positions_of_rows(spark, rows_per_part):
    df = spark.range(200).select("id", (F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 23).alias("p"))
    got = row_positions(df, (Order("p", False), Order("id")), ["g"], "place", rows_per_part).collect()
    for g in range(3):
        own = sorted((r for r in got if r.g == g), key=lambda r: (-r.p, r.id))
        assert [r.place for r in own] == list(range(1, len(own) + 1))


def test_dictionary_of_any_size(spark):
    df = spark.createDataFrame([("k1",), ("k1500",), ("none",)], "key string")
    mapping = {f"k{i}": i for i in range(3000)}
    got = {r.key: r.value for r in sets.dictionary_lookup(df, mapping, "key", "value", "key string, value int").collect()}
    assert got == {"k1": 1, "k1500": 1500, "none": None}


def test_repeated_values_and_duplicates_with_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 1), (None, 2), ("b", 1)], "v string, n int")
    assert {(r.v, r.occurrences) for r in sets.repeated_values(df, "v").collect()} == {("a", 2), (None, 3)}
    row = quality.duplicate_summary(df).first()
    assert (row.total_rows, row.rows_in_duplicate_groups, row.redundant_duplicate_rows) == (6, 4, 2)


def test_two_names_for_one_isotonic_model(spark):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(10)], "z double, bad_loan int")
    model = calibration.fit_isotonic(df)
    first = calibration.apply_isotonic(model, df, output="p1")
    second = calibration.apply_isotonic(model, df.withColumnRenamed("z", "other"), "other", "p2")
    assert first.count() == second.count() == 10 and "p1" in first.columns and "p2" in second.columns


def test_stages_can_be_cleared(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    assert session.materialize(spark.range(3)).count() == 3
    assert os.listdir(tmp_path / "loanweft")
    session.clear_stages(spark)
    assert not os.path.exists(tmp_path / "loanweft")


def test_numbered_reports_keep_their_order_over_several_files(spark, tmp_path):
    rows = [(i % 7, i) for i in range(500)]
    path = str(tmp_path / "numbered")
    writers.write_numbered_report(spark.createDataFrame(rows, "n int, k int").repartition(5), [Order("n", False), Order("k")], path)
    got = spark.read.option("header", True).csv(path).collect()
    wanted = sorted(rows, key=lambda r: (-r[0], r[1]))
    assert sorted((int(r.line), int(r.n), int(r.k)) for r in got) == [(i, *r) for i, r in enumerate(wanted)]
    with pytest.raises(DataCheckError):
        writers.write_numbered_report(spark.createDataFrame([], "n int, k int"), [Order("n"), Order("k")], str(tmp_path / "none"))
