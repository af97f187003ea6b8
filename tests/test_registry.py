"""The registered queries, compared with their SQL at the smallest scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from check_queries import compare

FOLDER = "/root/testdata/sf0.001"
QUICK = ["p1_target_column", "p7_decision", "a4_target_summary", "a7_duplicate_wide_rows", "a16_feature_types", "w1_time_split",
         "e1_probability_metrics", "e8_constant_score_deciles", "e12_rank_correlation", "g13_selection_report", "m14_isotonic_probability"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_sql_belongs_to_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, con, name):
    verdict, _ = compare(spark, con, FOLDER, name, entry_module.queries()[name], entry_module.oracle_sql()[name])
    assert verdict.startswith("ok")


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "decision" in df.columns
