"""Exact positions against sorting in memory, with ranges of a few keys."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanweft.operators.position import Order, exact_quantile_buckets, rows_at_ranks, running_totals

TINY = {"rows_per_part": 5}


def at(*ranks):
    """These ranks, whatever the number of rows."""
    return lambda n: F.array(*[F.lit(k).cast("bigint") for k in ranks])


def ordered(frame, keys, ascending):
    return frame.sort_values(keys, ascending=ascending, kind="mergesort").reset_index(drop=True)


@pytest.fixture(scope="module")
def frame():
    rng = random.Random(7)
    ids = rng.sample(range(-10**6, 10**18), 600)
    rows = []
    for i, key in enumerate(ids):
        p = 0.3 if i % 3 == 0 else rng.choice([0.0, 1.0, 0.30000000000000004, rng.random()])
        rows.append((f"g{i % 2}", float(p), key, f"loan-{key:020d}"))
    return pd.DataFrame(rows, columns=["g", "p", "id", "text_id"])


@pytest.mark.parametrize("key", ["id", "text_id"])
@pytest.mark.parametrize("ascending", [True, False])
def test_rows_at_ranks_match_a_sort(spark, frame, key, ascending):
    df = spark.createDataFrame(frame)
    wanted = [1, 2, 100, 101, 200, 299, 300]
    found, sizes = rows_at_ranks(df, [Order("p", ascending), Order(key)], at(*wanted), ["g"], **TINY)
    for group, part in frame.groupby("g"):
        expected = ordered(part, ["p", key], [ascending, True])
        assert sizes[(group,)] == len(part)
        for k in wanted:
            p, value = found[(group,)][k]
            assert p == expected.p[k - 1]
            assert value == expected[key][k - 1]


def test_ranks_of_one_column_with_many_ties(spark):
    values = sorted([5.0] * 400 + [1.0] * 3 + [float(i) for i in range(100, 160)])
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found, _ = rows_at_ranks(df, [Order("v")], lambda n: F.array(*[F.lit(k).cast("bigint") for k in (1, 3, 4, 403, 404)], n), **TINY)
    assert {k: key[0] for k, key in found[()].items()} == {k: values[k - 1] for k in (1, 3, 4, 403, 404, len(values))}


def test_extreme_doubles_make_progress(spark):
    values = [-1e308, -5e-324, 0.0, 5e-324, 1e-300, 1.0, 1e308] + [i * 1e-320 for i in range(40)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found, _ = rows_at_ranks(df, [Order("v")], lambda n: F.sequence(F.lit(1).cast("bigint"), n), rows_per_part=1)
    assert [found[()][k][0] for k in range(1, len(values) + 1)] == sorted(values)


def test_dates_are_ordered(spark):
    df = spark.range(400).select(F.date_add(F.lit("2015-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("d"), "id")
    found, _ = rows_at_ranks(df, [Order("d"), Order("id")], at(15, 200), **TINY)
    local = sorted((row.d, row.id) for row in df.collect())
    assert found[()] == {15: local[14], 200: local[199]}


@pytest.mark.parametrize("tuning", [TINY, {}])
def test_repeated_key_is_refused(spark, tuning):
    df = spark.createDataFrame([(0.5, 1)] * 50, "p double, id long")
    with pytest.raises(ValueError, match="not unique"):
        rows_at_ranks(df, [Order("p"), Order("id")], at(10), **tuning)
    with pytest.raises(ValueError, match="not unique"):
        exact_quantile_buckets(df, [Order("p"), Order("id")], 5, **tuning)


@pytest.mark.parametrize("kind,low", [("bigint", 2 ** 60), ("decimal(30,0)", 10 ** 25)])
def test_whole_numbers_that_share_a_double(spark, kind, low):
    values = [low] * 20 + [low + 1] * 20
    df = spark.createDataFrame([(str(v),) for v in values], "v string").select(F.col("v").cast(kind).alias("v"))
    found, _ = rows_at_ranks(df, [Order("v")], at(1, 20, 21, 40), **TINY)
    assert {k: int(key[0]) for k, key in found[()].items()} == {1: low, 20: low, 21: low + 1, 40: low + 1}


def test_more_groups_than_any_list_should_hold(spark):
    df = spark.range(6000).select("id", (F.col("id") % 600).alias("g"), ((F.col("id") * 7919) % 1009 / 1009).alias("p"))
    got = exact_quantile_buckets(df, [Order("p"), Order("id")], 5, ["g"], **TINY).groupBy("g", "bucket").count().collect()
    assert len(got) == 3000 and {row["count"] for row in got} <= {1, 2, 3}


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf")])
def test_unusable_key_is_refused(spark, bad):
    df = spark.createDataFrame([(0.5, 1), (bad, 2)], "p double, id long")
    with pytest.raises(ValueError, match="usable order key"):
        rows_at_ranks(df, [Order("p"), Order("id")], at(1))


@pytest.mark.parametrize("rows", [10, 11, 23, 100, 997])
@pytest.mark.parametrize("constant", [True, False])
def test_buckets_match_the_quantile_cut_on_position(spark, rows, constant):
    frame = pd.DataFrame({"id": range(rows)})
    frame["p"] = 0.25 if constant else (frame.id * 7 % 13) / 13
    df = spark.createDataFrame(frame)
    got = exact_quantile_buckets(df, [Order("p", False), Order("id")], 10, name="d", **TINY).toPandas()
    expected = ordered(frame, ["p", "id"], [False, True])
    expected["d"] = [max(1, -(-i * 10 // (rows - 1))) for i in range(rows)]
    assert dict(zip(got.id, got.d)) == dict(zip(expected.id, expected.d))


def test_23_rows_differ_from_ntile(spark):
    got = exact_quantile_buckets(spark.range(23), [Order("id")], 10, name="d").groupBy("d").count().toPandas()
    counts = dict(zip(got.d, got["count"]))
    assert counts == pd.qcut(range(23), 10, labels=range(1, 11)).value_counts().to_dict()


def test_too_few_rows_for_buckets(spark):
    with pytest.raises(ValueError, match="cannot fill"):
        exact_quantile_buckets(spark.range(9), [Order("id")], 10)


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("rows_per_part", [10_000, 20])
def test_running_totals(spark, ascending, rows_per_part):
    frame = pd.DataFrame({"g": [i % 3 for i in range(600)], "v": [(i * 7919) % 100_003 / 7 for i in range(600)],
                          "n": [i % 5 for i in range(600)]})
    got = running_totals(spark.createDataFrame(frame), "v", ["n"], ["g"], ascending, rows_per_part=rows_per_part).toPandas()
    expected = frame.sort_values("v", ascending=ascending)
    expected["before"] = expected.groupby("g").n.cumsum() - expected.n
    assert dict(zip(zip(got.g, got.v), got.n_before)) == dict(zip(zip(expected.g, expected.v), expected.before))


def test_results_do_not_depend_on_partitions(spark):
    df = spark.range(3000).select("id", ((F.col("id") * 7919) % 50 / 50).alias("p"))
    results = []
    for partitions in (1, 7):
        cut, _ = rows_at_ranks(df.repartition(partitions), [Order("p"), Order("id")], at(1234), **TINY)
        results.append(cut)
    assert results[0] == results[1]


def test_bins_are_counted_without_sorting_the_rows(spark, monkeypatch):
    """No task sorts the rows that it reads: their number grows with the data."""
    from loanweft.operators import position
    plans, written = [], position.materialize

    def seen(df, name="stage"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, name)

    monkeypatch.setattr(position, "materialize", seen)
    rows = spark.range(2_000).selectExpr("id", "id % 7 AS p", "id % 2 AS g")
    found, _ = position.keys_at_ranks(rows, [position.Order("p"), position.Order("id")], lambda n: F.array(F.lit(1), F.lit(500), n), ["g"], rows_per_part=100)
    assert [tuple(row) for row in found.orderBy("g", "_rank").select("g", "_rank", "p", "id").collect()] == [
        (g, k, *sorted((i % 7, i) for i in range(g, 2_000, 2))[k - 1]) for g in (0, 1) for k in (1, 500, 1000)]
    position.keys_at_ranks(rows, [position.Order("p")], lambda n: F.array(n), ["g"], rows_per_part=100)
    assert len(plans) > 6 and not any("SortAggregate" in plan for plan in plans)
