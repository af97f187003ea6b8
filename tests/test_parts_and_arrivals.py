"""Parts of the input that differ, arriving files, large sets, mergeable profiles, categories without a list."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from loanweft.functions.checks import absent_names, fraction_fault
from loanweft.operators import features, profile, sets
from loanweft.sources import readers
from loanweft.streaming import count_new_files


def test_headers_that_differ(spark, tmp_path):
    for name, text in {"a": "x,y,z\n1,2,3\n", "b": "x,y,z\n", "c": "﻿x,\"y\", z\n1,2,3\n", "d": "x,z\n1,2\n", "e": "y,x,z\n", "f": "x,y,z,w,w\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    found = {(r.file.rsplit("/", 1)[1][0], r.rule, r.offender) for r in readers.part_violations(spark, str(tmp_path)).collect()}
    assert found == {("d", "absent_column", "y"), ("e", "moved_column", "x"), ("e", "moved_column", "y"), ("f", "extra_column", "w"), ("f", "repeated_column", "w")}
    wanted = readers.part_violations(spark, str(tmp_path), ["x", "z"]).where("file like '%/d.csv'")
    assert wanted.count() == 0


def test_counts_of_arriving_files(spark, tmp_path):
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else f"v{i % 4}") for i in range(100)], "i int, v string")
    for arrival in range(4):
        rows.where(F.col("i") % 4 == arrival).write.mode("append").parquet(str(tmp_path / "in"))
        got = count_new_files(spark, str(tmp_path / "in"), rows.schema, "v", str(tmp_path / "out"), str(tmp_path / "state"))
        wanted = rows.where(F.col("i") % 4 <= arrival).groupBy("v").count()
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)
    again = count_new_files(spark, str(tmp_path / "in"), rows.schema, "v", str(tmp_path / "out"), str(tmp_path / "state"))
    assert sum(r["count"] for r in again.collect()) == 100


@pytest.mark.parametrize("bits", [1 << 28, 1 << 10])
def test_large_sets(spark, monkeypatch, bits):
    monkeypatch.setattr(sets, "MOST_BITS", bits)
    df = spark.createDataFrame([(i, i * 3 if i % 10 else None) for i in range(3000)], "i long, k long")
    names = spark.createDataFrame([(i * 3 if i % 50 else None,) for i in range(0, 3000, 5)], "k long")
    assert sorted(r.i for r in sets.members_of_large(df, names, "k").collect()) == sorted(r.i for r in sets.members(df, names, "k").collect())
    assert sorted(r.i for r in sets.absent_from_large(df, names, "k").collect()) == sorted(r.i for r in sets.absent(df, names, "k").collect())
    nothing = names.limit(0)
    assert sets.members_of_large(df, nothing, "k").count() == 0 and sets.absent_from_large(df, nothing, "k").count() == 3000
    if bits > 1 << 10:
        assert sets.may_be_members(df, names, "k").count() < sets.members(df, names, "k").count() + 150


def test_merged_profiles(spark):
    df = spark.createDataFrame([(i, float(i % 200) if i % 9 else None, f"t{i % 1500}") for i in range(4000)], "i long, x double, t string")
    states = [profile.profile_state(df.where(F.col("i") % 4 == load), ["x", "t"]) for load in range(4)]
    merged = profile.merged_states(states[0].unionByName(states[1]).unionByName(states[2]))
    got = {r.column_name: r for r in profile.profile_of_state(profile.merged_states(merged.unionByName(states[3]))).collect()}
    x = [i % 200 for i in range(4000) if i % 9]
    mean = sum(x) / len(x)
    assert (got["x"].total_count, got["x"].missing_count, got["x"].low, got["x"].high) == (4000, 4000 - len(x), 0.0, 199.0)
    assert got["x"].mean == pytest.approx(mean) and got["x"].deviation == pytest.approx((sum((v - mean) ** 2 for v in x) / len(x)) ** 0.5)
    assert abs(got["x"].unique_non_missing_estimate - 200) <= 2 and abs(got["t"].unique_non_missing_estimate - 1500) <= 30
    assert got["t"].mean is None and got["t"].deviation is None


def test_categories_without_a_list(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["b", "a", None, "ü"]), str(rng.randint(0, 40))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, c string, d string")
    known = features.category_dictionary(df.where("id < 250"), ["c", "d"], 3, rows_per_part=7)
    values = [sorted({r[1] or "Missing" for r in rows[:250]}), sorted({r[2] for r in rows[:250]})]
    slots = {(column, value): 3 + at for at, (column, value) in enumerate([("c", v) for v in values[0]] + [("d", v) for v in values[1]])}
    assert {(r.column_name, r.value): r.slot for r in known.collect()} == slots
    got = {r.id: r.slots for r in features.slotted(df, "id", ["c", "d"], known).collect()}
    assert got == {i: sorted(s for s in (slots.get(("c", c or "Missing")), slots.get(("d", d))) if s is not None) for i, c, d in rows}


def test_guards_for_rows(spark):
    df = spark.createDataFrame([(0.5, 0.5), (0.0, 1.0), (0.5, 0.4)], "a double, b double")
    assert [r.v for r in df.select(fraction_fault("a", "b").alias("v")).collect()] == ["fine", "fractions must be positive", "fractions must add up to 1"]
    maps = spark.createDataFrame([({"a": "1"},), ({"a": "1", "b": "2"},), ({},)], "m map<string,string>")
    assert [r.absent for r in absent_names(maps, "m", ["b", "a"]).collect()] == [["b"], ["b", "a"]]


def test_samples_of_texts_that_differ_by_blanks(spark):
    rows = [(i, " " * (i % 60) + f"v{i // 60}" + " " * (i % 7), i) for i in range(600)] + [(1000, "  ", 1), (1001, None, 2)]
    df = spark.createDataFrame(rows, "id long, t string, n int")
    got = {r.column_name: r.sample_values for r in profile.sample_values(df, ["t", "n"], "id").collect()}
    assert got == {"t": "v0, v1, v2, v3, v4", "n": "0, 1, 2, 3, 4"}
    counts = {r.column_name: r.unique_non_missing_count for r in profile.distinct_counts(df, ["t", "n"]).collect()}
    assert counts == {"t": len({t for _, t, _ in rows if t is not None}), "n": 600}


def test_one_large_file_with_line_breaks_is_many_tasks(spark, tmp_path):
    rng = random.Random(9)
    cells = ["plain", "a,b", 'say ""hi""', "two\nlines", "\n\n\n", "x" * 300 + "\n" + "y" * 300, "", "é\nü", 'q""\n""q', "tail "]
    rows = [[str(i), rng.choice(cells), rng.choice(cells)] for i in range(3000)]
    rows[500][1] = "long\n" * 3000  # longer than several byte ranges
    for part in (0, 1):
        with open(tmp_path / f"p{part}.csv", "w", encoding="utf-8", newline="") as file:
            file.write("id,first,second\n")
            file.writelines(",".join([r[0], *(f'"{c}"' for c in r[1:])]) + ("\r\n" if part else "\n") for r in rows[part::2])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = readers.read_raw_loans(spark, str(tmp_path), split_files=True)
        got = sorted(map(tuple, df.collect()))
        blocks = readers._records(spark, str(tmp_path)).select("file", "block").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert blocks > 20
    assert got == sorted((r[0], *(c.replace('""', '"') or None for c in r[1:])) for r in rows)
    assert got == sorted(map(tuple, readers.read_raw_loans(spark, str(tmp_path)).collect()))


def test_large_raw_text_is_written_as_several_files(spark, tmp_path, monkeypatch):
    """No task reads or writes more than a file of bounded size; small tables stay one file."""
    from driver_queries import data_queries
    texts = [None, "", "a,b", 'said "x"\nand, then', "line\n\nline\r\nend", "é" * 40] * 50
    rows = [(i, text, "en" if i % 3 else None) for i, text in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    for most, files in ((1 << 30, 1), (2_000, 3)):
        monkeypatch.setattr(data_queries, "RAW_FILE", most, raising=False)
        monkeypatch.setattr(data_queries, "scratch", lambda spark: str(tmp_path / f"raw-{files}"))
        got = data_queries.s1_split_file(spark, str(tmp_path)).collect()
        expected = [(str(i), hashlib.md5(text.encode()).hexdigest() if text else None, lang) for i, text, lang in rows]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
        assert len(list((tmp_path / f"raw-{files}").glob("part-*.csv"))) >= files
