"""Lookups and set tests between tables of names or values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanweft.session import literal_table, materialize

BLOOM_HASHES = 4
MOST_BITS = 1 << 28  # of a Bloom filter: 32 MB


def map_lookup(column: Column, mapping: Mapping) -> Column:
    """J1. Value of a dictionary of a few constants, NULL for an unknown key; ``dictionary_lookup`` is for large ones."""
    return F.try_element_at(F.create_map(*[F.lit(item) for item in chain.from_iterable(mapping.items())]), column)


def dictionary_lookup(df: DataFrame, mapping: Mapping, key: str, value: str, schema: str) -> DataFrame:
    """J1. The dictionary as a table (``schema`` names key and value), joined; any number of entries."""
    return table_lookup(df, literal_table(df.sparkSession, list(mapping.items()), schema), key).select(*df.columns, value)


def table_lookup(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """J1. Left join with a table of unique keys; Spark broadcasts it if its size allows."""
    return df.join(table, key, "left")


def members(df: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """J2. Rows whose key occurs in ``names``."""
    return df.join(names.select(key), key, "left_semi")


def absent(df: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """J3. Rows whose key does not occur in ``names``."""
    return df.join(names.select(key), key, "left_anti")


def _bits(bits: int, key: str) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(bits)) for seed in range(BLOOM_HASHES)]


def bloom_filter(names: DataFrame, key: str) -> tuple[Column, int]:
    """A Bloom filter over a column: its words of 64 bits as one array, and the number of bits.

    Built by aggregation, map-side too; ten bits a key and ``MOST_BITS`` at
    most, beyond which it lets more rows through but stays right.
    """
    keys = names.agg(F.approx_count_distinct(key).alias("n")).first().n
    bits = min(MOST_BITS, 1 << max(10, (10 * keys).bit_length()))
    at = names.where(F.col(key).isNotNull()).select(F.explode(F.array(*_bits(bits, key))).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("set"))
    every = names.sparkSession.range(bits // 64).withColumnRenamed("id", "word").join(words, "word", "left")
    listed = F.array_sort(F.collect_list(F.struct("word", F.coalesce("set", F.lit(0).cast("bigint")).alias("set"))))
    one = materialize(every.agg(F.transform(listed, lambda item: item["set"]).alias("words")), "bloom-filter")
    return one.select("words").scalar(), bits


def may_be_members(df: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Rows that pass a Bloom filter over the keys of ``names``: all members, and about one in a hundred of the others."""
    words, bits = bloom_filter(names, key)
    filtered = df.withColumn("_words", words)
    for at in _bits(bits, key):
        filtered = filtered.where(F.getbit(F.get("_words", F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63))) == 1)
    return filtered.drop("_words")


def members_of_large(df: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """J2 for a set of names as large as a table: most rows that are no members go before the shuffle, the join decides."""
    return members(may_be_members(df, names, key), names, key)


def absent_from_large(df: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """J3 likewise: rows that the filter refuses are absent and are not moved, the others are joined."""
    words, bits = bloom_filter(names, key)
    passed = F.lit(True)
    for at in _bits(bits, key):
        passed = passed & (F.getbit(F.get("_words", F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63))) == 1)
    judged = df.withColumn("_words", words).withColumn("_passed", F.coalesce(passed, F.lit(False))).drop("_words")
    return judged.where(~F.col("_passed")).drop("_passed").unionByName(absent(judged.where("_passed").drop("_passed"), names, key))


def side_by_side(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """J4. Columns of both tables for equal keys."""
    return left.join(right, key, "inner")


def same_values(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """U2. One row: values only left, only right, in both, and whether the sets are equal.

    Both sides are folded to distinct values and counted in one aggregation.
    """
    tagged = left.select(F.col(column).alias("v"), F.lit(True).alias("l"), F.lit(False).alias("r")).unionByName(
        right.select(F.col(column).alias("v"), F.lit(False).alias("l"), F.lit(True).alias("r")))
    per_value = tagged.where(F.col("v").isNotNull()).groupBy("v").agg(
        F.bool_or("l").alias("l"), F.bool_or("r").alias("r"))
    only_left, only_right = F.count_if(F.col("l") & ~F.col("r")), F.count_if(~F.col("l") & F.col("r"))
    return per_value.agg(
        only_left.alias("only_left"), only_right.alias("only_right"),
        F.count_if(F.col("l") & F.col("r")).alias("in_both"),
        ((only_left == 0) & (only_right == 0)).alias("equal"))


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """U4. Values that occur more than once, with their count.

    Values are counted by hash; only those whose hash repeats are moved, and
    equal hashes of different values are told apart.
    """
    value = F.col(column)
    hashed = df.select(value, *[F.xxhash64(F.lit(seed), value, value.isNull()).alias(f"_hash{seed}") for seed in (1, 2)])
    keys = ["_hash1", "_hash2"]
    often = hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)
    rows = hashed.join(often, keys, "left_semi")
    found = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"), F.min(column).alias(column), F.max(column).alias("_other"))
    alike = F.col(column).eqNullSafe(F.col("_other"))
    several = rows.join(found.where(~alike).select(*keys), keys, "left_semi").groupBy(column).agg(
        F.count(F.lit(1)).alias("occurrences")).where(F.col("occurrences") > 1)
    return found.where(alike).select(column, "occurrences").unionByName(several)


def union_reports(reports: Sequence[DataFrame]) -> DataFrame:
    """U1. Reports of equal columns as one table."""
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result
