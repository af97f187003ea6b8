import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanweft.llm import merkle
from loanweft.llm.queries import without_breaks

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)])


def climb(nodes, at):
    """Root, and the (left, right) of each level on the way of node ``at``."""
    way = []
    while len(nodes) > 1:
        low = at // 3 * 3
        way.append(("".join(nodes[low:at]), "".join(nodes[at + 1:low + 3])))
        nodes, at = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)], at // 3
    return nodes[0], way


def brute(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    trees = {name: sorted(trees[name], key=lambda x: x[:3]) for name in names}
    subroots = [climb([x[2] for x in trees[name]], 0)[0] for name in names]
    made = []
    for i, name in enumerate(names):
        root, upper = climb(subroots, i)
        for j, (_, _, digest, row) in enumerate(trees[name]):
            subroot, way = climb([x[2] for x in trees[name]], j)
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None
            end = leaf(row, row[1].replace("\n", "")) if tampered else digest
            for left, right in way + upper:
                end = h(left, end, right)
            proof = h(*[a + b for a, b in way + upper])
            made.append((row[0], digest, subroot, root, proof, end, end == root))
    return sorted(made, key=repr)


def run(df, height=1):
    return sorted((tuple(r) for r in merkle.manifest(df, without_breaks(), height).audit().collect()), key=repr)


@pytest.mark.parametrize("height", [1, 2, 6])
def test_audit_against_a_tree_by_hand(spark, height):
    rng = random.Random(height)
    rows = [(i, rng.choice(["a\nb", "ü", "", None, "x" * 3000, "\n\n"]), rng.choice(["de", None]), rng.choice(["hot", "hot", "b", "é", "", "one"]), i) for i in range(200)]
    rows += [(500, "t", "en", None, 1), (None, "no\nid", None, None, None), (None, "no\nid", None, None, None), (7, "again\n", "en", "hot", 2), (7, "again\n", "en", "hot", 2),
             (900, "alone\n", "x", "single", 3)]
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(5), height) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_one_source_of_any_size(spark, n):
    rows = [(i, f"t\n{i}", "l", "s", i) for i in range(n)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_many_sources_empty_tables_and_clashing_names(spark):
    rows = [(i, "x\n", "l", f"s{i % 23}", i) for i in range(60)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert run(spark.createDataFrame([], SCHEMA)) == []
    clash = spark.createDataFrame(rows, SCHEMA).withColumns({"position": F.lit(1), "tree": F.lit("x"), "digest": F.lit("y")})
    assert run(clash.select("*", F.lit("z").alias("TEXT"))) == brute(rows)
    whole = merkle.manifest(spark.createDataFrame(rows, SCHEMA))
    assert all(r.verified for r in whole.audit().collect()) and whole.subroots().count() == 23


def test_places_are_the_recursive_layout():
    def layout(levels, depth, index):  # nodes in order, by the definition
        if levels == 1:
            return [(depth, index)]
        upper = levels // 2
        order = layout(upper, depth, index)
        for j in range(3 ** upper):
            order += layout(levels - upper, depth + upper, index * 3 ** upper + j)
        return order

    for height in range(6):
        order = layout(height + 1, 0, 0)
        assert len(order) == merkle.size(height + 1)
        for at, (depth, index) in enumerate(order):
            assert merkle.places(height, height - depth)[index] == at
    assert np.unique(np.concatenate([merkle.places(4, level) for level in range(5)])).size == merkle.size(5)
