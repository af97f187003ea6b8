import random

import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from loanweft.llm import packing
from loanweft.llm.packing import Packer, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string"


def check(rows, documents, capacity):
    """Every id of every document in one piece, sequences gapless and full or a power of two."""
    tokenizer = Tokenizer.from_file(PATH)
    wanted = sorted(((d, (tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END])) for d, t in documents), key=lambda x: (x[0] is not None, x[0] or 0, len(x[1]), x[1]))
    sequences = {}
    for row in rows:
        assert row.length == len(row.ids) // 4 > 0
        sequences.setdefault(row.sequence_id, []).append(row)
    for pieces in sequences.values():
        at = 0
        for row in sorted(pieces, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at == capacity or (at < capacity and at & (at - 1) == 0)
    ids = {}
    for row in sorted(rows, key=lambda r: r.start):
        ids.setdefault((row.doc_id, row.doc_tokens), []).append((row.start, np.frombuffer(row.ids, "<u4").tolist()))
    known = {}
    for d, one in wanted:
        known.setdefault((d, len(one)), []).append(one)
    assert ids.keys() == known.keys()
    for key, pieces in ids.items():
        if len(known[key]) == 1:
            assert [start for start, _ in pieces] == np.r_[0, np.cumsum([len(p) for _, p in pieces])][:-1].tolist()
            assert sum((p for _, p in pieces), []) == known[key][0]
        else:  # repeated ids: the pieces as a whole
            assert sorted(sum((p for _, p in pieces), [])) == sorted(sum(known[key], []))
    return sequences


def words(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma delta", "Épsilon", "x", "zeta\n"]) for _ in range(n))


@pytest.mark.parametrize("partitions,capacity,most_open", [(1, 2048, 16), (5, 64, 4), (150, 32, 2), (3, 16, 1)])
def test_every_id_lies_in_one_piece_of_a_full_sequence(spark, partitions, capacity, most_open):
    rng = random.Random(partitions)
    documents = [(i, words(rng, rng.choice([0, 1, 3, 20, 90, 400]))) for i in range(300)]
    documents += [(1000, None), (None, "of no id"), (None, None), (7, documents[7][1]), (1001, ""), (1002, "long " * 20_000)]
    df = spark.createDataFrame(documents, SCHEMA).repartition(partitions)
    rows = pack(df, PATH, capacity, most_open).collect()
    sequences = check(rows, documents, capacity)
    short = [sum(r.length for r in pieces) for pieces in sequences.values() if sum(r.length for r in pieces) < capacity]
    assert len(short) == len(set(short))  # only the last rest, divided at powers of two


def test_empty_tables_single_rows_and_clashing_names(spark):
    assert pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    one = spark.createDataFrame([(1, None, "x", 9)], "doc_id bigint, text string, TEXT string, start int").toDF("doc_id", "text", "TEXT", "start")
    assert [(r.doc_id, r.start, r.length, r.offset, r.doc_tokens) for r in pack(one, PATH).collect()] == [(1, 0, 1, 0, 1)]


def test_best_fit_fills_the_fullest_when_none_fits():
    def piece(n):
        return b"\0\0\0\0" * n

    packer = Packer(0, 10, 2)
    packer.add(1, 0, 4, piece(4))
    packer.add(2, 0, 7, piece(7))  # a second window
    packer.add(3, 0, 3, piece(3))  # fits the second exactly, which is emitted
    assert [(r[0], r[5], r[6]) for r in packer.drained()] == [(2, 0, 0), (3, 0, 7)]
    packer.add(4, 0, 8, piece(8))
    packer.add(5, 0, 7, piece(7))  # none fits: two tokens fill the second, five the first
    assert [(r[0], r[1], r[2]) for r in packer.drained()] == [(4, 0, 8), (5, 0, 2)]
    assert [(w[0], [p[0] for p in w[1:]]) for w in packer.windows] == [(1, [1, 5])]
    packer.finish()
    assert [(r[0], r[2], r[5]) for r in packer.drained()] == [(1, 4, 2), (5, 4, 2), (5, 1, 3)]


def test_random_pieces_against_a_count_of_tokens():
    rng = random.Random(3)
    for _ in range(50):
        packer, total = Packer(0, 32, rng.choice([1, 2, 5])), 0
        for doc in range(rng.choice([0, 1, 10, 200])):
            n = rng.choice([1, 2, 3, 30, 31, 32, 33, 100])
            packer.add(doc, 0, n, b"abcd" * n)
            total += n
            assert len(packer.windows) <= packer.most_open and all(0 < w[0] < 32 for w in packer.windows)
        packer.finish()
        rows = packer.drained()
        assert sum(r[2] for r in rows) == total and not packer.windows
        sizes = {}
        for r in rows:
            sizes[r[5]] = sizes.get(r[5], 0) + r[2]
        assert all(s & (s - 1) == 0 for s in sizes.values())
