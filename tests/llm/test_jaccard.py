import pathlib
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from loanweft.llm import common, jaccard
from loanweft.llm.components import components


def sets_of(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute_components(rows, width, percent):
    """Every pair compared."""
    sets = {i: sets_of(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed):
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(400)]

    def prose(n):
        return chance.choices(words, k=n)

    line, rows = prose(40), []
    for number in range(25):
        base = prose(chance.choice([1, 2, 3, 6, 9, 10, 11, 20, 40, 90, 200]))
        if number % 3 == 0:
            base = base + line
        for _ in range(chance.randint(1, 7)):
            copy = list(base)
            for _ in range(chance.choice([0, 0, 1, 1, 2, 3, len(base) // 30 + 1])):
                if copy:
                    copy[chance.randrange(len(copy))] = chance.choice(words)
            base = copy if chance.random() < 0.5 else base  # chains of edits
            rows.append((len(rows) * 2, " ".join(copy)))
    for k in range(30):  # one passage in texts that differ otherwise
        rows.append((1000 + k, " ".join(prose(60) + line * 2)))
    rows += [(2000, ""), (2001, None), (2002, " \t"), (2003, "One"), (2004, "one")]
    return rows


@pytest.mark.parametrize("width,percent,seed", [(3, 90, 1), (5, 80, 2), (3, 90, 3)])
def test_components_against_all_pairs(spark, width, percent, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, signature string, node int").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_components(df, width, percent).collect()}
    assert got == brute_components(rows, width, percent)


def test_ids_joined_by_shuffle_and_repeated_and_missing_ids(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", -1)
    rows = [(1, "a b c d e f g h i j k l"), (1, "a b c d e f g h i j k l"), (4, "a b c d e f g h i j k l"), (None, "a b c d e f g h i j k l"), (None, None),
            (7, "other words stand in this text here")]
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_components(
        spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.component_id is not None)
    assert got == [(-1, 10, 1), (1, 10, 1), (1, 10, 1), (4, 10, 1), (7, 5, 7)]
    assert jaccard.near_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(4)
    for percent in (80, 90):
        for _ in range(400):
            n = int(rng.integers(1, 300))
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            apart = jaccard.most_apart(2 * len(a), percent)
            gone = int(rng.integers(0, apart + 1))
            new = rng.integers(0, 1 << 63, int(rng.integers(0, apart - gone + 1)), dtype=np.uint64)
            b = np.union1d(a[rng.permutation(len(a))[gone:]], new)
            common, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            if 100 * common >= percent * union and len(b) and common < union:
                assert len(np.intersect1d(jaccard.signatures(a, percent), jaccard.signatures(b, percent)))


@pytest.mark.parametrize("percent", [80, 90])
def test_every_size_of_set_is_cut_within_a_few_tries(percent):
    rng = np.random.default_rng(6)
    for n in (*range(1, 40), 100, 300, 310, 390, 702, 878, 2300, 3000, 20_000):
        made = jaccard.signatures(np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)), percent)
        assert len(made) <= 20 + 1.6 * n * (100 - percent) / percent * 4


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200), (None, 3), (5, 4)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}


def test_rows_of_one_id_or_none_are_linked_by_their_own_text(spark):
    rows = [(i, text) for i, (_, text) in enumerate(corpus(5))]
    wanted = brute_components(rows, 3, 90)
    ids = {i: None if i % 5 == 0 else i // 3 for i, _ in rows}  # shared by up to three rows
    df = spark.createDataFrame([(ids[i], text) for i, text in rows], "doc_id long, text string").repartition(4)
    members = {}
    for i, (_, root) in wanted.items():
        members.setdefault(root, []).append(ids[i])
    smallest = {root: min((d for d in found if d is not None), default=None) for root, found in members.items()}
    mine = [(ids[i], n, smallest[root] if len(members[root]) > 1 else ids[i]) for i, (n, root) in wanted.items()]
    got = [tuple(r) for r in jaccard.near_components(df).collect()]
    assert sorted(got, key=repr) == sorted(mine, key=repr)


def test_partitions_of_members_follow_the_signatures(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MEMBERS_PER_PART", 400, raising=False)
    written, write = {}, jaccard.materialize

    def noted(df, name):
        if name == "fragment-members":
            written[name] = df.rdd.getNumPartitions()
        return write(df, name)

    monkeypatch.setattr(jaccard, "materialize", noted)
    chance = random.Random(8)
    base = [f"w{chance.randrange(10_000)}" for _ in range(3000)]
    rows = [(i, " ".join(base[:i] + ["other"] + base[i + 1:])) for i in range(6)] + [(9, "none of these")]  # few texts, long ones
    got = {r.doc_id: r.component_id for r in jaccard.near_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()}
    assert got == {**dict.fromkeys(range(6), 0), 9: 9}
    made = sum(len(jaccard.signatures(s, 80)) for _, t in rows for s in jaccard.distinct_sets(*jaccard.raw(pa.array([t])), 5))
    assert made > 4 * 400 and 2 * written["fragment-members"] * 400 >= made


def test_a_task_leaves_no_powers_in_its_worker():
    common.polynomial(np.zeros(1 << 20, np.uint8))
    common.release()
    assert not common.POWERS
    again = common.polynomial(np.frombuffer(b"abcabc", np.uint8))(np.array([0, 3]), np.array([3, 6]))
    assert again[0] == again[1]


def test_tables_between_steps_go_and_shuffle_files_with_them(spark):
    folder = pathlib.Path(common.shared_folder(spark), "loanweft")
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {name for name in blocks.getAllBlocks().mkString(" ").split() if name.startswith("shuffle")}

    rows = spark.createDataFrame(corpus(6), "doc_id long, text string").repartition(4)
    known = set(folder.iterdir()) if folder.exists() else set()
    got = {r.doc_id: r.component_id for r in jaccard.near_components(rows, 5, 80).collect()}
    left = {path.name.rpartition("-")[0] for path in set(folder.iterdir()) - known}
    assert not left & {"fragment-members", "members", "segments", "overlaps", "open-members", "differences", "first-differences"}
    assert {"row-components", "smallest-ids"} <= left
    assert got == {i: root for i, (_, root) in brute_components(corpus(6), 5, 80).items()}
    before = shuffled()
    kept = common.materialize(rows.repartition(7, "doc_id"), "kept")
    for _ in range(50):  # the files are removed behind the write
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before and kept.count() == len(corpus(6))
    there = set(folder.glob("kept-*"))
    common.discard(kept, rows)  # what was not written here stays
    assert there and there - set(folder.glob("kept-*")) == there - known


@pytest.mark.parametrize("percent", [80, 90])
def test_stray_leaders_go_and_linked_texts_keep_one_in_common(spark, percent):
    chance = random.Random(percent)
    members, sets, wanted = [], {}, []
    for pair in range(60):  # two texts each that share as many fragments as linked ones must, dealt to few or many leaders
        n = chance.randint(40, 400)
        size = jaccard.levels(n, percent)[-1]
        at = list(jaccard.grid(percent)).index(size)
        remaining = size - jaccard.spared(size, percent)
        total = n + n * 100 // percent
        least = remaining - min(total * (100 - percent) // (100 + percent), -int(-remaining // jaccard.MARGIN) - 1)
        leaders = [10 * pair + i for i in range(chance.choice([1, 2, 3, 7, 8]))]
        x, y = 10 * pair + 8, 10 * pair + 9
        sets |= dict.fromkeys((x, y), n)
        label = iter(range(pair << 20, (pair + 1) << 20))
        for _ in range(least):
            signature, leader = next(label) * 128 + at, chance.choice(leaders)
            members += [(signature, leader, x), (signature, leader, y)]
        strays = least // 4 if pair % 2 else 0
        for doc in (x, y):
            members += [(next(label) * 128 + at, 100_000 + 1000 * pair + 100 * (doc - x) + i, doc) for i in range(strays)]
        wanted.append((x, y, least, len(leaders)))
    kept = jaccard.with_enough(spark.createDataFrame(members, jaccard.SHARED.replace("bigint", "long")),
                               spark.createDataFrame(list(sets.items()), "doc_id long, n_shingles long"), percent)
    led = {}
    for r in kept.collect():
        led.setdefault(r.doc_id, set()).add((r.signature, r.leader))
    for x, y, least, many in wanted:
        assert jaccard.SPARE * len(led[x] & led[y]) >= (jaccard.SPARE - 2) * least + 2
        assert many > 3 or least < 15 or not any(leader >= 100_000 for _, leader in led[x] | led[y])
    assert sum(many <= 3 and least >= 15 for _, _, least, many in wanted) >= 10
    alone = jaccard.with_enough(spark.createDataFrame([(5 * 128 + 3, 1, 1)], "signature long, leader long, doc_id long"),
                                spark.createDataFrame([(1, 5000)], "doc_id long, n_shingles long"), percent)
    assert alone.count() == 0
