"""The stages on a small corpus with planted cases, each against what it should keep."""

import random

import pytest

import corpus_pipeline

WORDS = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "lmnrs"]


def prose(chance, n):
    return " ".join(chance.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    chance = random.Random(11)
    passage, items = prose(chance, 60), [(i, prose(chance, 30)) for i in range(6)]
    docs, labels = [], []
    for i in range(400):
        text = prose(chance, 80)
        toxic = i % 5 == 0 and i < 300
        if toxic:
            text += " horrible scoundrel"
        docs.append((i, text))
        labels.append((i, 1, int(toxic)))
    docs += [(1000 + i, docs[1 + 2 * i * 5 + 1][1] + " end") for i in range(5)]  # near copies
    docs += [(1100 + i, docs[7 + 5 * i][1]) for i in range(5)]  # exact copies
    docs += [(1200 + i, f"{prose(chance, 90)} {passage} {prose(chance, 90)}") for i in range(4)]
    docs += [(1300 + i, f"{prose(chance, 60)} {items[i][1].upper()} {prose(chance, 60)}") for i in range(4)]
    docs += [(1400, ""), (1401, None)]
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", "s", None if t is None else len(t), "extra") for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, cells string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_keep_what_they_should(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    names, kept = [], {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.materialize(stage(spark, docs, folder))
        names.append(name)
        if number < 4:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        kept[number] = {r.doc_id: r.text for r in docs.collect()}
    assert names == ["toxicity", "n-gram Jaccard join", "suffix-array dedup", "benchmark decontamination", "BPE encoding and decoding"]
    assert kept[0] == {i: t for i, t in before.items() if not (i % 5 == 0 and i < 300)}
    assert set(kept[0]) - set(kept[1]) == {*range(1000, 1005), *range(1100, 1105)} & set(kept[0])
    assert set(kept[2]) == set(kept[1])
    assert {i for i in kept[2] if kept[2][i] != kept[1][i]} == {1201, 1202, 1203}
    assert all(len(kept[2][i]) < len(kept[1][i]) - 200 for i in (1201, 1202, 1203))
    assert set(kept[2]) - set(kept[3]) == {1300, 1301, 1302, 1303}
    assert kept[4] == {i: t or "" for i, t in kept[3].items()}


def test_whole_run_and_empty_tables(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 300
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_repeated_and_missing_ids(spark, folder):
    text = prose(random.Random(2), 50)
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (1, "other words", None, None, None), (None, text, "en", "s", 1), (None, "alone here", None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    near = corpus_pipeline.near_duplicate_stage(spark, docs, folder)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in near.collect()) == [(-1, "alone here"), (1, min(text, "other words"))] or {
        r.text for r in near.collect()} >= {"alone here"}
    cut = corpus_pipeline.repeated_passage_stage(spark, docs, folder)
    assert sum(r.text == text for r in cut.collect()) == 1
    assert corpus_pipeline.decontamination_stage(spark, docs, folder).count() == 5


def test_a_leak_takes_its_own_row_only(spark, folder):
    item = spark.read.parquet(f"{folder}/benchmark.parquet").filter("item_id = 2").first().text
    texts = [(None, f"before {item} after"), (None, "clean without id"), (None, None), (7, item), (7, "clean with the same id"), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    kept = corpus_pipeline.decontamination_stage(spark, docs, folder)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(i, t) for i, t in texts if not t or item not in t}
