import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from tokenizers import Tokenizer

from loanweft.llm import common, decontaminate, forced_bpe, substrings, token_ids, training_order
from loanweft.llm.common import raw

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def bpe():
    return forced_bpe.ForcedBpe(forced_bpe.content_of(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


PIECES = ["a", "b", " ", "  ", "\n", "\n\n", "'", "'s", "'re", "é", "1", "²", "!", "!'", "<|endoftext|>", "<|endof", "T", "😀", "é", "\t", "\r\n", "the",
          " the", "中", "　", "'ll", "ñ", "\x1c", "\x85", "—", "\x00", " ", "٣"]


def test_ids_equal_the_library(bpe, library):
    chance = random.Random(5)
    for _ in range(60):
        texts = ["".join(chance.choices(PIECES, k=chance.randint(0, 16))) for _ in range(60)] + [None, "", "x" * 5000]
        ids, at = bpe.encode(*raw(pa.array(texts)))
        for text, low, high in zip(texts, at[:-1], at[1:]):
            wanted = library.encode(text or "", add_special_tokens=False).ids
            assert ids[low:high].tolist() == wanted, text
            assert bpe.decode(ids[low:high]) == library.decode(wanted, skip_special_tokens=False)


def test_ids_by_ranks_equal_the_library(library):
    coder, chance = token_ids.TokenIds(token_ids.content_of(PATH)), random.Random(6)
    texts = ["".join(chance.choices(PIECES, k=chance.randint(0, 30))) for _ in range(2000)] + [None, "", "x" * 5000, "a" + " " * 400_000 + "b", " " * 5000]
    texts += ["".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)} !{chr(c)}? " for c in range(low, low + 256)) for low in range(0, 0x30000, 256)
              if not 0xD800 <= low <= 0xDFFF]
    ids, at = coder.encode(texts)
    for text, low, high in zip(texts, at[:-1], at[1:]):
        assert ids[low:high].tolist() == library.encode(text or "", add_special_tokens=False).ids, text
    with pytest.raises(ValueError):
        token_ids.TokenIds(token_ids.content_of(PATH).replace('"Ġthe":262', '"Ġthe":263').replace('"Ġc":269', '"Ġc":262'))


def test_fragments_do_not_cross_and_memory_is_bounded(library):
    small = forced_bpe.ForcedBpe(forced_bpe.content_of(PATH), kept=10)
    for text in ("one two three four five six seven eight nine ten eleven twelve", "other words here " * 30):
        ids, _ = small.encode(*raw(pa.array([text])))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    data = np.frombuffer(b"ab cd", np.uint8)
    assert small.starts(data, np.array([0, 5])).tolist() == [0, 2]


def test_encode_and_decode_frames(spark, library):
    rows = [(1, "Hello there"), (2, None), (None, "x"), (1, "Hello there"), (3, "<|endoftext|> a")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, ids int")
    encoded = forced_bpe.encode(df, PATH)
    assert sorted((r.doc_id or 0, list(r.ids)) for r in encoded.collect()) == sorted(
        (i or 0, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows)
    assert sorted(r.text for r in forced_bpe.decode(encoded, PATH).collect()) == sorted(t or "" for _, t in rows)
    assert forced_bpe.digests(df.limit(0), PATH).count() == 0


def test_permutation_is_a_bijection_that_its_inverse_undoes():
    for size in (1, 2, 3, 1000, 4097):
        order = training_order.Permutation(size, 9)
        placed = order.place(np.arange(size))
        assert sorted(placed.tolist()) == list(range(size))
        assert (order.number(placed) == np.arange(size)).all()
    assert (training_order.Permutation(1000, 1).place(np.arange(1000)) != training_order.Permutation(1000, 2).place(np.arange(1000))).any()
    with pytest.raises(ValueError):
        training_order.Permutation(0, 1)


def test_shards_hold_every_sequence_once_at_its_slot(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(training_order, "NUMBERS_PER_SHARD", 40)
    rows = [(i, f"text {i} " * (i % 60)) for i in range(80)] + [(None, "hi"), (None, None), (5, "twice"), (5, "twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "shards")
    training_order.write(df, path, PATH, 3, length=16)
    got = training_order.read(spark, path, 16).collect()
    assert sorted(r.slot for r in got) == list(range(len(got))) and len({r.shard for r in got}) > 3
    wanted = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [50256]
        wanted += [(-1 if i is None else i, k // 16, ids[k:k + 16]) for k in range(0, len(ids), 16)]
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.sequence, list(r.tokens)) for r in got) == sorted(wanted)
    known = training_order.manifest(spark, path, 16)
    for r in got[::17]:
        file, byte = training_order.locate(known, r.slot, 16)
        with open(file.removeprefix("file:"), "rb") as handle:
            handle.seek(byte + training_order.HEAD)
            assert np.frombuffer(handle.read(2 * r.n_tokens), "<u2").tolist() == list(r.tokens)
    again = str(tmp_path / "again")
    training_order.write(df.repartition(3), again, PATH, 3, length=16)
    assert sorted((r.slot, list(r.tokens)) for r in training_order.read(spark, again, 16).collect()) == sorted((r.slot, list(r.tokens)) for r in got)
    nothing = str(tmp_path / "nothing")
    training_order.write(df.limit(0), nothing, PATH, 3, length=16)
    assert training_order.read(spark, nothing, 16).count() == 0


def tasks_of(monkeypatch, frame, build):
    """The functions that ``build`` sends to tasks, as they are sent."""
    sent, whole = [], type(frame).mapInArrow
    with monkeypatch.context() as patch:
        patch.setattr(type(frame), "mapInArrow", lambda self, function, schema: sent.append(cloudpickle.dumps(function)) or whole(self, function, schema))
        build()
    return sent


def test_tasks_give_back_what_encoding_took(spark, tmp_path, monkeypatch):
    text = "some words " * 50_000
    df = spark.createDataFrame([(1, text), (None, None)], "doc_id long, text string")
    path, known = str(tmp_path / "shards"), training_order.content_of(PATH)
    encoding, = tasks_of(monkeypatch, df, lambda: training_order.write(df, path, PATH, 3, length=16))
    reading, = tasks_of(monkeypatch, df, lambda: training_order.read(spark, path, 16))
    other, = tasks_of(monkeypatch, df, lambda: common.over_batches(df, lambda piece: None, "doc_id long"))
    assert known in token_ids.LOADED and max(len(reading), len(other)) < 1 << 16  # what the driver has loaded does not go along
    before, left = pa.total_allocated_bytes(), []
    with monkeypatch.context() as patch:
        patch.setattr(common, "release", lambda: left.append(pa.total_allocated_bytes() - before))
        texts = (pa.RecordBatch.from_pydict({"doc_id": pa.array([i]), "base": pa.array([0]), "text": pa.array([text])}) for i in (1, 2))
        assert sum(made.num_rows for made in cloudpickle.loads(encoding)(texts)) > 2 * 50_000 // 16
    assert len(left) == 2 and max(left) < 400_000  # the texts, 550,000 bytes each, are gone
    for task in (reading, other):
        token_ids.loaded(known)
        assert not list(cloudpickle.loads(task)(iter([]))) and not token_ids.LOADED


def brute_repeats(rows):
    seen, made = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            if data[p:p + 100] in seen:
                gone[p:p + 100] = True
            seen.add(data[p:p + 100])
        runs = int(np.count_nonzero(np.diff(np.r_[False, gone].astype(int)) == 1))
        made.append((-1 if i is None else i, len(data), int(gone.sum()), runs, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(made)


def test_repeats_against_brute_force(spark):
    chance = random.Random(3)
    words = ["".join(chance.choices("abcdeé", k=chance.randint(1, 8))) for _ in range(200)]

    def text(n):
        return " ".join(chance.choices(words, k=n))

    shared, rows = [text(60) for _ in range(8)], []
    for i in range(150):
        parts = []
        for _ in range(chance.randint(0, 5)):
            passage = chance.choice(shared)
            low = chance.randint(0, 80)
            parts.append(passage[low:chance.randint(low, len(passage))] if chance.random() < 0.4 else text(chance.randint(0, 40)))
        rows.append((i, " ".join(parts)))
    rows += [(200 + i, rows[chance.randint(0, 149)][1]) for i in range(30)]
    rows += [(5, "x" * 500), (None, shared[0]), (None, None), (400, "ab" * 400), (401, "x" * 99), (402, "x" * 100), (7, rows[7][1]), (404, shared[1] * 20)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, pos string")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in substrings.remove_repeats(df).collect())
    assert got == brute_repeats(rows)
    assert substrings.remove_repeats(df.limit(0)).count() == 0


def test_text_joins_by_shuffle_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BROADCAST_KEYS", -1)
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{i} " * i + passage + f" end {i}" * 3) for i in range(12)]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
                 for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_repeats(rows)


def edit_distance(a, b):
    before = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return min(before)


def test_best_fit_is_exact():
    chance = random.Random(2)
    for _ in range(300):
        a, b = (bytes(chance.choices(b"abc", k=chance.randint(low, 24))) for low in (1, 0))
        assert decontaminate.best_fit(a, b)[0] == edit_distance(a, b)


def test_leaks_are_found_and_clean_texts_left(spark):
    chance = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def prose(n):
        return " ".join("".join(chance.choices(letters, k=chance.randint(2, 9))) for _ in range(n))

    items = [(i, prose(35)) for i in range(40)] + [(100, "Short one"), (101, None), (102, " !! ")]
    docs, wanted = [], set()
    for i in range(120):
        text = prose(150)
        if i % 2:
            number, item = items[i % 40]
            edited = "".join(c if chance.random() > 0.08 else chance.choice(["", c + "x", "z"]) for c in item)
            at = chance.randint(0, len(text))
            text = text[:at] + " " + edited.upper() + ", " + text[at:]
            if edit_distance(item.encode(), text.lower().encode()) <= len(item) * 0.2:
                wanted.add((i, number))
        docs.append((i, text))
    docs += [(500, None), (501, ""), (None, "xx " + items[3][1]), (502, "it is a short, ONE here")]
    leaks = decontaminate.find_leaks(spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, edits int"),
                                     spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r.doc_id, r.item_id) for r in leaks}
    assert (None, 3) in found and (502, 100) in found
    assert len(found & wanted) >= 0.93 * len(wanted)
    assert not (found - wanted - {(None, 3), (502, 100)})
    place = next(r for r in leaks if r.doc_id == 502)
    assert docs[-1][1].encode()[place.first:place.end] == b"short, ONE"
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), empty).count() == 0


def test_items_in_blocks_give_the_same(spark, monkeypatch):
    items = [(i, " ".join(f"{w}{i}" for w in ("alpha", "beta", "gamma", "delta", "epsilon"))) for i in range(9)]
    docs = spark.createDataFrame([(i, "before " + items[i % 9][1] + " after") for i in range(20)], "doc_id long, text string")
    frame = spark.createDataFrame(items, "item_id long, text string")
    once = sorted(map(tuple, decontaminate.find_leaks(docs, frame).collect()))
    monkeypatch.setattr(decontaminate, "ITEMS_PER_BLOCK", 2)
    assert sorted(map(tuple, decontaminate.find_leaks(docs, frame).collect())) == once and len(once) >= 20


def test_short_items_are_found_at_every_word_phase_and_up_to_the_limit():
    chance = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def prose(size):
        return " ".join("".join(chance.choices(letters, k=chance.randint(2, 9))) for _ in range(size))[:size].rstrip()

    def edited(text, edits):
        made = list(text)
        for at in chance.sample(range(len(made)), edits):
            made[at] = chance.choice(["", made[at] + "x", "z"])
        return "".join(made)

    for size, least in ((24, 0.9), (48, 0.9), (56, 0.9), (65, 0.9), (100, 0.93), (210, 0.93)):
        items = [prose(size + 1) for _ in range(40)]
        index = decontaminate.classes_of(list(enumerate(items)), 80)
        for edits, wanted in ((0, 1.0), (size // 10, 0.97), (size * 19 // 100, least)):
            texts = [" ".join(["word"] * (1 + phase)) + " " + edited(item, min(edits, len(item) // 5)) + " after it" for item in items for phase in range(3)]
            found = {(text, items.ids[which]) for items, finds in decontaminate.found_in(index, *raw(pa.array(texts))) for text, which, *_ in finds}
            assert sum((i, i // 3) in found for i in range(len(texts))) >= wanted * len(texts), (size, edits)


def test_bound_of_pieces_is_never_above_the_distance():
    chance = random.Random(6)
    for _ in range(100):
        a, b = (bytes(chance.choices(b"abc", k=chance.randint(1, most))) for most in (64, 90))
        masks = np.zeros((1, 256), np.uint64)
        for i, byte in enumerate(a):
            masks[0, byte] |= np.uint64(1 << i)
        made, zero = np.frombuffer(b, np.uint8), np.zeros(1, np.int64)
        assert decontaminate.least_edits(masks, zero, zero + len(a), made, zero, zero + len(b))[0] == decontaminate.best_fit(a, b)[0]


def test_short_items_are_found_whatever_word_comes_before():
    items = ["to", "cat", "to go", "cats and dogs"]
    texts = ["the to be", "can cat x", "t to", "to", "a cat", "into go", "they to go", "cot cats and dogs", "cat and cats and dogs", "tomato"]
    found = {(text, of.ids[which]) for of, finds in decontaminate.found_in(decontaminate.classes_of(list(enumerate(items)), 80), *raw(pa.array(texts)))
             for text, which, *_ in finds}
    assert found == {(i, k) for i, text in enumerate(texts) for k, item in enumerate(items) if f" {item} " in f" {text} "}


def test_many_rows_without_an_id_keep_their_order_and_their_own_cuts(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(None, f"{first} {passage}") for first in "ay"] + [(None, "z" * 100 + "own end")]
    short = spark.range(140_000).selectExpr("cast(null as long) as doc_id", "concat('b', id) as text")
    frame = short.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {bytes(r.kept).decode(): r.n_removed for r in substrings.remove_repeats(frame).filter("n_bytes >= 100").collect()}
    assert got == {rows[0][1]: 0, "y": len(passage) + 1, rows[2][1]: 0}
