import base64
import gzip
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from loanweft.llm import html_crf, toxicity, warc

PAGES = [(i, f"https://www.Site{i % 3}.example.org:443/a/?b=2&a={i % 4}#x", f"<p>page {i % 30}</p>" * (1 + i % 30)) for i in range(90)]
ODD = [(500, None, None), (501, "http://x y/\n", "a\r\n\r\nb"), (None, None, None), (None, "u", "<p>page 0</p>"), (3, PAGES[3][1], PAGES[3][2]), (502, "u", "é")]


def test_archives_are_read_back_in_order(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 7)
    rows = PAGES + ODD
    df = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, digest string").repartition(4)
    path = warc.shared_path(spark, "warc-test")
    warc.write(df, path)
    got = warc.merge_index(warc.read_runs(spark, path), per_range=20).collect()
    same = defaultdict(list)
    for i, _, html in rows:
        same[(html or "").encode()].append(i)
    wanted = Counter()
    for payload, ids in same.items():
        last = max((i for i in ids if i is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for k, i in enumerate(sorted(ids, key=lambda i: (i != last, i or 0))):
            wanted[(i, len(payload), digest, "revisit" if k else "response", last if k else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == wanted
    keys = [warc.order(tuple(r[2:])) for r in sorted(got, key=lambda r: (r.range, r.seq))]
    assert keys == sorted(keys) and len({r.range for r in got}) > 3
    row = next(r for r in got if r.page_id == 501)
    with open(f"{path.removeprefix('file:')}/{row.archive}", "rb") as file:
        file.seek(row.at)
        record = gzip.decompress(file.read(row.length))
    assert record.startswith(b"WARC/1.1\r\n") and b"\r\nWARC-Target-URI: http://x%20y/%0A\r\n" in record and record.endswith(b"a\r\n\r\nb\r\n\r\n")


def test_small_payloads_never_revisit_and_no_pages_give_no_entries(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    path = warc.shared_path(spark, "warc-test")
    warc.write(df, path, least_bytes=3)
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read_runs(spark, path).collect()) == [
        (1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)]
    assert warc.round_trip(df.limit(0)).count() == 0


def test_long_records_end_in_a_zero_byte_too():
    content = random.Random(1).randbytes(17 << 20)
    made = warc.member(content)
    assert made[-1] == 0 and gzip.decompress(made) == content


def test_loser_tree_merges_any_number_of_runs():
    chance = random.Random(3)
    for k in range(9):
        runs = [sorted((chance.randint(0, 30), i) for i in range(chance.randint(0, 12))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda v: v)) == sorted(v for run in runs for v in run)


@pytest.mark.parametrize("url,key", [("http://www.Example.com:80/A/b/?z=1&a=2#f", "com,example)/a/b?a=2&z=1"), ("https://m.x.org", "org,x,m)/"),
                                     ("", ")/"), ("http://h:8080/p", "h:8080)/p")])
def test_url_keys(url, key):
    assert warc.url_key(url) == key


def test_leaf_blocks():
    page = ("<!DOCTYPE html><head><title>no</title></head><body><nav class='main-menu'><a href='x>y'>A &amp; B</a></nav><script>var t='</p>';</script>"
            "<p>one<b> two</b><br>three<p>four&nbsp;\n five<!-- <p>no</p> --><div id=ad>six</div>tail</body>")
    blocks = html_crf.leaf_blocks(page)
    assert [b[0] for b in blocks] == ["A & B", "one two three", "four five", "six", "tail"]
    assert "has:nav" in blocks[0][1] and "mark:menu" in blocks[0][1] and blocks[0][2] > 0 and blocks[1][2] == 0
    assert "mark:ad" in blocks[3][1] and "mark:ad" not in blocks[4][1]
    for odd in ("", "<", "<p", "<!--", "<p title='x>a", "</div></p>", "a < b", "<script>x", "<" * 3000):
        html_crf.leaf_blocks(odd)


def test_viterbi_and_gradient_against_all_labelings():
    rng = np.random.default_rng(0)
    names = {f"f{i}": i for i in range(4)}
    field = html_crf.Field(names, rng.normal(size=(4, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    original = html_crf.features
    html_crf.features = lambda text, above, linked, place, count: list(above)
    try:
        blocks = [("x", tuple(f"f{i}" for i in rng.integers(0, 4, 2)), 0) for _ in range(7)]
        best = max(range(1 << 7), key=lambda code: score(field, blocks, [(code >> k) & 1 for k in range(7)]))
        assert field.labels(blocks) == [(best >> k) & 1 for k in range(7)]
    finally:
        html_crf.features = original
    assert field.labels([]) == []


def score(field, blocks, labels):
    total = field.start[labels[0]] + sum(field.move[a, b] for a, b in zip(labels, labels[1:]))
    return total + sum(field.emit[field.names[f], label] for (_, above, _), label in zip(blocks, labels) for f in above)


def test_held_out_pages_of_other_layouts(spark):
    texts = [" ".join(random.Random(k).choices("alpha beta gamma delta, epsilon. zeta eta theta".split(), k=300)) for k in range(20)]
    field = html_crf.train(html_crf.examples(html_crf.labelled_pages(texts, 300)))
    right = total = 0
    for page in html_crf.labelled_pages(texts, 150, seed=99):
        blocks = html_crf.leaf_blocks(page)
        wanted = [int(html_crf.ARTICLE in b[0]) for b in blocks]
        total += len(wanted)
        right += sum(a == b for a, b in zip(wanted, field.labels([(b[0].replace(html_crf.ARTICLE, "") or " ", *b[1:]) for b in blocks])))
    assert right / total > 0.97
    pages = [(1, "u", "<nav><a>Home</a></nav><article><h1>Title</h1><p>First  words. More &amp; more.</p><p>Second.</p></article><footer>&copy; Us</footer>"),
             (2, None, None), (None, "v", ""), (1, "w", "<footer>only</footer>")]
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in html_crf.extract(
        spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, text string"), field).collect()}
    assert got[1, "u"] == ("Title\n\nFirst words. More & more.\n\nSecond.", 41) and got[2, None] == ("", 0) and got[None, "v"] == ("", 0)
    assert len(got) == 4


def labelled_corpus(n):
    chance = random.Random(4)
    words, bad = [f"word{i}a".replace("0", "o").translate(str.maketrans("123456789", "bcdefghij")) for i in range(300)], ["vile", "awful", "nasty"]
    docs, labels = [], []
    for i in range(n):
        toxic = chance.random() < 0.2
        text = chance.choices(words, k=40)
        if toxic:
            text[chance.randrange(40)] = chance.choice(bad + [f"hate{chance.choice(words)}"]).upper()
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled_corpus(3000)
    frame = spark.createDataFrame([(i, t, "xx", "yy") for i, t in docs] + [(None, None, None, None), (9000, "", "a", "b")],
                                  "doc_id long, text string, lang string, score string")
    known = spark.createDataFrame(labels + [(None, 1, 1), (9001, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame, known)
    assert {(0, b"vile"), (4, b"hate")} <= set(model.voters)
    got = {r.doc_id: r for r in toxicity.score(frame, model).collect()}
    import zlib
    held = [(i, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i].predicted == t for i, t in held]) > 0.97
    assert got[None].predicted == 0 and got[9000].predicted == 0 and len(got) == 3002
    assert all((r.score >= 0.5) == (r.predicted == 1) and 0 <= r.score <= 1 for r in got.values())


def test_no_toxic_labels_give_no_toxic_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.predicted for r in toxicity.score(docs, model).collect()] == [0, 0]
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_label_model_finds_bad_and_correlated_voters():
    rng = np.random.default_rng(1)
    n = 4000
    truth = (rng.random(n) < 0.3).astype(int)
    good = (truth & (rng.random(n) < 0.6)).astype(float)
    copy = np.where(rng.random(n) < 0.95, good, 0.0)
    noise = (rng.random(n) < 0.2).astype(float)
    fired = np.stack([good, copy, (truth & (rng.random(n) < 0.5)).astype(float), noise], axis=1)
    annotated = np.where(rng.random(n) < 0.02, 1 - truth, truth)
    posterior, rates, cluster = toxicity.label_model(fired, annotated, 0.3)
    assert np.mean((posterior > 0.5) == truth) > 0.97
    assert rates[0, 1] > 10 * rates[0, 0] and abs(rates[3, 1] - rates[3, 0]) < 0.1
    assert cluster[0] == cluster[1] != cluster[2]


@pytest.mark.parametrize("page, wanted", [
    ("<head><meta><body><article><p>Hello</p></article>", ["Hello"]),
    ("<head><title>no</title><meta charset=x><p>a</p>", ["a"]),
    ("<html><head><script>var a = '<p>no</p>'</script><style>p{}</style></head><p>a</p>", ["a"]),
    ("<svg-icon name=x></svg-icon><p>b</p><p>c</p>", ["b", "c"]),
    ("<title-bar>t</title-bar><p>b</p>", ["t", "b"]), ("<template-x></template-x><p>b</p>", ["b"]), ("<head-line>h</head-line><p>b</p>", ["h", "b"]),
    ("<p>a<svg viewBox='0 0 1 1'/>b</p><p>c</p><svg><text>no</text></svg><p>d</p>", ["ab", "c", "d"]),
    ("<svg><p>a</p>", ["a"]), ("<template><p>a</p>", ["a"]), ("<noscript><p>a</p>", ["a"]),
    ("<noscript><p>no</p></noscript><template>no</template ><svg/><p>a</p>", ["a"]),
    ("<p>a</p><script>b<p>c</p>", ["a"]), ("<p>a</p><textarea>b</textarea x><p>c</p>", ["a", "c"]), ("<p>a</p><title>b<p>c</p>", ["a"]),
])
def test_skipped_elements_end_where_they_should(page, wanted):
    assert [block[0] for block in html_crf.leaf_blocks(page)] == wanted


def test_many_open_hidden_elements_take_no_longer():
    assert len(html_crf.leaf_blocks("<svg><template><p>a</p>" * 50_000)) == 50_000


@pytest.mark.parametrize("comment", ["<!-->", "<!--->", "<!-- x --!>", "<!-- a > b -->", "<!---->"])
def test_comments_end_as_in_browsers(comment):
    blocks = html_crf.leaf_blocks(f"<p>a</p>{comment}<p>b</p><iframe><p>no</p></iframe><p>c</p>")
    assert [text for text, *_ in blocks] == ["a", "b", "c"]


def test_one_response_for_rows_of_one_page_in_many_partitions(spark, tmp_path):
    rows = [(3, "u", "same")] * 4 + [(3, "t", "same"), (2, "u", "same"), (None, "n", "none"), (None, "n", "none"), (4, "u", "own"), (3, None, "other"), (3, "x", "other")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(7)
    warc.write(df, str(tmp_path / "w"))
    got = warc.read_runs(spark, str(tmp_path / "w")).select("page_id", "payload_digest", "record_type", "refers_to").collect()
    assert len(got) == len(rows)
    for digest in {r.payload_digest for r in got}:
        mine = [r for r in got if r.payload_digest == digest]
        answers = [r for r in mine if r.record_type == "response"]
        assert len(answers) == 1 and answers[0].page_id == max((r.page_id for r in mine if r.page_id is not None), default=None)
        assert all(r.refers_to == answers[0].page_id for r in mine if r.record_type == "revisit")
