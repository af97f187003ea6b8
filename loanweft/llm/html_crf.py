"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks, the texts between the tags that start or end a
block. Features of a block are its ancestors' tags and class, id and role words
and figures of its text. The field labels the blocks of a page in order as
article or other; it is trained by gradient ascent on the exact likelihood
(forward-backward) of labelled pages and decoded by Viterbi.

Labelled pages: ``labelled_pages`` lays out texts in pages of many kinds, with
and without telling tags, so every block's label is known. The texts come from
a bounded sample of the given pages, so that words and lengths are those of the
corpus. Training is on that fixed number of pages, whatever the corpus.
"""

from __future__ import annotations

import html as markup
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweft.llm.common import over_batches, pick

TRAINING_PAGES = 500
SAMPLED_PAGES = 200  # whose texts fill the training pages
STEPS = 150
TOGETHER = 2

BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html iframe input legend li main menu nav ol optgroup option p pre search section select summary table
tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSED_BY = {"p": BLOCK_TAGS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
             "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}}
TOKEN = re.compile(
    r"""<!--(?:>|->|.*?--!?>|.*)|<(script|style|title|textarea|iframe|noframes)(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>(?:.*?</\1(?=[\s/>])[^>]*>|.*)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)[^>]*>|<[!?/][^>]*>""", re.S | re.I)
HIDDEN = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in ("noscript", "template", "svg")}  # skipped up to their end tags, if there are any
MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+|[0-9]+")
ENDS = (".", "!", "?", "…", ":", "”", '"', "。")


def ancestry(stack: list[tuple[str, tuple[str, ...]]]) -> tuple[str, ...]:
    found = {f"has:{tag}" for tag, _ in stack} | {f"mark:{m}" for _, marks in stack for m in marks}
    if stack:
        found.add(f"in:{stack[-1][0]}")
        found.update(f"own:{m}" for m in stack[-1][1])
    return tuple(sorted(found - {"has:html", "has:body"}))


def leaf_blocks(page: str) -> list[tuple[str, tuple[str, ...], int]]:
    """(text, features of its ancestors, linked characters) of the leaf blocks with text, in order.

    Character references are decoded and white space becomes single blanks; a
    line break counts as white space. Contents of scripts, styles and the like
    are no text. Missing end tags and stray ones are passed over as browsers do:
    to the end of the page goes only what follows an open script, style, title,
    textarea, iframe or noframes. Comments end as in browsers, ``<!-->`` and
    ``--!>`` included.
    """
    made: list[tuple[str, tuple[str, ...], int]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    state = [0, 0, ()]  # open links, linked characters, features of the ancestors

    def flush() -> None:
        if parts:
            text = " ".join(" ".join(markup.unescape(part) if "&" in part else part for part in ["".join(parts)]).split())
            if text:
                made.append((text, state[2], state[1]))
            parts.clear()
        state[1] = 0

    at = 0
    endless: set[str] = set()  # names of hidden elements without a further end tag
    while found := TOKEN.search(page, at):
        if found.start() > at:
            piece = page[at:found.start()]
            parts.append(piece)
            if state[0]:
                state[1] += len(piece)
        at = found.end()
        tag = (found[3] or found[6] or "").lower()
        if not tag:
            continue
        closing = bool(found[2] or found[5])
        if tag in HIDDEN:
            if not closing and tag not in endless and not (tag == "svg" and found[0].endswith("/>")):
                if end := HIDDEN[tag].search(page, at):
                    at = end.end()
                else:
                    endless.add(tag)
            continue
        if tag == "a":
            state[0] = 0 if closing else 1
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCK_TAGS:
            flush()
            if closing:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == tag:
                        del stack[depth:]
                        break
            else:
                while stack and tag in CLOSED_BY.get(stack[-1][0], ()):
                    stack.pop()
                if tag not in VOID:
                    text = found[4] or ""
                    marks = tuple(w for m in MARKS.finditer(text) for w in WORDS.findall((m[1] or m[2] or m[3] or "").lower())) if "=" in text else ()
                    stack.append((tag, marks))
            state[2] = ancestry(stack)
    if at < len(page):
        parts.append(page[at:])
    flush()
    return made


def features(text: str, above: tuple[str, ...], linked: int, place: int, count: int) -> list[str]:
    words = text.count(" ") + 1
    made = ["always", f"words:{min(8, words.bit_length())}", f"links:{min(4, 4 * linked // max(1, len(text)))}", f"at:{4 * place // count}"]
    if text.endswith(ENDS):
        made.append("ends")
    if text[0] == "©" or "©" in text[:200]:
        made.append("copyright")
    if words > 12 and any(mark in text for mark in (". ", "! ", "? ")):
        made.append("sentences")
    made += above
    return made


class Field:
    """Weights of the chain: ``emit`` (feature, label), ``move`` (label, label), ``start`` (label); label 1 is the article."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.names, self.emit, self.move, self.start = names, emit, move, start
        self.gain = {name: (emit[i, 1] - emit[i, 0]) for name, i in names.items()}

    def labels(self, blocks: list[tuple[str, tuple[str, ...], int]]) -> list[int]:
        """The most likely labels of a page's blocks (Viterbi)."""
        get = self.gain.get
        scores = [sum(get(f, 0.0) for f in features(*block, i, len(blocks))) for i, block in enumerate(blocks)]
        if not scores:
            return []
        (a, b), (c, d) = self.move.tolist()
        other, article = self.start[0], self.start[1] + scores[0]
        back = []
        for score in scores[1:]:
            to_other, to_article = (other + a, article + c), (other + b, article + d)
            back.append((int(to_other[1] > to_other[0]), int(to_article[1] > to_article[0])))
            other, article = max(to_other), max(to_article) + score
        label = int(article > other)
        found = [label]
        for step in reversed(back):
            label = step[label]
            found.append(label)
        return found[::-1]

    def main_text(self, page: str) -> str:
        blocks = leaf_blocks(page)
        return "\n\n".join(block[0] for block, label in zip(blocks, self.labels(blocks)) if label)


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return (most + np.log(np.exp(x - most).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(pages: list[tuple[list[list[str]], list[int]]], steps: int = STEPS, penalty: float = 0.02) -> Field:
    """The field of (features of each block, labels) of pages, by Adam on the penalized likelihood."""
    pages = [(blocks, labels) for blocks, labels in pages if blocks]
    names: dict[str, int] = {}
    for blocks, _ in pages:
        for block in blocks:
            for name in block:
                names.setdefault(name, len(names))
    n, most, wide = len(pages), max(len(b) for b, _ in pages), max(len(f) for b, _ in pages for f in b)
    index = np.full((n, most, wide), len(names))  # the last weight stays zero
    gold, length = np.zeros((n, most), np.int64), np.array([len(b) for b, _ in pages])
    for i, (blocks, labels) in enumerate(pages):
        gold[i, :len(labels)] = labels
        for j, block in enumerate(blocks):
            index[i, j, :len(block)] = [names[f] for f in block]
    there = np.arange(most) < length[:, None]
    sizes = [(len(names) + 1) * 2, 4, 2]
    weights = np.zeros(sum(sizes))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    rows = np.arange(n)
    for step in range(1, steps + 1):
        emit, move, start = (part.reshape(shape) for part, shape in zip(np.split(weights, np.cumsum(sizes)[:-1]), ((-1, 2), (2, 2), (2,))))
        score = emit[index].sum(axis=2)
        forward, backward = np.zeros((n, most, 2)), np.zeros((n, most, 2))
        forward[:, 0] = score[:, 0] + start
        for j in range(1, most):
            forward[:, j] = np.where(there[:, j, None], log_sum(forward[:, j - 1, :, None] + move, 1) + score[:, j], forward[:, j - 1])
        for j in range(most - 2, -1, -1):
            backward[:, j] = np.where(there[:, j + 1, None], log_sum(move + (score[:, j + 1] + backward[:, j + 1])[:, None, :], 2), 0.0)
        total = log_sum(forward[:, -1], 1)
        single = np.exp(forward + backward - total[:, None, None]) * there[:, :, None]
        both = np.exp(forward[:, :-1, :, None] + move + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]) * there[:, 1:, None, None]
        error = -single
        np.put_along_axis(error, gold[:, :, None], np.take_along_axis(error, gold[:, :, None], 2) + there[:, :, None], 2)
        of_emit = np.stack([np.bincount(index.ravel(), np.repeat(error[:, :, k].ravel(), wide), len(names) + 1) for k in (0, 1)], axis=1)
        of_move = -both.sum(axis=(0, 1))
        np.add.at(of_move, (gold[:, :-1][there[:, 1:]], gold[:, 1:][there[:, 1:]]), 1)
        of_start = -single[:, 0].sum(axis=0)
        np.add.at(of_start, gold[rows, 0], 1)
        gradient = np.concatenate([of_emit.ravel(), of_move.ravel(), of_start]) / n - penalty * weights / 10
        gradient[2 * len(names):2 * len(names) + 2] = 0
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient ** 2
        weights = weights + 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    emit, move, start = np.split(weights, np.cumsum(sizes)[:-1])
    return Field(names, emit.reshape(-1, 2)[:-1], move.reshape(2, 2), start)


ARTICLE = "\ue000"  # marks a block of the article in a training page; a private character that texts are cleared of
# How sites usually name their parts.
NAMES = {
    "article": ["content", "main content", "post", "post body", "entry content", "article body", "story", "text", "page content"],
    "menu": ["nav", "menu", "navbar", "main menu", "breadcrumb", "toc", "pagination"],
    "header": ["header", "site header", "masthead", "top bar", "banner", "branding"],
    "footer": ["footer", "site footer", "bottom", "copyright", "legal"],
    "sidebar": ["sidebar", "aside", "widget", "related posts", "popular", "recent", "tags"],
    "advert": ["ad", "ads", "advert", "sponsored", "promo", "banner ad"],
    "notice": ["cookie notice", "notice", "alert", "consent", "newsletter", "subscribe", "share buttons", "social"],
    "comments": ["comments", "comment list", "reader comments", "comment body", "replies", "discussion"],
}
TELLING = {"article": "article", "menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside"}


def labelled_pages(texts: list[str], count: int, seed: int = 7) -> list[str]:
    """Pages of many layouts, filled with pieces of ``texts``; blocks of the article start with ``ARTICLE``."""
    chance = random.Random(seed)
    words = [w for text in texts for w in text.replace(ARTICLE, "").split()] or ["word"]

    def some(low: int, high: int, end: str = "") -> str:
        size = chance.randint(low, high)
        at = chance.randrange(max(1, len(words) - size))
        return markup.escape(" ".join(words[at:at + size])) + end

    def part(kind: str, inner: str) -> str:
        named = chance.choice(NAMES[kind]).replace(" ", chance.choice("-_ "))
        telling = TELLING.get(kind)
        if telling and chance.random() < 0.6:
            return f"<{telling}{chance.choice(['', f' class={named!r}'])}>{inner}</{telling}>"
        mark = chance.choice(["class", "class", "id"])
        tag = chance.choice(["div", "div", "section"])
        return f'<{tag} {mark}="{named}">{inner}</{tag}>' if chance.random() < 0.95 else f"<{tag}>{inner}</{tag}>"

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{some(1, 3)}</a></li>' for i in range(n)) + "</ul>"

    def paragraphs(n: int, mark: str, low: int = 3, high: int = 90) -> str:
        made = []
        for _ in range(n):
            style = chance.random()
            body = some(1, 6) if style < 0.15 else some(low, high, chance.choice([".", ".", ""]))
            made.append(f"<p><b>{mark}{body}<br>" if style > 0.85 else f"<p>{mark}{body}</p>")
        return "".join(made)

    def article() -> str:
        head = f"<h1>{ARTICLE}{some(1, 12)}</h1>" if chance.random() < 0.9 else ""
        body = paragraphs(chance.choice([1, 1, 2, 3, 5, 8, 12, 18]), ARTICLE)
        for extra in (f"<h2>{ARTICLE}{some(1, 6)}</h2>", f"<ul><li>{ARTICLE}{some(3, 20)}</li><li>{ARTICLE}{some(3, 20)}</li></ul>",
                      f"<blockquote>{ARTICLE}{some(8, 40)}</blockquote>", f"<pre>{ARTICLE}{some(5, 30)}</pre>",
                      f"<table><tr><td>{ARTICLE}{some(1, 5)}</td><td>{ARTICLE}{some(1, 5)}</td></tr></table>"):
            if chance.random() < 0.15:
                body += extra + paragraphs(1, ARTICLE)
        if chance.random() < 0.15:
            body += part("advert", some(3, 20)) + paragraphs(1, ARTICLE)
        return part("article", head + body) if chance.random() < 0.85 else f"<article>{head}{body}</article>"

    def page() -> str:
        before = [part("header", f"<a href='/'>{some(1, 3)}</a>" + (f"<p>{some(2, 8)}</p>" if chance.random() < 0.4 else "")),
                  part("menu", links(chance.randint(2, 9))), part("advert", f"{some(3, 25, '.')}"), part("notice", f"<p>{some(5, 30, '.')}</p><button>{some(1, 2)}</button>"),
                  f"<form>{some(1, 3)}<input name=q><select><option>{some(1, 2)}<option>{some(1, 2)}</select><button>{some(1, 2)}</button></form>"]
        after = [part("sidebar", f"<h3>{some(1, 3)}</h3>" + links(chance.randint(1, 6)) + (f"<p>{some(5, 30, '.')}</p>" if chance.random() < 0.4 else "")),
                 part("comments", f"<h3>{some(1, 2)}</h3>" + "".join(
                     f"<div class='comment'><b>{some(1, 2)}</b><p>{some(4, 50, '.')}</p></div>" for _ in range(chance.randint(1, 5)))),
                 part("advert", some(3, 25, ".")), part("notice", f"<p>{some(5, 30, '.')}</p>")]
        first = [x for x in before if chance.random() < 0.5]
        last = [x for x in after if chance.random() < 0.4]
        foot = part("footer", chance.choice(["&copy; ", "", "&copy; 2024 "]) + some(2, 25, chance.choice([".", ""]))) if chance.random() < 0.85 else ""
        chance.shuffle(first)
        return ("<!DOCTYPE html><html><head><title>" + some(1, 8) + "</title><style>p{margin:0}</style></head><body>" + "".join(first) + "<!-- x -->"
                + article() + "".join(last) + foot + "</body></html>")

    return [page() for _ in range(count)]


def examples(pages: list[str]) -> list[tuple[list[list[str]], list[int]]]:
    made = []
    for page in pages:
        blocks = leaf_blocks(page)
        labels = [int(ARTICLE in text) for text, _, _ in blocks]
        clean = [(text.replace(ARTICLE, "") or " ", above, linked) for text, above, linked in blocks]
        made.append(([features(*block, i, len(clean)) for i, block in enumerate(clean)], labels))
    return made


def fit(pages: DataFrame, count: int = TRAINING_PAGES, sample: int = SAMPLED_PAGES) -> Field:
    """A field trained on ``count`` labelled pages that hold texts of at most ``sample`` pages (those with the smallest hashes)."""
    rows = pick(pages, page_id="bigint", html="string").filter("html is not null")
    chosen = rows.select(F.xxhash64("page_id", "html").alias("h")).orderBy("h").limit(sample)
    taken = rows.join(F.broadcast(chosen), F.xxhash64("page_id", "html") == F.col("h"), "left_semi").limit(sample).select("page_id", "html")

    def words(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = [" ".join(block[0] for block in leaf_blocks(page)) for page in piece.column(1).to_pylist()]
        return pa.RecordBatch.from_pydict({"page_id": piece.column(0), "text": pa.array([" ".join(t.split()[:2_000]) for t in texts], pa.string())})

    texts = sorted(row.text for row in over_batches(taken, words, "page_id bigint, text string", TOGETHER, ["html"]).collect())
    return train(examples(labelled_pages(texts, count)))


def extract(pages: DataFrame, field: Field) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of (page_id, url, html); blocks of the text are set apart by an empty line.

    A null or empty page, or one without an article block, has the text "".
    Null and repeated ids stay, one row each; other columns are left out.
    """

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = [field.main_text(page or "") for page in piece.column(2).to_pylist()]
        return pa.RecordBatch.from_pydict({"page_id": piece.column(0), "url": piece.column(1), "text": pa.array(texts, pa.string()),
                                           "n_chars": pa.array(map(len, texts), pa.int64())})

    return over_batches(pick(pages, page_id="bigint", url="string", html="string"), run, "page_id bigint, url string, text string, n_chars bigint",
                        TOGETHER, ["html"])
