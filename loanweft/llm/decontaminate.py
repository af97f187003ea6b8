"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts and items are compared in a plain form: A-Z lower-cased, everything but
letters, digits and bytes from 0x80 on turned into single blanks. The CGK
embedding reads a string by a random walk: step j puts out the current byte and
moves on or not, as a random bit of (j, byte) says. Two strings with few edits
then differ in few places, as walks that an edit drives apart soon meet again;
edit distance becomes Hamming distance, and a hash of a few sampled places of
the output (bit sampling) agrees with fair probability. Several walks with
several samples each raise it to the recall wanted.

Windows are sized so that every item holds some: a window is what a number of
steps read, about half as many bytes; shorter items have shorter walks of their
own, more of them and fewer sampled places (``CLASSES``). No walk has more
steps than the items of its class have bytes, so an unchanged copy that begins
with a word is always a candidate. Windows start at every word of an item and of
a text. Where a table agrees, the window is extended to the item's size, and the
exact edit distance between the item and the best-fitting part of that stretch
decides. Before, the item's pieces of 64 bytes are fitted one by one for many
stretches at once: their least edits add up to no more than the item's, so a
stretch whose sum is above what is allowed can be dropped.

Items below ``LEAST_ITEM`` bytes, where no edit is allowed, are compared at each
word that begins like them.

A block of items is an index small enough for every task; a larger benchmark is
searched for in several blocks. Texts are read in one pass per block and never
shuffled; what leaves a task are its finds.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweft.llm.common import LOWER, MIX, mixed, over_batches, pick, raw

# least bytes of an item, steps, places of the walk's output in a table's key (or all of a shorter one), walks, tables per walk
CLASSES = ((200, 32, 14, 3, 2), (80, 24, 10, 3, 2), (48, 20, 10, 4, 2), (24, 14, 8, 7, 2), (14, 14, 14, 1, 1), (6, 6, 6, 1, 1), (3, 3, 3, 1, 1), (1, 1, 1, 1, 1))
MOST_STEPS = max(steps for _, steps, *_ in CLASSES)
Shape = tuple[int, int, int, int]
PERCENT = 80  # similarity: 1 - edits / length of the item
LEAST_ITEM = 24  # bytes in plain form; shorter items must occur unchanged, from word to word
ITEMS_PER_BLOCK = 5_000
TOGETHER = 2
AT_ONCE = 8_192  # windows whose walks are followed together, few enough for a core's cache
SIEVE = 1 << 18  # low bits of keys that a table notes, so that most windows need no search
STRETCHES = 4_096  # whose pieces are fitted together
PIECE = 64  # bytes, one for each bit of a machine word
WORDLIKE = np.zeros(256, bool)
WORDLIKE[[*range(97, 123), *range(48, 58), *range(128, 256)]] = True


@functools.lru_cache(maxsize=64)
def moves_of(walk: int) -> np.ndarray:
    """Move bits [step, byte] of a walk, the same for items of all lengths. Fixed by their seed, so all tasks agree."""
    return np.random.default_rng((20240601, walk)).integers(0, 2, (MOST_STEPS, 256))


@functools.lru_cache(maxsize=256)
def sampled_steps(steps: int, sampled: int, walk: int, table: int) -> frozenset[int]:
    chance = np.random.default_rng((20240602, steps, sampled, walk, table))
    return frozenset(chance.choice(steps, min(steps, sampled), replace=False).tolist())


def embed(data: np.ndarray, starts: np.ndarray, shapes: Sequence[Shape]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per shape the keys (table, start) of the windows of ``data`` at ``starts``, and how far the farthest walk went.

    Shapes share their walks: a shorter one reads the beginning of a longer one.
    """
    padded = np.r_[data, np.zeros(MOST_STEPS + 1, np.uint8)].astype(np.int64)  # one type throughout, so that no step converts
    multiplier = MIX.astype(np.int64)
    made = [(np.empty((count * tables, len(starts)), np.uint64), np.zeros(len(starts), np.int64)) for _, _, count, tables in shapes]
    for low in range(0, len(starts), AT_ONCE):
        own = slice(low, low + AT_ONCE)
        for walk in range(max(count for _, _, count, _ in shapes)):
            at, moves = starts[own].astype(np.int64), moves_of(walk)
            open_ = [(number, shape, [(np.full(len(at), walk * shape[3] + t + 1, np.int64), sampled_steps(*shape[:2], walk, t)) for t in range(shape[3])])
                     for number, shape in enumerate(shapes) if walk < shape[2]]
            for step in range(max(shape[0] for _, shape, _ in open_)):
                byte = padded.take(at)
                for _, shape, sums in open_:
                    for total, chosen in sums:
                        if step in chosen:
                            np.multiply(total, multiplier, out=total)
                            np.add(total, byte, out=total)
                at += moves[step].take(byte)
                for number, shape, sums in open_:
                    if step == shape[0] - 1:
                        keys, farthest = made[number]
                        for table, (total, _) in enumerate(sums):
                            keys[walk * shape[3] + table, own] = mixed(total.view(np.uint64))
                        farthest[own] = np.maximum(farthest[own], at)
    return made


def plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Plain form of texts: its bytes, the texts' offsets in it (each text ends with a blank), and each byte's place in ``data``."""
    low = LOWER[data]
    word = WORDLIKE[low]
    last = np.zeros(len(data) + 1, bool)
    last[offsets[1:]] = True  # the first byte of the next text
    keep = word | (np.r_[False, word[:-1]] & ~last[:-1])
    place = np.flatnonzero(keep)
    made = np.where(word, low, 32).astype(np.uint8)[place]
    return made, np.searchsorted(place, offsets), place


def word_starts(made: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    first = np.zeros(len(made) + 1, bool)
    first[offsets] = True
    return np.flatnonzero((made != 32) & (np.r_[True, made[:-1] == 32] | first[:-1]))


class Items:
    """Items of one class of lengths (``least`` up to below ``most`` bytes) and the hash tables of their windows."""

    def __init__(self, rows: list[tuple[int, str]], percent: int, least: int, most: int, *shape: int):
        self.percent, self.shape = percent, shape
        self.ids, self.texts, keys, owner, offset = [], [], [], [], []
        for item_id, text in rows:
            data = np.frombuffer((text or "").encode(), np.uint8)
            made, _, _ = plain(data, np.array([0, len(data)]))
            made = made[:-1] if len(made) and made[-1] == 32 else made
            if not least <= len(made) < most:
                continue
            number = len(self.ids)
            self.ids.append(item_id)
            self.texts.append(made.tobytes())
            starts = word_starts(made, np.array([0, len(made)]))
            starts = starts if self.allowed(number) else starts[:1]
            (found, end), = embed(made, starts, [shape])
            inside = end <= len(made)
            keys.append(found[:, inside])
            owner.append(np.full(inside.sum(), number))
            offset.append(starts[inside])
        _, _, count, tables = shape
        every = np.concatenate(keys, axis=1) if keys else np.zeros((count * tables, 0), np.uint64)
        self.owner, self.offset = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owner, offset))
        self.order = np.argsort(every, axis=1, kind="stable")
        self.keys = np.take_along_axis(every, self.order, axis=1)
        self.there = np.zeros((count * tables, SIEVE), bool)
        for table in range(count * tables):
            self.there[table, (self.keys[table] & np.uint64(SIEVE - 1)).astype(np.int64)] = True
        self.lengths = np.array([len(text) for text in self.texts], np.int64)
        self.first, self.bytes = np.cumsum(self.lengths) - self.lengths, np.frombuffer(b"".join(self.texts), np.uint8)
        self.edits = np.array([self.allowed(number) for number in range(len(self.ids))], np.int64)

    def candidates(self, found: np.ndarray, starts: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place where an item would start, item), each once, for windows of keys ``found`` that start in the texts ``text``."""
        window, entries = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for table in range(len(found)):
            maybe = np.flatnonzero(self.there[table].take((found[table] & np.uint64(SIEVE - 1)).astype(np.int64)))
            key = found[table][maybe]
            low, high = (np.searchsorted(self.keys[table], key, side) for side in ("left", "right"))
            count = high - low
            entries.append(self.order[table][np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())])
            window.append(np.repeat(maybe, count))
        window, entries = np.concatenate(window), np.concatenate(entries)
        of, begin, item = text[window], starts[window] - self.offset[entries], self.owner[entries]
        order = np.lexsort((begin, item, of))
        of, begin, item = of[order], begin[order], item[order]
        once = np.ones(len(of), bool)
        once[1:] = (of[1:] != of[:-1]) | (item[1:] != item[:-1]) | (begin[1:] != begin[:-1])
        return of[once], begin[once], item[once]

    def allowed(self, item: int) -> int:
        return len(self.texts[item]) * (100 - self.percent) // 100 if len(self.texts[item]) >= LEAST_ITEM else 0


def classes_of(rows: list[tuple[int, str]], percent: int) -> list[Items]:
    """A block's items by length, classes without items left out."""
    bounds = [1 << 60, *[least for least, *_ in CLASSES]]
    made = [Items(rows, percent, least, most, *shape) for most, (least, *shape) in zip(bounds, CLASSES)]
    return [items for items in made if items.ids]


def best_fit(pattern: bytes, text: bytes) -> tuple[int, int]:
    """Least edit distance between ``pattern`` and any part of ``text``, and where that part ends (bit-parallel, exact)."""
    m = len(pattern)
    masks: dict[int, int] = {}
    for i, byte in enumerate(pattern):
        masks[byte] = masks.get(byte, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for place, byte in enumerate(text, 1):
        equal = masks.get(byte, 0)
        across = equal | down
        diagonal = (((equal & up) + up) ^ up) | equal
        rise = down | (full & ~(diagonal | up))
        fall = up & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up = fall | (full & ~(across | rise))
        down = rise & across
        if score < best:
            best, end = score, place
    return best, end


def least_edits(masks: np.ndarray, row: np.ndarray, length: np.ndarray, made: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A bound from below of ``best_fit`` for pieces of at most 64 bytes (rows of ``masks``), each in ``made[low:high]``."""
    one = np.uint64(1)
    up, down, top = np.full(len(row), ~np.uint64(0)), np.zeros(len(row), np.uint64), (length - 1).astype(np.uint64)
    score, best, table, first = length.copy(), length.copy(), masks.reshape(-1), row * 256
    for step in range(int((high - low).max(initial=0))):
        place = low + step
        byte = np.where(place < high, made.take(place, mode="clip"), 0)  # 0 is in no piece
        equal = table.take(first + byte)
        across = equal | down
        diagonal = (((equal & up) + up) ^ up) | equal
        rise, fall = down | ~(diagonal | up), up & diagonal
        score += (rise >> top & one).astype(np.int64) - (fall >> top & one).astype(np.int64)
        rise, fall = rise << one, fall << one
        up, down = fall | ~(across | rise), rise & across
        np.minimum(best, score, out=best)
    return best


def plausible(items: Items, made: np.ndarray, begin: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Which candidates can be within their item's allowed edits: those whose pieces together need no more.

    Between the window that agreed and a piece lie at most the allowed edits, so
    the piece is no farther than that from its place (and the eight bytes that
    one candidate stands for).
    """
    spent, open_ = np.zeros(len(item), np.int64), np.arange(len(item))
    most = items.edits[item]
    for start in range(0, int(items.lengths.max(initial=0)), PIECE):
        open_ = open_[(spent[open_] <= most[open_]) & (items.lengths[item[open_]] > start) & (most[open_] > 0)]
        for at in range(0, len(open_), STRETCHES):
            own = open_[at:at + STRETCHES]
            which, row = np.unique(item[own], return_inverse=True)
            masks = np.zeros((len(which), 256), np.uint64)
            of, bit = np.nonzero(start + np.arange(PIECE) < items.lengths[which][:, None])
            np.bitwise_or.at(masks, (of, items.bytes[items.first[which[of]] + start + bit]), np.uint64(1) << bit.astype(np.uint64))
            length, slack = np.minimum(items.lengths[item[own]] - start, PIECE), most[own] + 8
            spent[own] += least_edits(masks, row, length, made, np.maximum(low[own], begin[own] + start - slack),
                                      np.minimum(high[own], begin[own] + start + length + slack))
    return spent <= most


Find = tuple[int, int, int, int, int]


def found_in(index: Sequence[Items], data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[Items, list[Find]]]:
    """For the items of each class (text, item, first byte, end byte in the text, edits) of every one found in the texts; of each pair the best place."""
    made, at, place = plain(data, offsets)
    starts = word_starts(made, at)
    if not len(starts) or not index:
        return
    text = np.searchsorted(at, starts, "right") - 1
    for items, (keys, _) in zip(index, embed(made, starts, [items.shape for items in index])):
        yield items, verified(items, made, at, place, offsets, *items.candidates(keys, starts, text))


def verified(items: Items, made: np.ndarray, at: np.ndarray, place: np.ndarray, offsets: np.ndarray, of: np.ndarray, begin: np.ndarray,
             item: np.ndarray) -> list[Find]:
    """The candidates (text ``of``, place ``begin``, ``item``) that the exact edit distance confirms."""
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    content, allowed = made.tobytes(), items.edits[item]
    # one of the places in eight bytes, as the stretch searched for it is wider by eight bytes on either side; each where no edit is allowed
    bucket = np.where(allowed > 0, begin >> 3, begin)
    first = np.ones(len(of), bool)
    first[1:] = (of[1:] != of[:-1]) | (item[1:] != item[:-1]) | (bucket[1:] != bucket[:-1])
    of, begin, item, allowed = of[first], begin[first], item[first], allowed[first]
    end = begin + items.lengths[item]  # an item without edits begins and ends with a word of its text
    apart = np.r_[made == 32, True]
    whole = (begin >= at[of]) & (end <= at[of + 1]) & ((begin == at[of]) | apart.take(begin - 1, mode="clip")) & ((end == at[of + 1]) | apart.take(end, mode="clip"))
    inside = (allowed > 0) | whole
    of, begin, item, allowed = of[inside], begin[inside], item[inside], allowed[inside]
    low, high = np.maximum(at[of], begin - allowed - 8), np.minimum(at[of + 1], begin + items.lengths[item] + allowed + 8)
    stays = plausible(items, made, begin, low, high, item)
    for text, which, where, a, b in zip(*(x[stays].tolist() for x in (of, item, begin, low, high))):
        pattern, most = items.texts[which], items.allowed(which)
        known = best.get((text, which))
        if known and known[0] == 0:
            continue
        if most:
            edits, end = best_fit(pattern, content[a:b])
        else:
            edits, end = int(content[where:where + len(pattern)] != pattern), where + len(pattern) - a
        if edits <= most and (not known or edits < known[0]):
            best[text, which] = edits, a + end - len(pattern), a + end
    return [(text, which, int(place[max(a, int(at[text]))] - offsets[text]), int(place[b - 1] + 1 - offsets[text]), edits)
            for (text, which), (edits, a, b) in sorted(best.items()) if b > a and b <= len(place)]


def indexes(benchmark: DataFrame, percent: int) -> Iterator[list[Items]]:
    """The index of each block of the items (item_id, text)."""
    items = pick(benchmark, item_id="bigint", text="string").filter("text is not null")
    blocks = max(1, -(-items.count() // ITEMS_PER_BLOCK))
    for block in range(blocks):
        own = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield classes_of([tuple(row) for row in own.orderBy("item_id", "text").collect()], percent)


def without_items(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` in whose text no item occurs, as ``find_leaks`` has it; each row is judged by itself, whatever its id."""
    place = docs.columns.index("text")
    for index in indexes(benchmark, percent):

        def keep(piece: pa.RecordBatch, index: list[Items] = index) -> pa.RecordBatch:
            data, offsets = raw(piece.column(place))
            stays = np.ones(piece.num_rows, bool)
            for _, finds in found_in(index, data, offsets):
                stays[[text for text, *_ in finds]] = False
            return piece.filter(pa.array(stays))

        docs = over_batches(docs, keep, docs.schema, TOGETHER)
    return docs


def find_leaks(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, first, end, edits): the items (item_id, text) that occur in the texts (doc_id, text).

    An item occurs if some part of a text has an edit distance of at most
    ``100 - percent`` per cent of the item's length in plain form; below
    ``LEAST_ITEM`` bytes it must occur unchanged. first and end are the byte
    range in the text (UTF-8), first up to that many bytes off where edits
    changed the length. Every pair comes once, with its best place. Null or
    blank texts and items occur nowhere; null and repeated ids are searched
    like others; an empty table on either side gives no rows. Other columns
    are left out.
    """
    docs = pick(docs, doc_id="bigint", text="string")
    found = None
    for index in indexes(benchmark, percent):

        def run(piece: pa.RecordBatch, index: list[Items] = index) -> pa.RecordBatch:
            data, offsets = raw(piece.column(1))
            rows = [(text, items.ids[item], *rest) for items, finds in found_in(index, data, offsets) for text, item, *rest in finds]
            ids = piece.column(0).to_pylist()
            return pa.RecordBatch.from_pydict({
                "doc_id": pa.array([ids[r[0]] for r in rows], pa.int64()), "item_id": pa.array([r[1] for r in rows], pa.int64()),
                "first": pa.array([r[2] for r in rows], pa.int64()), "end": pa.array([r[3] for r in rows], pa.int64()),
                "edits": pa.array([r[4] for r in rows], pa.int32())})

        part = over_batches(docs, run, "doc_id bigint, item_id bigint, first bigint, end bigint, edits int", TOGETHER)
        found = part if found is None else found.unionByName(part)
    return found
