"""Removal of repeated substrings by distributed prefix doubling over synchronized positions.

A byte is removed if it lies in a stretch of ``LENGTH`` bytes that also starts
earlier: in a text of smaller id, or further ahead in the same one. Suffixes of
all byte positions would be many times the corpus, so the suffix array is kept
sparse: of every stretch the position of its smallest ``GRAM``-byte hash (the
leftmost on a tie) is the anchor. Equal stretches have their anchors at equal
places, so all stretches with one anchor form a cell of start positions that
can be compared as a whole.

Each round sorts (rank, position) pairs, rank standing for the content that all
stretches of a cell share:

* a cell whose rank is unique holds no repeated stretch and is dropped;
* a cell whose whole content occurred earlier is repeated throughout;
* the others are cut into smaller cells. What the stretches of a smaller cell
  share is longer: 24, 93, then 100 bytes, where the threshold is reached.

So ranks grow until they are unique or past the threshold, and only where a
repeated passage begins or ends a few cells reach the last round.

Equal contents are found by 64-bit hashes of the shared and of the whole
content together. Before the shuffle of a round each task keeps, of equal
cells, the first; later ones are known to be repeated and go to a random
partition. A passage that occurs in a third of all texts so sends one pair per
task. Texts travel only when few cells need them (see ``join_by_key``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweft.llm.common import materialize, mixed, over_batches, parts_of, pick, polynomial, raw, release, slices

LENGTH = 100
GRAM = 24
CELL = 8  # start positions in a cell of the second round
TOGETHER = 0.25  # MB: a text's arrays take some 150 bytes for each of its own
BROADCAST_KEYS = 500_000  # texts with lists that are sent to every task, if these hold
BROADCAST_ITEMS = 4_000_000  # numbers together at most (32 MB); otherwise they are joined by a shuffle
NO_ID = -(1 << 63)
REPEATED, OPEN = 1, 2


def pack(copy: np.ndarray, anchor: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Copy number, anchor and the distances from a cell's start positions to it, as one long that sorts like the anchor."""
    return ((copy.astype(np.int64) << 46) | (anchor.astype(np.int64) << 14) | (low.astype(np.int64) << 7) | high.astype(np.int64))


def unpack(pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (pos >> 14) & 0xFFFFFFFF, (pos >> 7) & 127, pos & 127


def sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest of each ``width`` neighbours, the leftmost on a tie."""
    n = len(keys)
    bits = max(1, (n - 1).bit_length())
    packed = (keys >> np.uint64(bits) << np.uint64(bits)) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = packed
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(behind[:n - width + 1], ahead[width - 1:n])
    return (least & np.uint64((1 << bits) - 1)).astype(np.int64)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Callable]:
    """All cells of texts: anchor, smallest and largest distance of its stretches' starts to it (places in ``data``), and their hash function."""
    of, n = polynomial(data), len(data)
    if n < LENGTH:
        return *(np.zeros(0, np.int64),) * 3, of
    at = np.arange(n - GRAM + 1)
    least = sliding_argmin(mixed(of(at, at + GRAM)), LENGTH - GRAM + 1)
    inside = np.ones(n, bool)  # starts of stretches that end within their text
    lengths = np.diff(offsets)
    for back in range(1, LENGTH):
        inside[offsets[1:][lengths >= back] - back] = False
    start = np.flatnonzero(inside[:len(least)])
    if not len(start):
        return *(np.zeros(0, np.int64),) * 3, of
    anchor, text = least[start], np.searchsorted(offsets, start, "right")
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (np.diff(start) != 1)])
    last = np.r_[first[1:], len(start)] - 1
    return anchor[first], anchor[first] - start[last], anchor[first] - start[first], of


PAIR = "core bigint, whole bigint, doc bigint, pos bigint"


def pairs(core: np.ndarray, whole: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """Rank-position pairs for the shuffle; of equal cells the first only, the others as repeated ones (core 0, whole 0)."""
    order = np.lexsort((pos, doc, whole, core))
    core, whole, doc, pos = core[order], whole[order], doc[order], pos[order]
    again = np.r_[False, (core[1:] == core[:-1]) & (whole[1:] == whole[:-1])] if len(core) else np.zeros(0, bool)
    return pa.RecordBatch.from_pydict({name: pa.array(values.astype(np.uint64).view(np.int64)) for name, values in (
        ("core", np.where(again, 0, core)), ("whole", np.where(again, 0, whole)), ("doc", doc.astype(np.int64)), ("pos", pos))})


def ranked(units: DataFrame, parts: int) -> DataFrame:
    """One round: (doc, pos, state) of the cells that are repeated or stay open; unique ones are dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, 0), np.int64)  # the last core's first cells of each content: its first row, and one of another content
        several = False
        for batch in batches:
            rows = np.stack([np.asarray(c) for c in batch.columns])
            core, whole, doc, pos = rows
            known = (core == 0) & (whole == 0)
            out_doc, out_pos = doc[known], pos[known]
            yield of_state(out_doc, out_pos, REPEATED)
            core, whole, doc, pos = (held_row if not len(row) else np.r_[held_row, row] for held_row, row in zip(held, rows[:, ~known]))
            if not len(core):
                continue
            same_core = np.r_[False, core[1:] == core[:-1]]
            same = same_core & np.r_[False, whole[1:] == whole[:-1]]
            firsts = np.flatnonzero(~same)
            yield of_state(doc[same], pos[same], REPEATED)
            # of the firsts, those whose core has several contents stay open; the last first waits for the next batch
            alike = same_core[firsts]
            more = np.r_[alike[1:], False]
            is_open = alike | more
            if len(firsts) and several and held.shape[1] and not alike[0]:
                is_open[0] = True
            keep = firsts[-1]
            yield of_state(doc[firsts[:-1]][is_open[:-1]], pos[firsts[:-1]][is_open[:-1]], OPEN)
            several = bool(alike[-1]) or (len(firsts) == 1 and several and held.shape[1] > 0)
            held = np.array([[core[keep]], [whole[keep]], [doc[keep]], [pos[keep]]])
        if held.shape[1] and several:
            yield of_state(held[2], held[3], OPEN)
        release()

    def of_state(doc: np.ndarray, pos: np.ndarray, state: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"doc": pa.array(doc, pa.int64()), "pos": pa.array(pos, pa.int64()),
                                           "state": pa.array(np.full(len(doc), state, np.int32))})

    # the sort is by rank, then by position: the first of equal cells is the earliest
    known = (F.col("core") == 0) & (F.col("whole") == 0)
    spread = F.when(known, F.xxhash64("doc", "pos")).otherwise(F.col("core"))
    placed = units.repartition(parts, spread).sortWithinPartitions("core", "whole", "doc", "pos")
    return placed.mapInArrow(run, "doc bigint, pos bigint, state int")


def numbered(df: DataFrame, **more: str) -> DataFrame:
    """(doc, copy, doc_id, text, columns of ``more``): doc is the id, a null one the smallest long, and copy is 0.

    If ids repeat, doc is the row's number by id and text instead, null ids
    first. Ranges of rows are sorted, so no task gets all rows of one id, and
    the table is written, so that the numbers stay.
    """
    docs = pick(df, doc_id="bigint", text="string", **more).withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID)))
    counted = docs.agg(F.count("*").alias("n"), F.count_distinct("doc").alias("d")).first()
    if counted.n != counted.d:
        order = [F.asc("doc"), F.asc_nulls_first("text"), F.asc("row")]  # row sets equal rows apart
        ranges = docs.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(parts_of(docs, 50_000, counted.n), *order)
        docs = materialize(ranges.sortWithinPartitions(*order).withColumn("doc", F.monotonically_increasing_id()).drop("row"), "numbered")
    return docs.select("doc", F.lit(0).alias("copy"), "doc_id", "text", *more)


def join_by_key(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """``docs`` with what ``lists`` (a written table) has for their (doc, copy); it is sent to every task if its size is checked to be small."""
    arrays = [F.sum(F.size(name)) for name, kind in lists.dtypes if kind.startswith("array")]
    rows, items = lists.agg(F.count("*"), F.coalesce(*arrays, F.lit(0)) if arrays else F.lit(0)).first()
    small = rows <= BROADCAST_KEYS and items <= BROADCAST_ITEMS
    return docs.join(F.broadcast(lists) if small else lists, ["doc", "copy"], how)


def per_text(cells: DataFrame) -> DataFrame:
    """(doc, copy, cells): the cells of each text."""
    copy = F.shiftrightunsigned("pos", 46).cast("int")
    return cells.groupBy("doc", copy.alias("copy")).agg(F.collect_list("pos").alias("cells"))


def first_round(docs: DataFrame) -> DataFrame:
    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = raw(piece.column(2))
        anchor, low, high, of = anchors(data, offsets)
        text = np.searchsorted(offsets, anchor, "right") - 1
        core = mixed(of(anchor, anchor + GRAM))
        whole = mixed(of(anchor - high, anchor - low + LENGTH) + ((low << 7) | high).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))
        return pairs(core, whole, np.asarray(piece.column(0))[text], pack(np.asarray(piece.column(1))[text], anchor - offsets[text], low, high))

    return over_batches(docs.select("doc", "copy", "text"), run, PAIR, TOGETHER)


def contexts(docs: DataFrame, cells: DataFrame) -> DataFrame:
    """(doc, pos, context): the bytes that the stretches of each open cell cover."""
    wanted = join_by_key(docs.select("doc", "copy", "text"), materialize(per_text(cells), "open-cells"), "inner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, ["text"], 1 << 20):
                doc, pos, content = [], [], []
                for key, text, cells_of in zip(piece.column(0).to_pylist(), piece.column(2).cast(pa.binary()), piece.column(3)):
                    whole, of = text.as_py(), np.asarray(cells_of.values)
                    anchor, low, high = unpack(of)
                    doc += [key] * len(of)
                    pos += of.tolist()
                    content += [whole[a:b] for a, b in zip((anchor - high).tolist(), (anchor - low + LENGTH).tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(pos, pa.int64()), pa.array(content, pa.binary())],
                                                 names=["doc", "pos", "context"])

    return materialize(wanted.select("doc", "copy", "text", "cells").mapInArrow(run, "doc bigint, pos bigint, context binary"), "contexts")


def smaller_cells(context: DataFrame, size: int) -> DataFrame:
    """The cells of (doc, pos, context) cut into those of ``size`` start positions, as pairs for the next round."""

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = raw(piece.column(2))
        pos, doc = np.asarray(piece.column(1)), np.asarray(piece.column(0))
        anchor, low, high = unpack(pos)
        count = high // size - low // size + 1
        row = np.repeat(np.arange(len(pos)), count)
        cell = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + (low // size)[row]
        near, far = np.maximum(cell * size, low[row]), np.minimum(cell * size + size - 1, high[row])
        of, at = polynomial(data), offsets[:-1][row] + high[row]  # where the anchor is
        label = mixed(cell.astype(np.uint64) + np.uint64(size << 32))
        core = mixed(of(at - cell * size, at - cell * size - size + 1 + LENGTH) + label)
        whole = mixed(of(at - far, at - near + LENGTH) + mixed(((near << 7) | far).astype(np.uint64)))
        return pairs(core, whole, doc[row], pack(pos[row] >> 46, anchor[row], near, far))

    return over_batches(context, run, PAIR, TOGETHER, ["context"])


def spans(docs: DataFrame) -> DataFrame:
    """(doc, copy, runs): of each text with repeated stretches, begin and end of each maximal run of bytes that they cover, in order."""
    parts = parts_of(docs, 50_000, docs.count())
    first = materialize(ranked(first_round(docs), parts), "ranks")
    context = contexts(docs, first.filter(F.col("state") == OPEN))
    second = materialize(ranked(smaller_cells(context, CELL), parts), "ranks")
    still = second.filter(F.col("state") == OPEN).select(F.col("doc").alias("d"), F.shiftrightunsigned("pos", 14).alias("anchor"),
                                                         F.col("pos").bitwiseAND((1 << 14) - 1).alias("reach"))
    joined = context.join(still, (F.col("doc") == F.col("d")) & (F.shiftrightunsigned("pos", 14) == F.col("anchor")))

    def narrow(piece: pa.RecordBatch) -> pa.RecordBatch:
        """Of a cell's context the part that a smaller cell covers."""
        pos, reach = np.asarray(piece.column(1)), np.asarray(piece.column(3))
        _, _, high = unpack(pos)
        near, far = (reach >> 7) & 127, reach & 127
        cut = [c.as_py()[a:b] for c, a, b in zip(piece.column(2), (high - far).tolist(), (high - near + LENGTH).tolist())]
        return pa.RecordBatch.from_pydict({"doc": piece.column(0), "pos": pa.array((pos >> 14 << 14) | reach), "context": pa.array(cut, pa.binary())})

    cells = over_batches(joined.select("doc", "pos", "context", "reach"), narrow, "doc bigint, pos bigint, context binary", TOGETHER, ["context"])
    third = ranked(smaller_cells(cells, 1), parts)
    every = first.unionByName(second).unionByName(third).filter(F.col("state") == REPEATED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [covered(np.asarray(cells.values)) for cells in batch.column(2)]
            yield pa.RecordBatch.from_pydict({"doc": batch.column(0), "copy": batch.column(1), "runs": pa.array(runs, pa.list_(pa.int32()))})

    return materialize(per_text(every).mapInArrow(run, "doc bigint, copy int, runs array<int>"), "repeated-runs")


def covered(pos: np.ndarray) -> np.ndarray:
    """Begin and end, alternating, of the maximal runs of bytes that the cells' stretches cover."""
    anchor, low, high = unpack(pos)
    order = np.argsort(anchor - high)
    begin, end = (anchor - high)[order], np.maximum.accumulate((anchor - low + LENGTH)[order])
    first = np.r_[True, begin[1:] > end[:-1]]
    return np.stack([begin[first], end[np.r_[first[1:], True]]], axis=1).reshape(-1).astype(np.int32)


def remove_repeats(df: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row of (doc_id, text); kept holds the remaining bytes.

    Texts are UTF-8 bytes, a null text is empty, and one below 100 bytes is
    left whole. Stretches are judged on the input: overlaps count, and a
    stretch that starts earlier counts even if it is removed itself. Rows
    without an id come first; rows with one id are ordered by their text, so of
    equal rows the first is kept. An empty table gives an empty one; other
    columns are left out.
    """
    docs = numbered(df)
    joined = join_by_key(docs, spans(docs), "left").select("doc_id", "text", "runs")

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for text, found in zip(piece.column(1).cast(pa.binary()), piece.column(2).to_pylist()):
            content, runs = text.as_py() or b"", found or []
            n_bytes.append(len(content))
            n_removed.append(sum(runs[1::2]) - sum(runs[::2]))
            n_spans.append(len(runs) // 2)
            edges = [0, *runs, len(content)]
            kept.append(b"".join(content[a:b] for a, b in zip(edges[::2], edges[1::2])))
        return pa.RecordBatch.from_pydict({"doc_id": piece.column(0), "n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                                           "n_spans": pa.array(n_spans, pa.int64()), "kept": pa.array(kept, pa.binary())})

    return over_batches(joined, run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary", 2)
