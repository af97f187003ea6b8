"""Packing of token sequences: bounded-space best fit, online in every partition.

Each task keeps at most ``OPEN`` windows of ``CAPACITY`` tokens open while it
reads its texts once. A text's ids and an end mark are one piece; what is as
long as a window fills windows of its own, the rest goes

* to the open window it leaves the least room in (best fit), or
* to a new window while fewer than ``OPEN`` are open, or
* if it fits none, its beginning fills the fullest window to the brim, that
  window is emitted, and what remains is placed anew.

So a partition emits full windows only. The at most ``OPEN`` windows that it
leaves are merged: those of ``MERGED`` partitions go through the same packer in
one task, round by round, until one task holds the last. It fills the fuller
windows from the emptier ones and divides the last rest at powers of two, which
are not padded. No sequence holds padding then, whatever the texts' lengths.

A task's memory is bounded by its open windows and one text. Nothing is
shuffled but the open windows. Sequence numbers say round, partition and count,
so a task that is run again gives the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweft.llm.common import materialize, pick, slices
from loanweft.llm.token_ids import content_of, loaded

CAPACITY = 2048
OPEN = 16
MERGED = 64  # partitions whose open windows one task merges: 8 MB of ids at most
END = 1
TOGETHER = 2_000_000  # bytes of text encoded at once
PER_BATCH = 4_000_000  # bytes of ids in a batch of results
PIECE = ("doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary, "
         "sequence_id bigint, offset bigint, part bigint, window bigint")
NAMES = [column.split()[0] for column in PIECE.split(", ")]
TYPES = [pa.binary() if name == "ids" else pa.int64() for name in NAMES]


class Packer:
    """The open windows of one task. ``closed`` gets the pieces of emitted windows.

    A piece is (doc_id, start, doc_tokens, ids), ids being bytes of ``WIDTH``
    each; a window is a list of its room and its pieces.
    """

    WIDTH = 4

    def __init__(self, first: int, capacity: int = CAPACITY, most_open: int = OPEN):
        if capacity < 1 or most_open < 1:
            raise ValueError("a window holds a token, and one is open, at least")
        self.capacity, self.most_open, self.next = capacity, most_open, first
        self.windows: list[list] = []
        self.closed: list[tuple] = []
        self.bytes = 0

    def add(self, doc_id: int | None, start: int, doc_tokens: int, ids: bytes) -> None:
        capacity, width = self.capacity, self.WIDTH
        left = len(ids) // width
        while left >= capacity:
            self.emit([(doc_id, start, doc_tokens, ids[:capacity * width])])
            ids, start, left = ids[capacity * width:], start + capacity, left - capacity
        while left:
            best = fullest = None
            for window in self.windows:
                room = window[0]
                if room >= left and (best is None or room < best[0]):
                    best = window
                if fullest is None or room < fullest[0]:
                    fullest = window
            if best is None and len(self.windows) < self.most_open:
                best = [capacity]
                self.windows.append(best)
            into = best or fullest
            taken = min(left, into[0])
            into.append((doc_id, start, doc_tokens, ids[:taken * width]))
            into[0] -= taken
            if not into[0]:
                self.windows = [window for window in self.windows if window is not into]
                self.emit(into[1:])
            ids, start, left = ids[taken * width:], start + taken, left - taken

    def emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, doc_tokens, ids in pieces:
            self.closed.append((doc_id, start, len(ids) // self.WIDTH, doc_tokens, ids, self.next, offset, None, None))
            offset += len(ids) // self.WIDTH
            self.bytes += len(ids)
        self.next += 1

    def finish(self) -> None:
        """Emit all: the fuller windows are filled from the emptier ones, the rest is divided at powers of two."""
        while len(self.windows) > 1:
            emptiest = max(self.windows, key=lambda window: window[0])
            self.windows = [window for window in self.windows if window is not emptiest]
            most, self.most_open = self.most_open, len(self.windows)
            for piece in emptiest[1:]:
                self.add(*piece)  # opens a window again only if the others are full
            self.most_open = most
        for window in self.windows:
            pieces, self.windows = window[1:], []
            left = self.capacity - window[0]
            while left:
                size = 1 << (left.bit_length() - 1)
                head, pieces = divided(pieces, size, self.WIDTH)
                self.emit(head)
                left -= size

    def opened(self, part: int) -> list[tuple]:
        """The pieces of the windows still open, without a sequence number."""
        rows = []
        for number, window in enumerate(self.windows):
            offset = 0
            for doc_id, start, doc_tokens, ids in window[1:]:
                rows.append((doc_id, start, len(ids) // self.WIDTH, doc_tokens, ids, None, offset, part, number))
                offset += len(ids) // self.WIDTH
        return rows

    def drained(self) -> list[tuple]:
        rows, self.closed, self.bytes = self.closed, [], 0
        return rows


def divided(pieces: list[tuple], size: int, width: int) -> tuple[list[tuple], list[tuple]]:
    """The first ``size`` tokens of a window's pieces, and the others."""
    head, rest = [], []
    for doc_id, start, doc_tokens, ids in pieces:
        taken = min(size, len(ids) // width)
        if taken:
            head.append((doc_id, start, doc_tokens, ids[:taken * width]))
        if len(ids) > taken * width:
            rest.append((doc_id, start + taken, doc_tokens, ids[taken * width:]))
        size -= taken
    return head, rest


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), TYPES)], names=NAMES)


def first_number(round_: int, part: int) -> int:
    """Sequence numbers of a task: 5 bits for the round, 27 for the partition, 31 for the count."""
    if round_ >= 1 << 5 or part >= 1 << 27:
        raise ValueError("too many rounds or partitions for the sequence numbers")
    return round_ << 58 | part << 31


def encoded(df: DataFrame, path: str, capacity: int, most_open: int) -> DataFrame:
    """The first round: every partition's texts encoded and packed."""
    content = content_of(path)
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = loaded(content), TaskContext.get().partitionId()
        packer = Packer(first_number(0, part), capacity, most_open)
        for batch in batches:
            for piece in slices(batch, ["text"], TOGETHER):
                ids, at = coder.encode(piece.column(1).to_pylist())
                blob = ids.astype("<u4").tobytes()
                for doc_id, low, high in zip(piece.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    packer.add(doc_id, 0, high - low + 1, blob[4 * low:4 * high] + end)
                    if packer.bytes >= PER_BATCH:
                        yield batch_of(packer.drained())
        if rows := packer.drained() + packer.opened(part):
            yield batch_of(rows)

    return pick(df, doc_id="bigint", text="string").mapInArrow(run, PIECE)


def merged(windows: DataFrame, round_: int, groups: int, capacity: int, most_open: int) -> DataFrame:
    """One round over the open windows of partitions 0 to ``groups`` * MERGED - 1; a single group is finished."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer = Packer(first_number(round_, part), capacity, most_open)
        for batch in batches:
            for doc_id, start, doc_tokens, ids in zip(*(batch.column(name).to_pylist() for name in ("doc_id", "start", "doc_tokens", "ids"))):
                packer.add(doc_id, start, doc_tokens, ids)
                if packer.bytes >= PER_BATCH:
                    yield batch_of(packer.drained())
        if groups == 1:
            packer.finish()
        if rows := packer.drained() + packer.opened(part):
            yield batch_of(rows)

    group = F.floor(F.col("part") / MERGED).cast("int")
    return windows.repartitionById(groups, group).sortWithinPartitions("part", "window", "offset").mapInArrow(run, PIECE)


def pack(df: DataFrame, path: str, capacity: int = CAPACITY, most_open: int = OPEN) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, sequence_id, offset) of the pieces of all texts.

    ids is binary, four little-endian bytes an id. Every row of (doc_id, text)
    gives its ids and the end mark ``END``, cut where a window ends; start is
    the place of a piece in its own row's ids. A null or empty text is the end
    mark alone. Null and repeated doc_ids stay, each row by itself. Every
    sequence is full or as long as a power of two. An empty table gives an empty
    one; other columns are left out.
    """
    made = materialize(encoded(df, path, capacity, most_open), "packed")
    done, round_, groups = made.filter("sequence_id is not null"), 1, 0
    while groups != 1:
        windows = made.filter("sequence_id is null")
        last = windows.agg(F.max("part").alias("part")).first().part
        groups = 1 if last is None else last // MERGED + 1
        made = materialize(merged(windows, round_, groups, capacity, most_open), "packed")
        done, round_ = done.unionByName(made.filter("sequence_id is not null")), round_ + 1
    return done.drop("part", "window")
