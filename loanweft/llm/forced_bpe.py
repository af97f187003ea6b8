"""BPE encoding and decoding with forced boundaries.

A byte pair that occurs inside no token of the vocabulary can never be merged
over, so a text may be cut there: the fragments are encoded independently and
their ids are put one after another. The pairs come from the vocabulary itself.
Because the tokenizer first splits a text by a pattern, a cut must not change
what the pattern sees either. A forced pair is therefore used only where

* its left character is no white space (a run of white space is split by what
  follows it),
* its right character is no apostrophe (contractions are matched by their
  start), and it is a character's first byte.

To the left of such a cut the pattern ends a piece at the end of the text just
as it does at a change of class; to the right it starts anew either way.
Special tokens are found first; the sections between them are texts of their
own.

Short fragments repeat often and are kept in a bounded memory per task, so the
library encodes each of them once. There is no shuffle: a task reads its texts
and writes their ids. Null texts count as empty and give no ids; a text is
never shortened, however long.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweft.llm.common import FORGET, mixed, pick, polynomial, raw, release, slices

KEPT_FRAGMENTS = 200_000  # fragments a task remembers before it starts again
KEPT_BYTES = 64  # longer fragments are encoded but not remembered
TOGETHER = 1_000_000  # bytes of text worked on at once


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 itself, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ForcedBpe:
    """Encoder and decoder of one tokenizer file's content (``tokenizers`` JSON, byte-level BPE)."""

    def __init__(self, content: str, kept: int = KEPT_FRAGMENTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer

        described, letters = json.loads(content), byte_letters()
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.encode_batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        special = {t["content"]: t["id"] for t in described.get("added_tokens", [])}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in described.get("added_tokens", [])) or described.get("normalizer"):
            raise ValueError("tokens that take up neighbouring text and normalizers are not handled")
        if described["pre_tokenizer"]["type"] != "ByteLevel" or described["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("a byte-level vocabulary without an added first space is needed")
        self.special = {name.encode(): number for name, number in special.items()}
        self.sections = re.compile(b"(" + b"|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + b")") if special else None
        vocabulary = {word: number for word, number in described["model"]["vocab"].items() if word not in special}
        inside = np.zeros(1 << 16, bool)
        self.pieces: list[bytes] = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
        for word, number in vocabulary.items():
            piece = bytes(letters[c] for c in word)
            self.pieces[number] = piece
            if len(piece) > 1:
                part = np.frombuffer(piece, np.uint8).astype(np.int32)
                inside[part[:-1] << 8 | part[1:]] = True
        for name, number in self.special.items():
            self.pieces[number] = name
        left, right = np.divmod(np.arange(1 << 16), 256)
        space = (left == 32) | ((left >= 9) & (left <= 13)) | ((left >= 28) & (left <= 31))
        self.forced = ~inside & ~space & ((right < 0x80) | (right >= 0xC0)) & (right != ord("'"))
        self.ids: dict[bytes, bytes] = {}
        self.kept = kept

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Offsets in ``data`` (texts one after another, bounded by ``offsets``) at which a fragment starts."""
        first = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            at = np.flatnonzero(self.forced[data[:-1].astype(np.int32) << 8 | data[1:]])
            wide = data[at] >= 0x80  # a character of several bytes on the left: only two-byte ones from U+00C0 on are surely no white space
            lead = data[np.maximum(at - 1, 0)]
            first[at[~wide | ((lead >= 0xC3) & (lead <= 0xDF) & (at > 0))] + 1] = True
        blob = data.tobytes()
        if any(name in blob for name in self.special):
            for low, high in zip(offsets[:-1], offsets[1:]):
                for found in self.sections.finditer(blob[low:high]):
                    first[low + found.start():low + found.end()] = False
                    first[[low + found.start(), low + found.end()]] = True
        first[offsets] = True
        return np.flatnonzero(first[:-1])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the offset of each text in them."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        starts = self.starts(data, offsets)
        ends = np.r_[starts[1:], len(data)]
        kind, place = distinct_fragments(data, starts, ends)
        blob = data.tobytes()
        fragments = [blob[low:high] for low, high in zip(starts[kind].tolist(), ends[kind].tolist())]
        if len(self.ids) > self.kept:
            self.ids = {}
        known = self.ids
        new = list(set(fragments).difference(known))
        made = self.encode_batch([f.decode() for f in new], add_special_tokens=False)
        known.update(zip(new, (array("i", e.ids).tobytes() for e in made)))
        ids = list(map(known.__getitem__, fragments))
        for fragment in new:
            if len(fragment) > KEPT_BYTES:
                del known[fragment]
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, at = spread(np.frombuffer(b"".join(ids), np.int32), np.cumsum(counts) - counts, counts, place)
        return flat, np.r_[at, len(flat)][np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, special tokens included; bytes that form no character become U+FFFD."""
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


def distinct_fragments(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One fragment of each content, and for every fragment the place of its content among those.

    Found by a hash and confirmed byte by byte.
    """
    key = mixed(polynomial(data)(starts, ends))
    _, kind, place = np.unique(key, return_index=True, return_inverse=True)
    lengths = ends - starts
    source = np.repeat(starts[kind][place] - starts, lengths) + np.arange(starts[0], len(data))
    if not ((lengths == lengths[kind][place]).all() and (data[starts[0]:] == data[np.minimum(source, len(data) - 1)]).all()):
        blob, seen = data.tobytes(), {}
        place = np.array([seen.setdefault(blob[low:high], len(seen)) for low, high in zip(starts, ends)], np.int64)
        kind = np.unique(place, return_index=True)[1]
    return kind, place


def spread(values: np.ndarray, begins: np.ndarray, counts: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``values`` (begin and count by place) put one after another in the order of ``place``; where each begins."""
    taken = counts[place]
    at = np.cumsum(taken) - taken
    return values[np.repeat(begins[place] - at, taken) + np.arange(taken.sum())], at


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


LOADED: dict[str, ForcedBpe] = {}  # of this worker process: later tasks find the fragments that earlier ones met
FORGET.append(LOADED.clear)


def loaded(content: str) -> ForcedBpe:
    if content not in LOADED:
        LOADED.clear()
        LOADED[content] = ForcedBpe(content)
    return LOADED[content]


def content_of(path: str) -> str:
    """A tokenizer file, read on the driver; its size does not depend on the data."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(df: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of (doc_id, text), and with ``decoded`` the text that the ids give.

    A null text is empty: no ids, decoded text "". Null and repeated doc_ids
    stay, one row each. An empty table gives an empty one. Columns other than
    doc_id and text are left out, whatever their names.
    """
    content = content_of(path)
    schema = "doc_id bigint, ids array<int>" + (", decoded string" if decoded else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        bpe = loaded(content)
        for batch in batches:
            for piece in slices(batch, ["text"], TOGETHER):
                ids, offsets = bpe.encode(*raw(piece.column(1)))
                columns = {"doc_id": piece.column(0), "ids": lists(ids, offsets)}
                if decoded:
                    columns["decoded"] = pa.array([bpe.decode(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.string())
                yield pa.RecordBatch.from_pydict(columns)
            release()

    return pick(df, doc_id="bigint", text="string").mapInArrow(run, schema)


def decode(df: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids). Null ids give an empty text; ids outside the vocabulary are an error."""
    content = content_of(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(content)
        for batch in batches:
            texts = [bpe.decode(np.asarray(ids or [], np.int64)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "text": pa.array(texts, pa.string())})

    return pick(df, doc_id="bigint", ids="array<int>").mapInArrow(run, "doc_id bigint, text string")


def digests(df: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the round trip of every text."""
    return encode(df, path, decoded=True).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
