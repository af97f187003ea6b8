"""N-gram Jaccard join by vertical partitioning, and the components of its links.

A text's set holds its distinct shingles of three words, as 64-bit hashes. The
global order of the shingles is that of their hashes. It is cut into fragments
twice:

* For candidates, into more fragments, by a third, than a linked pair can differ
  in places: two sets with Jaccard similarity of t or more differ in at most
  ``(1 - t) / (1 + t) * (|A| + |B|)`` shingles, so a quarter of the fragments at
  least is equal in both. A text that shares fewer of them with others, such as
  one with a passage that many texts hold, has no link and goes at once. The
  number of fragments follows from the size, on a grid, and
  a set near a step of the grid is cut for both sides. A fragment that is empty
  in both says nothing: some are spared for that, and a set with more empty
  ones is cut once more, by another hash. So no link is lost, and a shingle that
  very many texts share makes no candidates by itself.
* For verification, into a fixed number of fragments: of each candidate pair
  the overlap in each fragment is counted apart, and the counts are summed.

Equal sets are one class first. Of the sets that share a fragment not all pairs
are formed: each is paired with the one of smallest id, its leader, links are
verified and give components. Only sets with one leader that lie in different
components are compared in a second round, by what they differ from the leader
in (see ``second_round``). Whatever is not paired is connected already or too
far apart.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanweft.llm.common import MIX, discard, materialize, mixed, over_batches, parts_of, raw, release, shingle_hashes
from loanweft.llm.components import components
from loanweft.llm.substrings import numbered

WORDS = 3
PERCENT = 90
FRAGMENTS = 4  # of a set, for counting overlaps
MARGIN = 1.3  # fragments, without the spared ones, for each place in which a linked pair can differ
STEP = 1.25  # between numbers of fragments on the grid
BROADCAST_IDS = 2_000_000  # 16 MB of ids, or 32 of pairs; more are joined by a shuffle
SPARE = 3  # of the fragments that linked texts must share, each of the two may let go one in so many, so that some stay
TOGETHER = 0.5
MEMBERS_PER_PART = 500_000  # rows of a signature and a text that a task puts in order
NOBODY = -(1 << 63)
LEVELS = 128  # of the grid at most
SHARED = "signature bigint, leader bigint, doc_id bigint"


def distinct_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    hashes, at = shingle_hashes(data, offsets, words)
    return [np.unique(hashes[low:high]) for low, high in zip(at[:-1].tolist(), at[1:].tolist())]


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def most_apart(total: int, percent: int) -> int:
    """Largest symmetric difference of two linked sets with ``total`` elements together: 100 I >= percent U."""
    return total * (100 - percent) // (100 + percent)


@functools.lru_cache(maxsize=4)
def grid(percent: int, largest: int = 1 << 24) -> dict[int, int]:
    """Numbers of fragments to cut into, each with how many of them may be empty: more than the smallest sets cut so usually have."""
    made, size, enough = {}, 2, 0
    while size < largest:
        smallest = (enough + 1) * (100 + percent) / (2 * (100 - percent)) * percent / 100
        mean = size * math.exp(-smallest / size)
        made[size] = math.floor(mean + math.sqrt(mean))
        enough = max(enough, math.ceil((size - made[size]) / MARGIN) - 1)
        size = max(size + 1, int(size * STEP))
    if len(made) > LEVELS:
        raise ValueError("the grid has too many levels")
    return made


def spared(size: int, percent: int) -> int:
    return grid(percent)[size]


def level(apart: int, percent: int) -> int:
    """Smallest number of fragments on the grid of which more than ``MARGIN`` times ``apart`` remain, even without the spared ones."""
    return next(size for size, empty in grid(percent).items() if size - empty > MARGIN * apart)


def needed(level_column: Column, n: Column, percent: int) -> Column:
    """How many fragments of a level two linked sets have in common at least, one of which has ``n`` shingles."""
    remaining = F.get(F.array(*[F.lit(size - empty) for size, empty in grid(percent).items()]), level_column)
    total = n + F.floor(n * 100 / percent)
    most = F.floor(total * (100 - percent) / (100 + percent))
    return remaining - F.least(most, F.ceil(remaining / MARGIN) - 1)


@functools.lru_cache(maxsize=100_000)
def levels(n: int, percent: int) -> tuple[int, ...]:
    """Numbers of fragments that a set of ``n`` shingles is cut into: those that it may share with partners of its size and larger ones."""
    largest = n * 100 // percent
    low, high = (most_apart(2 * size, percent) for size in (n, largest))
    if not high:
        return ()  # only equal sets link
    first, last = level(max(low, 1), percent), level(high, percent)
    return tuple(size for size in grid(percent) if first <= size <= last)


def signatures(shingles: np.ndarray, percent: int) -> np.ndarray:
    """One 64-bit value per fragment of each cut of a sorted set; equal fragments have equal values, whose last bits tell the level."""
    found, known = [], list(grid(percent))
    for size in levels(len(shingles), percent):
        seed = 0
        while True:
            spread = mixed(shingles + np.uint64(seed * int(MIX) % (1 << 64))) if seed else shingles
            fragment = (((spread >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)
            if seed:
                order = np.argsort(fragment, kind="stable")
                spread, fragment = spread[order], fragment[order]
            first = np.flatnonzero(np.r_[True, fragment[1:] != fragment[:-1]])
            label = mixed(fragment[first].astype(np.uint64) + np.uint64((size << 20) + (seed << 52)))
            values = mixed(np.add.reduceat(mixed(spread), first) + label)
            found.append(values & ~np.uint64(LEVELS - 1) | np.uint64(known.index(size)))
            if size - len(first) <= spared(size, percent):
                break
            seed += 1
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def described(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, digest) of every row."""

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        made = distinct_sets(*raw(piece.column(1)), words)
        return pa.RecordBatch.from_pydict({"doc_id": piece.column(0), "n_shingles": pa.array([len(s) for s in made], pa.int64()),
                                           "digest": pa.array([digest(s) if len(s) else None for s in made], pa.binary())})

    return over_batches(docs, run, "doc_id bigint, n_shingles bigint, digest binary", TOGETHER)


def members_of(docs: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """(signature, leader, doc_id) of every text that shares a signature with others; the leader is the smallest id among them.

    Of the texts that a task reads together one per signature is sent, the one
    of smallest id; the others are bound to it and go to random partitions, so
    a signature that very many texts share is met by few rows. The bound ones
    then take over the leader of the one that they are bound to. A text has
    signatures by its size, so the partitions follow the shingles of ``sets``.
    Heads tell whether any are bound to them: only those are looked up.
    """

    def send(piece: pa.RecordBatch) -> pa.RecordBatch:
        made = [signatures(s, percent) for s in distinct_sets(*raw(piece.column(1)), words)]
        signature = np.concatenate(made).astype(np.int64)
        doc = np.repeat(np.asarray(piece.column(0)), [len(m) for m in made])
        order = np.lexsort((doc, signature))
        signature, doc = signature[order], doc[order]
        first = np.r_[True, signature[1:] != signature[:-1]] if len(doc) else np.zeros(0, bool)
        leader = doc[np.maximum.accumulate(np.where(first, np.arange(len(doc)), 0))]
        shared = ~first | np.r_[~first[1:], False] if len(doc) else first
        return pa.RecordBatch.from_pydict({"signature": pa.array(signature), "leader": pa.array(leader, mask=~shared), "doc_id": pa.array(doc)})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last signature's leader: rows still to come may share it
        for batch in batches:
            signature, doc = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            own = np.asarray(batch.column(1).fill_null(NOBODY))
            bound = (own != NOBODY) & (own != doc)
            yield rows(signature[bound], own[bound], doc[bound], own[bound] != NOBODY, True)
            signature, doc, known = signature[~bound], doc[~bound], own[~bound] != NOBODY
            if not len(doc):
                continue
            sent = np.zeros(len(doc), bool)
            if held:
                signature, doc = np.r_[held[0], signature], np.r_[held[1], doc]
                known, sent = np.r_[held[2], known], np.r_[held[3], sent]
            first = np.r_[True, signature[1:] != signature[:-1]]
            at = np.maximum.accumulate(np.where(first, np.arange(len(doc)), 0))
            shared = ~first | np.r_[~first[1:], False] | known
            out = shared & ~sent
            yield rows(signature[out], doc[at][out], doc[out], known[out], False)
            last = at[-1]
            held = signature[last], doc[last], known[last], bool(shared[last])
        release()

    def rows(signature: np.ndarray, leader: np.ndarray, doc: np.ndarray, several: np.ndarray, bound: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(signature, pa.int64()), pa.array(leader, pa.int64()), pa.array(doc, pa.int64()), pa.array(several, pa.bool_()),
                                           pa.array(np.full(len(doc), bound))], names=["signature", "leader", "doc_id", "several", "bound"])

    sent = over_batches(docs, send, SHARED, TOGETHER)
    free = F.col("leader").isNull() | (F.col("leader") == F.col("doc_id"))
    expected = (sets.agg(F.sum("n_shingles")).first()[0] or 0) * 4 * (100 - percent) // percent
    placed = sent.repartition(parts_of(docs, MEMBERS_PER_PART, expected), F.when(free, F.col("signature")).otherwise(F.xxhash64("signature", "doc_id")))
    met = materialize(placed.sortWithinPartitions("signature", "doc_id").mapInArrow(meet, SHARED + ", several boolean, bound boolean"), "fragment-members")
    heads = met.filter("not bound").select("signature", "leader", "doc_id")
    to = met.filter("not bound and several").select(F.col("signature").alias("s"), F.col("leader").alias("head"), F.col("doc_id").alias("via"))
    bound = met.filter("bound").join(to, (F.col("signature") == F.col("s")) & (F.col("leader") == F.col("via")))
    return heads.unionByName(bound.select("signature", F.col("head").alias("leader"), "doc_id"))


def with_enough(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The members whose text shares as many fragments of a level with others as a linked one must, without stray leaders.

    Of the fragments that it shares by another's lead, a text lets go those of
    the leaders that it has fewest in common with, as long as they are at most
    one in ``SPARE`` of those that a linked text must share, less one: most such
    leaders are met by chance, in one or two fragments. Two linked texts let go
    two in ``SPARE`` together, so at one leader at least both stay.
    """
    level_of = F.col("signature").bitwiseAND(F.lit(LEVELS - 1)).cast("int")
    sized = members.withColumn("level", level_of).join(sets.select("doc_id", F.col("n_shingles").alias("n")), "doc_id")
    of_level, of_leader = Window.partitionBy("doc_id", "level"), Window.partitionBy("doc_id", "level", "leader")
    alone = F.col("doc_id") == F.col("leader")  # its own lead makes no pair and stays
    counted = sized.withColumn("needed", needed(F.col("level"), F.col("n"), percent)).withColumn("shared", F.count("*").over(of_level)).filter("shared >= needed")
    common = counted.withColumn("common", F.when(~alone, F.count("*").over(of_leader)))
    upto = F.count("common").over(of_level.orderBy(F.asc_nulls_last("common"), "leader").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    kept = common.withColumn("upto", upto).filter(alone | (F.col("upto") > F.floor((F.col("needed") - 1) / SPARE)))
    return materialize(kept.select("signature", "leader", "doc_id"), "members")


def with_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join by doc_id; the ids are sent to every task only if their number is checked to be small."""
    return docs.join(sent_if_few(materialize(ids.select("doc_id").distinct(), "ids")), "doc_id", how)


def sent_if_few(known: DataFrame) -> DataFrame:
    """A written table of ids or pairs; it is sent to every task only if its size is checked to be small."""
    return F.broadcast(known) if known.count() <= BROADCAST_IDS else known


def segments(docs: DataFrame, words: int, fragments: int) -> DataFrame:
    """(doc_id, fragment, size, segment): each set's sorted hashes (8 bytes each), cut at fixed places of the global order."""
    edges = np.array([(1 << 64) * i // fragments for i in range(1, fragments)], np.uint64)

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, shingles in zip(piece.column(0).to_pylist(), distinct_sets(*raw(piece.column(1)), words)):
            rows += [(doc_id, i, len(shingles), part.tobytes()) for i, part in enumerate(np.split(shingles, np.searchsorted(shingles, edges)))]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                                          names=["doc_id", "fragment", "size", "segment"])

    return over_batches(docs, run, "doc_id bigint, fragment int, size int, segment binary", TOGETHER)


def overlaps(pairs: DataFrame, docs: DataFrame, words: int, fragments: int = FRAGMENTS) -> DataFrame:
    """(a, b, size_a, size_b, fragment, common, apart) of pairs (a, b), written to the shared folder.

    Of each fragment the number of common shingles, and those that only one of
    the two texts has.
    """
    needed = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
    parts = materialize(segments(with_ids(docs, needed, "left_semi"), words, fragments), "segments")
    left = parts.select(F.col("doc_id").alias("a"), "fragment", F.col("size").alias("size_a"), F.col("segment").alias("segment_a"))
    right = parts.select(F.col("doc_id").alias("b"), "fragment", F.col("size").alias("size_b"), F.col("segment").alias("segment_b"))
    cut = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))))
    together = cut.join(left, ["a", "fragment"]).join(right, ["b", "fragment"])

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        sets = [tuple(np.frombuffer(s.as_buffer(), np.uint64) for s in both) for both in zip(piece.column(5), piece.column(6))]
        apart = [np.setxor1d(x, y, assume_unique=True).view(np.int64) for x, y in sets]
        common = [(len(x) + len(y) - len(d)) // 2 for (x, y), d in zip(sets, apart)]
        return pa.RecordBatch.from_arrays([*piece.columns[:5], pa.array(common, pa.int32()), pa.array(apart, pa.list_(pa.int64()))],
                                          names=["a", "b", "size_a", "size_b", "fragment", "common", "apart"])

    schema = "a bigint, b bigint, size_a int, size_b int, fragment int, common int, apart array<bigint>"
    counted = materialize(over_batches(together.select("a", "b", "size_a", "size_b", "fragment", "segment_a", "segment_b"), run, schema, 2,
                                       ["segment_a", "segment_b"]), "overlaps")
    discard(parts)
    return counted


def summed(counted: DataFrame) -> DataFrame:
    """(a, b, size_a, size_b, common): the fragments' counts summed per pair."""
    return counted.groupBy("a", "b", "size_a", "size_b").agg(F.sum("common").alias("common"))


def linked(counted: DataFrame, percent: int) -> DataFrame:
    union = F.col("size_a") + F.col("size_b") - F.col("common")
    return materialize(summed(counted).filter(100 * F.col("common") >= percent * union).select("a", "b"), "links")


def near_components(df: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of (doc_id, text).

    Two rows link when 100 * intersection >= percent * union of their sets; the
    component is the smallest doc_id reachable by links, its own included. Rows
    that share a doc_id, or have none, are linked each by its own text; a
    component without any id has none. Null texts and texts without words have
    size 0, no links and their own id. Other columns are left out.
    """
    return row_components(numbered(df), words, percent).select("doc_id", "n_shingles", "component_id")


def row_components(rows: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc, doc_id, n_shingles, component, component_id) of ``numbered`` rows, written; component is the smallest doc reached."""
    docs = rows.select(F.col("doc").alias("doc_id"), "text")  # from here on the row's own key
    sets = materialize(described(docs, words), "shingle-sets")
    classes = sets.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("node"), F.count("*").alias("n"))
    shared = materialize(classes.filter("n > 1").select("digest", "node"), "equal-sets")
    copies = sets.join(shared, "digest").filter(F.col("doc_id") != F.col("node")).select("doc_id")
    ready = with_ids(docs, copies, "left_anti")
    met = members_of(ready, sets, words, percent)
    members = with_enough(met, sets, percent)
    discard(met)
    pairs = materialize(members.filter("doc_id <> leader").select(F.col("leader").alias("a"), F.col("doc_id").alias("b")).distinct(), "pairs")
    counted = overlaps(pairs, docs, words)
    found = linked(counted, percent)
    nodes = components(found)
    again = second_round(members, counted, nodes, percent)
    other = materialize(again.join(pairs, ["a", "b"], "left_anti"), "pairs")
    discard(members, counted, again)
    if other.limit(1).count():
        more = overlaps(other, docs, words)
        nodes = components(found.unionByName(linked(more, percent)))
        discard(more)
    of_class = sets.join(shared, "digest", "left").select("doc_id", "n_shingles", F.coalesce("node", "doc_id").alias("node"))
    placed = of_class.join(nodes, "node", "left").select(F.col("doc_id").alias("doc"), "n_shingles", F.coalesce("component", "node").alias("component"))
    named = materialize(placed.join(rows.select("doc", "doc_id"), "doc"), "row-components")
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return named.join(materialize(smallest, "smallest-ids"), "component", "left").select(
        "doc", "doc_id", "n_shingles", "component", F.coalesce("component_id", "doc_id").alias("component_id"))


def second_round(members: DataFrame, counted: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of texts with one leader that may link although they lie in different components.

    Only fragments count that texts of several components share which are near
    in size and in distance from the leader, the leader not counted: most chance
    agreements are between a text and its leader. A text that has fewer of those
    than a linked one must share, less what both may have let go in
    ``with_enough``, is closed. What two
    texts differ in is what just one of them differs from the leader in: with x
    and y elements that they have not in common with the leader, of which o are
    the same, they are x + y - 2 o apart. That is little enough
    only if o is large, so of each text's differences, the rarest among the
    leader's texts first, just as many as two texts may be apart, plus one, are
    looked at: linked texts share one of these, at places behind which enough
    are left. Differences that all have, such as the leader's own edits, come
    last and bind nobody.
    """
    apart = F.col("size_a") + F.col("size_b") - 2 * F.col("common")
    texts = summed(counted).select("a", "b", F.col("size_b").alias("size"), apart.alias("apart"))
    named = nodes.select(F.col("node").alias("n"), "component")
    own = F.coalesce("component", "b").alias("component")
    texts = materialize(texts.join(named, F.col("b") == F.col("n"), "left").select("a", "b", "size", "apart", own), "texts")
    shared = members.filter("doc_id <> leader").select("signature", F.col("leader").alias("a"), F.col("doc_id").alias("b")).join(texts, ["a", "b"])
    level_of = F.col("signature").bitwiseAND(F.lit(LEVELS - 1)).cast("int")

    def in_several(rows: DataFrame, keys: list[str]) -> DataFrame:
        """The rows whose fragment texts of several components share, of texts that have enough such fragments; read from one written table."""
        several = rows.groupBy(*keys).agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select(*keys)
        left = materialize(rows.join(several, keys), "open-members")
        shared_by = left.groupBy("b", level_of.alias("level"), "size").agg(F.count_distinct("signature").alias("shared"))
        least = needed(F.col("level"), F.col("size"), percent)
        enough = shared_by.filter(SPARE * F.col("shared") >= (SPARE - 2) * least + 2).select("b", "level")
        return left.withColumn("level", level_of).join(sent_if_few(materialize(enough, "enough")), ["b", "level"], "left_semi").drop("level")

    shared = in_several(shared, ["signature"])
    # linked texts are near in size and in distance from the leader: they share a label of each kind
    ratio, share = 100 / percent, (100 - percent) / (100 + percent)
    near = F.floor(F.log("size") / math.log(ratio) + 1e-9).cast("int")
    sized = shared.withColumn("near", F.explode(F.array(near, near + 1)))
    width = F.floor(2 * share * F.pow(F.lit(ratio), F.col("near") + 1)) + 1
    far = F.floor(F.col("apart") / width).cast("int")
    placed = sized.withColumn("far", F.explode(F.array(far, far + 1))).drop("apart")
    near_enough = in_several(placed, ["signature", "near", "far"])
    discard(shared)
    still = materialize(near_enough.select("a", "b").distinct(), "open-texts")
    discard(near_enough)
    few = sent_if_few(still)
    texts = texts.join(few, ["a", "b"])
    elements = materialize(counted.join(few, ["a", "b"]).select("a", "b", F.explode("apart").alias("e")), "differences")
    often = elements.groupBy("a", "e").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("a", "b").orderBy("n", "e"))
    ranked = elements.join(often, ["a", "e"]).withColumn("i", rank).join(texts, ["a", "b"])
    reach = F.floor((F.col("size") + F.floor(F.col("size") * 100 / percent)) * (100 - percent) / (100 + percent)) + 1
    first = materialize(ranked.filter((F.col("i") <= reach) & (F.col("n") > 1)).drop("n"), "first-differences")
    discard(elements)
    x, y = (first.select("a", "e", *[F.col(c).alias(f"{c}_{side}") for c in ("b", "i", "size", "apart", "component")]) for side in "xy")
    most = F.floor((F.col("size_x") + F.col("size_y")) * (100 - percent) / (100 + percent))
    left = F.least(F.col("apart_x") - F.col("i_x"), F.col("apart_y") - F.col("i_y")) + 1
    may = (F.col("b_x") < F.col("b_y")) & (F.col("component_x") != F.col("component_y")) & (2 * left >= F.col("apart_x") + F.col("apart_y") - most)
    found = materialize(x.join(y, ["a", "e"]).filter(may).select(F.col("b_x").alias("a"), F.col("b_y").alias("b")).distinct(), "open-pairs")
    discard(first)
    return found
