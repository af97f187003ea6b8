"""Merkle manifest of a dataset: ternary hash trees in van Emde Boas layout.

Every row is a leaf, every source a tree, and the trees' roots are the leaves
of one more tree. Nodes are joined in threes; the last run of a level may hold
fewer, even one.

A tree is cut into aligned subtrees of ``HEIGHT`` levels of edges. A task
builds such a block from its leaves, at most 3^HEIGHT of them, and writes it as
one array of digests in van Emde Boas order: the upper half of the levels first,
then each subtree below it, every part laid out the same way in turn. So the
nodes on a way to the root lie near each other on pages of any size, and where
a node lies is arithmetic (``places``), which serves building and siblings
alike. The blocks' roots are the leaves of the next tier, until one block
remains. Siblings are found from the top tier down: a block hands the way from
its root on to those below it.

Rows are put in order by one range sort of their digests; a source that holds
a third of all rows is many blocks in many tasks. Texts are hashed where they
are read and never move. The driver sees the number of tiers only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanweft.llm.common import in_order, materialize, pick

ARITY = 3
HEIGHT = 6  # levels of edges in a block: 729 leaves, 35 KB of digests
FIELDS = {"doc_id": "bigint", "source": "string", "lang": "string", "n_chars": "bigint", "text": "string"}
BLOCK = "tree string, position bigint, total bigint, height int, leaves int, nodes binary, doc_ids array<bigint>, claims array<binary>"
WAY = "tree string, position bigint, subroot string, root string, lefts array<string>, rights array<string>"
AUDIT = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def size(levels: int) -> int:
    """Nodes of a whole tree of that many levels of nodes."""
    return (ARITY ** levels - 1) // (ARITY - 1)


def place(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Van Emde Boas places of the nodes ``index`` at ``depth`` in a tree of ``levels`` levels of nodes."""
    if levels == 1:
        return np.zeros_like(index)
    upper = levels // 2
    if depth < upper:
        return place(upper, depth, index)
    below = ARITY ** (depth - upper)
    return size(upper) + index // below * size(levels - upper) + place(levels - upper, depth - upper, index % below)


@lru_cache(maxsize=64)
def places(height: int, level: int) -> np.ndarray:
    """Places of all nodes ``level`` steps above the leaves of a tree of ``height``."""
    return place(height + 1, height - level, np.arange(ARITY ** (height - level)))


def height_of(leaves: int) -> int:
    """Levels of edges above that many leaves."""
    height = 0
    while ARITY ** height < leaves:
        height += 1
    return height


def joined(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def counts(leaves: int, height: int) -> list[int]:
    """Nodes on each level, from the leaves up."""
    return [-(-leaves // ARITY ** level) for level in range(height + 1)]


def built(leaves: list[bytes], height: int) -> bytes:
    """The block over ``leaves`` in van Emde Boas order; places without a node are zero."""
    nodes = np.zeros((size(height + 1), 32), np.uint8)
    nodes[places(height, 0)[:len(leaves)]] = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, 32)
    for level, count in enumerate(counts(len(leaves), height)[:-1]):
        row = nodes[places(height, level)[:count]].tobytes().hex()
        parents = [hashlib.sha256(row[i:i + 64 * ARITY].encode()).digest() for i in range(0, len(row), 64 * ARITY)]
        nodes[places(height, level + 1)[:len(parents)]] = np.frombuffer(b"".join(parents), np.uint8).reshape(-1, 32)
    return nodes.tobytes()


def siblings(nodes: bytes, leaves: int, height: int) -> list[tuple[list[str], list[str], list[str]]]:
    """For each level, from the leaves up to below the root: the nodes, and what stands left and right of each in its run."""
    grid, levels = np.frombuffer(nodes, np.uint8).reshape(-1, 32), []
    for level, count in enumerate(counts(leaves, height)[:-1]):
        row = grid[places(height, level)[:count]].tobytes().hex()
        runs = [row[i:i + 64 * ARITY] for i in range(0, len(row), 64 * ARITY)]
        at = [(runs[j // ARITY], j % ARITY * 64) for j in range(count)]
        levels.append(([run[k:k + 64] for run, k in at], [run[:k] for run, k in at], [run[k + 64:] for run, k in at]))
    return levels


def ways(nodes: bytes, leaves: int, height: int, lefts: list[str], rights: list[str]) -> Iterator[tuple[str, list[str], list[str]]]:
    """(digest, lefts, rights) of each leaf of a block whose root goes on by ``lefts`` and ``rights``."""
    levels = siblings(nodes, leaves, height)
    own = levels[0][0] if levels else [nodes[:32].hex()]
    for j in range(leaves):
        at = [j // ARITY ** level for level in range(height)]
        yield own[j], [levels[k][1][i] for k, i in enumerate(at)] + lefts, [levels[k][2][i] for k, i in enumerate(at)] + rights


def folded(leaf: str, lefts: list[str], rights: list[str]) -> str:
    for left, right in zip(lefts, rights):
        leaf = hashlib.sha256((left + leaf + right).encode()).hexdigest()
    return leaf


def leaf_of(*columns: Column) -> Column:
    """Hex digest of columns: "-" for a null one, else its UTF-8 bytes' count, a colon and itself."""
    texts = [column.cast("string") for column in columns]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]).cast("binary"), 256)


def blocks(leaves: DataFrame, most: int) -> DataFrame:
    """The blocks of at most ``most`` levels over (tree, position, total, digest, doc_id, claim): one row each, position being the block's."""
    limit = ARITY ** most

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        total, tree = table.column("total")[0].as_py(), table.column("tree")[0].as_py()
        height = min(most, height_of(total))
        nodes = built(table.column("digest").to_pylist(), height)
        return pa.table({
            "tree": pa.array([tree], pa.string()), "position": pa.array([table.column("position")[0].as_py() // limit], pa.int64()),
            "total": pa.array([total], pa.int64()), "height": pa.array([height], pa.int32()), "leaves": pa.array([table.num_rows], pa.int32()),
            "nodes": pa.array([nodes], pa.binary()), "doc_ids": pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            "claims": pa.array([table.column("claim").to_pylist()], pa.list_(pa.binary()))})

    block = F.floor(F.col("position") / limit)
    placed = leaves.select("tree", "position", "total", "digest", "doc_id", "claim", block.alias("block"))
    return materialize(placed.groupBy("tree", "block").applyInArrow(build, BLOCK), "merkle-blocks")


def tiers(leaves: DataFrame, most: int) -> list[DataFrame]:
    """The blocks of all tiers, from the leaves up; the roots of the blocks of one tier are the leaves of the next."""
    made, limit = [blocks(leaves, most)], ARITY ** most
    while made[-1].filter(F.col("total") > limit).limit(1).count():
        roots = made[-1].filter(F.col("total") > limit).select(
            "tree", "position", F.ceil(F.col("total") / limit).alias("total"), F.substring("nodes", 1, 32).alias("digest"),
            F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("binary").alias("claim"))
        made.append(blocks(roots, most))
    return made


def tops(made: list[DataFrame], most: int) -> DataFrame:
    """(tree, digest) of every tree."""
    top = F.col("total") <= ARITY ** most
    return reduce(DataFrame.unionByName, [tier.filter(top).select("tree", F.substring("nodes", 1, 32).alias("digest")) for tier in made])


def descend(made: list[DataFrame], most: int, above: DataFrame, each: Callable[[dict], pa.RecordBatch], schema: str) -> DataFrame:
    """``each`` on the lowest tier's blocks with the ways of their roots; ``above`` holds those of the trees' roots (WAY, position 0)."""
    below = None
    for number in range(len(made) - 1, -1, -1):
        top = made[number].filter(F.col("total") <= ARITY ** most).select(F.col("tree").alias("of"))
        known = above.join(top, F.col("tree").eqNullSafe(F.col("of")), "left_semi")
        known = known if below is None else known.unionByName(below)
        found = made[number].join(known.withColumnsRenamed({"tree": "of", "position": "at"}), F.col("tree").eqNullSafe(F.col("of")) & (F.col("position") == F.col("at")))
        found = found.select(*[c.split()[0] for c in BLOCK.split(", ")], "subroot", "root", "lefts", "rights")
        if number:
            below = materialize(found.mapInArrow(batchwise(partial(handed_on, limit=ARITY ** most)), WAY), "merkle-ways")
    return found.mapInArrow(batchwise(each), schema)


def batchwise(function: Callable[[dict], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One block at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield function({name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)})

    return run


def handed_on(row: dict, limit: int) -> pa.RecordBatch:
    """The ways of a block's leaves, which are the roots of the blocks below."""
    made = list(ways(row["nodes"], row["leaves"], row["height"], row["lefts"], row["rights"]))
    first = row["position"] * limit
    return way_rows([row["tree"]] * len(made), range(first, first + len(made)), [row["subroot"]] * len(made), row["root"], made)


def named(row: dict) -> pa.RecordBatch:
    """The ways of sources: in the tree over them a leaf is a subroot, and its claim holds the source's name."""
    made = list(ways(row["nodes"], row["leaves"], row["height"], row["lefts"], row["rights"]))
    names = [None if claim is None else claim.decode() for claim in row["claims"]]
    return way_rows(names, [0] * len(made), [digest for digest, _, _ in made], row["root"], made)


def way_rows(trees: list, positions: Iterable[int], subroots: list, root: str, made: list[tuple]) -> pa.RecordBatch:
    columns = (trees, positions, subroots, [root] * len(made), [lefts for _, lefts, _ in made], [rights for _, _, rights in made])
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in WAY.split(", ")])


def audited(row: dict) -> pa.RecordBatch:
    """Proof and folded root of each leaf of a block."""
    rows = []
    for doc_id, claim, (leaf, lefts, rights) in zip(row["doc_ids"], row["claims"], ways(row["nodes"], row["leaves"], row["height"], row["lefts"], row["rights"])):
        proof = hashlib.sha256("".join(a + b for a, b in zip(lefts, rights)).encode()).hexdigest()
        end = folded(claim.hex() if claim else leaf, lefts, rights)
        rows.append((doc_id, leaf, row["subroot"], row["root"], proof, end, end == row["root"]))
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in AUDIT.split(", ")])


@dataclass(frozen=True)
class Manifest:
    """The tiers of the sources' trees and of the tree over them, each a written table of blocks."""

    sources: list[DataFrame]
    whole: list[DataFrame]
    height: int

    def subroots(self) -> DataFrame:
        """(tree, digest): each source's root; a null source is a tree like others."""
        return tops(self.sources, self.height)

    def root(self) -> DataFrame:
        """(digest) of the dataset; no row for an empty one."""
        return tops(self.whole, self.height).select("digest")

    def audit(self) -> DataFrame:
        """Every row's leaf, its way up, and whether what was claimed of it leads to the root (columns: ``AUDIT``)."""
        start = self.root().select(F.lit(None).cast("string").alias("tree"), F.lit(0).cast("bigint").alias("position"), F.lit(None).cast("string").alias("subroot"),
                                   F.lower(F.hex("digest")).alias("root"), F.array().cast("array<string>").alias("lefts"), F.array().cast("array<string>").alias("rights"))
        of_sources = descend(self.whole, self.height, start, named, WAY)
        return descend(self.sources, self.height, materialize(of_sources, "merkle-ways"), audited, AUDIT)


def manifest(df: DataFrame, claimed: Column | None = None, height: int = HEIGHT) -> Manifest:
    """Trees over (doc_id, source, lang, n_chars, text); other columns are left out.

    Leaves stand by rising doc_id within their source, null ones first, rows of
    one id by their leaf; equal rows are leaves of their own. ``claimed`` is an
    expression for the text that somebody claims a row to have, by default its
    text; ``Manifest.audit`` judges it. An empty table has no tree.
    """
    rows = pick(df, **FIELDS)
    others = [F.col(name) for name in FIELDS if name != "text"]
    leaf = F.unhex(leaf_of(*others, F.col("text")))
    if claimed is None:
        claim = F.lit(None).cast("binary")
    else:
        claim = F.when(claimed.eqNullSafe(F.col("text")), None).otherwise(F.unhex(leaf_of(*others, claimed)))
    leaves = materialize(rows.select("source", "doc_id", leaf.alias("digest"), claim.alias("claim")), "leaves")
    sources = tiers(in_order(leaves, F.col("source"), F.col("doc_id"), F.col("digest")), height)
    roots = tops(sources, height).select(F.col("tree").alias("name"), "digest", F.lit(None).cast("bigint").alias("doc_id"), F.col("tree").cast("binary").alias("claim"))
    return Manifest(sources, tiers(in_order(materialize(roots, "subroots"), F.lit(None).cast("string"), F.col("name")), height), height)
