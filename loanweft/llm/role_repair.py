"""Repair of conversations by generalised LR parsing of their roles.

``Parser`` builds the LR(0) automaton of a role grammar. All stacks that can be
live at once are followed together: a stack is a node that names its top state
and the node below, so stacks share what they have in common, and equal stack
tops are one node. Of all ways to a node only the cheapest is kept, by (cost,
audit). Each row may be kept, rerole or be deleted, and rows may be inserted;
reductions are followed at once. For a grammar whose stacks are bounded, as
those of left-recursive ones are, the moves between nodes are found once, and a
row is then one step of a table.

``repair`` sorts the rows by conversation and turn in ranges. A task reads its
range once and finishes every conversation that lies inside it. Of the first
and the last, which may go on in other ranges, it keeps what the stretch does
from each node to each other: such tables have the form of a row's own and are
joined in order. So a conversation that holds a third of all rows is repaired
in many tasks. Only its digest, which is that of one text, is taken in one, by
reading its rows once more without holding them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweft.llm.common import materialize, parts_of, pick

ROLES = {"s": "system", "u": "user", "a": "assistant"}  # by their initials, the grammar's terminals
GRAMMAR = (("dialogue", ()), ("dialogue", ("pairs",)), ("dialogue", ("s", "pairs")), ("pairs", ("u", "a")), ("pairs", ("pairs", "u", "a")))
INSERTED = RENAMED = ("u", "a")  # roles that may be inserted, and given to a row
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs; keeping a row is free
GONE = "-"  # the token of a row that must be deleted; others are an initial (or "?") and whether the row is truncated
MOST_NODES = 1_000
ROWS_PER_PART = 100_000
HELD_ROWS, HELD_CHARS = 5_000, 4_000_000  # of one conversation and of results, at most, in a task's memory
SHORT = 64  # rows of a conversation whose repair is remembered by its tokens
BLANK, DUPLICATE, CUT, SOUND = "blank", "duplicate", "truncated", ""

Front = dict[int, tuple[int, int, tuple | None]]  # node: cost, rank of its audit among the others, audit as linked letters
Table = dict[int, list[tuple[int, int, str]]]  # node: (next node, cost, audit letters)


class Parser:
    """Nodes (stacks) of a role grammar, the moves between them, and which of them can end a conversation.

    A grammar is productions (left, right); the first one's left is what a
    conversation must be. Terminals are single letters. A grammar whose stacks
    grow without bound is refused.
    """

    def __init__(self, grammar: Sequence[tuple[str, tuple[str, ...]]] = GRAMMAR, inserted: Sequence[str] = INSERTED, renamed: Sequence[str] = RENAMED):
        self.grammar, self.names = grammar, {left for left, _ in grammar}
        self.terminals = {symbol for _, right in grammar for symbol in right} - self.names
        self.renamed = renamed
        self.states: dict[frozenset, int] = {}
        start = self.state({(-1, 0)})
        self.goto: dict[tuple[int, str], int] = {}
        items = [frozenset(self.closed({(-1, 0)}))]
        for item in items:  # grows
            for symbol in sorted({self.after(i) for i in item} - {None}):
                kernel = frozenset((p, dot + 1) for p, dot in item if self.after((p, dot)) == symbol)
                if kernel not in self.states:
                    items.append(frozenset(self.closed(kernel)))
                self.goto[self.states[self.kernel(item)], symbol] = self.state(kernel)
        self.items = {self.states[self.kernel(item)]: item for item in items}
        # a node is (state, node below); numbers name them
        self.nodes: list[tuple[int, int | None]] = []
        self.numbers: dict[tuple[int, int | None], int] = {}
        self.start = self.node(start, None)
        self.shifts: list[dict[str, int]] = []
        self.ends: list[bool] = []
        for number in self.growing():
            stacks = self.reduced(number)
            self.ends.append(any(self.accepts(s) for s in stacks))
            moves = {}
            for letter in sorted(self.terminals):
                to = {self.node(self.goto[self.nodes[s][0], letter], s) for s in stacks if (self.nodes[s][0], letter) in self.goto}
                to = {t for t in to if self.useful(t)}
                if to:
                    moves[letter] = sorted(to)
            self.shifts.append(moves)
        live = {self.start}
        while more := {t for n in live for to in self.shifts[n].values() for t in to} - live:
            live |= more
        self.live = sorted(live)  # the others are only met between reductions
        self.inserts = [self.after_inserts(number, inserted) for number in range(len(self.nodes))]
        self.tables = {initial + cut: self.table(initial, TRUNCATED if cut else 0) for initial in (*sorted(self.terminals), "?") for cut in ("", "!")}
        self.tables[GONE] = {number: [(number, DELETE, "D")] for number in range(len(self.nodes))}

    # the automaton

    def after(self, item: tuple[int, int]) -> str | None:
        production, dot = item
        right = (self.grammar[0][0],) if production < 0 else self.grammar[production][1]
        return right[dot] if dot < len(right) else None

    def closed(self, kernel: Iterable[tuple[int, int]]) -> set[tuple[int, int]]:
        items = list(kernel)
        for item in items:  # grows
            items += [(p, 0) for p, (left, _) in enumerate(self.grammar) if left == self.after(item) and (p, 0) not in items]
        return set(items)

    def kernel(self, item: Iterable[tuple[int, int]]) -> frozenset:
        return frozenset((p, dot) for p, dot in item if dot or p < 0)

    def state(self, kernel: Iterable[tuple[int, int]]) -> int:
        return self.states.setdefault(frozenset(kernel), len(self.states))

    # the stacks

    def node(self, state: int, below: int | None) -> int:
        if (state, below) not in self.numbers:
            if len(self.nodes) >= MOST_NODES:
                raise ValueError("the grammar's stacks grow without bound; make it left-recursive")
            self.numbers[state, below] = len(self.nodes)
            self.nodes.append((state, below))
        return self.numbers[state, below]

    def growing(self) -> Iterator[int]:
        number = 0
        while number < len(self.nodes):
            yield number
            number += 1

    def reduced(self, number: int) -> list[int]:
        """The node and all that reductions make of it."""
        found = [number]
        for one in found:  # grows
            for production, dot in self.items[self.nodes[one][0]]:
                if production < 0 or self.after((production, dot)) is not None:
                    continue
                base: int | None = one
                for _ in range(dot):
                    base = self.nodes[base][1]
                to = self.goto.get((self.nodes[base][0], self.grammar[production][0]))
                if to is not None and (made := self.node(to, base)) not in found:
                    found.append(made)
        return found

    def accepts(self, number: int) -> bool:
        return (-1, 1) in self.items[self.nodes[number][0]]

    def useful(self, number: int) -> bool:
        return bool(self.items[self.nodes[number][0]])

    # the moves

    def after_inserts(self, number: int, inserted: Sequence[str]) -> dict[int, int]:
        """Nodes that insertions reach, with the least number of them."""
        reached, edge = {number: 0}, [number]
        while edge:
            count = reached[edge[0]] + 1
            edge = sorted({t for n in edge for letter in inserted for t in self.shifts[n].get(letter, ()) if t not in reached})
            reached.update(dict.fromkeys(edge, count))
        return reached

    def table(self, initial: str, more: int) -> Table:
        """What a row of that initial does: insertions before it, then the row itself."""
        made: Table = {}
        for number, reached in enumerate(self.inserts):
            best: dict[int, tuple[int, str]] = {}
            for at, count in reached.items():
                moves = [(t, more, "K") for t in self.shifts[at].get(initial, ())]
                moves += [(t, RENAME + more, "R") for letter in self.renamed for t in self.shifts[at].get(letter, ())]
                for t, cost, letter in [*moves, (at, DELETE, "D")]:
                    way = (INSERT * count + cost, "I" * count + letter)
                    if t not in best or way < best[t]:
                        best[t] = way
            made[number] = [(t, *way) for t, way in sorted(best.items())]
        return made

    def last(self) -> Table:
        """The insertions after the last row that end a conversation; -1 stands for its end."""
        return {number: [(-1, INSERT * count, "I" * count) for at, count in reached.items() if self.ends[at]] for number, reached in enumerate(self.inserts)}


def step(front: Front, table: Table) -> Front:
    """All nodes one table further; of several ways to a node the cheapest, then the one whose audit is least.

    Audits of one front differ before one ends (each holds one letter for every
    row, the last letter is a row's), so their ranks and the letters added
    decide as the whole audits would.
    """
    best: dict[int, tuple[tuple[int, int, str], tuple | None]] = {}
    for node, (cost, rank, audit) in front.items():
        for to, more, letters in table[node]:
            way = (cost + more, rank, letters)
            if to not in best or way < best[to][0]:
                best[to] = (way, audit)
    if len(best) == 1:
        return {to: (way[0], 0, (audit, way[2])) for to, (way, audit) in best.items()}
    ranks = {audit: rank for rank, audit in enumerate(sorted({way[1:] for way, _ in best.values()}))}
    return {to: (way[0], ranks[way[1:]], (audit, way[2])) for to, (way, audit) in best.items()}


def letters_of(audit: tuple | None) -> str:
    parts = []
    while audit is not None:
        audit, letters = audit
        parts.append(letters)
    return "".join(reversed(parts))


@lru_cache(maxsize=1)
def parser() -> Parser:
    return Parser()


@lru_cache(maxsize=100_000)
def of_tokens(tokens: tuple[str, ...]) -> tuple[int, str]:
    """(cost, audit) of a conversation."""
    known = parser()
    front: Front = {known.start: (0, 0, None)}
    for token in tokens:
        front = step(front, known.tables[token])
    cost, _, audit = step(front, known.last())[-1]
    return cost, letters_of(audit)


class Rewriter:
    """The lines ``role:text`` of a repaired conversation, letter by letter, and their digest."""

    def __init__(self) -> None:
        self.at, self.any, self.digest = parser().start, False, hashlib.sha256()

    def take(self, letter: str, role: str = "", text: str = "") -> None:
        """Apply one letter of the audit; role and text are those of its row, if it has one."""
        if letter == "D":
            return
        moves = parser().shifts[self.at]
        if letter == "K":
            (self.at,) = moves[role[:1]]
        else:
            initial = next(i for i in INSERTED if i in moves)
            (self.at,), role = moves[initial], ROLES[initial]
        self.digest.update(("\n" * self.any + f"{role}:{text if letter != 'I' else ''}").encode())
        self.any = True


def digest_of(audit: str, rows: Iterable[tuple[str, str]]) -> str:
    """Of a whole conversation's repaired lines."""
    made, rows = Rewriter(), iter(rows)
    for letter in audit:
        made.take(letter, *(() if letter == "I" else next(rows)))
    return made.digest.hexdigest()


# faults of rows

LAST = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")


def token_of(role: str, text: str, again: bool) -> tuple[str, str]:
    """Token and fault of a row; ``again``: role and text were seen earlier."""
    found = LAST.search(text)
    if found is None:
        return GONE, BLANK
    if again:
        return GONE, DUPLICATE
    initial = role[:1] if role[:1] in ROLES else "?"
    return (initial, SOUND) if found[1] in ".!?" else (initial + "!", CUT)


# the stretches of conversations in a sorted range

FIELDS = {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}
RESULT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
COUNTED = ["blank", "duplicate", "truncated", "illegal"]
PARTIAL = (RESULT + ", part int, seq bigint, low bigint, high bigint, turns bigint, first string, last string, role string, text string, "
           "tables array<struct<node:int,ways:array<struct<to:int,cost:bigint,audit:string>>>>")
RESULT_NAMES = [column.split()[0] for column in RESULT.split(", ")]
NAMES = [column.split()[0] for column in re.sub(r"<.*>", "", PARTIAL).split(", ")]
WAY = pa.struct([("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
KINDS = {"part": pa.int32(), "tables": pa.list_(pa.struct([("node", pa.int32()), ("ways", pa.list_(WAY))])),
         **dict.fromkeys(["audit", "repaired_sha256", "first", "last", "role", "text"], pa.string())}


def batch_of(rows: list[dict], names: Sequence[str] = NAMES) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row.get(name) for row in rows], KINDS.get(name, pa.int64())) for name in names], names=names)


class Stretch:
    """The rows of one conversation in one range, read in order."""

    def __init__(self, conv_id: int | None, whole: bool):
        self.conv_id, self.whole = conv_id, whole  # whole: it can have no rows elsewhere
        self.counts = dict.fromkeys(COUNTED, 0)
        self.tokens: list[str] = []
        self.rows: list[tuple[str, str]] = []
        self.chars = 0
        self.fronts: dict[int, Front] | None = None
        self.low = self.high = None
        self.turns, self.first, self.last = 0, None, None

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        token, fault = token_of(role, text, again)
        if fault:
            self.counts[fault] += 1
        if self.last is not None and self.last + role[:1] not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.first, self.last = role[:1] if self.first is None else self.first, role[:1]
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.rows.append((role, text))
        self.chars += len(text)
        self.tokens.append(token)

    def moved(self) -> None:
        """Take the tokens met so far into the fronts, one for each node that the stretch may begin at."""
        known = parser()
        if self.fronts is None:
            self.fronts = {node: {node: (0, 0, None)} for node in known.live}
        for token in self.tokens:
            table = known.tables[token]
            self.fronts = {node: step(front, table) for node, front in self.fronts.items()}
        self.tokens = []

    def tables(self) -> list[dict]:
        self.moved()
        return [{"node": node, "ways": [{"to": to, "cost": cost, "audit": letters_of(audit)} for to, (cost, _, audit) in front.items()]}
                for node, front in self.fronts.items()]

    def result(self) -> dict:
        """Of a whole conversation."""
        tokens = tuple(self.tokens)
        cost, audit = of_tokens(tokens) if len(tokens) <= SHORT else of_tokens.__wrapped__(tokens)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv_id": self.conv_id, "gaps": gaps, **self.counts, "cost": cost, "audit": audit, "repaired_sha256": digest_of(audit, self.rows)}


def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the conversations inside a sorted range, and the rows and tables of the first and the last one."""
    part, stretch, seq, chars = TaskContext.get().partitionId(), None, 0, 0
    out: list[dict] = []

    def flush(last: bool) -> None:
        if stretch.whole and not last:
            out.append(stretch.result())
            return
        out.extend({"conv_id": stretch.conv_id, "part": part, "seq": seq + i, "role": role, "text": text} for i, (role, text) in enumerate(stretch.rows))
        if last or not stretch.whole:
            out.append({"conv_id": stretch.conv_id, "part": part, "seq": -1, **stretch.counts, "low": stretch.low, "high": stretch.high,
                        "turns": stretch.turns, "first": stretch.first, "last": stretch.last, "tables": stretch.tables()})

    for batch in batches:
        for conv_id, turn, role, text, again in zip(*(column.to_pylist() for column in batch.columns)):
            if stretch is None or conv_id != stretch.conv_id:
                if stretch is not None:
                    flush(False)
                stretch, seq = Stretch(conv_id, stretch is not None), 0
            stretch.add(turn, role, text, again)
            if len(stretch.rows) >= HELD_ROWS or stretch.chars >= HELD_CHARS:  # too long to be held: it goes on as rows and tables
                out.extend({"conv_id": conv_id, "part": part, "seq": seq + i, "role": r, "text": t} for i, (r, t) in enumerate(stretch.rows))
                chars, seq, stretch.rows, stretch.chars, stretch.whole = chars + stretch.chars, seq + len(stretch.rows), [], 0, False
                stretch.moved()
            if len(out) >= HELD_ROWS or chars >= HELD_CHARS:
                yield batch_of(out)
                out.clear()
                chars = 0
    if stretch is not None:
        flush(True)
    if out:
        yield batch_of(out)


class Joined:
    """A conversation in several stretches: first their counts and tables in order, then its rows in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.counts = conv_id, dict.fromkeys(COUNTED, 0)
        self.low = self.high = self.last = None
        self.turns, self.front = 0, {parser().start: (0, 0, None)}
        self.cost, self.audit, self.letter, self.made = 0, None, 0, Rewriter()

    def stretch(self, row: dict) -> None:
        for name in COUNTED:
            self.counts[name] += row[name]
        if self.last is not None and self.last + row["first"] not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.last = row["last"]
        if row["low"] is not None:
            self.turns += row["turns"] - (row["low"] == self.high)
            self.low, self.high = row["low"] if self.low is None else self.low, row["high"]
        self.front = step(self.front, {t["node"]: [(w["to"], w["cost"], w["audit"]) for w in t["ways"]] for t in row["tables"]})

    def row(self, role: str, text: str) -> None:
        if self.audit is None:
            self.cost, self.audit = ended(self.front)
        while self.audit[self.letter] == "I":
            self.made.take("I")
            self.letter += 1
        self.made.take(self.audit[self.letter], role, text)
        self.letter += 1

    def result(self) -> dict:
        for letter in self.audit[self.letter:]:
            self.made.take(letter)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv_id": self.conv_id, "gaps": gaps, **self.counts, "cost": self.cost, "audit": self.audit, "repaired_sha256": self.made.digest.hexdigest()}


def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the conversations in several stretches, sorted by conversation, kind, range and seq."""
    known: Joined | None = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if known is None or row["conv_id"] != known.conv_id:
                out += [known.result()] if known else []
                known = Joined(row["conv_id"])
            known.stretch(row) if row["seq"] < 0 else known.row(row["role"], row["text"])
        if out:
            yield batch_of(out, RESULT_NAMES)
    if known is not None:
        yield batch_of([known.result()], RESULT_NAMES)


def ended(front: Front) -> tuple[int, str]:
    cost, _, audit = step(front, parser().last())[-1]
    return cost, letters_of(audit)


def damaged(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults that follow from conversation and turn alone.

    The check sum of ``conv_id:turn`` modulo 20 decides: 0 drops a row, 1 empties
    its text, 2 takes its full stops, question and exclamation marks out, 3 repeats
    it, 4 makes it a user's. Nulls count as one space, in role and text too.
    """
    space = F.lit(" ")
    rows = pick(df, **FIELDS)
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    text = F.coalesce("text", space)
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce("role", space))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.filter(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def repair(df: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """The faults of every conversation of (conv_id, turn, role, text) and its cheapest repair (columns: ``RESULT``).

    Rows stand by turn, null ones first, those of one turn by role and text; a
    null role or text is one space. The first fault of a row counts: blank,
    duplicate (role and text seen earlier) or truncated. A row whose role has
    no initial of ``ROLES`` cannot be kept as it is. Rows without conv_id are
    one conversation. Conversations of ``every`` (conv_id) without rows need no
    repair. An empty table gives an empty one; other columns are left out.
    """
    blank = {name: F.coalesce(F.col(name), F.lit(" ")).alias(name) for name in ("role", "text")}
    rows = pick(df, **FIELDS).select("conv_id", "turn", blank["role"], blank["text"], F.monotonically_increasing_id().alias("row"))
    key = F.unhex(F.md5(F.concat_ws(":", F.octet_length("role"), "role", "text").cast("binary")))
    rows = materialize(rows.withColumn("key", key), "turns")
    # structs sort null turns first; equal rows of one turn are told apart by their number
    first = rows.groupBy("conv_id", "key").agg(F.min(F.struct("turn", "row")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = materialize(first.select(F.col("conv_id").alias("c"), F.col("key").alias("k"), F.col("first.row").alias("first")), "repeated-turns")
    flagged = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left")
    flagged = flagged.withColumn("again", F.coalesce(F.col("first") != F.col("row"), F.lit(False)))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("row")]
    # a range may begin anywhere in a conversation: one longer than a range is spread over several
    sorted_ = flagged.repartitionByRange(parts_of(rows, ROWS_PER_PART), *order).sortWithinPartitions(*order)
    made = materialize(sorted_.select("conv_id", "turn", "role", "text", "again").mapInArrow(ranges, PARTIAL), "stretches")
    whole = made.filter("part is null").select(*RESULT_NAMES)
    several = made.filter("part is not null").withColumn("is_row", F.col("seq") >= 0)
    joined = several.repartition(parts_of(several, ROWS_PER_PART), "conv_id").sortWithinPartitions("conv_id", "is_row", "part", "seq")
    result = whole.unionByName(joined.select(*NAMES).mapInArrow(finished, RESULT))
    if every is None:
        return result
    met = rows.select(F.col("conv_id").alias("c")).distinct()
    without = pick(every, conv_id="bigint").distinct().join(met, F.col("conv_id").eqNullSafe(F.col("c")), "left_anti")
    none = {name: F.lit("") if name == "audit" else F.sha2(F.lit("").cast("binary"), 256) if name == "repaired_sha256" else F.lit(0).cast("bigint") for name in RESULT_NAMES[1:]}
    return result.unionByName(without.select("conv_id", *[column.alias(name) for name, column in none.items()]))
