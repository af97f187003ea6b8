import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from loanweft.llm import role_repair
from loanweft.llm.role_repair import Parser, damaged, of_tokens, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NAMES = {"u": "user", "a": "assistant"}


def cheapest_by_trial(tokens):
    """Every edit sequence with up to two insertions a gap, judged by the pattern."""
    gaps = [""] + ["".join(x) for n in (1, 2) for x in itertools.product("ua", repeat=n)]
    best = None
    for rows in itertools.product("KuaD", repeat=len(tokens)):
        if any(t == "-" and r != "D" for t, r in zip(tokens, rows)):
            continue
        for inserts in itertools.product(gaps, repeat=len(tokens) + 1):
            letters, roles, cost = "I" * len(inserts[0]), inserts[0], 3 * len(inserts[0])
            for token, row, more in zip(tokens, rows, inserts[1:]):
                cost += {"K": 0, "D": 4}.get(row, 3) + (3 if token.endswith("!") and row != "D" else 0) + 3 * len(more)
                letters += ("R" if row in "ua" else row) + "I" * len(more)
                roles += ("" if row == "D" else token[0] if row == "K" else row) + more
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, letters) < best):
                best = (cost, letters)
    return best


def cheapest(tokens):
    """Dynamic programming over what the pattern has read: nothing, s, u, a."""
    nexts = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def put(into, state, way):
        if state not in into or way < into[state]:
            into[state] = way

    def inserted(front):
        front = dict(front)
        for _ in range(4):
            for state, (cost, audit) in list(front.items()):
                for letter in "ua":
                    if (state, letter) in nexts:
                        put(front, nexts[state, letter], (cost + 3, audit + "I"))
        return front

    front = {"": (0, "")}
    for token in tokens:
        made = {}
        for state, (cost, audit) in inserted(front).items():
            put(made, state, (cost + 4, audit + "D"))
            if token == "-":
                continue
            more = 3 if token.endswith("!") else 0
            if (state, token[0]) in nexts:
                put(made, nexts[state, token[0]], (cost + more, audit + "K"))
            for letter in "ua":
                if (state, letter) in nexts:
                    put(made, nexts[state, letter], (cost + 3 + more, audit + "R"))
        front = made
    return min(way for state, way in inserted(front).items() if state in ("", "a"))


TOKENS = ["s", "u", "a", "?", "s!", "u!", "a!", "?!", "-"]


def test_tables_against_every_edit_sequence():
    for n in range(3):
        for tokens in itertools.product(TOKENS, repeat=n):
            assert of_tokens(tokens) == cheapest_by_trial(tokens) == cheapest(tokens), tokens


def test_tables_against_dynamic_programming():
    rng = random.Random(4)
    for _ in range(1500):
        tokens = tuple(rng.choices(TOKENS, weights=[1, 4, 4, 1, 1, 2, 2, 1, 2], k=rng.randint(3, 40)))
        assert of_tokens(tokens) == cheapest(tokens), tokens


def test_other_grammars():
    turns = Parser((("talk", ("u",)), ("talk", ("talk", "a", "u"))), inserted=("u",), renamed=())
    assert len(turns.live) < 10 and turns.ends[turns.start] is False
    with pytest.raises(ValueError):
        Parser((("talk", ("u", "talk", "a")), ("talk", ())))


def by_hand(rows, every):
    made = {}
    for row in rows:
        made.setdefault(row[0], []).append(tuple(x if x is not None or i < 2 else " " for i, x in enumerate(row)))
    out = []
    for conv in {row[0] for row in every}:
        mine = sorted(made.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        tokens, counts, seen = [], {"blank": 0, "duplicate": 0, "truncated": 0}, set()
        for _, _, role, text in mine:
            plain = text.strip(" \t\n\v\f\r")
            initial = role[:1] if role[:1] in ("s", "u", "a") else "?"
            fault = "blank" if not plain else "duplicate" if (role, text) in seen else "truncated" if plain[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            tokens.append("-" if fault in ("blank", "duplicate") else initial + "!" * (fault == "truncated"))
        cost, audit = cheapest(tuple(tokens))
        lines, state, at = [], "", iter(mine)
        for letter in audit:
            role, text = ("", "") if letter == "I" else next(at)[2:]
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if state == "u" else "user"
            state = role[:1]
            lines.append(f"{role}:{'' if letter == 'I' else text}")
        turns = [r[1] for r in mine if r[1] is not None]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def damage(rows):
    made = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        made += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return made


def talk(rng, conversations, most):
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(0, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn + (turn > 3) if rng.random() < 0.95 else None, role, rng.choice(["Yes.", "No!", "maybe", "ü?  ", "\t\n", "", None, "end.\n"])))
    return rows


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("rows_per_part", [3, 1_000])
def test_conversations_against_brute_force(spark, monkeypatch, rows_per_part):
    monkeypatch.setattr(role_repair, "ROWS_PER_PART", rows_per_part)
    rng = random.Random(rows_per_part)
    rows = talk(rng, 60, 9) + [(None, None, None, None), (None, 3, "user", "hi."), (None, 3, "user", "hi."), (None, 9, "assistant", "ho.")]
    rows += [(77, None, "assistant", "a."), (77, None, "user", "b."), (78, 0, "system", "x" * 200_000)] + [(79, i // 2, "user", "same.") for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert plain(repair(damaged(df), df)) == by_hand(damage(rows), rows)
    assert plain(repair(df)) == by_hand(rows, rows)


def test_a_conversation_longer_than_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(role_repair, "ROWS_PER_PART", 5_000)
    rng = random.Random(8)
    rows = [(5, i, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Yes.", "no", f"{i}.", ""])) for i in range(16_000)] + talk(rng, 12, 6)
    df = spark.createDataFrame(rows, SCHEMA)
    assert plain(repair(df)) == by_hand(rows, rows)


def test_empty_tables_dropped_rows_and_clashing_names(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert repair(nothing).count() == 0 and repair(damaged(nothing), nothing).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "x.")], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert plain(repair(damaged(df), df)) == [(dropped, 0, 0, 0, 0, 0, 0, "", empty)]
    clash = df.withColumns({"again": F.lit(1), "key": F.lit("x"), "row": F.lit(2), "part": F.lit(3)}).select("*", F.lit("y").alias("TEXT"))
    assert plain(repair(clash)) == by_hand([(dropped, 0, "user", "x.")], [(dropped, 0, "user", "x.")])
