"""Repair of conversations against all edit scripts and against a plain automaton."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from trackspark.llm import conversations as cv
from trackspark.llm import queries as q

NEXT = {"^": "u", "s": "u", "u": "a", "a": "u"}


def by_states(turns):
    """Cheapest (cost, audit) by a pass over the states of the grammar."""
    now = {"^": (0, "")}

    def insert(now):
        for _ in range(2):
            for state, (cost, audit) in list(now.items()):
                to, value = NEXT[state], (cost + 3, audit + "I")
                now[to] = min(now.get(to, value), value)
        return now

    for turn in turns:
        after = {}

        def reach(state, value):
            after[state] = min(after.get(state, value), value)

        for state, (cost, audit) in insert(now).items():
            reach(state, (cost + 4, audit + "D"))
            if turn != "D":
                kind, short, to = turn.lower(), 3 * turn.isupper(), NEXT[state]
                reach(to, (cost + short + (0 if kind == to else 3), audit + ("K" if kind == to else "R")))
                if state == "^" and kind == "s":
                    reach("s", (cost + short, audit + "K"))
        now = after
    now = insert(now)
    return min(now[s] for s in "^a" if s in now)


def by_all_scripts(turns, longest):
    """The same by trying every string of edits."""
    best = None
    for n in range(longest + 1):
        for script in itertools.product("DIKR", repeat=n):
            left, roles, cost = list(turns), "", 0
            for edit in script:
                expected = "u" if not roles or roles[-1] in "sa" else "a"
                if edit == "I":
                    roles, cost = roles + expected, cost + 3
                    continue
                if not left:
                    break
                turn = left.pop(0)
                if edit == "D":
                    cost += 4
                    continue
                if turn == "D":
                    break
                cost += 3 * turn.isupper() + 3 * (edit == "R")
                roles += turn.lower() if edit == "K" else expected
            else:
                if not left and re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, "".join(script)) < best):
                    best = cost, "".join(script)
    return best


def test_every_short_conversation_against_all_scripts():
    for n in range(4):
        for turns in itertools.product("suaAxD", repeat=n):
            assert cv.best_script([cv.align("".join(turns))] if turns else []) == by_all_scripts("".join(turns), n + 2), turns


@pytest.mark.parametrize("piece", [1, 3, 16])
def test_pieces_together_are_the_whole(piece):
    r = random.Random(piece)
    for n in (5, 17, 60):
        for _ in range(25):
            turns = "".join(r.choice("suauaUAxDS") for _ in range(n))
            assert cv.best_script([cv.align(turns[i:i + piece]) for i in range(0, n, piece)]) == by_states(turns)


def plain(rows):
    """The contract for the damaged rows of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, letters, count = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    for i, (turn, role, text) in enumerate(rows):
        shown = text.strip(" \t\n\x0b\x0c\r")
        bad = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
        seen.add((role, text))
        letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
        letters += "D" if bad in ("blank", "duplicate") else letter.upper() if bad else letter
        if bad:
            count[bad] += 1
        if i and rows[i - 1][1][:1] + role[:1] not in ("su", "ua", "au"):
            count["illegal"] += 1
    turns = {r[0] for r in rows} - {None}
    cost, audit = by_states(letters)
    left, out = iter(rows), []
    for edit in audit:
        expected = "user" if not out or out[-1][0][:1] in ("s", "a") else "assistant"
        if edit == "I":
            out.append((expected, ""))
            continue
        _, role, text = next(left)
        if edit != "D":
            out.append((role if edit == "K" else expected, text))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *count.values(), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()), out


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            out += [(conv, (turn, "user" if fault == 4 else role, text))] * (2 if fault == 3 else 1)
    return out


@pytest.fixture(scope="module")
def turns():
    r = random.Random(7)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(r.choice([1, 2, 5, 9])):
            role = ("user", "assistant")[turn % 2] if r.random() < 0.8 else r.choice(["system", "tool", "", None, "user", "Sure"])
            rows.append((conv, turn if r.random() < 0.95 else None, role, r.choice(["Yes.", "No!", "Why? ", f"Turn {turn}.", "cut", " \n", None, "é."])))
    rows += [(1000, i, ("user", "assistant")[i % 2], f"Said {i % 90}.") for i in range(400)]  # crosses pieces and ranges
    dropped = next(c for c in itertools.count(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(dropped, 0, "user", "Never seen.")]
    rows += [(1001, 3, "user", "Same row.")] * 4 + [(1002, None, None, None)] * 2
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def folder(spark, turns, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("turns"))
    df = spark.createDataFrame([(*t, "k", 1, 2) for t in turns], f"{SCHEMA}, kind string, part int, copy int")
    df.repartition(3).write.parquet(f"{d}/conversations.parquet")
    return d


def test_op12(spark, folder, turns):
    got = {r.conv_id: tuple(r)[1:] for r in q.op12_conversations(spark, folder).collect()}
    groups = {t[0]: [] for t in turns}
    for conv, row in damage(turns):
        groups[conv].append(row)
    assert got == {conv: plain(rows)[0] for conv, rows in groups.items()}
    assert any(not rows for rows in groups.values()) and got[1002][0] == 0


def test_sql_agrees(spark, folder):
    duckdb = pytest.importorskip("duckdb")
    from trackspark.llm.oracles import oracle_sql

    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{folder}/conversations.parquet/*.parquet')")
    df = q.op12_conversations(spark, folder)
    want = con.execute(f"select {', '.join(df.columns)} from ({oracle_sql()['op12_conversations']})").fetchall()
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))


def test_repaired_turns_follow_the_grammar(spark, turns):
    rows = [(c, *r) for c, r in damage(turns)]
    out = cv.repaired_turns(spark.createDataFrame(rows, SCHEMA)).collect()
    groups = {}
    for r in sorted(out, key=lambda r: r.position):
        groups.setdefault(r.conv_id, []).append((r.role, r.text))
    for conv, kept in groups.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in kept))
        assert kept == plain([r for c, r in damage(turns) if c == conv])[1]
