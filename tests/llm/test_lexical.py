"""Ranked search against a plain count of terms."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

pytest.importorskip("ahocorasick")
from trackspark.llm import lexical  # noqa: E402
from trackspark.llm import queries as q  # noqa: E402

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
R = random.Random(4)
WORDS = ["red", "redder", "a", "b2", "é", "日本", "sea", "see", "zoo", "Red"]


def text(n):
    return R.choice([" ", "-", "\n"]).join(R.choice(WORDS) for _ in range(n))


DOCS = [(i, text(R.randrange(1, 60))) for i in range(80)] + [(100, None), (101, ""), (102, "!!! --"), (103, "red"), (104, "red"), (103, "red"), (None, "red"),
                                                             (105, "other words " * 3000 + "sea")]
ITEMS = [("i1", "red SEA, sea"), ("i2", None), ("i3", "..."), ("i4", "nowhere"), (None, "zoo é"), ("i5", "b2"), ("i5", "日本"), ("i5", "b2"), ("i6", "Red/redder")]


def terms(t):
    return re.findall(TERM, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def expected():
    docs = [(d, Counter(terms(t))) for d, t in DOCS]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    total, df = sum(n for *_, n in docs), Counter(w for _, c, _ in docs for w in c)
    items = {}
    for item, t in set(ITEMS):
        items.setdefault(item, Counter()).update(terms(t))
    out = set()
    for item, wanted in items.items():
        scored = []
        for d, c, n in docs:
            m = 100 - 75 + (75 * n * len(docs)) // total
            score = sum(times * math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 8 * m))
                        for w, times in wanted.items())
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        out |= {(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored)[:10])}
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("search"))
    spark.createDataFrame([(*r, "t", 1, 2) for r in DOCS], "doc_id long, text string, item string, score int, rank int").repartition(4).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(*r, 5, 1) for r in ITEMS], "item_id string, text string, doc_id int, salt int").write.parquet(f"{d}/benchmark.parquet")
    return d


def rows(df):
    out = [tuple(r) for r in df.collect()]
    assert len(out) == len(set(out))
    return set(out)


def test_op13(spark, folder):
    assert rows(q.op13_lexical(spark, folder)) == expected()


def test_op13_sql_agrees(spark, folder):
    duckdb = pytest.importorskip("duckdb")
    from trackspark.llm.oracles import oracle_sql

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet/*.parquet')")
    assert set(con.execute(f"select item_id, rank, doc_id, score from ({oracle_sql()['op13_lexical']})").fetchall()) == expected()


def test_several_automata_pieces_and_integers_change_nothing(spark, folder, monkeypatch):
    monkeypatch.setattr(lexical, "BROADCAST_BYTES", 40)
    monkeypatch.setattr(lexical, "PIECE", 50)
    monkeypatch.setattr(lexical, "_EXACT", 0)
    assert rows(q.op13_lexical(spark, folder)) == expected()


def test_matches_are_whole_terms():
    found = lexical.automaton(["red", "redder"])
    n, numbers, counts = lexical.scan(found, "Red redder-red, reddest bored RED")
    assert (n, dict(zip(numbers.tolist(), counts.tolist()))) == (6, {0: 3, 1: 1})
