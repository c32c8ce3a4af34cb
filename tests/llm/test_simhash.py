"""SimHash groups against all pairs, on texts and on planted fingerprints."""

from __future__ import annotations

import random

import numpy as np
import pytest

xxhash = pytest.importorskip("xxhash")
from trackspark.llm import simhash  # noqa: E402
from trackspark.llm.components import components  # noqa: E402


def plain_fingerprint(text, k=4):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    votes = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b, v in enumerate(votes) if 2 * v > len(shingles))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def groups(prints, distance=4):
    """The smallest linked fingerprint of each, by all pairs."""
    root = {p: p for p in prints}
    known = sorted(root)
    for i, a in enumerate(known):
        for b in known[i + 1:]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance:
                x, y = root[a], root[b]
                if x != y:
                    root = {p: min(x, y) if r in (x, y) else r for p, r in root.items()}
    return root


def planted(n_centres=12, near=25, seed=1):
    r, out = random.Random(seed), {0, -1, 1, 7, 1 << 40}
    for _ in range(n_centres):
        centre = r.getrandbits(64)
        for _ in range(near):
            x = centre
            for _ in range(r.randrange(7)):
                x ^= 1 << r.randrange(64)
            out.add(signed(x))
    return sorted(out)


WORDS = "alpha beta Gamma delta épsilon zeta eta theta iota kappa".split()
R = random.Random(2)
LONG = " ".join(R.choice(WORDS) for _ in range(400))
NEAR = LONG.replace("zeta", "zeta", 1) + " tail"
ROWS = [(4, LONG), (3, NEAR), (9, LONG.upper()), (5, None), (2, ""), (7, " \t\n "), (8, "one two"), (6, "One  TWO"), (None, LONG), (None, "lonely words"),
        (11, "a b c d e"), (11, "quite other words stand here now"), (12, "quite other words stand here now"), (11, "a b c d e"), (1, "x" * 5000)]


def test_texts_against_all_pairs(spark):
    docs = spark.createDataFrame([(d, t, "n", 1, 2) for d, t in ROWS], "doc_id long, text string, key string, print int, first int").repartition(3)
    rows = simhash.simhash_groups(docs).collect()
    assert sorted((r.doc_id or 0, r.fingerprint) for r in rows) == sorted((d or 0, f"{plain_fingerprint(t):016x}") for d, t in ROWS)
    root = groups([signed(plain_fingerprint(t)) for _, t in ROWS])
    home = {}  # rows of one id belong together, whatever their texts
    for d, t in ROWS:
        home.setdefault(root[signed(plain_fingerprint(t))], set()).add(d)
    merged = []
    for ids in home.values():
        known = {d for d in ids if d is not None}
        for other in [m for m in merged if m & known]:
            known |= other
            merged.remove(other)
        merged.append(known)
    for r in rows:
        if r.doc_id is not None:
            assert r.component_id == min(next(m for m in merged if r.doc_id in m))
    by_print = {r.fingerprint: r.component_id for r in rows}
    assert by_print[f"{plain_fingerprint(LONG):016x}"] in (3, 4)
    assert by_print[f"{plain_fingerprint('lonely words'):016x}"] is None
    assert {r.component_id for r in rows if r.doc_id in (2, 5, 7)} == {2}
    assert {r.component_id for r in rows if r.doc_id in (11, 12)} == {11}


@pytest.mark.parametrize("limit", [4096, 30, 6])
def test_planted_fingerprints_lose_no_link(spark, limit):
    prints = planted()
    near = simhash.links(spark.createDataFrame([(p,) for p in prints], "print long"), limit=limit)
    for a, b in near.collect():
        assert a in prints and b in prints
    got = {r.node: r.component for r in components(near).collect()}
    assert {p: got.get(p, p) for p in prints} == groups(prints)


def test_pivot_distances_never_discard_a_link():
    prints = np.array(planted(4, 40), np.int64).view(np.uint64)
    same_key = np.zeros(len(prints), np.int64)
    pairs = {(int(a), int(b)) for x, y in simhash.near_pairs(same_key, prints, simhash.references(), 4) for a, b in zip(x, y)}
    want = {(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints)) if int(prints[i] ^ prints[j]).bit_count() <= 4}
    assert pairs == want and want


def test_pivots_discard_most_pairs_of_unlike_fingerprints():
    r = np.random.default_rng(1).integers(0, 1 << 63, 400, dtype=np.uint64)
    table = simhash.distance_table(r, simhash.references()).astype(int)
    far = np.abs(table[:, :, None] - table[:, None, :]).max(axis=0) > 4
    assert far.sum() > 0.99 * (400 * 399)


def test_a_long_text_in_pieces_has_the_same_fingerprint(monkeypatch):
    want = simhash.fingerprint(LONG.encode())
    monkeypatch.setattr(simhash, "PIECE", 64)
    assert simhash.fingerprint(LONG.encode()) == want == signed(plain_fingerprint(LONG))
    assert simhash.fingerprint(b"a b") == signed(plain_fingerprint("a b"))
