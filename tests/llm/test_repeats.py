"""Repeated ids and rows, clashing names, a missing library, swaps of group terms, the perfect hash."""

from __future__ import annotations

import random
import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

from trackspark.llm import lines, queries as q, toxicity
from trackspark.llm.lines import dedup_lines
from trackspark.llm.ngram_join import ngram_join
from trackspark.llm.suffixes import dedup_substrings

R = random.Random(8)
WORDS = [a + b for a in "kzmtpr" for b in ("ala", "ona", "eri", "usk")]


def text(n):
    return " ".join(R.choice(WORDS) for _ in range(n))


def test_op4_keeps_the_links_of_each_row_of_an_id(spark):
    a, b = text(200), text(200)
    rows = [(1, a), (2, a + " more"), (2, b + " more"), (3, b), (4, text(50)), (None, a), (2, None), (3, b)]
    got = {(r.doc_id, r.n_shingles > 0): r.component_id
           for r in ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, True): 1, (2, True): 1, (3, True): 1, (4, True): 4, (None, True): None, (2, False): 1}


def test_op10_a_repeated_row_is_no_earlier_occurrence(spark):
    shared = text(40)[:140]
    first, second = text(60) + shared, text(60) + shared + text(60)
    for copies in (1, 2, 3):
        rows = [(1, first)] + [(5, second)] * copies
        got = dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {r.n_removed for r in got if r.doc_id == 5} == {sum(r.n_removed for r in got if r.doc_id == 5) // copies}
        # what is common may reach a byte or two beyond the passage
        assert all(140 <= r.n_removed < 150 for r in got if r.doc_id == 5) and all(r.n_removed == 0 for r in got if r.doc_id == 1)


def test_op7_repeated_rows_and_ids(spark):
    line = "The same line of words stands here."
    rows = [(2, f"{line}\nOwn words of the second text here.")] * 2 + [(1, line), (1, f"other {line}"), (None, line)]
    got = sorted(((r.doc_id or 0, r.kept) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == [(0, line), (1, ""), (1, f"other {line}"), (2, "Own words of the second text here."), (2, "Own words of the second text here.")]


def test_op7_units_are_those_of_the_expression():
    from trackspark.llm.words import utf8

    import pyarrow as pa

    for _ in range(400):
        texts = ["".join(R.choice("ab .!?\n\té") for _ in range(R.randrange(14))) for _ in range(4)]
        data, offsets = utf8(pa.array(texts))
        want = []
        for at, t in zip(offsets.tolist(), texts):
            for unit in re.findall(lines.UNIT, t):
                want.append(at)
                at += len(unit.encode())
        assert lines.unit_starts(data, offsets).tolist() == want


def test_op7_is_linear_in_a_text(spark):
    import time

    took = []
    for n in (20_000, 80_000):
        df = spark.createDataFrame([(1, "one and the same line again\n" * n)], "doc_id long, text string")
        start = time.perf_counter()
        (row,) = dedup_lines(df).collect()
        took.append(time.perf_counter() - start)
        assert len(row.removed) == n - 1 and row.kept == "one and the same line again\n"
    assert took[1] < 8 * took[0] + 5


def test_mixing_stage_keeps_columns_of_any_name(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(i, text(5), "s", f"n{i}", i, i) for i in range(6)],
                                 "doc_id long, text string, source string, n string, copies int, ID2 int").withColumnRenamed("ID2", "_id")
    out = corpus_pipeline.mixing_stage(spark, docs, "")
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}


def test_trajectory_queries_survive_a_missing_library():
    code = ("import sys; sys.modules['trackspark.llm.tokens'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); assert len(q) > 30 and not any(n.startswith('op') for n in q); print(len(q))")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_no_tokenizer_library_is_needed_to_register():
    code = "import sys; sys.modules['tokenizers'] = None\nimport __spark_entry__ as e; assert 'op3_token_ids' in e.queries()"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=120).returncode == 0


GROUPS = {"colour": ["green", "violet"]}


def test_the_penalty_keeps_a_score_from_hanging_on_the_group(spark):
    r = random.Random(3)
    plain = ["walk", "house", "river", "table", "window", "garden"]
    rows = []
    for i in range(900):
        toxic = i % 3 == 0
        # one group is named in toxic texts far more often
        group = "green" if r.random() < (0.8 if toxic else 0.1) else "violet"
        words = [r.choice(plain) for _ in range(8)] + [group] + (["vile"] if toxic and r.random() < 0.7 else [])
        r.shuffle(words)
        rows.append((i, " ".join(words) + ".", int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    import pyarrow as pa

    def change(model):
        pairs = [(f"walk garden green {w}", f"walk garden violet {w}") for w in plain]
        a, b = (model.score(pa.array(side)) for side in zip(*pairs))
        return float(np.abs(a - b).max())

    free = toxicity.train(docs, labels, counterfactual=0.0, groups=GROUPS)
    tied = toxicity.train(docs, labels, counterfactual=10.0, groups=GROUPS)
    assert change(free) > 0.2 and change(tied) < change(free) / 10
    vile = tied.score(pa.array(["walk vile garden violet", "walk river garden violet"]))
    assert vile[0] > 0.5 > vile[1]


@pytest.mark.parametrize("n", [1, 2, 5, 40, 700, 3000])
def test_perfect_hash_is_minimal_and_leads_to_each_key(n):
    from trackspark.llm import tokens

    keys = np.unique(np.random.default_rng(n).integers(-2 ** 62, 2 ** 62, n))
    moves, slots = tokens.minimal_perfect_hash(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    ids, sizes = np.arange(2 * len(keys)), np.full(len(keys), 2)
    shard = tokens.Shard(tokens.shard_bytes(ids, sizes, keys, np.zeros(len(keys), bool), 0, 0, 4) + tokens._SEPARATOR.encode())
    for i in (0, len(keys) // 2, len(keys) - 1):
        assert shard.get(int(keys[i])).tolist() == [2 * i, 2 * i + 1]
    absent = sum(shard.get(int(k)) is not None for k in range(50))
    assert absent == 0


def encoder(**known):
    from trackspark.llm import tokens

    pytest.importorskip("tokenizers")
    return tokens.Encoder(Path(q.tokenizer_path()).read_text(), **known)


def test_words_are_encoded_once_whatever_texts_they_come_in():
    import pyarrow as pa

    once, asked = encoder(), []
    inner = once._distinct
    once._distinct = lambda words: asked.extend(words.to_pylist()) or inner(words)
    for texts in (["House house, river;"], ["River! house$$$", None, "garden (house) 12"], ["garden house river"]):
        once.encode(pa.array(texts))
    assert len(asked) == len(set(asked)) and {"house", "river", "garden"} <= set(asked)
    # marks after plain letters make no words of their own
    assert not {"river;", "River!", "house$$$"} & set(asked)


@pytest.mark.parametrize("known", [{}, {"known_bytes": 0}, {"known_bytes": 200}])
def test_ids_are_the_tokenizers_own_with_any_marks_and_memory(known):
    import pyarrow as pa

    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    texts = [f"{w}{m} {w}{m}{n}" for w in ("tree", "\u00c9t\u00e9", "\u017dena") for m in marks for n in ("'s", "!", ",1", "<|endoftext|>", "|>")]
    texts += [None, "", " ", "tree  tree\n\ntree", "e\u0301t\u00e9= \u0338 =\u0338", "it's. it'. 's \t'll", "x" * 5000 + "...", "tree\r\ntree&&&\tx"]
    some = encoder(**known)
    for i in range(0, len(texts), 300):
        part = texts[i:i + 300]
        ids, begin = some.encode(pa.array(part, pa.string()))
        want = [[*some.full.encode(t or "", add_special_tokens=False).ids, 1] for t in part]
        assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == want


def test_the_tasks_of_a_worker_share_their_tokenizers_and_no_words():
    import pyarrow as pa

    one = encoder()
    one.encode(pa.array(["tree house, 12"]))
    two = encoder()
    assert one.full is two.full and one.plain is two.plain
    assert len(one.known) and not len(two.known)


def test_memory_of_a_worker_does_not_grow_with_its_tasks():
    import pyarrow as pa

    from trackspark.llm.common import give_back

    def held():
        give_back()
        return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024
    if not Path("/proc/self/status").exists():
        pytest.skip("no /proc here")
    text, seen = " ".join(f"w{i:x} {''.join(chr(97 + int(c)) for c in str(i * 7919))}" for i in range(40_000)), []
    for _ in range(6):
        encoder().encode(pa.array([text]))
        seen.append(held())
    assert seen[-1] - seen[1] < 10  # MB; a tokenizer of its own for each task left 5 to 7 behind
