from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from tests.conftest import GOLDEN, LABELS, at, label_text, write
from trackspark.operators.intervals import REACH, attach_labels, first_label_wins, interval_index, interval_probes, map_modes
from trackspark.schemas import MODES
from trackspark.sources import EmptyLabelsError, read_labels

INTERVAL_DDL = "UserId string, StartTime timestamp, EndTime timestamp, Mode string"
START = datetime(2020, 1, 1)


def step_frame(stored, rows):
    return stored([(i, *row) for i, row in enumerate(rows)], "id int, UserId string, StepTimestamp timestamp")


def test_mode_mapping(spark):
    modes = [*MODES, "hover", "7", "", None]
    df = map_modes(spark.createDataFrame([("u", START, START, m) for m in modes], INTERVAL_DDL))
    assert [r.Label for r in df.collect()] == [*range(1, 12), None, 7, None, None]
    assert dict(df.dtypes)["Label"] == "int"


def test_golden_labels(steps, labels):
    got = attach_labels(steps, map_modes(labels))
    assert got.columns == [*steps.columns, "Label"]
    assert dict(got.dtypes)["Label"] == "int" and not got.schema["Label"].nullable
    for name, rows in GOLDEN.items():
        mine = got.where(got.TrajectoryID == name).orderBy("StepTimestamp").collect()
        assert [r.Label for r in mine] == [row[4] for row in rows]


def test_ends_are_inside_and_users_apart(spark, stored):
    second = timedelta(seconds=1)
    labels = map_modes(spark.createDataFrame([("u", START, START + 60 * second, "bus")], INTERVAL_DDL))
    times = [START - second, START, START + 60 * second, START + 61 * second]
    df = step_frame(stored, [("u", t) for t in times] + [("v", START), ("u", None)])
    assert [r.Label for r in attach_labels(df, labels).orderBy("id").collect()] == [0, 3, 3, 0, 0, 0]


def random_case(seed):
    """Short, long, equal, nested and inverted intervals; one user has most of them."""
    rng = random.Random(seed)
    users = ["hot"] * 6 + ["a", "b"]
    intervals = []
    for _ in range(60):
        start = START + timedelta(seconds=rng.randrange(400_000))
        length = rng.choice([0, 5, 600, 7200, 50_000, -10, 40_000_000 if rng.random() < 0.1 else 30])
        intervals.append((rng.choice(users), start, start + timedelta(seconds=length), rng.choice([*MODES, "hover", "7"])))
    intervals += intervals[:3]
    steps = [(rng.choice([*users, "nobody"]), START + timedelta(seconds=rng.randrange(420_000))) for _ in range(200)]
    steps += [(u, s) for u, s, _, _ in intervals[:20]] + [(u, e) for u, _, e, _ in intervals[:20]]
    return intervals, steps


def label_of(mode):
    return MODES.index(mode) + 1 if mode in MODES else int(mode) if mode.isdigit() else 0


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bin_seconds", [None, 1800])
def test_label_join_against_brute_force(stored, seed, bin_seconds):
    intervals, rows = random_case(seed)
    labels = map_modes(stored(intervals, INTERVAL_DDL))
    df = step_frame(stored, rows)
    expected_all, expected_first = [], []
    for i, (user, ts) in enumerate(rows):
        hits = sorted((s, e, -1 if label_of(m) == 0 else label_of(m)) for u, s, e, m in intervals
                      if u == user and s <= ts <= e)
        found = [max(0, h[2]) for h in hits] or [0]
        expected_all += [(i, x) for x in found]
        expected_first.append((i, found[0]))
    for overlap, expected in (("all", expected_all), ("first", expected_first)):
        got = attach_labels(df, labels, overlap, bin_seconds).select("id", "Label").collect()
        assert sorted(tuple(r) for r in got) == sorted(expected)


def test_first_label_wins_is_disjoint(stored):
    intervals, _ = random_case(5)
    labels = map_modes(stored([i for i in intervals if i[1] <= i[2]], INTERVAL_DDL))
    by_user = {}
    for r in first_label_wins(labels).collect():
        by_user.setdefault(r.UserId, []).append((r.StartTime, r.EndTime))
    for spans in by_user.values():
        spans.sort()
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


LONG_AGO, FOR_EVER = datetime(1, 1, 2), datetime(9999, 12, 30)


def compared(steps, labels):
    """Pairs of a step and a label or gap that share a bin, by user."""
    users, cut = interval_index(labels)
    probes = interval_probes(steps, users)
    pairs = probes.join(cut, (probes["UserId"] == cut["_user"]) & (probes["_level"] == cut["_label_level"])
                        & (probes["_bin"] == cut["_label_bin"]))
    return {r["UserId"]: r["count"] for r in pairs.groupBy("UserId").count().collect()}


def test_a_label_for_ever_concerns_no_other_user(stored):
    hour = timedelta(hours=1)
    rows = [(u, START + i * hour, START + i * hour + timedelta(minutes=30), "bus") for u in ("a", "b") for i in range(500)]
    df = step_frame(stored, [(u, START + i * hour + timedelta(minutes=i % 50)) for u in ("a", "b", "c") for i in range(500)])
    before = compared(df, map_modes(stored(rows, INTERVAL_DDL)))
    after = compared(df, map_modes(stored([*rows, ("c", LONG_AGO, FOR_EVER, "car")], INTERVAL_DDL)))
    assert before == {"a": before["a"], "b": before["a"]} and before["a"] <= 500 * 2 * (REACH + 1)
    assert after == before | {"c": 500}
    # even of the user's own pairs, a long label adds one for each step
    own = compared(df, map_modes(stored([*rows, ("a", LONG_AGO, FOR_EVER, "car")], INTERVAL_DDL)))
    assert own["b"] == before["b"] and own["a"] <= before["a"] + 500


def test_cut_intervals_are_bounded_whatever_their_lengths(stored):
    spans = [1, 60, 3600, 40_000, 90_000, 10 ** 6, 10 ** 8, 10 ** 10]
    rows = [(f"u{i}", START, START + timedelta(seconds=n), "bus") for i, n in enumerate(spans)]
    rows += [("v", START + timedelta(days=9 * i), START + timedelta(days=9 * i, hours=i), "bus") for i in range(40)]
    rows += [("w", LONG_AGO, FOR_EVER, "car")]
    _, cut = interval_index(map_modes(stored(rows, INTERVAL_DDL)))
    assert cut.count() <= 2 * (REACH + 1) * len(rows)


def test_labels_of_all_lengths_against_brute_force(stored):
    rng = random.Random(11)
    spans = [0, 7, 900, 6 * 3600, 3 * 86_400, 90 * 86_400, 3 * 365 * 86_400]
    intervals = [(u, s, s + timedelta(seconds=rng.choice(spans)), rng.choice(["walk", "bus", "hover"]))
                 for u in ("a", "b", "d") for s in (START + timedelta(seconds=rng.randrange(10 ** 7)) for _ in range(40))]
    intervals += [("d", LONG_AGO, START, "run"), ("a", START, FOR_EVER, "boat"), (None, START, FOR_EVER, "car")]
    rows = [(rng.choice(["a", "b", "c", "d", None]), START + timedelta(seconds=rng.randrange(-10 ** 6, 2 * 10 ** 7))) for _ in range(300)]
    rows += [(u, x) for u, s, e, _ in intervals[:60] for x in (s, e)] + [("a", None), (None, None), ("d", None)]
    df, expected = step_frame(stored, rows), []
    for i, (user, ts) in enumerate(rows):
        hits = [label_of(m) for u, s, e, m in intervals if user is not None and ts is not None and u == user and s <= ts <= e]
        expected += [(i, x) for x in hits or [0]]
    got = attach_labels(df, map_modes(stored(intervals, INTERVAL_DDL))).select("id", "Label").collect()
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_overlap_is_checked(steps, labels):
    with pytest.raises(ValueError):
        attach_labels(steps, map_modes(labels), overlap="last")


def test_read_labels(spark, tree):
    got = read_labels(spark, str(tree)).orderBy("StartTime")
    assert got.schema.simpleString() == "struct<UserId:string,StartTime:timestamp,EndTime:timestamp,Label:int>"
    assert [tuple(r) for r in got.collect()] == [
        ("000", at(s), at(e), label) for (s, e, _), label in zip(LABELS, (1, 2))]


def test_no_label_file_at_all(spark, tmp_path):
    write(tmp_path / "Data" / "u" / "Trajectory" / "a.plt", "")
    got = read_labels(spark, str(tmp_path))
    assert got.columns == ["UserId", "StartTime", "EndTime", "Label"] and got.count() == 0


@pytest.mark.parametrize("text", ["no labels here\r\n\r\n", "Start Time\tEnd Time\tTransportation Mode", ""])
def test_label_file_without_rows(spark, tree, text):
    write(tree / "Data" / "a+b %1" / "labels.txt", text)
    with pytest.raises(EmptyLabelsError, match="1 of 2 label files have no rows"):
        read_labels(spark, str(tree))
    assert read_labels(spark, str(tree), check=False).count() == 2


def test_bad_label_lines(spark, tree):
    good, bad = label_text(LABELS[:1]), "2007-04-29 08:00:00\t2007/04/29 09:00:00\tbus\r\n"
    write(tree / "Data" / "001" / "labels.txt", good + bad + "2007/04/30 08:00:00\t2007/04/30 09:00:00\tbus\r\n")
    with pytest.raises(Exception, match="bad label line in .*001/labels.txt: 2007-04-29 08:00:00"):
        read_labels(spark, str(tree)).collect()
    kept = read_labels(spark, str(tree), mode="DROPMALFORMED").where("UserId = '001'")
    assert sorted(r.Label for r in kept.collect()) == [1, 3]
    with pytest.raises(ValueError):
        read_labels(spark, str(tree), mode="PERMISSIVE")


def test_label_users_with_special_names(spark, tmp_path):
    for user in ("u+2", "a%b", "_x", "with space", ".hidden"):
        write(tmp_path / "Data" / user / "labels.txt", label_text(LABELS[:1]))
    got = {r.UserId for r in read_labels(spark, str(tmp_path)).collect()}
    assert got == {"u+2", "a%b", "_x", "with space"}


def test_label_files_a_few_at_a_time_and_opened_once(spark, tmp_path):
    users = ["a,b", "c{1}", "d", "e"]
    for user in users:
        write(tmp_path / "Data" / user / "labels.txt", label_text(LABELS[:1]))
    got = read_labels(spark, str(tmp_path), files_at_once=2)
    for user in users:
        (tmp_path / "Data" / user / "labels.txt").unlink()
    assert sorted(r.UserId for r in got.collect()) == users
    for user in users[1:]:
        write(tmp_path / "Data" / user / "labels.txt", label_text(LABELS[:1]))
    write(tmp_path / "Data" / "a,b" / "labels.txt", "no rows\r\n")
    with pytest.raises(EmptyLabelsError, match="1 of 4 label files have no rows, for example .*/a,b/labels.txt"):
        read_labels(spark, str(tmp_path), files_at_once=2)
