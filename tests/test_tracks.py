from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from tests.conftest import FIRST, RUN_TS, SECOND, golden_rows, track_text, write
from trackspark.schemas import STEP_SCHEMA
from trackspark.plans import runs
from trackspark.sources import parse_track_text, read_tracks, tracks

BOTH_WAYS = pytest.mark.parametrize("whole_file_bytes", [64 << 20, 0])


def read(spark, root, **how):
    return read_tracks(spark, str(root), RUN_TS, **how)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@BOTH_WAYS
def test_golden_tracks(spark, tree, whole_file_bytes):
    got = read(spark, tree, whole_file_bytes=whole_file_bytes)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in STEP_SCHEMA]
    assert rows_of(got) == sorted(golden_rows())


@BOTH_WAYS
def test_names_and_hidden_users(spark, tmp_path, whole_file_bytes):
    names = [("u+2", "a%b"), ("_x", "1"), ("with space", "c d"), ("x=1", "p"), (".hidden", "2")]
    for user, name in names:
        write(tmp_path / "Data" / user / "Trajectory" / f"{name}.plt", track_text(FIRST[:1]))
        write(tmp_path / "Data" / user / "Trajectory" / f"{name}.txt", track_text(FIRST[:1]))
        write(tmp_path / "Data" / user / f"{name}.plt", track_text(FIRST[:1]))
    got = read(spark, tmp_path, whole_file_bytes=whole_file_bytes).select("UserId", "TrajectoryID")
    assert rows_of(got) == sorted(names[:-1])


@BOTH_WAYS
def test_header_is_skipped_by_position(spark, tmp_path, whole_file_bytes):
    # header lines that look like data, line ends of all kinds, a blank line, short and empty files
    data = track_text(FIRST, header=0).split("\r\n")[:4]
    folder = tmp_path / "Data" / "u" / "Trajectory"
    write(folder / "crlf.plt", "\r\n".join([data[0]] * 6 + data[:2] + ["", data[2]]))
    write(folder / "lf.plt", "\n".join([data[3]] * 6 + data[:1]) + "\n")
    write(folder / "head.plt", "\n".join([data[3]] * 6) + "\n")
    write(folder / "short.plt", "\n".join([data[3]] * 3))
    write(folder / "empty.plt", "")
    got = read(spark, tmp_path, whole_file_bytes=whole_file_bytes)
    assert {(r.TrajectoryID, r["count"]) for r in got.groupBy("TrajectoryID").count().collect()} == {("crlf", 3), ("lf", 1)}
    assert rows_of(got.where("TrajectoryID = 'crlf'").select("Latitude")) == sorted((r[0],) for r in FIRST[:3])


def test_one_large_file_is_split_among_tasks(spark, tmp_path):
    many = [(i / 1000, 116.0, 1.0, "2007-04-29 08:34:32", 0, 0.0) for i in range(20_000)]
    write(tmp_path / "Data" / "u" / "Trajectory" / "big.plt", track_text(many))
    for i in range(5):
        write(tmp_path / "Data" / "u" / "Trajectory" / f"s{i}.plt", track_text(SECOND))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        got = read(spark, tmp_path, whole_file_bytes=10_000)
        assert got.rdd.getNumPartitions() > 8
        counts = {r.TrajectoryID: r["count"] for r in got.groupBy("TrajectoryID").count().collect()}
        total = got.where("TrajectoryID = 'big'").agg(F.sum("Latitude")).first()[0]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert counts == {"big": 20_000, **{f"s{i}": 4 for i in range(5)}}
    assert total == pytest.approx(sum(r[0] for r in many))


@pytest.mark.parametrize("bad", [
    "39.9,116.3,0,1,39201", "x,116.3,0,1,2,2007-04-29,08:34:32", "39.9,116.3,0,1,2,2007-13-29,08:34:32",
    "39.9,116.3,0,,2,2007-04-29,08:34:32", "39.9,116.3,0,1,2,2007-04-29,08:34"])
def test_bad_lines(spark, bad):
    text = track_text(FIRST[:2]) + bad + "\r\n"
    files = spark.createDataFrame([(text, "file:/r/Data/u/Trajectory/t.plt")], "value string, path string")
    assert parse_track_text(files, mode="DROPMALFORMED").count() == 2
    with pytest.raises(PySparkException, match="bad track line in file:/r/Data/u/Trajectory/t.plt"):
        parse_track_text(files).count()
    with pytest.raises(ValueError):
        parse_track_text(files, mode="PERMISSIVE")


def test_missing_input(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_tracks(spark, str(tmp_path / "nothing"))


def test_rejected_lines_are_kept_apart(spark, tree, tmp_path):
    bad = ["north,116.3,0,1,0,2007-04-29,08:00:00", "40,east,0,1,0,2007-04-29,08:00:00", "40,116,0,high,0,2007-04-29,08:00:00",
           "40,116,0,1,0,2007-13-29,08:00:00", "40,116,0,1", "", "  "]
    write(tree / "Data" / "007" / "Trajectory" / "bad.plt", track_text([]) + "\r\n".join([*bad, "40,116,0,1,0,2007-04-29,08:00:00"]))
    rejects, out = str(tmp_path / "rejects"), str(tmp_path / "out")
    for again in (1, 2):
        counts = runs.ingest_with_rejects(spark, str(tree), out, rejects)
        assert counts == {"read": 14, "kept": 9, "rejected": 5}
        kept = spark.read.schema("File string, Line string, Reason string").json(rejects).collect()
        assert spark.read.parquet(f"{out}/geo_table.parquet").count() == 9 * again and len(kept) == 5 * again
    assert {(r.Line, r.Reason) for r in kept} == set(zip(bad[:5], ["bad latitude", "bad longitude", "bad altitude", "bad time", "too few fields"]))
    assert all(r.File.endswith("/bad.plt") for r in kept)
    assert spark.read.parquet(f"{out}/geo_table.parquet").where("Label > 0").count() == 2 * 6


def test_a_tree_without_bad_lines_rejects_none(spark, tree, tmp_path):
    counts = runs.ingest_with_rejects(spark, str(tree), str(tmp_path / "out"), str(tmp_path / "rejects"))
    assert counts == {"read": 8, "kept": 8, "rejected": 0}


def files_listed(spark):
    return spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED().getCount()


@BOTH_WAYS
def test_the_tree_is_listed_once_unless_files_are_large(spark, tmp_path, whole_file_bytes):
    for user in range(4):
        for i in range(60):
            write(tmp_path / "Data" / str(user) / "Trajectory" / f"{i}.plt", track_text(FIRST[:1]))
    before = files_listed(spark)
    df = read(spark, tmp_path, whole_file_bytes=whole_file_bytes)
    assert df.count() == 240
    assert files_listed(spark) - before == 240 * (1 if whole_file_bytes else 2)


@BOTH_WAYS
def test_users_are_read_a_few_at_a_time(spark, tmp_path, whole_file_bytes, monkeypatch):
    names = ["a,b", "c{1}", "d[e]f", "g\\h", "u+2", "_x", "with space", "plain"]
    for i, user in enumerate(names):
        for j in range(i % 3 + 1):
            write(tmp_path / "Data" / user / "Trajectory" / f"{j}.plt", track_text(FIRST))
    (tmp_path / "Data" / "empty" / "Trajectory").mkdir(parents=True)
    (tmp_path / "Data" / "none").mkdir()
    parts, load = [], tracks.track_files

    def seen(spark, folders):
        parts.append(folders)
        return load(spark, folders)

    monkeypatch.setattr(tracks, "track_files", seen)
    lines = tracks.read_track_lines(spark, str(tmp_path), whole_file_bytes, users_at_once=2)
    assert [len(p) for p in parts] == [2, 2, 2, 2, 1]
    whole = tracks.read_track_lines(spark, str(tmp_path), whole_file_bytes)
    columns = ["UserId", "TrajectoryID", "line"]
    assert rows_of(lines.select(columns)) == rows_of(whole.select(columns)) and whole.count() > 4 * len(names)
    assert {r.UserId for r in tracks.parse_track_lines(lines).collect()} == set(names)
    assert not tracks.has_large_files(spark, str(tmp_path), users_at_once=2)
    assert tracks.has_large_files(spark, str(tmp_path), 100, users_at_once=2)


def test_many_small_files_are_few_tasks(spark, tmp_path):
    for i in range(200):
        write(tmp_path / "Data" / "u" / "Trajectory" / f"{i}.plt", track_text(FIRST[:1]))
    # Spark's default cost of opening a file would make seven tasks
    assert read(spark, tmp_path).rdd.getNumPartitions() <= 4
