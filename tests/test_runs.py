from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from tests.conftest import FIRST, GOLDEN, LABELS, RUN_TS, at, label_text, track_text, write
from trackspark.__main__ import main
from trackspark.operators import HotLimits
from trackspark.operators.intervals import attach_labels
from trackspark.plans import runs
from trackspark.sources import EmptyLabelsError, geo_table_sql, read_geo_table
from trackspark.sources.labels import read_labels
from trackspark.sources.tracks import parse_track_lines
from trackspark.streaming.source import arriving_lines
from trackspark.streaming import ingest_incremental

GOLDEN_LABELLED = sorted(
    ("000", name, lat, lon, alt, at(ts), label) for name, rows in GOLDEN.items() for lat, lon, alt, ts, label, _ in rows)


def labelled(df):
    return sorted(tuple(r) for r in df.drop("IngestionTime").collect())


def files_in(path):
    return [p for p in path.rglob("part-*") if p.is_file()]


def test_ingest(spark, tree, tmp_path):
    path = runs.ingest(spark, str(tree), str(tmp_path / "out"), run_ts=RUN_TS)
    table = read_geo_table(spark, str(tmp_path / "out"))
    assert path == str(tmp_path / "out" / "geo_table.parquet")
    assert table.columns == ["IngestionTime", "UserId", "TrajectoryID", "Latitude", "Longitude", "Altitude",
                             "StepTimestamp", "Label"]
    assert labelled(table) == GOLDEN_LABELLED
    assert {r[0] for r in table.select("IngestionTime").collect()} == {RUN_TS}


def test_ingest_appends_and_limits_files(spark, tree, tmp_path):
    for _ in range(2):
        runs.ingest(spark, str(tree), str(tmp_path / "out"), max_records_per_file=3)
    assert labelled(read_geo_table(spark, str(tmp_path / "out"))) == sorted(GOLDEN_LABELLED * 2)
    assert len(files_in(tmp_path / "out")) >= 6


def test_ingest_users_without_labels_or_tracks(spark, tree, tmp_path):
    write(tree / "Data" / "001" / "Trajectory" / "t.plt", track_text(FIRST))
    write(tree / "Data" / "002" / "labels.txt", label_text(LABELS))
    runs.ingest(spark, str(tree), str(tmp_path / "out"))
    got = labelled(read_geo_table(spark, str(tmp_path / "out")))
    assert [r for r in got if r[0] == "000"] == GOLDEN_LABELLED
    assert [r[-1] for r in got if r[0] == "001"] == [0] * 4 and len(got) == 12


def test_ingest_without_any_labels(spark, tmp_path):
    write(tmp_path / "in" / "Data" / "001" / "Trajectory" / "t.plt", track_text(FIRST))
    runs.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert [r[-1] for r in labelled(read_geo_table(spark, str(tmp_path / "out")))] == [0] * 4


def test_ingest_failures(spark, tree, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        runs.ingest(spark, str(tmp_path / "nothing"), str(tmp_path / "out"))
    write(tmp_path / "empty" / "Data" / "001" / "Trajectory" / "notes.txt", "no track")
    with pytest.raises(FileNotFoundError, match="no track file"):
        runs.ingest(spark, str(tmp_path / "empty"), str(tmp_path / "out"))
    write(tree / "Data" / "bad" / "labels.txt", "junk\r\n\r\n")
    with pytest.raises(EmptyLabelsError):
        runs.ingest(spark, str(tree), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_reports_on_disk(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    paths = runs.run_all(spark, str(tree), out, run_id=17)
    assert sorted(paths) == ["geo_table", "length", "time_gross", "time_net"]
    assert paths["time_net"] == f"{out}/time_net_17.parquet"
    single = {
        "length": runs.analyse_length_dist(spark, out, run_id=18, limits=HotLimits(rows=2)),
        "time_gross": runs.analyse_time_gross_dist(spark, out, run_id=18),
        "time_net": runs.analyse_time_net_dist(spark, out, run_id=18),
    }
    expected = {"length": {("<5", 2, 100.0)}, "time_gross": {("1-6", 1, 50.0), ("6-12", 1, 50.0)},
                "time_net": {("1-6", 1, 50.0), ("6-12", 1, 50.0)}}
    for name, rows in expected.items():
        for path in (paths[name], single[name]):
            assert {tuple(r) for r in spark.read.parquet(path).collect()} == rows
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        runs.analyse_time_gross_dist(spark, out, run_id=17)
    kmh = runs.analyse_time_net_dist(spark, out, run_id="kmh", fmt="csv", speed_mode="km_per_hour")
    part, = files_in(tmp_path / "out" / "time_net_kmh.csv")
    assert kmh == f"{out}/time_net_kmh.csv"
    assert sorted(part.read_text().split()) == ["1-6,1,50.0", "<1,1,50.0", "TimeCat,TimeNetDistribution,percentage"]
    with pytest.raises(ValueError):
        runs.analyse_time_gross_dist(spark, out, fmt="png")


def test_sql_over_the_view_ignores_case(spark, steps):
    got = geo_table_sql(steps, "select userid, TRAJECTORYID as t, max(altitude) as top from geo_table group by all")
    assert got.columns == ["userid", "t", "top"] and got.count() == 2


def test_incremental_ingest(spark, tree, tmp_path):
    out, state, archive = (str(tmp_path / n) for n in ("table", "state", "archive"))

    def run():
        return ingest_incremental(spark, str(tree), out, state, archive)

    assert run()
    assert labelled(spark.read.parquet(out)) == GOLDEN_LABELLED
    assert not run()
    assert labelled(spark.read.parquet(out)) == GOLDEN_LABELLED
    write(tree / "Data" / "009" / "Trajectory" / "new.plt", track_text(FIRST))
    assert run()
    got = labelled(spark.read.parquet(out))
    assert [r for r in got if r[0] == "000"] == GOLDEN_LABELLED
    assert [r[1] for r in got if r[0] == "009"] == ["new"] * 4
    # files of the first batch have been moved by the time a later one has run
    assert not list((tree / "Data" / "000" / "Trajectory").glob("*.plt"))
    assert len(list((tmp_path / "archive").rglob("*.plt"))) == 2


def test_incremental_ingest_in_bounded_batches(spark, tree, tmp_path):
    out = tmp_path / "table"
    ingest_incremental(spark, str(tree), str(out), str(tmp_path / "state"), max_files_per_trigger=1)
    assert labelled(spark.read.parquet(str(out))) == GOLDEN_LABELLED
    assert len([p for p in (out / "_spark_metadata").iterdir() if p.name.isdigit()]) == 2


def test_label_join_of_a_stream_reads_a_table_not_single_tracks(spark, tree, tmp_path):
    state = tmp_path / "state"
    ingest_incremental(spark, str(tree), str(tmp_path / "table"), str(state))
    sources = "".join(p.read_text() for p in (state / "sources").rglob("*") if p.is_file() and not p.name.startswith("."))
    assert ".parquet" in sources and ".plt" not in sources


def test_steps_of_a_call_that_failed_before_labelling_are_not_lost(spark, tree, tmp_path, monkeypatch):
    out, state = str(tmp_path / "table"), str(tmp_path / "state")

    def failing(*_):
        raise RuntimeError("no labels today")

    with monkeypatch.context() as patched:
        patched.setattr("trackspark.streaming.incremental.attach_labels", failing)
        with pytest.raises(RuntimeError, match="today"):
            ingest_incremental(spark, str(tree), out, state)
    assert ingest_incremental(spark, str(tree), out, state)
    assert labelled(spark.read.parquet(out)) == GOLDEN_LABELLED
    assert not ingest_incremental(spark, str(tree), out, state)


def test_checkpoint_of_a_single_stream_goes_on(spark, tree, tmp_path):
    out, state = str(tmp_path / "table"), str(tmp_path / "state")
    once = attach_labels(parse_track_lines(arriving_lines(spark, str(tree))), read_labels(spark, str(tree)))
    once.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
    assert not ingest_incremental(spark, str(tree), out, state)
    write(tree / "Data" / "009" / "Trajectory" / "new.plt", track_text(FIRST))
    assert ingest_incremental(spark, str(tree), out, state)
    got = labelled(spark.read.parquet(out))
    assert [r for r in got if r[0] == "000"] == GOLDEN_LABELLED and len([r for r in got if r[0] == "009"]) == 4


def test_run_with_a_checkpoint_can_be_repeated(spark, tree, tmp_path):
    out, state, archive = (str(tmp_path / n) for n in ("out", "state", "archive"))
    paths = [runs.run_all(spark, str(tree), out, run_id=i, checkpoint=state, archive=archive) for i in (1, 2)]
    assert labelled(read_geo_table(spark, out)) == GOLDEN_LABELLED
    for name in ("length", "time_gross", "time_net"):
        first, second = ({tuple(r) for r in spark.read.parquet(p[name]).collect()} for p in paths)
        assert first == second
    with pytest.raises(ValueError, match="checkpoint"):
        runs.run_all(spark, str(tree), out, archive=archive)


def test_incremental_table_is_kept_apart(spark, tree, tmp_path):
    path = runs.ingest(spark, str(tree), str(tmp_path / "out"))
    with pytest.raises(ValueError, match="path of its own"):
        ingest_incremental(spark, str(tree), path, str(tmp_path / "state"))


def test_batch_run_refuses_an_incremental_table(spark, tree, tmp_path):
    ingest_incremental(spark, str(tree), str(tmp_path / "out" / "geo_table.parquet"), str(tmp_path / "state"))
    with pytest.raises(ValueError, match="incremental"):
        runs.ingest(spark, str(tree), str(tmp_path / "out"))


def test_commands(spark, tree, tmp_path, capsys):
    out = str(tmp_path / "out")
    main(["ingest", "--input_folder", str(tree), "--output_folder", out])
    assert labelled(read_geo_table(spark, out)) == GOLDEN_LABELLED
    main(["time-net", "--database_folder", out, "--run_id", "5", "--speed_mode", "km_per_hour", "--format", "csv"])
    assert capsys.readouterr().out.split()[-1] == f"{out}/time_net_5.csv"
    main(["ingest-new", "--input_folder", str(tree), "--output_folder", str(tmp_path / "new"),
          "--checkpoint", str(tmp_path / "state")])
    assert labelled(read_geo_table(spark, str(tmp_path / "new"))) == GOLDEN_LABELLED


def test_sql_over_two_tables_of_one_name(spark, steps):
    queries = [geo_table_sql(df, "select count(*) as n from {geo_table}") for df in (steps, steps.limit(3))]
    assert [q.first()["n"] for q in queries] == [8, 3]
    assert not spark.catalog.tableExists("geo_table") or geo_table_sql(steps, "select 1 from geo_table").count() == 8


@pytest.mark.parametrize("limit", [64 << 20, 10])
def test_arriving_files_need_python_only_if_large(spark, tree, limit):
    stream = arriving_lines(spark, str(tree), whole_file_bytes=limit)
    assert stream.isStreaming
    assert ("MapInArrow" in stream._jdf.queryExecution().analyzed().toString()) == (limit == 10)
