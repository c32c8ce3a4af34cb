"""

The given tables hold no tracks, so steps, label intervals and raw files are derived from
``events`` row by row (``trackspark.plans.derived``), in Spark and in SQL alike. Sums of doubles
are rounded to six decimals, because the order of summation differs.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import trackspark
from trackspark.functions.timing import micros
from trackspark.operators.buckets import bucketize, distribution
from trackspark.operators.intervals import attach_labels, map_modes
from trackspark.operators.previous import HotLimits
from trackspark.operators.steps import calculate_distance, classify_stops, step_measures
from trackspark.plans import analyses, runs
from trackspark.plans.layout import append_bucketed
from trackspark.plans.derived import raw_labels_from_events, steps_from_events, track_texts, write_raw_files
from trackspark.schemas import LENGTH_BINS, LENGTH_NAMES, TRAJECTORY, UNKNOWN_LABEL
from trackspark.session import fresh_path, size_file_listing
from trackspark.sources.labels import read_labels
from trackspark.sources.tables import geo_table_sql
from trackspark.sources.tracks import check_track_lines, parse_track_text, read_tracks, split_track_text
from trackspark.streaming import analyse_maintained, ingest_incremental, ingest_maintained, maintained_steps

# Python workers get the few functions they run with the task, so the package need not be
# installed where they start.
cloudpickle.register_pickle_by_value(trackspark)

SMOKE_DIR = "/root/testdata/sf0.001"

# of a table with a hot trajectory, groups above this share of all rows are split
SPLIT_SHARE = 50

BUCKETS = 16

ORDER_BINS = [float("-inf"), 1000.0, 50_000.0, 150_000.0, float("inf")]
ORDER_NAMES = ["<1000", "1000-50000", "50000-150000", ">=150000"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # results depend on the session time zone; everything here is meant in UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps_from_events(_table(spark, sf_dir, "events"))


def _hot_steps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, HotLimits]:
    """The steps of every third user as one trajectory, those of each other user as one, and limits that split the first."""
    user = F.col("UserId")
    hot = _steps(spark, sf_dir).withColumns({
        "UserId": F.when(user.cast("bigint") % 3 == 0, F.lit("hot")).otherwise(user), "TrajectoryID": F.lit("all")})
    return hot, HotLimits(rows=max(1, hot.count() // SPLIT_SHARE))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_modes(raw_labels_from_events(_table(spark, sf_dir, "events")))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _step_fields(df: DataFrame) -> DataFrame:
    """Parsed steps in comparable form: times as epoch seconds, no run time."""
    seconds = F.unix_timestamp("StepTimestamp").alias("StepSeconds")
    label = ["Label"] if "Label" in df.columns else []
    return df.select(*TRAJECTORY, "Latitude", "Longitude", "Altitude", seconds, *label)


def _step_distance(steps: DataFrame, limits: HotLimits | None = None) -> DataFrame:
    measured = calculate_distance(steps, limits=limits)
    return _rounded(measured, "Distance").select(
        "event_id", *TRAJECTORY, "PrevLatitude", "PrevLongitude", "Distance")


def _step_hours(spark: SparkSession, d: str) -> DataFrame:
    measured = classify_stops(step_measures(_steps(spark, d)))
    return _rounded(measured, "StepTimestampDiff", "Speed").select(
        "event_id", "StepTimestampDiff", "Speed", "SpeedCat")


def _net_hours(spark: SparkSession, d: str, mode: str) -> DataFrame:
    return _rounded(analyses.trajectory_net_hours(_steps(spark, d), mode), "StepTimestampDiff")


def _summary(steps: DataFrame, limits: HotLimits | None = None) -> DataFrame:
    return _rounded(analyses.trajectory_summary(steps, limits=limits), "TotalDistance", "StepTimestampDiff")


def _label_counts(spark: SparkSession, d: str) -> DataFrame:
    labelled = attach_labels(_steps(spark, d), _labels(spark, d))
    return labelled.groupBy("Label").agg(F.count("*").alias("Steps"))


def _merged_rows(spark: SparkSession, d: str, overlap: str) -> DataFrame:
    return attach_labels(_steps(spark, d), _labels(spark, d), overlap).select(
        "event_id", "UserId", micros(F.col("StepTimestamp")).alias("StepMicros"), "Label")


def _mixed_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of half a minute to two years."""
    events = _table(spark, d, "events")
    n = F.col("event_id") % 40
    seconds = F.when(n == 0, 63_072_000).when(n == 1, 3_456_000).when(n == 2, 259_200).when(n < 10, 21_600).otherwise(30)
    start = F.col("ts").cast("timestamp")
    end = F.timestamp_micros(micros(start) + seconds.cast("bigint") * 1_000_000)
    return events.select(F.col("user_id").cast("string").alias("UserId"), start.alias("StartTime"), end.alias("EndTime"),
                         (F.col("event_id") % 11 + 1).cast("int").alias("Label"))


def _merged_mixed(spark: SparkSession, d: str) -> DataFrame:
    return attach_labels(_steps(spark, d), _mixed_labels(spark, d)).groupBy("event_id").agg(
        F.count("*").alias("n_labels"), F.sum("Label").alias("label_sum"), F.max("Label").alias("last_label"))


def _bucket_order_price(spark: SparkSession, d: str) -> DataFrame:
    orders = _table(spark, d, "orders").select("o_totalprice")
    return distribution(bucketize(orders, ORDER_BINS, ORDER_NAMES, "o_totalprice", "PriceCat"), "PriceCat", "Orders")


def _geo_table_sql(spark: SparkSession, d: str) -> DataFrame:
    # lower-case names on purpose: SQL finds the columns of the view without regard to case
    return geo_table_sql(_steps(spark, d), """
        select userid as user_id, trajectoryid as trajectory_id, latitude, longitude,
               unix_micros(steptimestamp) as step_micros from {geo_table}""")


def _mode_labels(spark: SparkSession, d: str) -> DataFrame:
    return _labels(spark, d).select(
        "UserId", micros(F.col("StartTime")).alias("StartMicros"), micros(F.col("EndTime")).alias("EndMicros"),
        F.coalesce("Label", F.lit(UNKNOWN_LABEL)).alias("Label"))


def _raw_files(spark: SparkSession, d: str) -> str:
    size_file_listing(spark)
    events = _table(spark, d, "events")
    root = fresh_path(spark, "raw")
    write_raw_files(steps_from_events(events), raw_labels_from_events(events), root)
    return root


def _read_tracks(spark: SparkSession, d: str, **how: int) -> DataFrame:
    return _step_fields(read_tracks(spark, _raw_files(spark, d), **how))


def _damaged_texts(steps: DataFrame) -> DataFrame:
    """Track files of one line each, of which three in ten cannot be read."""
    kind = F.col("event_id") % 10
    whole = r"^(?s)(.*\r\n)([^,\r\n]*),([^\r\n]*)\r\n$"
    return track_texts(steps.where(kind > 2)).unionByName(
        track_texts(steps.where(kind == 0)).withColumn("value", F.regexp_replace("value", whole, "$1north,$3\r\n"))).unionByName(
        track_texts(steps.where(kind == 1)).withColumn("value", F.regexp_replace("value", whole, "$1$2,116\r\n"))).unionByName(
        track_texts(steps.where(kind == 2)).withColumn("value", F.regexp_replace("value", r",(\d{4})-", ",$1/")))


def _parse_rejected(spark: SparkSession, d: str) -> DataFrame:
    checked = check_track_lines(split_track_text(_damaged_texts(_steps(spark, d))))
    return checked.groupBy(*TRAJECTORY, F.coalesce("Reason", F.lit("kept")).alias("Reason")).agg(F.count("*").alias("Lines"))


def _read_labels(spark: SparkSession, d: str) -> DataFrame:
    labels = read_labels(spark, _raw_files(spark, d))
    return labels.select("UserId", F.unix_timestamp("StartTime").alias("StartSeconds"),
                         F.unix_timestamp("EndTime").alias("EndSeconds"),
                         F.coalesce("Label", F.lit(UNKNOWN_LABEL)).alias("Label"))


def _ingest_batch(spark: SparkSession, d: str) -> DataFrame:
    return _step_fields(spark.read.parquet(runs.ingest(spark, _raw_files(spark, d), fresh_path(spark, "table"))))


def _ingest_stream(spark: SparkSession, d: str) -> DataFrame:
    root, out, state = _raw_files(spark, d), fresh_path(spark, "table"), fresh_path(spark, "state")
    for _ in range(2):  # the second call must add nothing
        ingest_incremental(spark, root, out, state)
    return _step_fields(spark.read.parquet(out))


def _stored_reports(spark: SparkSession, d: str, fmt: str) -> dict[str, str]:
    folder = fresh_path(spark, "reports")
    _steps(spark, d).drop("event_id").write.parquet(f"{folder}/geo_table.parquet")
    return runs.analyse_all(spark, folder, run_id=1, fmt=fmt)


def _pipeline_twice(spark: SparkSession, d: str) -> DataFrame:
    """The whole run twice over the same input, the second time with files archived: reports of the second."""
    size_file_listing(spark)
    root, out, state = _raw_files(spark, d), fresh_path(spark, "out"), fresh_path(spark, "state")
    archive = fresh_path(spark, "archive")
    for run_id in (1, 2):
        paths = runs.run_all(spark, root, out, run_id=run_id, checkpoint=state, archive=archive)
    return _report_rows(spark, {name: path for name, path in paths.items() if name != "geo_table"}, "parquet")


def _ingest_archive(spark: SparkSession, d: str) -> DataFrame:
    """Tracks that came in two parts, consumed files being moved away in between."""
    size_file_listing(spark)
    events = _table(spark, d, "events")
    steps, labels = steps_from_events(events), raw_labels_from_events(events)
    root, out, state = fresh_path(spark, "raw"), fresh_path(spark, "table"), fresh_path(spark, "state")
    archive = fresh_path(spark, "archive")
    half = F.pmod(F.xxhash64(*TRAJECTORY), F.lit(2)) == 0
    for part, known in ((steps.where(half), labels), (steps.where(~half), labels.limit(0))):
        write_raw_files(part, known, root)
        ingest_incremental(spark, root, out, state, archive)
    return _step_fields(spark.read.parquet(out))


def _ingest_with(spark: SparkSession, d: str, labelled: str) -> DataFrame:
    """Batch ingestion where only the users for whom ``labelled`` holds have a label file."""
    size_file_listing(spark)
    events = _table(spark, d, "events")
    root = fresh_path(spark, "raw")
    write_raw_files(steps_from_events(events), raw_labels_from_events(events.where(labelled)), root)
    return _step_fields(spark.read.parquet(runs.ingest(spark, root, fresh_path(spark, "table"))))


def _bucket_edges(spark: SparkSession, d: str) -> DataFrame:
    """Values on, below and outside the edges of the length buckets, NULL and NaN, by event."""
    n = F.col("event_id") % 10
    value = F.element_at(F.array(*[F.lit(x).cast("double") for x in (-1.0, 0.0, 4.999, 5.0, 20.0, 99.99, 100.0, float("inf"), float("nan"), None)]),
                         n.cast("int") + 1)
    named = bucketize(_table(spark, d, "events").select("event_id", value.alias("value")), LENGTH_BINS, LENGTH_NAMES, "value", "DistCat")
    return named.select("event_id", "DistCat")


def _step_speed_kmh(spark: SparkSession, d: str) -> DataFrame:
    measured = classify_stops(step_measures(_steps(spark, d)), "km_per_hour")
    return _rounded(measured, "Speed").select("event_id", "Speed", "SpeedCat")


def _two_increments(spark: SparkSession, d: str, late: bool) -> str:
    """A store after two increments of half the tracks each; with ``late``, odd users' labels come with the second."""
    size_file_listing(spark)
    events = _table(spark, d, "events")
    steps, labels = steps_from_events(events), raw_labels_from_events(events)
    root, store = fresh_path(spark, "raw"), fresh_path(spark, "store")
    half = F.pmod(F.xxhash64(*TRAJECTORY), F.lit(2)) == 0
    first = labels.where("cast(UserId as bigint) % 2 = 0") if late else labels
    for part, known in ((steps.where(half), first), (steps.where(~half), labels if late else labels.limit(0))):
        write_raw_files(part, known, root)
        ingest_maintained(spark, root, store)
    return store


def _reports_after_increments(spark: SparkSession, d: str) -> DataFrame:
    paths = analyse_maintained(spark, _two_increments(spark, d, False), fresh_path(spark, "reports"), 1)
    return _report_rows(spark, paths, "parquet")


def _bucketed_reports(spark: SparkSession, d: str) -> DataFrame:
    """The reports from a bucketed table that was appended to once."""
    folder = fresh_path(spark, "reports")
    steps = _steps(spark, d).drop("event_id")
    for part in (0, 1):
        append_bucketed(steps.where(F.pmod(F.xxhash64(*TRAJECTORY), F.lit(2)) == part), f"{folder}/geo_table.parquet", BUCKETS)
    return _report_rows(spark, runs.analyse_all(spark, folder, run_id=1), "parquet")


def _stored_report_rows(spark: SparkSession, d: str, fmt: str) -> DataFrame:
    return _report_rows(spark, _stored_reports(spark, d, fmt), fmt)


def _report_rows(spark: SparkSession, paths: dict[str, str], fmt: str) -> DataFrame:
    schema = "category string, n bigint, percentage double"
    reader = spark.read.option("header", True).schema(schema) if fmt == "csv" else spark.read
    rows = [reader.format(fmt).load(path).toDF("category", "n", "percentage").withColumn("report", F.lit(name))
            for name, path in paths.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _text_parts() -> tuple[dict, dict]:
    """Queries and SQL of the subpackage for text and vectors, if it is there."""
    try:
        import corpus_pipeline
        from trackspark.llm import oracles
        from trackspark.llm import queries as text_queries
    except ImportError as missing:
        # the folders may have been left out, or a library that they need; the other queries do without
        print(f"queries over texts and vectors are left out: {missing}", file=sys.stderr)
        return {}, {}

    cloudpickle.register_pickle_by_value(corpus_pipeline)
    sql = oracles.oracle_sql()
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return text_queries.queries() | {"pipeline": corpus_pipeline.run}, sql


def entry(spark: SparkSession) -> DataFrame:
    return analyses.length_distribution(_steps(spark, SMOKE_DIR))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "length_dist": lambda s, d: analyses.length_distribution(_steps(s, d)),
        "time_gross_dist": lambda s, d: analyses.gross_time_distribution(_steps(s, d)),
        "time_net_dist_ref": lambda s, d: analyses.net_time_distribution(_steps(s, d), "hours_per_km"),
        "time_net_dist_kmh": lambda s, d: analyses.net_time_distribution(_steps(s, d), "km_per_hour"),
        "label_counts": _label_counts,
        "parse_tracks": lambda s, d: _step_fields(parse_track_text(track_texts(_steps(s, d)))),
        "parse_tracks_rejected": _parse_rejected,
        "step_distance": lambda s, d: _step_distance(_steps(s, d)),
        "step_distance_split": lambda s, d: _step_distance(*_hot_steps(s, d)),
        "step_hours": _step_hours,
        "trajectory_length": lambda s, d: _rounded(analyses.trajectory_length(_steps(s, d)), "TotalDistance"),
        "trajectory_gross_hours": lambda s, d: analyses.trajectory_gross_hours(_steps(s, d)),
        "trajectory_net_hours_ref": lambda s, d: _net_hours(s, d, "hours_per_km"),
        "trajectory_net_hours_kmh": lambda s, d: _net_hours(s, d, "km_per_hour"),
        "trajectory_summary": lambda s, d: _summary(_steps(s, d)),
        "trajectory_summary_split": lambda s, d: _summary(*_hot_steps(s, d)),
        "segment_summary": lambda s, d: _rounded(analyses.trajectory_totals(_steps(s, d)), "TotalDistance", "StepTimestampDiff"),
        "segment_summary_hot": lambda s, d: _rounded(
            analyses.trajectory_totals(_hot_steps(s, d)[0]), "TotalDistance", "StepTimestampDiff"),
        "stop_share": lambda s, d: analyses.stop_share(_steps(s, d)),
        "stop_share_kmh": lambda s, d: analyses.stop_share(_steps(s, d), "km_per_hour"),
        "bucket_order_price": _bucket_order_price,
        "chart_table": lambda s, d: analyses.chart_table(
            analyses.length_distribution(_steps(s, d)), "DistCat", "TotalDistanceDistribution"),
        "mode_labels": _mode_labels,
        "merge_labels_rows": lambda s, d: _merged_rows(s, d, "all"),
        "merge_labels_first": lambda s, d: _merged_rows(s, d, "first"),
        "merge_labels_mixed": _merged_mixed,
        "geo_table_sql": _geo_table_sql,
        "read_tracks": _read_tracks,
        "read_tracks_by_line": lambda s, d: _read_tracks(s, d, whole_file_bytes=0),
        "read_labels": _read_labels,
        "ingest_batch": _ingest_batch,
        "ingest_stream": _ingest_stream,
        "stored_reports_parquet": lambda s, d: _stored_report_rows(s, d, "parquet"),
        "stored_reports_csv": lambda s, d: _stored_report_rows(s, d, "csv"),
        "stored_reports_bucketed": _bucketed_reports,
        "pipeline_twice": _pipeline_twice,
        "ingest_archive": _ingest_archive,
        "ingest_no_labels": lambda s, d: _ingest_with(s, d, "false"),
        "label_some_users": lambda s, d: _ingest_with(s, d, "user_id % 3 = 0"),
        "bucket_edges": _bucket_edges,
        "step_speed_kmh": _step_speed_kmh,
        "reports_after_increments": _reports_after_increments,
        "relabel_late": lambda s, d: _step_fields(maintained_steps(s, _two_increments(s, d, True))),
    } | _text_parts()[0]


# ---- SQL equivalents -------------------------------------------------------------------------

_STEPS = """
t as (select event_id, cast(user_id as varchar) as UserId, strftime(ts, '%Y%m%d') as TrajectoryID,
             39 + value / 1000 as Latitude, 116 + (event_id % 100) / 100 as Longitude,
             value as Altitude, ts as StepTimestamp from events)"""

_MEASURES = _STEPS + """,
l as (select *, lag(Latitude) over w as PrevLatitude, lag(Longitude) over w as PrevLongitude,
             lag(StepTimestamp) over w as PrevTimestamp
      from t window w as (partition by UserId, TrajectoryID order by StepTimestamp, Latitude, Longitude)),
a as (select *, pow(sin(radians(Latitude - PrevLatitude) / 2), 2)
                + cos(radians(PrevLatitude)) * cos(radians(Latitude))
                  * pow(sin(radians(Longitude - PrevLongitude) / 2), 2) as h,
             date_diff('microsecond', PrevTimestamp, StepTimestamp) / 1e6 / 60 / 60 as elapsed from l),
m as (select *, coalesce(atan2(sqrt(h), sqrt(1 - h)) * 12742, 0) as Distance from a),
s as (select *, coalesce(elapsed / nullif(Distance, 0), 0) as hours_per_km,
             coalesce(Distance / nullif(elapsed, 0), 0) as km_per_hour from m)"""

_LENGTHS = "select UserId, TrajectoryID, sum(Distance) as TotalDistance from s group by all"
_GROSS = """select UserId, TrajectoryID,
    (floor(epoch(max(StepTimestamp))) - floor(epoch(min(StepTimestamp)))) / 60 / 60 as TimeDiffHours
    from t group by all"""
_NET = """select UserId, TrajectoryID, sum(coalesce(elapsed, 0)) as StepTimestampDiff
    from s where {mode} >= 0.05 group by all"""

_TIME_CASE = "case when {v} < 1 then '<1' when {v} < 6 then '1-6' when {v} < 12 then '6-12' else '>=12' end"
_LENGTH_CASE = "case when {v} < 5 then '<5' when {v} < 20 then '5-20' when {v} < 100 then '20-100' else '>=100' end"

_LABELS = """
i as (select cast(user_id as varchar) as UserId, ts as StartTime, ts + interval 6 hours as EndTime,
             (['walk', 'bike', 'bus', 'car', 'subway', 'train', 'airplane', 'boat', 'run', 'motorcycle', 'taxi',
               'hover', '7'])[event_id % 13 + 1] as Mode
      from events),
b as (select UserId, StartTime, EndTime, cast(coalesce(
             nullif(list_position(['walk', 'bike', 'bus', 'car', 'subway', 'train', 'airplane', 'boat', 'run',
                                   'motorcycle', 'taxi'], Mode), 0),
             try_cast(Mode as int)) as int) as Label from i)"""

_JOINED = """
j as (select t.event_id, t.UserId, epoch_us(t.StepTimestamp) as StepMicros, b.StartTime, b.EndTime,
             cast(coalesce(b.Label, 0) as int) as Label, b.Label as raw_label
      from t left join b on t.UserId = b.UserId and t.StepTimestamp between b.StartTime and b.EndTime)"""

# what survives a round trip through the text formats: times are cut to whole seconds there
_FILE_STEPS = "select UserId, TrajectoryID, Latitude, Longitude, Altitude, cast(floor(epoch(StepTimestamp)) as bigint) as StepSeconds"
_FILE_LABELLED = f"""with {_STEPS}, {_LABELS},
    p as ({_FILE_STEPS} from t),
    q as (select UserId, cast(floor(epoch(StartTime)) as bigint) as s0,
                 cast(floor(epoch(EndTime)) as bigint) as s1, Label from b)
    select p.*, cast(coalesce(q.Label, 0) as int) as Label
    from p left join q on p.UserId = q.UserId and p.StepSeconds between q.s0 and q.s1"""


def _dist(ctes: str, source: str, case: str, cat: str, count: str) -> str:
    return f"""with {ctes}, g as ({source}), c as (select {case} as "{cat}" from g)
        select "{cat}", count(*) as "{count}", 100 * count(*) / sum(count(*)) over () as percentage
        from c group by 1"""


def _stop_share_sql(mode: str) -> str:
    return _dist(_MEASURES, f"select {mode} as v from s", "case when v < 0.05 then 'stop' else 'not-stop' end",
                 "SpeedCat", "StepDistribution")


def oracle_sql() -> dict[str, str]:
    length = _dist(_MEASURES, _LENGTHS, _LENGTH_CASE.format(v="TotalDistance"), "DistCat", "TotalDistanceDistribution")
    gross = _dist(_STEPS, _GROSS, _TIME_CASE.format(v="TimeDiffHours"), "TimeCat", "TimeGrossDistribution")
    net = {mode: _dist(_MEASURES, _NET.format(mode=mode), _TIME_CASE.format(v="StepTimestampDiff"),
                       "TimeCat", "TimeNetDistribution") for mode in ("hours_per_km", "km_per_hour")}
    net_hours = {mode: f"""with {_MEASURES}, g as ({_NET.format(mode=mode)})
        select UserId, TrajectoryID, round(StepTimestampDiff, 6) as StepTimestampDiff from g""" for mode in net}
    hot_measures = _MEASURES.replace(
        "cast(user_id as varchar) as UserId, strftime(ts, '%Y%m%d') as TrajectoryID",
        "case when user_id % 3 = 0 then 'hot' else cast(user_id as varchar) end as UserId, 'all' as TrajectoryID")
    step_distance = f"""with {{}} select event_id, UserId, TrajectoryID, PrevLatitude, PrevLongitude,
        round(Distance, 6) as Distance from s"""
    summary = f"""with {{}} select UserId, TrajectoryID, round(sum(Distance), 6) as TotalDistance,
        (floor(epoch(max(StepTimestamp))) - floor(epoch(min(StepTimestamp)))) / 60 / 60 as TimeDiffHours,
        round(sum(elapsed) filter (where hours_per_km >= 0.05), 6) as StepTimestampDiff from s group by 1, 2"""
    reports = " union all ".join(
        f"""select '{name}' as report, * from (select "{cat}" as category, "{count}" as n, percentage from ({sql}))"""
        for name, cat, count, sql in (
            ("length", "DistCat", "TotalDistanceDistribution", length),
            ("time_gross", "TimeCat", "TimeGrossDistribution", gross),
            ("time_net", "TimeCat", "TimeNetDistribution", net["hours_per_km"])))
    # what goes through raw files has whole seconds only
    file_reports = reports.replace("ts as StepTimestamp from events", "date_trunc('second', ts) as StepTimestamp from events")
    parsed = f"with {_STEPS} {_FILE_STEPS} from t"
    return {
        "length_dist": length,
        "time_gross_dist": gross,
        "time_net_dist_ref": net["hours_per_km"],
        "time_net_dist_kmh": net["km_per_hour"],
        "label_counts": f'with {_STEPS}, {_LABELS}, {_JOINED} select Label, count(*) as "Steps" from j group by 1',
        "parse_tracks": parsed,
        "parse_tracks_rejected": f"""with {_STEPS} select UserId, TrajectoryID, case event_id % 10 when 0 then 'bad latitude'
            when 1 then 'too few fields' when 2 then 'bad time' else 'kept' end as "Reason", count(*) as "Lines" from t group by all""",
        "step_distance": step_distance.format(_MEASURES),
        "step_distance_split": step_distance.format(hot_measures),
        "step_hours": f"""with {_MEASURES} select event_id, round(coalesce(elapsed, 0), 6) as StepTimestampDiff,
            round(hours_per_km, 6) as Speed,
            case when hours_per_km < 0.05 then 'stop' else 'not-stop' end as SpeedCat from s""",
        "trajectory_length": f"""with {_MEASURES}, g as ({_LENGTHS})
            select UserId, TrajectoryID, round(TotalDistance, 6) as TotalDistance from g""",
        "trajectory_gross_hours": f"with {_STEPS} {_GROSS}",
        "trajectory_net_hours_ref": net_hours["hours_per_km"],
        "trajectory_net_hours_kmh": net_hours["km_per_hour"],
        "trajectory_summary": summary.format(_MEASURES),
        "trajectory_summary_split": summary.format(hot_measures),
        "segment_summary": summary.format(_MEASURES),
        "segment_summary_hot": summary.format(hot_measures),
        "stop_share": _stop_share_sql("hours_per_km"),
        "stop_share_kmh": _stop_share_sql("km_per_hour"),
        "bucket_order_price": _dist(
            "o as (select o_totalprice as v from orders)", "select v from o",
            "case when v < 1000 then '<1000' when v < 50000 then '1000-50000' "
            "when v < 150000 then '50000-150000' else '>=150000' end", "PriceCat", "Orders"),
        "chart_table": f"""with d as (select "DistCat" as c, "TotalDistanceDistribution" as n from ({length})),
            e as (select *, cast(sum(n) over () as bigint) as total from d),
            k as (select *, (2000 * n + total) // (2 * total) as tenths from e)
            select c as "Slice", n / total as "Share",
                   cast(tenths // 10 as varchar) || '.' || cast(tenths % 10 as varchar) || '%' as "PercentLabel"
            from k""",
        "mode_labels": f"""with {_LABELS} select UserId, epoch_us(StartTime) as StartMicros,
            epoch_us(EndTime) as EndMicros, coalesce(Label, 0) as Label from b""",
        "merge_labels_rows": f"""with {_STEPS}, {_LABELS}, {_JOINED}
            select event_id, UserId, StepMicros, Label from j""",
        "merge_labels_first": f"""with {_STEPS}, {_LABELS}, {_JOINED}
            select event_id, UserId, StepMicros, Label from j
            qualify row_number() over (partition by event_id order by StartTime, EndTime, raw_label nulls first) = 1""",
        "merge_labels_mixed": f"""with {_STEPS},
            b as (select cast(user_id as varchar) as UserId, ts as StartTime, event_id % 11 + 1 as Label,
                         ts + to_seconds(case when event_id % 40 = 0 then 63072000 when event_id % 40 = 1 then 3456000
                              when event_id % 40 = 2 then 259200 when event_id % 40 < 10 then 21600 else 30 end) as EndTime from events)
            select event_id, count(*) as n_labels, cast(sum(coalesce(b.Label, 0)) as bigint) as label_sum,
                   cast(max(coalesce(b.Label, 0)) as int) as last_label
            from t left join b on t.UserId = b.UserId and t.StepTimestamp between b.StartTime and b.EndTime group by 1""",
        "geo_table_sql": f"""with {_STEPS} select UserId as user_id, TrajectoryID as trajectory_id,
            Latitude as latitude, Longitude as longitude, epoch_us(StepTimestamp) as step_micros from t""",
        "read_tracks": parsed,
        "read_tracks_by_line": parsed,
        "read_labels": f"""with {_LABELS} select UserId, cast(floor(epoch(StartTime)) as bigint) as StartSeconds,
            cast(floor(epoch(EndTime)) as bigint) as EndSeconds, coalesce(Label, 0) as Label from b""",
        "ingest_batch": _FILE_LABELLED,
        "ingest_stream": _FILE_LABELLED,
        "stored_reports_parquet": reports,
        "stored_reports_csv": reports,
        "stored_reports_bucketed": reports,
        "pipeline_twice": file_reports,
        "ingest_archive": _FILE_LABELLED,
        "ingest_no_labels": f"with {_STEPS}, p as ({_FILE_STEPS} from t) select p.*, cast(0 as int) as Label from p",
        "label_some_users": _FILE_LABELLED.replace("as bigint) as s1, Label from b", "as bigint) as s1, Label from b where cast(UserId as bigint) % 3 = 0"),
        "bucket_edges": """select event_id, case event_id % 10 when 1 then '<5' when 2 then '<5' when 3 then '5-20' when 4 then '20-100'
            when 5 then '20-100' when 6 then '>=100' when 7 then '>=100' end as "DistCat" from events""",
        "step_speed_kmh": f"""with {_MEASURES} select event_id, round(km_per_hour, 6) as Speed,
            case when km_per_hour < 0.05 then 'stop' else 'not-stop' end as SpeedCat from s""",
        "reports_after_increments": file_reports,
        "relabel_late": _FILE_LABELLED,
    } | _text_parts()[1]
