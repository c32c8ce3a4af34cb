"""``spark-submit`` / ``python -m trackspark`` entry: one command per run."""

from __future__ import annotations

import argparse

from trackspark.plans import runs
from trackspark.session import build_session
from trackspark.sources.tables import GEO_TABLE
from trackspark.streaming import ingest_incremental


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="trackspark")
    top.add_argument("--master", help="Spark master; by default that of the environment")
    commands = top.add_subparsers(dest="command", required=True)

    load = commands.add_parser("ingest", help="append all tracks below a folder to the geo table")
    increment = commands.add_parser("ingest-new", help="append the tracks that have arrived since the last call")
    everything = commands.add_parser("all", help="ingest, then write the three reports")
    for sub in (load, increment, everything):
        sub.add_argument("--input_folder", required=True)
    increment.add_argument("--checkpoint", required=True)
    everything.add_argument("--checkpoint", help="ingest only what no run with this checkpoint has ingested")
    for sub in (increment, everything):
        sub.add_argument("--archive", help="where to move consumed files")

    reports = [commands.add_parser(name, help=f"write the {name} report") for name in ("length", "time-gross", "time-net")]
    for sub in (load, increment, everything):
        sub.add_argument("--output_folder", required=True)
    for sub in reports:
        sub.add_argument("--database_folder", required=True)
    for sub in (*reports, everything):
        sub.add_argument("--format", choices=["parquet", "csv"], default="parquet")
        sub.add_argument("--run_id")
    for sub in (reports[2], everything):
        sub.add_argument("--speed_mode", choices=["hours_per_km", "km_per_hour"], default=runs.SPEED_MODE)
    for sub in (load, increment, everything, *reports):
        sub.add_argument("--table", default=GEO_TABLE)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session("trackspark", args.master)
    if args.command == "ingest":
        print(runs.ingest(spark, args.input_folder, args.output_folder, args.table))
    elif args.command == "ingest-new":
        ingest_incremental(spark, args.input_folder, f"{args.output_folder}/{args.table}", args.checkpoint, args.archive)
    elif args.command == "all":
        print(runs.run_all(spark, args.input_folder, args.output_folder, args.table, args.run_id, args.format,
                           args.speed_mode, args.checkpoint, args.archive))
    else:
        how = {"table": args.table, "run_id": args.run_id, "fmt": args.format}
        if args.command == "length":
            print(runs.analyse_length_dist(spark, args.database_folder, **how))
        elif args.command == "time-gross":
            print(runs.analyse_time_gross_dist(spark, args.database_folder, **how))
        else:
            print(runs.analyse_time_net_dist(spark, args.database_folder, speed_mode=args.speed_mode, **how))


if __name__ == "__main__":
    main()
