from __future__ import annotations

from datetime import datetime

import pytest

from trackspark.schemas import STEP_SCHEMA
from trackspark.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", master="local[4]",
        **{"spark.sql.shuffle.partitions": 4, "spark.ui.enabled": "false", "spark.driver.memory": "4g",
           "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


RUN_TS = at("2007-04-29 12:34:24")

# latitude, longitude, altitude, time, label, distance in km
FIRST = [
    (39.9755666666667, 116.33035, 226.377952755906, "2007-04-29 08:34:32", 0, 0.0),
    (39.97545, 116.330233333333, 301.837270341207, "2007-04-29 08:37:00", 0, 0.016343826744769148),
    (39.9738333333333, 116.332966666667, 328.083989501312, "2007-04-29 12:34:24", 1, 0.29421713655076837),
    (39.9739, 116.332733333333, 328.083989501312, "2007-04-29 12:34:32", 1, 0.021219945729212226),
]
SECOND = [
    (28.2079666666667, 116.9131, 131.233595800525, "2007-04-29 12:37:20", 1, 0.0),
    (28.2088333333333, 116.9175, 131.233595800525, "2007-04-29 12:37:25", 1, 0.4417893098085645),
    (28.2087333333333, 116.917683333333, 131.233595800525, "2007-04-29 23:37:11", 2, 0.02112742108758325),
    (28.2055666666667, 116.91735, 141.076115485564, "2007-04-29 23:37:16", 2, 0.35362898876982113),
]
GOLDEN = {"20070429083432": FIRST, "20070502001318": SECOND}
LABELS = [("2007-04-29 12:34:24", "2007-04-29 12:53:45", "walk"),
          ("2007-04-29 22:27:11", "2007-04-30 04:28:00", "bike")]


def golden_rows() -> list[tuple]:
    return [(RUN_TS, "000", name, lat, lon, alt, at(ts)) for name, rows in GOLDEN.items()
            for lat, lon, alt, ts, _, _ in rows]


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """Write rows to Parquet and read them back, so that Spark knows the size of the input."""
    def store(rows, schema):
        path = str(tmp_path_factory.mktemp("rows") / "rows.parquet")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        return spark.read.parquet(path)
    return store


@pytest.fixture(scope="session")
def steps(stored):
    return stored(golden_rows(), STEP_SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [("000", at(s), at(e), mode) for s, e, mode in LABELS]
    return spark.createDataFrame(rows, "UserId string, StartTime timestamp, EndTime timestamp, Mode string")


def track_text(rows: list[tuple], header: int = 6) -> str:
    lines = [f"header {i}" for i in range(header)]
    for lat, lon, alt, ts, *_ in rows:
        date, time = ts.split(" ")
        lines.append(f"{lat},{lon},0,{alt},39201.35,{date},{time}")
    return "".join(f"{line}\r\n" for line in lines)


def label_text(rows: list[tuple]) -> str:
    lines = ["Start Time\tEnd Time\tTransportation Mode"]
    lines += [f"{s.replace('-', '/')}\t{e.replace('-', '/')}\t{mode}" for s, e, mode in rows]
    return "".join(f"{line}\r\n" for line in [*lines, ""])


def write(path, text: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())


@pytest.fixture
def tree(tmp_path):
    """A data folder with the golden user; its name needs URI encoding."""
    root = tmp_path / "A B 1.3"
    for name, rows in GOLDEN.items():
        write(root / "Data" / "000" / "Trajectory" / f"{name}.plt", track_text(rows))
    write(root / "Data" / "000" / "labels.txt", label_text(LABELS))
    return root
