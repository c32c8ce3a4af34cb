"""Every registered query against its SQL on whole tables, with DuckDB as the other engine."""

from __future__ import annotations

from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
import __spark_entry__ as registered  # noqa: E402

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")

#: Queries over texts and vectors have tests of their own, as some cannot be SQL.
NAMES = [name for name in registered.queries() if name not in registered._text_parts()[0]]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(NAMES) <= registered.oracle_sql().keys() <= registered.queries().keys()


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = registered.queries()[name](spark, str(DATA))
    expected = duck.execute(registered.oracle_sql()[name])
    names = [c[0] for c in expected.description]
    want = comparable(names, expected.fetchall())
    assert comparable(df.columns, df.collect()) == want
    assert want[1]


def test_flagship(spark):
    df = registered.entry(spark)
    assert df.columns == ["DistCat", "TotalDistanceDistribution", "percentage"]
    assert sum(r.TotalDistanceDistribution for r in df.collect()) == 397
