"""Archives: members, ids, files, segments; what is amiss raises."""

from __future__ import annotations

import gzip
import re
from collections import Counter
from pathlib import Path

import pytest

from trackspark.llm import warc

PAGES = [(1, "u", "a" * 40_000), (1, "u", "a" * 40_000), (2, "u", "a" * 40_000), (2, None, "a" * 40_000), (2, "u", "b" * 99), (None, "u", "a" * 40_000),
         (None, "u", None), (None, "u", None), (3, "u\r\nx", "é" * 30_000), (4, "u", ""), (5, "u", "c" * 1200), (None, "u", "c" * 1200)]


@pytest.fixture()
def archive(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("Number", warc.F.lit(1)).withColumn("digest", warc.F.lit("x"))
    df.repartition(3).write.parquet(f"file://{tmp_path}/pages")
    warc.write_archives(spark.read.parquet(f"file://{tmp_path}/pages"), f"file://{tmp_path}/a", file_bytes=60_000)
    return tmp_path / "a"


def test_repeated_pages_come_back_as_often_as_they_occur(spark, archive):
    got = Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archives(spark, f"file://{archive}").collect())
    assert got == Counter([(1, "revisit", 2, 40_000), (1, "revisit", 2, 40_000), (2, "response", None, 40_000), (2, "response", None, 40_000),
                           (2, "response", None, 99), (None, "revisit", 2, 40_000), (None, "response", None, 0), (None, "response", None, 0),
                           (3, "response", None, 60_000), (4, "response", None, 0), (5, "response", None, 1200), (None, "revisit", 5, 1200)])


def test_files_are_bounded_members_with_ids_of_their_own(archive):
    ids, origins, refers = [], set(), set()
    for path in Path(archive).glob("part-*"):
        data = path.read_bytes()
        members = list(warc.members(data))
        # any gzip reader sees the same
        assert gzip.decompress(data) == b"".join(members) and len(b"".join(members)) <= 60_000
        for member in members:
            ((headers, _),) = warc.cut_records(member)
            ids.append(headers["warc-record-id"])
            origins.add(headers.get("warc-segment-origin-id"))
            refers.add(headers.get("warc-refers-to"))
    assert len(ids) == len(set(ids)) and (origins | refers) - {None} <= set(ids)
    assert len(list(Path(archive).glob("part-*"))) > 3


def test_plain_files_and_several_records_in_a_member_are_read(spark, archive, tmp_path):
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(archive).glob("part-*")))
    for name, data in (("plain", whole), ("one", gzip.compress(whole))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.warc").write_bytes(data)
        assert warc.read_archives(spark, f"file://{tmp_path}/{name}").count() == len(PAGES)


@pytest.mark.parametrize("change", [
    lambda d: re.sub(rb"WARC-Segment-Number: 2\r\n", b"WARC-Segment-Number: 5\r\n", d),
    lambda d: re.sub(rb"WARC-Segment-Total-Length: \d", b"WARC-Segment-Total-Length: 9", d),
    lambda d: re.sub(rb"sha1:\w", b"sha1:z", d),
    lambda d: d.replace(b"\r\n4b0\r\n", b"\r\n4b1\r\n"),
    lambda d: d[:-9],
    lambda d: b"junk" + d,
])
def test_what_is_amiss_raises(spark, archive, tmp_path, change):
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(archive).glob("part-*")))
    (tmp_path / "bad").mkdir()
    assert change(whole) != whole
    (tmp_path / "bad" / "x.warc").write_bytes(change(whole))
    with pytest.raises(Exception, match="ValueError"):
        warc.read_archives(spark, f"file://{tmp_path}/bad").collect()


def test_a_member_that_ends_early_raises():
    member = warc._member(b"x" * 5000) + b"\0"
    assert list(warc.members(member)) == [b"x" * 5000 + b"\r\n\r\n"]
    with pytest.raises(ValueError):
        list(warc.members(member[:-12]))
