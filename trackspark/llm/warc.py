"""WARC archives: pages as records in segments, and their reassembly.

Writing. Every page is a record whose block is an HTTP response with the payload in chunked transfer
framing. A block longer than ``segment_bytes`` is cut: the first part keeps the record's headers and is
segment 1, the rest are ``continuation`` records that name their origin, and the last one carries the
total length. Of pages with equal payloads of ``revisit_bytes`` or more the one with the largest id is
``response``; the others are ``revisit`` records, which have HTTP headers only: they state digest and
length and refer to the response. Every record is a gzip member of its own, so a record can be read from its
offset. A member ends with its length in four bytes, the last of which is zero below 16 MB; Spark's text writer
puts that byte there as its line separator, so files are members and nothing else. A file holds at most ``FILE_BYTES`` of records.

Reading. Files are read whole, a member at a time, and cut into records by Content-Length. Complete records are decoded where they are. Parts are grouped by origin and ordered by
segment number; numbers must run from 1 to the last, and lengths must add up to the stated total. Then
chunked framing is removed, and the digest is checked. Anything amiss raises.

A NULL html is an empty payload. Record ids hold the page_id, the payload's digest and a number of the row, so rows that
repeat an id, NULL ids and repeated rows are records of their own and no group is larger than one page. They are read back as often as they occur, and
where they hold the largest id each is a response; revisits refer to one of them. Numbers come from where a row stands, so ``pages`` should be
a stored table: of one that is computed anew each time, a revisit still names page and payload it refers to, but maybe another number. An empty table gives no records. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm.common import runs, same

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
_PIECE = 32 << 10
FILE_BYTES = 32 << 20
#: room for the headers of a record, of which a file needs an estimate only
_HEAD_BYTES = 512
_END = b"\r\n\r\n"
_RECORD = "record_id string, origin string, segment int, total long, kind string, page_id long, refers_to long, digest string, block binary"
_NAMES = ["record_id", "origin", "segment", "total", "kind", "page_id", "refers_to", "digest", "block"]
_TYPES = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
_PAGE = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _chunked(payload: bytes) -> bytes:
    parts = []
    for i in range(0, len(payload), CHUNK_BYTES):
        piece = payload[i:i + CHUNK_BYTES]
        parts.append(b"%x\r\n%b\r\n" % (len(piece), piece))
    return b"".join(parts) + b"0\r\n\r\n"


def dechunk(body: bytes) -> bytes:
    """Undo chunked transfer framing; trailers are dropped, a bad size or missing end raises."""
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where it says")
        parts.append(body[at:at + size])
        at += size + 2


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def _member(record: bytes) -> bytes:
    """The record as a gzip member, less its last byte, which is zero."""
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    data = packer.compress(record + _END) + packer.flush()
    if data[-1]:
        raise ValueError(f"a record of {len(record)} bytes is too long for an archive; segments have to be shorter")
    return data[:-1]


def _name(page_id: int | None, digest: str, number: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}:{number}>"


def _page_records(page_id: int | None, url: str | None, payload: bytes, digest: str, number: int, refers_to: int | None,
                  refers_number: int | None, segment_bytes: int) -> list[bytes]:
    name = _name(page_id, digest, number)
    about = [("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A") or None), ("WARC-Date", "1970-01-01T00:00:00Z"),
             ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        head = [("WARC-Type", "revisit"), ("WARC-Record-ID", name), ("WARC-Refers-To", _name(refers_to, digest, refers_number)),
                ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), *about]
        return [_record(head, status + b"Content-Length: %d\r\n\r\n" % len(payload))]
    block = status + b"Transfer-Encoding: chunked\r\n\r\n" + _chunked(payload)
    head = [("WARC-Type", "response"), ("WARC-Record-ID", name), *about]
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        return [_record(head, block)]
    out = [_record([*head, ("WARC-Segment-Number", 1)], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        out.append(_record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{n}>"), ("WARC-Date", "1970-01-01T00:00:00Z"),
                            ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", n),
                            ("WARC-Segment-Total-Length", len(block) if n == len(parts) else None)], part))
    return out


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, revisit_bytes: int = 1000,
                   file_bytes: int = FILE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) below ``path``."""
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    made = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"), F.monotonically_increasing_id().alias("number"))
    made = made.withColumns({"digest": F.sha1("payload"), "same_as": F.when(F.octet_length("payload") >= revisit_bytes, F.sha2("payload", 256))})
    # groups of copies only; map-side combined, so a large group is one row for each task
    # the largest id is never NULL where there is another, as NULL is least
    copies = (made.where("same_as is not null").groupBy("same_as").agg(F.max(F.struct("page_id", "number")).alias("last"), F.count("*").alias("n"))
              .where("n > 1 and last.page_id is not null")
              .select(F.col("same_as").alias("copied"), F.col("last.page_id").alias("latest"), F.col("last.number").alias("latest_number")))
    later = ~same(F.col("page_id"), F.col("latest"))
    placed = made.join(copies, made["same_as"] == copies["copied"], "left").select(
        "page_id", "url", "payload", "digest", "number", F.when(later, F.col("latest")).alias("refers_to"),
        F.when(later, F.col("latest_number")).alias("refers_number"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, "payload"):
                records = [_member(x) for row in zip(*(c.to_pylist() for c in part.columns)) for x in _page_records(*row, segment_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])
    (placed.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("record"))
     .write.option("lineSep", "\0").option("maxRecordsPerFile", max(1, file_bytes // (segment_bytes + _HEAD_BYTES))).text(path))


def cut_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record."""
    at = 0
    while at < len(data):
        end = data.index(_END, at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record where one should begin: {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        begin = end + len(_END)
        at = begin + int(headers["content-length"])
        if data[at:at + len(_END)] != _END:
            raise ValueError("a record is cut short")
        yield headers, data[begin:at]
        at += len(_END)


def members(content: bytes) -> Iterator[bytes]:
    """What each gzip member of a file holds; a file that is not packed is one."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    view, at = memoryview(content), 0
    while at < len(view):
        # a member is found without copying what follows it
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            if at >= len(view):
                raise ValueError("an archive ends within a record")
            piece = view[at:at + _PIECE]
            parts.append(unpack.decompress(piece))
            at += len(piece) - len(unpack.unused_data)
        yield b"".join(parts)


def _page_of(name: str | None) -> int | None:
    page = (name or "<urn:page::>").split(":")[2]
    return int(page) if page else None


def _parse(whole: bool):
    """Records of files: only complete ones if ``whole``, else only those in segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for h, block in (record for data in members(content.as_py()) for record in cut_records(data)):
                    if ("warc-segment-number" not in h) != whole:
                        continue
                    name = h["warc-record-id"]
                    rows.append((name, h.get("warc-segment-origin-id", name), int(h.get("warc-segment-number", 1)),
                                 int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None,
                                 h["warc-type"], _page_of(name), _page_of(h.get("warc-refers-to")) if "warc-refers-to" in h else None,
                                 h.get("warc-payload-digest", "").removeprefix("sha1:") or None, block))
                    held += len(block)
                    if held > 4 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(_NAMES), _TYPES)], _NAMES)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads of whole blocks; a revisit has none, but says how long it was."""
    for batch in batches:
        rows = []
        for kind, page_id, refers_to, digest, block in zip(*(batch.column(c).to_pylist() for c in ("kind", "page_id", "refers_to", "digest", "block"))):
            head, _, body = block.partition(b"\r\n\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
            if kind == "revisit":
                rows.append((page_id, kind, refers_to, int(fields[b"content-length"]), digest, None))
                continue
            payload = dechunk(body) if fields.get(b"transfer-encoding") == b"chunked" else body
            found = hashlib.sha1(payload).hexdigest()
            if digest and found != digest:
                raise ValueError(f"page {page_id}: the payload does not have the digest of its record")
            rows.append((page_id, kind, None, len(payload), found, payload))
        names = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, types)], names)


def _joined_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks from the ordered parts of one origin; equal records in the archive stay as many as they are."""
    for batch in batches:
        rows = []
        for origin, parts in zip(batch.column("origin").to_pylist(), batch.column("parts").to_pylist()):
            copies = sum(p["segment"] == 1 for p in parts)
            ordered = parts[::copies] if copies else []
            head, last = (ordered[0], ordered[-1]) if ordered else (None, None)
            if (not ordered or [p["segment"] for p in ordered for _ in range(copies)] != [p["segment"] for p in parts]
                    or [p["segment"] for p in ordered] != list(range(1, len(ordered) + 1))):
                raise ValueError(f"{origin}: segments are missing")
            block = b"".join(p["block"] for p in ordered)
            if last["total"] != len(block):
                raise ValueError(f"{origin}: {len(block)} bytes instead of {last['total']}")
            rows += [(origin, origin, 1, len(block), head["kind"], head["page_id"], head["refers_to"], head["digest"], block)] * copies
        yield _batch(rows)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, record_type, refers_to, payload_bytes, payload_digest, payload (NULL for revisits)."""
    files = spark.read.format("binaryFile").load(path).select("content")
    parts = F.struct("segment", "total", "kind", "page_id", "refers_to", "digest", "block")
    # a group is one record; it holds its segments, which fit a task as the record does
    joined = (files.mapInArrow(_parse(False), _RECORD).groupBy("origin").agg(F.array_sort(F.collect_list(parts)).alias("parts"))
              .mapInArrow(_joined_parts, _RECORD))
    return files.mapInArrow(_parse(True), _RECORD).unionByName(joined).mapInArrow(_decode, _PAGE)
