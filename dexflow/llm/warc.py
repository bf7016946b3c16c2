"""WARC archives: write segmented records with chunked payloads, read them back and reassemble them."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, scratch_path

NAME = b"WARC/1.1"
VERSION = NAME + b"\r\n"
END = "\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> Iterator[bytes]:
    """``payload`` in chunked transfer framing.

    A chunk also ends inside every occurrence of the version line, and inside the version's name where a chunk would
    end with it and its line break make the line, so the line never stands inside a record and a
    reader can split archives at it.
    """
    cuts = {*range(0, len(payload), size), *(m.start() + 4 for m in re.finditer(re.escape(VERSION), payload)), len(payload)}
    cuts = sorted(cuts | {c - 4 for c in cuts if payload[max(c - len(NAME), 0):c] == NAME})
    for a, b in zip(cuts, cuts[1:]):
        yield b"%x\r\n%b\r\n" % (b - a, payload[a:b])
    yield b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload inside chunked framing; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        n = int(body[at:line].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        at = line + 2 + n
        if body[at:at + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(body[line + 2:at])
        at += 2


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the two line breaks that end it (the writer puts them between records)."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return VERSION + f"{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def clean(value: str | None) -> str | None:
    """A header value: control characters, and the stop of a version's name at its end, as percent escapes."""
    return None if value is None else re.sub(r"[\x00-\x1f\x7f]|(?<=WARC/1)\.(?=1$)", lambda m: f"%{ord(m[0]):02X}", value)


def segments_of(block: bytes, size: int) -> Iterator[bytes]:
    """``block`` in pieces of ``size`` bytes, four less where the piece would end with a version's name."""
    at = 0
    while at < len(block):
        end = at + size
        end -= 4 if block[at:end].endswith(NAME) and size > 4 else 0
        yield block[at:end]
        at = end


def records_of(row: dict, salt: int, segment: int, chunk: int) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response and its continuations."""
    name = lambda i: f"<urn:uuid:{uuid.uuid5(uuid.UUID(int=salt), f'{row["row"]}/{i}')}>"
    shared = [("WARC-Date", DATE), ("WARC-Target-URI", clean(row["url"])), ("X-Page-Id", row["page_id"])]
    payload = (row["html"] or "").encode()
    about = [("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"), ("X-Payload-Length", len(payload))]
    if row["origin"] is not None:
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", name(1)), *shared, ("WARC-Profile", PROFILE),
                      ("X-Refers-To-Page-Id", row["origin"]), *about], HTTP)
        return
    block = HTTP + b"".join(chunked(payload, chunk))
    parts = list(segments_of(block, segment))
    for i, part in enumerate(parts, 1):
        many = [("WARC-Segment-Number", i)] if len(parts) > 1 else []
        if i == 1:
            yield record([("WARC-Type", "response"), ("WARC-Record-ID", name(1)), *shared, *about, *many], part)
        else:
            last = [("WARC-Segment-Total-Length", len(block))] if i == len(parts) else []
            yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", name(i)), *shared,
                          ("WARC-Segment-Origin-ID", name(1)), *many, *last], part)


def mark_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, html`` with ``origin``: the page whose equal payload this one repeats, else null.

    Payloads are equal if their SHA-256 is. Groups are combined before their
    shuffle, and pages meet them in a join that adaptive execution splits if one
    payload is very common. The smallest page_id of a group is the origin; repeated rows of that
    page are all responses. Null ids repeat the origin of their group, if it has one.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    p = pages.select("page_id", "url", "html", F.sha2(body, 256).alias("digest"))
    groups = (p.where(F.octet_length(body) >= least_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .where("n > 1 and first is not null").select("digest", "first"))
    other = F.expr("case when page_id is null or page_id <> first then first end")
    return p.join(saved(groups, "payloads"), "digest", "left").select("page_id", "url", "html", other.alias("origin"))


def in_batches(values: Iterator[tuple], schema: pa.Schema, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about ``most_bytes`` from rows whose last value is bytes."""
    rows, held = [], 0
    for v in values:
        rows.append(v)
        held += 64 + len(v[-1] or b"")
        if held >= most_bytes:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows, held = [], 0
    if rows:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def write_archives(pages: DataFrame, path: str, segment: int = 32768, chunk: int = 8192) -> None:
    """Write ``page_id, url, html, origin`` rows as WARC files (uncompressed) into the folder ``path``.

    Spark's text writer puts the two line breaks after each record that the format asks for;
    the records are bytes and pass through it unchanged.
    """
    salt = uuid.uuid4().int
    schema = pa.schema([("value", pa.binary())])

    def write(batches):
        rows = (row for batch in batches for part in range(0, batch.num_rows, 256)
                for row in batch.slice(part, 256).to_pylist())
        yield from in_batches(((r,) for row in rows for r in records_of(row, salt, segment, chunk)), schema)

    rows = pages.select("page_id", "url", "html", "origin", F.monotonically_increasing_id().alias("row"))
    (rows.mapInArrow(write, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", END).text(path))


RECORD = "id string, segment int, total long, type string, page_id long, refers_to long, digest string, length long, block binary"
RECORD_ARROW = pa.schema([("id", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("type", pa.string()),
                          ("page_id", pa.int64()), ("refers_to", pa.int64()), ("digest", pa.string()),
                          ("length", pa.int64()), ("block", pa.binary())])


def parsed(fragment: bytes) -> tuple:
    """A record's fields and block, from what stands between two version lines; ValueError if it is cut short."""
    head, _, rest = fragment.partition(b"\r\n\r\n")
    f = {k.lower(): v for k, _, v in (line.partition(": ") for line in head.decode().split("\r\n"))}
    if not {"content-length", "warc-record-id", "warc-type"} <= f.keys():
        raise ValueError(f"record {f.get('warc-record-id')}: a header is missing")
    n = int(f["content-length"])
    if rest[n:] not in (b"\r\n\r\n", b""):
        raise ValueError(f"record {f.get('warc-record-id')}: {len(rest) - 4} bytes where {n} are declared")
    number = lambda k: int(f[k]) if k in f else None
    return (f.get("warc-segment-origin-id", f["warc-record-id"]), number("warc-segment-number"),
            number("warc-segment-total-length"), f["warc-type"], number("x-page-id"), number("x-refers-to-page-id"),
            f.get("warc-payload-digest", "").removeprefix("sha1:") or None, number("x-payload-length"), rest[:n])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives in ``path``, one row each, segments apart.

    Files are split at version lines by Spark's reader, so one large archive is many
    tasks. ``write_archives`` keeps the line out of every block; an archive where it
    stands inside one raises ValueError, as its lengths do not agree.
    """
    def parse(batches):
        yield from in_batches((parsed(v.as_py()) for b in batches for v in b.column(0) if v.as_py()), RECORD_ARROW)

    lines = spark.read.option("lineSep", VERSION.decode()).text(path)
    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(parse, RECORD)


def payload_of(segments: list[dict]) -> bytes:
    """The payload of a record from its segments, in order of their numbers.

    ValueError unless the numbers run from 1 without gaps and the joined length is the
    total that the last one declares.
    """
    segments = sorted(segments, key=lambda s: s["segment"] or 1)
    block = b"".join(s["block"] for s in segments)
    if len(segments) > 1 or segments[0]["segment"]:
        if [s["segment"] for s in segments] != list(range(1, len(segments) + 1)):
            raise ValueError(f"segments of {segments[0]['id']} are missing or repeated")
        if segments[-1]["total"] != len(block):
            raise ValueError(f"{segments[0]['id']}: {len(block)} bytes, {segments[-1]['total']} declared")
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


PAGE_ARROW = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
PAGE = "page_id long, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def reassembled(segments: list[dict]) -> tuple:
    first = min(segments, key=lambda s: s["segment"] or 1)
    if first["type"] == "revisit":
        return (first["page_id"], "revisit", first["refers_to"], first["digest"], first["length"], None)
    payload = payload_of(segments)
    if first["digest"] not in (None, digest_of(payload)):
        raise ValueError(f"{first['id']}: the payload does not have the declared digest")
    return (first["page_id"], first["type"], None, digest_of(payload), len(payload), payload)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Pages from the archives in ``path``: page_id, record_type, refers_to, payload_digest, payload_bytes, payload.

    Only records in several segments are shuffled, by the identifier of the first one;
    a group is one record, so it is as large as its payload. Segments are put in order, their
    numbers, total length and payload digest are checked, chunked framing is decoded. A
    revisit has the digest and length of the full payload and no payload of its own.
    An empty folder gives no rows. ``payloads=False`` leaves the bytes out.
    """
    records = read_records(spark, path)
    fields = F.struct(*records.columns)
    parts = records.where("segment is not null").groupBy("id").agg(F.collect_list(fields).alias("segments"))
    whole = records.where("segment is null").select(F.array(fields).alias("segments"))

    def join(batches):
        rows = (reassembled(v.as_py()) for b in batches for v in b.column(0))
        yield from in_batches((r if payloads else (*r[:-1], None) for r in rows), PAGE_ARROW)

    return whole.unionByName(parts.select("segments")).mapInArrow(join, PAGE)


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write an archive of ``pages`` (page_id, url, html) to shared scratch and read it back without payload bytes."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(mark_revisits(pages, least_bytes), path)
    return read_archives(spark, path, payloads=False)
