"""WARC archives: records in segments with chunked payloads, written and read back.

A record longer than ``SEGMENT`` bytes is written as continuation records.  Reading
brings only those together, by the identifier of their origin; whole records are not
shuffled.  Archives hold a bounded number of records, so a reading task holds a bounded
amount of bytes.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.session import ship_package

SEGMENT = 32 * 1024  # bytes of a record's block in one segment
CHUNK = 8 * 1024  # bytes of a payload in one chunk of the transfer coding
RECORDS_PER_FILE = 4000  # at most 128 MB unpacked
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORD = "type string, record_id string, origin_id string, number bigint, total bigint, page_id string, refers_to string, digest string, block binary"


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id}|{digest}'.encode()).hexdigest())}>"


def _clean(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def chunked(payload: bytes) -> bytes:
    """The payload in the chunked transfer coding."""
    parts = [b"%X\r\n%s\r\n" % (len(payload[i : i + CHUNK]), payload[i : i + CHUNK]) for i in range(0, len(payload), CHUNK)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(data: bytes) -> bytes:
    """The payload of a chunked body; extensions after a size and trailers are skipped."""
    parts, at = [], 0
    while True:
        end = data.index(b"\r\n", at)
        size = int(data[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        if data[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        parts.append(data[end + 2 : end + 2 + size])
        at = end + 4 + size


def _record(kind: str, record_id: str, block: bytes, fields: dict[str, object]) -> bytes:
    """A record without its last line break, which the writer of lines adds."""
    head = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": DATE, **fields, "Content-Length": len(block)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n"


def records_of(page_id, url: str, payload: bytes, refers_to, is_revisit: bool) -> list[bytes]:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    own = _record_id(page_id, digest)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    fields = {"WARC-Target-URI": _clean(url) or None, "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http;msgtype=response", "X-Page-Id": page_id}
    if is_revisit:
        block = http + b"Content-Length: %d\r\n\r\n" % len(payload)
        return [_record("revisit", own, block, {**fields, "WARC-Profile": PROFILE, "WARC-Refers-To": _record_id(refers_to, digest), "X-Refers-To-Page-Id": refers_to})]
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= SEGMENT:
        return [_record("response", own, block, fields)]
    parts = [block[i : i + SEGMENT] for i in range(0, len(block), SEGMENT)]
    out = [_record("response", own, parts[0], {**fields, "WARC-Segment-Number": 1})]
    for k, part in enumerate(parts[1:], 2):
        name = f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{own}|{k}'.encode()).hexdigest())}>"
        total = len(block) if k == len(parts) else None
        out.append(_record("continuation", name, part, {"WARC-Segment-Origin-ID": own, "WARC-Segment-Number": k, "WARC-Segment-Total-Length": total}))
    return out


def _written(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            rows = batch.slice(at, 500).to_pydict()
            out = []
            for page_id, url, payload, refers_to, again in zip(*rows.values(), strict=True):
                out += records_of(page_id, url or "", payload or b"", refers_to, again)
            yield pa.record_batch({"record": pa.array(out, pa.binary())})


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> None:
    """Write a record for each row: of equal payloads of at least ``least`` bytes, the largest id is the response."""
    ship_package(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    last = rows.where(F.length("payload") >= least).groupBy("sha").agg(F.max("page_id").alias("last"))
    rows = rows.join(last.hint("merge"), "sha", "left")
    again = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    rows = rows.select("page_id", "url", "payload", F.when(again, F.col("last")).alias("refers_to"), again.alias("again"))
    records = rows.mapInArrow(_written, "record binary").select(F.col("record").cast("string"))
    records.write.option("lineSep", "\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse(data: bytes):
    """The records of an unpacked archive: header fields by lower-case name, and block."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no record begins at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        fields = {}
        for line in data[at:end].decode().split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        start = end + 4
        stop = start + int(fields["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield fields, data[start:stop]
        at = stop + 4


def _number(value: str | None):
    return None if value is None else int(value)


def _parsed(batches):
    names = [field.split()[0] for field in _RECORD.split(", ")]
    kinds = [pa.int64() if n in ("number", "total") else pa.binary() if n == "block" else pa.string() for n in names]

    def packed(rows):
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        for content in batch.column(0):
            rows = []
            for f, block in parse(gzip.decompress(content.as_py())):
                digest = f.get("warc-payload-digest", "").removeprefix("sha1:") or None
                rows.append((
                    f["warc-type"], f["warc-record-id"], f.get("warc-segment-origin-id"), _number(f.get("warc-segment-number")),
                    _number(f.get("warc-segment-total-length")), f.get("x-page-id"), f.get("x-refers-to-page-id"), digest, block,
                ))
                if len(rows) == 500:
                    yield packed(rows)
                    rows = []
            if rows:
                yield packed(rows)


def _decoded(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            sizes, payloads = [], []
            for kind, digest, total, blocks in zip(*(part.column(c).to_pylist() for c in ("type", "digest", "total", "blocks")), strict=True):
                block = b"".join(blocks)
                if total is not None and total != len(block):
                    raise ValueError(f"a record of {total} bytes was put together from {len(block)}")
                head, _, body = block.partition(b"\r\n\r\n")
                fields = dict(line.lower().split(b": ", 1) for line in head.split(b"\r\n")[1:])
                if kind == "revisit":
                    sizes.append(int(fields[b"content-length"]))
                    payloads.append(None)
                    continue
                payload = unchunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body
                if digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
                    raise ValueError("a payload does not have its digest")
                sizes.append(len(payload))
                payloads.append(payload)
            kept = {c: part.column(c) for c in ("page_id", "digest", "type", "refers_to")}
            yield pa.record_batch({**kept, "payload_bytes": pa.array(sizes, pa.int64()), "payload": pa.array(payloads, pa.binary())})


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, digest, type, refers_to, payload_bytes, payload``: one row for each response and revisit.

    Continuations are grouped by origin and ordered by number; a missing segment, a
    wrong total length, a broken chunk or a payload without its digest is an error.
    Segments that occur again, from repeated rows, are put together once and the record
    is repeated.  A revisit has the size and digest of the payload but not the payload.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    records = files.mapInArrow(_parsed, _RECORD)
    columns = ["page_id", "digest", "type", "refers_to", "total"]
    whole = records.where("number is null and origin_id is null").select(*columns, F.array("block").alias("blocks"))
    parts = records.where("number is not null or origin_id is not null").select(F.coalesce("origin_id", "record_id").alias("origin"), "number", *columns, "block")
    once = parts.groupBy("origin", "number").agg(F.count("*").alias("times"), *[F.any_value(c).alias(c) for c in [*columns, "block"]])
    first = {c: F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in ("page_id", "digest", "type", "refers_to", "times")}
    segments = F.array_sort(F.collect_list(F.struct("number", "block")))
    joined = once.groupBy("origin").agg(*first.values(), F.max("total").alias("total"), segments.alias("segments"))
    complete = (F.col("total").isNotNull()) & (F.element_at("segments", -1)["number"] == F.size("segments"))
    joined = joined.withColumn("blocks", F.when(complete, F.transform("segments", lambda s: s["block"])).otherwise(F.raise_error(F.concat(F.lit("a segment is missing of "), "origin"))))
    joined = joined.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*columns, "blocks")
    schema = "page_id string, digest string, type string, refers_to string, payload_bytes bigint, payload binary"
    return whole.unionByName(joined).mapInArrow(_decoded, schema)
