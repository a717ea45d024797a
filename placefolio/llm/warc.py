"""WARC archives written by Spark and read back with segment reassembly.

A page becomes an HTTP response with chunked transfer framing inside a WARC record. A block longer than ``segment_bytes`` is
split into a first record and ``continuation`` records that name it as their origin. Reading groups the continuation records
by origin, orders them by segment number, checks the total length and takes the chunked framing off again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from placefolio.llm.common import text_of
from placefolio.operators.hot_keys import hot_keys, spread_join
from placefolio.session import staged

SEGMENT_BYTES = 8192
CHUNK_BYTES = 4096
# Payloads shorter than this are always stored whole.
LEAST_SHARED = 100
# Records per file. A file is read by one task.
FILE_RECORDS = 20_000
_VERSION = b"WARC/1.1\r\n"
_DATE = b"2024-01-01T00:00:00Z"
_END = b"\r\n\r\n"

_RECORDS = ("page_id long, uri string, record_type string, refers_to long, record_digest string, record_id string, "
            "segment int, total long, block binary, payload binary, error string")
_PAGES = "page_id long, uri string, record_type string, refers_to long, record_digest string, payload binary, error string"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[i:i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Body without chunked framing; raises ``ValueError`` if the framing is broken or ends early."""
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk size is missing")
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(parts)
        if len(body) < at + size + 2 or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut short")
        parts.append(body[at:at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("HTTP head does not end")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _record(headers: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    # A line break inside a value would start another header.
    lines = [name + b": " + value.replace(b"\r", b"%0D").replace(b"\n", b"%0A") for name, value in headers]
    return _VERSION + b"\r\n".join([*lines, b"Content-Length: %d" % len(block)]) + b"\r\n\r\n" + block


def _records_of(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, name: str,
                segment_bytes: int) -> Iterator[bytes]:
    ident = b"<urn:page:%s>" % name.encode()
    headers = [(b"WARC-Type", b"revisit" if revisit else b"response"), (b"WARC-Record-ID", ident),
               (b"WARC-Date", _DATE), (b"Content-Type", b"application/http;msgtype=response"),
               (b"WARC-Payload-Digest", b"sha256:" + digest.encode())]
    if page_id is not None:
        headers.append((b"X-Page-ID", b"%d" % page_id))
    if url is not None:
        headers.append((b"WARC-Target-URI", url.encode()))
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if revisit:
        profile = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        more = [(b"WARC-Profile", profile), (b"WARC-Refers-To", b"<urn:page:%d>" % refers_to)]
        yield _record(headers + more, head + b"\r\n")
        return
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        yield _record(headers, block)
        return
    yield _record([*headers, (b"WARC-Segment-Number", b"1")], parts[0])
    for n, part in enumerate(parts[1:], 2):
        own = [(b"WARC-Type", b"continuation"), (b"WARC-Record-ID", b"<urn:page:%s:%d>" % (name.encode(), n)),
               (b"WARC-Date", _DATE), (b"WARC-Segment-Origin-ID", ident), (b"WARC-Segment-Number", b"%d" % n)]
        if n == len(parts):
            own.append((b"WARC-Segment-Total-Length", b"%d" % len(block)))
        yield _record(own, part)


def _writer(segment_bytes: int):
    def run(batches):
        from pyspark import TaskContext
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows, size = [], 0
            for page_id, url, payload, digest, keep, revisit in zip(*(batch[c].to_pylist() for c in (
                    "page_id", "url", "payload", "digest", "keep_id", "revisit"))):
                n += 1
                # The task and a running number tell repeated rows apart.
                name = f"{page_id}:{task}-{n}"
                for record in _records_of(page_id, url, payload, digest, keep, revisit, name, segment_bytes):
                    rows.append(record)
                    size += len(record)
                if size > 8 << 20:
                    yield _strings(rows)
                    rows, size = [], 0
            if rows:
                yield _strings(rows)
    return run


def _strings(rows: list[bytes]) -> pa.RecordBatch:
    # The text writer copies the bytes of a string as they are, so records need not be valid UTF-8.
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()).view(pa.string())], ["record"])


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   segment_bytes: int = SEGMENT_BYTES, least_shared: int = LEAST_SHARED) -> None:
    """Write one record (or its segments) per row of ``pages`` as gzip files under ``path``.

    Null payloads are empty. Of rows with equal payloads of at least ``least_shared`` bytes those with the smallest id
    are responses, the others revisits without a payload; a null id is larger than all others, and such rows are only
    revisits if a row with an id has their payload. Repeated ids are archived row by row: rows with the id of the response and
    its payload are all responses. An empty table gives archives without records.
    """
    payload = text_of(html).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    shared = (pages.select(F.col(page_id).cast("long").alias("page_id"), F.sha2(payload, 256).alias("digest"),
                           F.octet_length(text_of(html)).alias("size")).where(F.col("size") >= least_shared)
              .groupBy("digest").agg(F.min("page_id").alias("keep_id"), F.count("*").alias("n")).where("n > 1"))
    rows = rows.join(shared.drop("n"), "digest", "left")
    revisit = F.col("keep_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep_id"))
    (rows.withColumn("revisit", revisit).mapInArrow(_writer(segment_bytes), "record string")
     .write.option("lineSep", _END.decode()).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS)
     .text(path))


def records_in(pieces: Iterator[tuple[str, bytes]]) -> Iterator[tuple[dict[bytes, bytes], bytes, str | None]]:
    """``(headers, block, error)`` of every record in a stream of ``(file, piece)``.

    The pieces of a file are its bytes between blank lines, in order. Only what belongs to the present record is held.
    Where a file is broken or ends early, its last record has an error, and the next file begins anew.
    """
    file, held, headers, length, broken = None, bytearray(), None, 0, False

    def rest():
        if headers is not None and not broken:
            yield headers, b"", f"record has {len(held)} bytes, not {length}"
        elif held.strip() and not broken:
            yield {}, b"", "head of a record does not end"

    for name, piece in pieces:
        if name != file:
            yield from rest()
            file, held, headers, broken = name, bytearray(), None, False
        if broken:
            continue
        held += piece + _END
        while True:
            if headers is None:
                start = len(held) - len(held.lstrip(b"\r\n"))
                end = held.find(_END, start)
                if end < 0:
                    break
                version, *lines = bytes(held[start:end]).split(b"\r\n")
                found = {n.lower(): v.strip() for n, _, v in (line.partition(b":") for line in lines)}
                size = found.get(b"content-length", b"")
                if not version.startswith(b"WARC/") or not size.isdigit():
                    yield {}, b"", "no WARC record where one should begin"
                    broken = True
                    break
                headers, length = found, int(size)
                del held[:end + len(_END)]
            if len(held) < length:
                break
            yield headers, bytes(held[:length]), None
            del held[:length]
            headers = None
    yield from rest()


def _page_of(value: bytes | None) -> int | None:
    """Page id inside ``<urn:page:17>``."""
    return int(value.strip(b"<>").rpartition(b":")[2]) if value else None


_SCHEMA = pa.schema([("page_id", pa.int64()), ("uri", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                     ("record_digest", pa.string()), ("record_id", pa.string()), ("segment", pa.int32()), ("total", pa.int64()),
                     ("block", pa.binary()), ("payload", pa.binary()), ("error", pa.string())])
# Bytes of records that go to Spark at once.
_BATCH_BYTES = 8 << 20


def _row(h: dict[bytes, bytes], block: bytes, error: str | None) -> tuple:
    """Record of one piece with its payload, segment with its block."""
    get = lambda k: h[k].decode("utf-8", "replace") if k in h else None
    digest = h.get(b"warc-payload-digest", b"").rpartition(b":")[2].decode("utf-8", "replace") or None
    row = [None, get(b"warc-target-uri"), get(b"warc-type"), None, digest, None, None, None, None, None, error]
    try:
        number = lambda k: int(h[k]) if k in h else None
        row[0], row[3] = number(b"x-page-id"), _page_of(h.get(b"warc-refers-to"))
        row[5] = get(b"warc-segment-origin-id") or get(b"warc-record-id")
        row[6], row[7] = number(b"warc-segment-number"), number(b"warc-segment-total-length")
        if row[6] is not None and not error:
            row[8] = block
        elif row[2] == "response" and not error:
            row[9] = payload_of(block, digest)
    except ValueError as problem:
        row[10] = str(problem)
    return tuple(row)


def _read(batches):
    def pieces():
        for batch in batches:
            yield from zip(batch["file"].to_pylist(), batch["value"].to_pylist())

    rows, size = [], 0
    for headers, block, error in records_in(pieces()):
        rows.append(_row(headers, block, error))
        size += len(block) + 200
        if size > _BATCH_BYTES:
            yield _table(rows)
            rows, size = [], 0
    if rows:
        yield _table(rows)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def payload_of(block: bytes, digest: str | None) -> bytes:
    """Payload of an HTTP response; raises ``ValueError`` if it is broken or has not the recorded SHA-256."""
    payload = http_payload(block)
    if digest and len(digest) == 64 and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("payload has another digest than its record")
    return payload


def joined_segments(kind: str | None, digest: str | None, total: int | None, parts: list[dict]) -> tuple[bytes | None, str | None]:
    """Payload and error of a record in segments ``{segment, block}``, which are in order."""
    numbers, block = [p["segment"] for p in parts], b"".join(p["block"] or b"" for p in parts)
    if numbers != list(range(1, len(numbers) + 1)):
        return None, "segments are missing or repeated"
    if total != len(block):
        return None, f"segments have {len(block)} bytes, not {total}"
    try:
        return (payload_of(block, digest) if kind == "response" else None), None
    except ValueError as problem:
        return None, str(problem)


def _decode(batches):
    names = ["page_id", "uri", "record_type", "refers_to", "record_digest"]
    for batch in batches:
        done = [joined_segments(*r) for r in zip(*(batch[c].to_pylist() for c in ("record_type", "record_digest", "total", "parts")))]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array([p for p, _ in done], pa.binary()),
                                          pa.array([e for _, e in done], pa.string())], [*names, "payload", "error"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, uri, record_type, refers_to, record_digest, payload, payload_bytes, error``: one row per archived page.

    Spark reads the files as a stream of pieces between blank lines, so a file of any size passes through one task
    record by record, and each file is read once. Records in one piece are decoded where they are read; only segments
    are shuffled, by their origin. A broken record has a null payload and says why in ``error``; a file that breaks off
    gives one such row for its rest. Revisits have no payload of their own; their ``payload_bytes`` are those of the response
    with the id they refer to and their own digest, as one id may have several payloads, and null if it is not there.
    """
    files = (spark.read.option("pathGlobFilter", "*.gz").option("lineSep", _END.decode()).text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value")))
    columns = ["page_id", "uri", "record_type", "refers_to", "record_digest", "payload", "error"]
    records = staged(files.mapInArrow(_read, _RECORDS), "warc-records")
    part = F.struct(F.col("segment"), F.col("block"))
    first = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    pieces = (records.where(F.col("segment").isNotNull()).groupBy("record_id")
              .agg(*[first(c) for c in columns[:5]], F.max("total").alias("total"),
                   F.sort_array(F.collect_list(part)).alias("parts")).drop("record_id").mapInArrow(_decode, _PAGES))
    pages = records.where(F.col("segment").isNull()).select(*columns).unionByName(pieces)
    revisit = F.coalesce(F.col("record_type") == "revisit", F.lit(False))
    own = pages.where(~revisit).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    # A revisit is never in segments, so these rows come from the stored records alone.
    again = records.where(revisit & F.col("segment").isNull()).select(*columns)
    sizes = (own.where(F.col("payload_bytes").isNotNull()).groupBy(F.col("page_id").alias("refers_to"), "record_digest")
             .agg(F.max("payload_bytes").alias("payload_bytes")))
    found = spread_join(again, sizes, ["refers_to", "record_digest"], hot_keys(again, "record_digest"), "left")
    order = [*columns[:6], "payload_bytes", "error"]
    return own.select(*order).unionByName(found.select(*order))
