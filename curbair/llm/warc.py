"""WARC archives: writing with segments and chunked framing, reading with reassembly.

A record larger than the segment size is written as a first segment and continuation
records that name it as their origin. The reader parses files where they are, decodes
unsegmented records on the spot, and brings only the segments of the others together:
grouped by origin, in the order of their numbers, checked against the total length the
last one states. Chunked transfer framing is taken off at the end.

Archives are gzipped record by record, each record a member of its own.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curbair.llm.common import slices
from curbair.llm.files import get, put, task_name
from curbair.operators.joins import lookup_join
from curbair.sources.staging import fresh_path, staged

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE, REVISIT, CONTINUATION = "response", "revisit", "continuation"

#: Bytes of a record's block per segment, of a chunk, and of an archive before packing.
SEGMENT_BYTES, CHUNK_BYTES, ARCHIVE_BYTES = 16 << 10, 8 << 10, 16 << 20
#: Payloads below this size are never revisits.
REVISIT_BYTES = 100


class DamagedRecord(ValueError):
    """A record that cannot be read as the format says."""


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked framing; extensions and trailers are skipped."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise DamagedRecord("chunk size missing")
        try:
            size = int(body[at:end].split(b";")[0].strip(), 16)
        except ValueError as error:
            raise DamagedRecord("chunk size unreadable") from error
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            raise DamagedRecord("chunk cut short")
        parts.append(body[at : at + size])
        at += size + 2


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return VERSION + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _one_line(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def records(
    record_id: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
    segment_bytes: int = SEGMENT_BYTES,
) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response in as many segments as it needs."""
    common = [("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", "1970-01-01T00:00:00Z"),
              ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        common.append(("X-Page-Id", str(page_id)))
    if url is not None:
        common.append(("WARC-Target-URI", _one_line(url)))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        yield _record([("WARC-Type", REVISIT), ("WARC-Profile", PROFILE), ("X-Refers-To-Page", str(refers_to)),
                       *common, ("Content-Type", "application/http; msgtype=response")], http + b"\r\n")
        return
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    kind = ("Content-Type", "application/http; msgtype=response")
    if len(block) <= segment_bytes:
        yield _record([("WARC-Type", RESPONSE), *common, kind], block)
        return
    pieces = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    yield _record([("WARC-Type", RESPONSE), ("WARC-Segment-Number", "1"), *common, kind], pieces[0])
    for number, piece in enumerate(pieces[1:], 2):
        own = uuid.uuid5(uuid.UUID(record_id.rsplit(":", 1)[1]), str(number)).urn
        total = [("WARC-Segment-Total-Length", str(len(block)))] if number == len(pieces) else []
        yield _record([("WARC-Type", CONTINUATION), ("WARC-Record-ID", f"<{own}>"),
                       ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Segment-Number", str(number)),
                       ("WARC-Segment-Origin-ID", f"<{record_id}>"), *total], piece)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of an archive."""
    view, at = memoryview(data), 0
    while at < len(view):
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            piece = view[at : at + (64 << 10)]
            if not piece:
                raise DamagedRecord("archive cut short")
            try:
                parts.append(member.decompress(piece))
            except zlib.error as error:
                raise DamagedRecord("member unreadable") from error
            at += len(piece)
        at -= len(member.unused_data)
        record = b"".join(parts)
        head, _, rest = record.partition(b"\r\n\r\n")
        first, *lines = head.decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise DamagedRecord("no WARC version")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = int(headers["content-length"])
        if len(rest) < length:
            raise DamagedRecord("block cut short")
        yield headers, rest[:length]


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block, without transfer framing."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise DamagedRecord("no end of the HTTP header")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head) else body


_MANIFEST = pa.schema([("uri", pa.string()), ("records", pa.int64())])


def _write(folder: str, segment_bytes: int, archive_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size, count = 0, [], 0, 0

        def close() -> pa.RecordBatch:
            uri = f"{folder}/{task_name('pages', number, '.warc.gz')}"
            put(uri, b"".join(held))
            return pa.RecordBatch.from_pylist([{"uri": uri, "records": count}], _MANIFEST)

        for part in slices(batches, "html"):
            for row in part.to_pylist():
                payload = (row["html"] or "").encode("utf-8", "surrogatepass")
                refers = row["response"] if row["type"] == REVISIT else None
                name = uuid.uuid4().urn
                for data in records(name, row["page_id"], row["url"], payload, row["digest"], refers, segment_bytes):
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    held.append(packer.compress(data) + packer.flush())
                    size, count = size + len(data), count + 1
                    if size >= archive_bytes:
                        yield close()
                        number, held, size, count = number + 1, [], 0, 0
        if held:
            yield close()

    return run


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    segment_bytes: int = SEGMENT_BYTES, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record per row below ``folder``; returns the manifest (uri, records).

    Of rows with equal payloads of REVISIT_BYTES or more, that with the smallest id is
    the response and the others revisit it. A NULL payload is empty. Rows that repeat
    the smallest id are responses too; a NULL id revisits any other and is a response
    among its like. A NULL url is left out. An empty table writes nothing.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"),
                        F.sha2(payload.cast("binary"), 256).alias("digest"),
                        F.octet_length(payload).alias("size"))
    shared = staged(
        rows.filter(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(
            F.min("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and response is not null").select("digest", "response"), "shared-payloads")
    kind = F.when(F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response")), REVISIT)
    marked = lookup_join(rows, shared, ["digest"]).withColumn("type", kind.otherwise(RESPONSE))
    return staged(marked.select("page_id", "url", "html", "digest", "response", "type").mapInArrow(
        _write(folder, segment_bytes, archive_bytes), "uri string, records long"), "warc-manifest")


_PARSED = pa.schema([
    ("page_id", pa.int64()), ("type", pa.string()), ("digest", pa.string()), ("length", pa.int64()),
    ("refers_to", pa.int64()), ("payload", pa.binary()), ("problem", pa.string()),
    ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary())])


def _whole(headers: dict[str, str], block: bytes, payloads: bool) -> dict:
    """The row of a complete record; what does not fit is told in ``problem``."""
    page = headers.get("x-page-id")
    row = dict.fromkeys(_PARSED.names) | {"type": headers["warc-type"], "page_id": None if page is None else int(page)}
    stated = headers.get("warc-payload-digest", "").rpartition(":")[2], int(headers.get("x-payload-length", -1))
    if row["type"] == REVISIT:
        return row | {"digest": stated[0], "length": stated[1], "refers_to": int(headers["x-refers-to-page"])}
    try:
        payload = payload_of(block)
    except DamagedRecord as error:
        return row | {"problem": str(error)}
    found = hashlib.sha256(payload).hexdigest()
    row |= {"digest": found, "length": len(payload), "payload": payload if payloads else None}
    return row if (found, len(payload)) == stated else row | {"problem": "digest or length differs"}


def _parse(payloads: bool, limit: int = 4 << 20):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                rows, size = [], 0
                for headers, block in parse(get(uri)):
                    number = headers.get("warc-segment-number")
                    if number is None:
                        row = _whole(headers, block, payloads)
                    else:
                        # a first segment carries its own headers along, in front of its block
                        first = headers["warc-type"] != CONTINUATION
                        origin = headers["warc-record-id" if first else "warc-segment-origin-id"]
                        kept = "\n".join(f"{k}:{v}" for k, v in headers.items()) if first else ""
                        total = headers.get("warc-segment-total-length")
                        row = dict.fromkeys(_PARSED.names) | {
                            "type": CONTINUATION, "origin": origin, "number": int(number), "block": block,
                            "total": None if total is None else int(total), "problem": kept}
                    rows.append(row)
                    size += len(row["block"] or row["payload"] or b"") + 200
                    if size >= limit:
                        yield pa.RecordBatch.from_pylist(rows, _PARSED)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _PARSED)

    return run


_OUT = pa.schema([(f.name, f.type) for f in _PARSED][:7])


def _reassemble(payloads: bool):
    """Rows of segmented records, from segments sorted by origin and number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        origin, pieces, headers, total, numbers = None, [], {}, None, []

        def finish() -> pa.RecordBatch:
            block = b"".join(pieces)
            if numbers != list(range(1, len(numbers) + 1)) or total is None:
                row = {"type": headers.get("warc-type"), "problem": "segments missing or repeated"}
            elif total != len(block):
                row = {"type": headers.get("warc-type"), "problem": "total length differs"}
            else:
                row = _whole(headers, block, payloads)
            page = headers.get("x-page-id")
            row["page_id"] = None if page is None else int(page)
            return pa.RecordBatch.from_pylist([{k: row.get(k) for k in _OUT.names}], _OUT)

        for part in slices(batches, "block"):
            done = []
            for row in part.to_pylist():
                if row["origin"] != origin:
                    if origin is not None:
                        done.append(finish())
                    origin, pieces, headers, total, numbers = row["origin"], [], {}, None, []
                pieces.append(row["block"])
                numbers.append(row["number"])
                if row["problem"]:
                    headers = dict(line.split(":", 1) for line in row["problem"].split("\n"))
                total = row["total"] if row["total"] is not None else total
            yield from done
        if origin is not None:
            yield finish()

    return run


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Per record: page_id, type, digest, length, refers_to, payload and problem.

    Digest and length are those of the full payload: computed for responses, stated for
    revisits. ``payload`` is NULL for revisits, and everywhere if ``payloads`` is false.
    ``problem`` tells why a record could not be put together or differs from what its
    headers state, and is NULL otherwise.
    """
    schema = ("page_id long, type string, digest string, length long, refers_to long, payload binary, "
              "problem string, origin string, number int, total long, block binary")
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parsed = staged(manifest.select("uri").repartition(parts, "uri").mapInArrow(_parse(payloads), schema), "records")
    whole = parsed.filter("origin is null").select(_OUT.names)
    segments = parsed.filter("origin is not null").select("origin", "number", "total", "problem", "block")
    rebuilt = segments.repartition("origin").sortWithinPartitions("origin", "number").mapInArrow(
        _reassemble(payloads), schema.partition(", origin")[0])
    return whole.unionByName(rebuilt)


def archived(pages: DataFrame, payloads: bool = False, **settings) -> DataFrame:
    """Write the pages below the shared folder and read the archives back."""
    folder = fresh_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, **settings), payloads)
