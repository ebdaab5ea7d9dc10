"""Page operators: archives by exact round trip, url rules by brute force."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from curbair.llm import warc
from curbair.llm.urlrules import judge_urls

PAGES = "page_id long, url string, html string"


def pages():
    big = "<p>é🙂</p>" * 9000
    same = "y" * 150
    return [(1, "http://a/", None), (2, None, ""), (3, "http://b/ x\r\ny", big), (4, "u", big), (5, "u", same), (6, "u", same),
            (6, "u", same), (5, "u", same), (None, "u", same), (7, "u", "short"), (8, "u", "short"), (None, "n", "z" * 200)]


@pytest.mark.parametrize("segment", [16 << 10, 300])
def test_archives_round_trip(spark, segment):
    df = spark.createDataFrame(pages(), PAGES).withColumns({"type": F.lit(1), "digest": F.lit(1), "response": F.lit(1)})
    found = warc.archived(df, payloads=True, segment_bytes=segment, archive_bytes=20_000).collect()
    first = {hashlib.sha256((h or "").encode()).hexdigest(): i for i, _, h in reversed(pages()) if i is not None}
    for i, _, h in pages():
        if i is not None:
            digest = hashlib.sha256((h or "").encode()).hexdigest()
            first[digest] = min(first[digest], i)
    want = []
    for i, _, h in pages():
        data = (h or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        to = first.get(digest) if len(data) >= 100 else None
        revisit = to is not None and to != i
        want.append((i, len(data), digest, "revisit" if revisit else "response", to if revisit else None, None if revisit else data))
    got = [(r.page_id, r.length, r.digest, r.type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert all(r.problem is None for r in found)
    assert warc.archived(df.limit(0)).count() == 0


def test_chunked_framing():
    for n in (0, 1, warc.CHUNK_BYTES, 3 * warc.CHUNK_BYTES + 5):
        data = bytes(i % 251 for i in range(n))
        assert warc.unchunked(warc.chunked(data)) == data
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for bad in (b"", b"zz\r\nabc", b"5\r\nabc\r\n0\r\n\r\n"):
        with pytest.raises(warc.DamagedRecord):
            warc.unchunked(bad)


def test_missing_segments_are_told(spark):
    import pyarrow as pa

    def rows(numbers, total, origin):
        return [{"origin": origin, "number": n, "total": total if n == max(numbers) else None, "block": b"x" * 10,
                 "problem": "warc-type:response\nx-page-id:4" if n == 1 else ""} for n in numbers]

    schema = pa.schema([("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary()), ("problem", pa.string())])
    batch = pa.RecordBatch.from_pylist(rows([1, 3], 30, "a") + rows([1, 2], 99, "b") + rows([2], 20, "c"), schema)
    out = [r for b in warc._reassemble(True)(iter([batch])) for r in b.to_pylist()]
    assert [r["problem"] for r in out] == ["segments missing or repeated", "total length differs", "segments missing or repeated"]


def test_cut_archive_is_refused():
    import gzip

    record = next(iter(warc.records("urn:uuid:" + "0" * 32, 1, "u", b"abc", "d", None)))
    data = gzip.compress(record)
    assert len(list(warc.parse(data + data))) == 2
    with pytest.raises(warc.DamagedRecord):
        list(warc.parse(data[:-5]))


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("example.org", "/en/12", "allow"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("a.example.org", "", "block"), ("org", "/es/a-very-long-path", "allow")]
URLS = ["http://x.org/a", "https://www.EXAMPLE.org/es/1", "http://example.org/en/1", "http://q.example.org/en/123?x", "http://example.org",
        "http://notexample.org/es/", "ftp://com/fr/x#y", "http://b.com/de/", "http://b.com/d", "http://a.example.org?x=/", "no scheme", "", None,
        "http://u@a.b.c.a.example.org:80/x", "http://a.example.org/es/", "http://x.example.org/es/a-very-long-path/1", "://org/", "http://a://org/",
        "http://./x", "http://é.org/es\n/x", "http://org/"]


def brute(url, default="allow"):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[3], max(fits)[2]) if fits else (host, path, None, default)


@pytest.mark.parametrize("salt", [20_000, 2])
def test_url_rules_equal_brute_force(spark, salt):
    urls = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0])], "page_id long, url string")
    urls = urls.withColumns({"host": F.lit("x"), "key": F.lit(1), "rule": F.lit(2), "row": F.lit(3)})
    rules = spark.createDataFrame(RULES + [RULES[0], (None, "/", "block")], "host string, path string, verdict string")
    found = judge_urls(urls, rules, salt_rows=salt).collect()
    assert sorted((r.page_id, r.host, r.path, str(r.rule), r.verdict) for r in found) == sorted(
        (i, h, p, str(r), v) for i, (h, p, r, v) in [*enumerate(map(brute, URLS)), (0, brute(URLS[0]))])
    assert judge_urls(urls.limit(0), rules).count() == 0
    assert {r.verdict for r in judge_urls(urls, rules.limit(0), default="block").collect()} == {"block"}
