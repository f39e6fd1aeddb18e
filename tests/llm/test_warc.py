import base64
import gzip
import hashlib
import io

import pytest

from rowgate.llm import warc

PAGES = "page_id long, url string, html string"


def expected(rows):
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if page is not None:
            first[body] = min(first.get(body, page), page)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        revisit = body in first and page != first[body]
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "revisit" if revisit else "response", first[body] if revisit else None))
    return out


ROWS = [
    (5, "http://a/\r\nX: y", "same é"), (3, None, "same é"), (9, "http://b", None), (4, "http://c", ""),
    (7, "http://d", "WARC/1.1\r\n\r\n" * 50), (8, "http://ü/ ?", "long " * 500_000),
    (3, None, "same é"), (None, "http://e", "same é"), (None, "http://f", "alone"),
]


def test_round_trip(spark, stored):
    folder = stored(pages=spark.createDataFrame(ROWS, PAGES))
    found = [tuple(r) for r in warc.op3_warc_chunks(spark, folder).collect()]
    assert sorted(found, key=str) == sorted(expected(ROWS), key=str)


def test_chunks_carry_running_digests_and_whole_payloads(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, PAGES)
    chunks = warc.chunked(warc.with_revisits(pages), 1000)
    manifest = warc.write_archives(chunks, f"file://{tmp_path}/w", file_bytes=200)
    assert manifest.count() > 1, "files are rolled"
    rows = warc.read_archives(manifest, 700).filter("page_id = 8").orderBy("chunk_no").collect()
    assert [r.chunk_no for r in rows] == list(range(len(rows))) and len(rows) > 3000
    seen, body = hashlib.sha1(), b""
    for r in rows:
        assert len(r.chunk) <= 700
        body += r.chunk
        seen.update(r.chunk)
        assert r.digest_so_far == base64.b32encode(seen.digest()).decode()
        assert r.is_last == (r.chunk_no == len(rows) - 1)
    assert body.decode() == ROWS[5][2] and rows[0].url == ROWS[5][1]


def test_damage_is_found(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abcdefgh" * 40)], PAGES)
    path = warc.write_archives(warc.chunked(warc.with_revisits(pages)), f"{tmp_path}/w").first().path
    raw = gzip.decompress(open(path, "rb").read())
    other = gzip.compress(raw.replace(b"abcdefgh", b"abcdefgX", 1))
    (row,) = list(warc.chunks_of(io.BytesIO(other), 1 << 20))
    assert row["digest_so_far"] != row["claimed_digest"]
    with pytest.raises(EOFError):
        list(warc.chunks_of(io.BytesIO(gzip.compress(raw)[:-30]), 1 << 20))


def test_least_size_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], PAGES)
    kinds = warc.with_revisits(pages, least_bytes=3).select("record_type").distinct().collect()
    assert [r[0] for r in kinds] == ["response"]
    nothing = warc.write_archives(warc.chunked(warc.with_revisits(pages.limit(0))), "/tmp/none")
    assert warc.read_archives(nothing).collect() == []
