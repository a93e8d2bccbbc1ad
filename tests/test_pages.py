"""Pages by brute force, where the queries' SQL can't follow."""

import gzip
import hashlib
import zlib

from pagemill.operators import pages
from pagemill.plans.reference import content_route

HTML = b"<!doctype html><HTML lang=en><p>x</p>"
ROUTES = [
    (None, HTML, "html"), ("", HTML, "html"), ("", b"x" * 2_500_000 + b"<hTmL>", "html"), ("", b"\xff\xfe plain", "text"), ("", b"a\0b", "binary"), ("", b"a" * 2000 + b"\0", "text"), ("", b"%PDF-1.7 \0", "pdf"),
    (" ", HTML, "text"), (";charset=utf-8", HTML, "text"), ("text/plain", HTML, "text"), ("TEXT/HTML; charset=x", b"", "html"), ("application/octet-stream", b"%PDF-1.4", "pdf"), ("image/png", HTML, "binary"),
    ("application/pdf", b"", "pdf"), ("application/ld+json", b"\0", "text"), (None, None, "text"), ("image/png", None, "binary"),
]


def test_routes(spark):
    rows = [(i, ct, body if body is None else gzip.compress(body)) for i, (ct, body, _) in enumerate(ROUTES)]
    rows += [(90, None, b"no gzip"), (91, "", gzip.compress(b"a") + gzip.compress(HTML))]
    got = {r.page_id: r.route for r in pages.routed_pages(spark.createDataFrame(rows, "page_id long, content_type string, raw_gzip binary")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(ROUTES)} | {90: "text", 91: "html"}


def test_untyped_pages(spark, small):
    """Pages without a type, by their bodies."""
    rows = [r for r in spark.read.parquet(f"{small}/rendered.parquet").collect() if not r.content_type and r.raw_gzip]
    want = {r.page_id: "html" if b"<html" in (body := zlib.decompress(r.raw_gzip, 47)).lower() else "binary" if b"\0" in body[:1024] else "text" for r in rows}
    got = {r.page_id: r.route for r in content_route(spark, small).collect() if r.page_id in want}
    assert got == want and "html" in got.values()


def test_bodies_of_several_members(spark):
    parts = [b"<html>one\n", b"", b"two\n" * 5000]
    whole, raw = b"".join(parts), b"".join(map(gzip.compress, parts))
    rows = [(1, raw), (2, raw + b"\0" * 9), (3, gzip.compress(whole)), (4, zlib.compress(whole)), (5, raw + b"more"), (6, None), (7, raw[: len(raw) - len(gzip.compress(parts[2])) // 2])]
    got = {r.page_id: (r["size"], r.digest) for r in pages.raw_bodies(spark.createDataFrame(rows, "page_id long, raw_gzip binary")).collect()}
    want = (len(whole), hashlib.md5(whole).hexdigest())
    assert [got[i] for i in range(1, 7)] == [want] * 4 + [(None, None)] * 2
    assert len(parts[0]) <= got[7][0] < len(whole)
