"""Fetching, backends, settings, saving and frames: loopback servers, temporary folders and given transports."""

import http.server
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from pagemill import pipeline, registry, sinks
from pagemill.operators.admission import AllowList, blocked_texts, parse_allow_list, permitted_targets
from pagemill.operators.pages import gunzip
from pagemill.sources import backends, frames, http as web
from pagemill.sources.settings import Settings, load_settings

LOOPBACK = parse_allow_list(["127.0.0.1", "localhost"])


class Handler(http.server.BaseHTTPRequestHandler):
    seen: list = []

    def do_GET(self):
        Handler.seen.append((self.path, self.headers["User-Agent"]))
        status, headers, body = 200, {"Content-Type": "text/plain"}, b"hello"
        if self.path == "/moved":
            status, headers = 302, {"Location": "/page?x=1"}
        elif self.path == "/loop":
            status, headers = 302, {"Location": "/loop"}
        elif self.path == "/inside":
            status, headers = 302, {"Location": "http://10.0.0.1/"}
        elif self.path == "/flaky":
            status = 503 if sum(p == "/flaky" for p, _ in Handler.seen) == 1 else 200
        elif self.path.startswith("/status/"):
            status = int(self.path[8:])
        elif self.path.startswith("/html"):
            headers = {"Content-Type": "text/html"}
            body = b"<html><head><title>T</title></head><body><article><p>The words of this page are enough to be its main content.</p><a href='/x'>X</a><img src='i.png' alt='A'></article></body></html>"
        elif self.path == "/large":
            body = b"x" * 5000
        self.send_response(status)
        for k, v in headers.items():
            self.send_header(k, v)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def base():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_address[1]}"
    server.shutdown()


def get(url, **k):
    return web.fetch(url, allow=LOOPBACK, wait=lambda s: None, **k)


def test_fetching(base):
    r = get(f"{base}/moved")
    assert (r["final_url"], r["status"], r["body"], r["body_truncated"], r["error"]) == (f"{base}/page?x=1", 200, b"hello", False, "")
    r = get(f"{base}/large", most=4000)
    assert len(r["body"]) == 4000 and r["body_truncated"]
    Handler.seen.clear()
    assert get(f"{base}/flaky")["status"] == 200 and len(Handler.seen) == 2
    Handler.seen.clear()
    assert get(f"{base}/status/404", user_agent="Browser")["error"] == f"http 404 fetching {base}/status/404 (page not found — check the URL; the page may have moved or been removed)"
    assert Handler.seen == [("/status/404", web.BROWSER)]
    assert "even with the browser" in get(f"{base}/status/403", user_agent="browser")["error"] and "rate limited" in get(f"{base}/status/429")["error"]
    assert get(f"{base}/loop")["error"] == "too many redirects: stopped after 10 redirects"
    assert get(f"{base}/inside")["error"] == web.BLOCKED
    assert web.fetch(f"{base}/page")["error"] == web.BLOCKED  # nothing local is admitted unless it is listed
    assert get("ftp://h.test/")["error"].startswith("unsupported scheme") and get("http://h.test:22/")["error"].startswith("port 22") and get(None)["error"] and get("http://[::1]:22/x")["error"].startswith("port 22")


def test_dropped_connections():
    tries = []

    def transport(url, *rest):
        tries.append(url)
        if len(tries) == 1:
            raise ConnectionResetError("reset by peer")
        return web.Response(200, {"content-type": "text/html"}, b"x")

    assert get("http://h.test/", transport=transport)["body"] == b"x" and len(tries) == 2
    assert get("http://h.test/", transport=lambda *a: (_ for _ in ()).throw(TimeoutError("slow")))["error"] == "timeout: slow"


def test_fetched_rows(spark, base):
    df = spark.createDataFrame([(1, f"{base}/page", None), (2, "nonsense", None), (3, f"{base}/status/500", "me")], "id long, url string, user_agent string")
    got = {r.id: r for r in web.fetched(df, ["id"], 2, allow=LOOPBACK).collect()}
    assert got[1].body == b"hello" and got[2].error and "server error" in got[3].error
    images = web.fetched_images(df.where("id = 1"), ["id"], allow=LOOPBACK).collect()
    assert images[0].error.startswith("unsupported or non-image content (text/plain)")


def test_targets(spark):
    df = spark.createDataFrame([("a.test", ["10.0.0.1", "8.8.8.8"]), ("b.test", ["10.0.0.1"]), ("ok.test", ["10.0.0.1"]), ("c.test", None)], "host string, ips array<string>")
    got = permitted_targets(df, F.col("host"), F.col("ips"), parse_allow_list(["OK.test"])).select("host", "dial", blocked_texts(F.col("host"), F.col("dial")).alias("t")).collect()
    assert {r.host: r.dial for r in got} == {"a.test": "8.8.8.8", "b.test": None, "ok.test": "10.0.0.1", "c.test": None}
    assert all((r.t.error == "") == (r.dial is not None) and "test" not in r.t.error for r in got) and '"b.test"' in next(r.t.detail for r in got if r.host == "b.test")


@pytest.mark.parametrize("backend", ["searxng", "tavily"])
def test_backends(spark, backend):
    asked = []

    def send(method, url, headers, body):
        asked.append((method, url, body))
        return 200, backends.payload_of([{"title": "t", "url": "https://a.test/1", "snippet": "s", "published": "2024"}, {"title": "u", "url": "https://sub.b.test/"}], backend).encode()

    queries = spark.createDataFrame([(1, " x y ", 5, None, ["https://B.test/x"], None, "advanced"), (2, " ", 0, "day", None, None, None)], "query_id long, query_text string, max_results int, freshness string, include_domains array<string>, exclude_domains array<string>, depth string")
    settings = Settings(search_backend=backend, tavily_api_key="k", searxng_url="http://s.test/")
    got = backends.searched(queries, settings, send, 1).collect()
    assert [r.error for r in got if r.query_id == 2] == ["query is required"]
    urls = [r.url for r in sorted((r for r in got if r.query_id == 1), key=lambda r: r.place)]
    assert urls == (["https://sub.b.test/"] if backend == "searxng" else ["https://a.test/1", "https://sub.b.test/"])
    for bad in (Settings(search_backend="tavily"), Settings(search_backend="searxng"), Settings(search_backend="searxng", searxng_url="ftp://x"), Settings(search_backend="?")):
        assert backends.chosen_backend(bad)[1] and all(r.error for r in backends.searched(queries, bad, send, 1).collect())


def test_settings(tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    a.mkdir(), b.mkdir()
    assert load_settings(str(a), environ={}) == Settings()
    (b / "config.json").write_text(json.dumps({"search_backend": " SearXNG ", "fetch_max_bytes": 10**12, "fetch_cache_ttl_sec": -4, "fetch_timeout_sec": "x", "allow_local_hosts": [], "other": 1}))
    s = load_settings(str(a), str(b), environ={"PAGEMILL_FETCH_MAX_BYTES": "77", "PAGEMILL_ALLOW_LOCAL_HOSTS": " h1, ,h2 ", "PAGEMILL_FETCH_INLINE_IMAGES": "T", "PAGEMILL_FETCH_CACHE_MAX_ENTRIES": "9999", "PAGEMILL_FETCH_TIMEOUT_SEC": "-3"})
    assert (s.search_backend, s.fetch_max_bytes, s.fetch_cache_ttl_sec, s.fetch_timeout_sec, s.allow_local_hosts, s.fetch_inline_images, s.fetch_cache_max_entries) == ("searxng", 77, 0, 25, ("h1", "h2"), True, 128)
    (a / "config.json").write_text("{broken")
    assert load_settings(str(a), str(b), environ={}) == Settings()  # the first file counts alone
    assert load_settings(str(b), environ={}).fetch_max_bytes == 32 << 20


def test_saving(tmp_path, spark):
    w = tmp_path / "w"
    (w / ".git").mkdir(parents=True)
    (tmp_path / "out").mkdir()
    os.symlink(tmp_path / "out", w / "link")
    (w / "file").write_text("old")
    os.symlink(w / "file", w / "to_file")
    assert sinks.path_error(str(w), "new/deep/x") == "" and not (w / "new").exists()
    for path, part in (("/abs", "absolute"), ("../x", "escapes"), ("a/../../x", "escapes"), (".git/config", ".git"), ("a/../.git", ".git"), ("link/x", "is a symlink"), ("file/x", "not a directory"), ("to_file", "points to a symlink"), ("file", "already exists")):
        assert part in sinks.path_error(str(w), path), path
        with pytest.raises(sinks.SaveError):
            sinks.save(str(w), path, b"x")
    assert "no workspace" in sinks.path_error(" ", "x") and "not accessible" in sinks.path_error(str(w / "none"), "x")
    assert sinks.save(str(w), "a/./b//c.txt", b"one") == "a/b/c.txt" and (w / "a/b/c.txt").read_bytes() == b"one"
    assert sinks.save(str(w), ".gitignore", b"x") == ".gitignore" and sinks.save(str(w), "file", b"new", True) == "file" and (w / "file").read_text() == "new"
    df = spark.createDataFrame([(1, "t/1", b"1"), (2, "../2", b"2"), (3, None, b"3")], "id long, path string, body binary")
    assert {(r.id, r.saved, bool(r.error)) for r in sinks.saved(df, str(w), F.col("path"), F.col("body"), ["id"]).collect()} == {(1, "t/1", False), (2, None, True), (3, None, True)}


def test_frames(spark):
    r = registry.default_registry()
    sent = [json.loads(x.frame) for x in frames.greeting(spark, r).orderBy("place").collect()]
    assert [f["type"] for f in sent] == ["hello", *["register_tool"] * 6, "register_command", "subscribe", "ready"] and sent[0]["capabilities"] == ["tools", "events", "commands"]
    assert all(t.authority == registry.NETWORK for t in r.tools) and r.find("web_links") and r.find("none") is None and registry.version_text(build="abc").endswith(" (abc)")
    assert "commands" not in json.loads(frames.greeting(spark, registry.Registry("x", "1")).first().frame)["capabilities"]
    df = spark.createDataFrame([("id", "cap", b"\xff" * 90), ("id", "", b"x"), ("id", "only", None), ("id", None, None)], "i string, t string, d binary")
    got = [json.loads(x.f)["content"] for x in df.select(frames.tool_result(F.col("i"), F.col("t"), F.lit(False), F.lit("image/png"), F.col("d")).alias("f")).collect()]
    assert [[b["type"] for b in c] for c in got] == [["image", "text"], ["image"], ["text"], ["text"]] and "\n" not in got[0][0]["data"] and got[3][0]["text"] == ""
    shown = spark.range(1).select(frames.command_response(F.lit("7"), F.lit("display"), F.lit("note"), F.lit("")).alias("f")).first().f
    assert json.loads(shown) == {"type": "command_response", "id": "7", "action": "display", "display": "note"}


def test_said_of_saved(spark):
    row = spark.range(1).select(sinks.raw_saved_text(F.lit("a/b"), F.lit(" "), F.lit(12), F.lit("f"), F.lit("u"), F.lit(True)).alias("t")).first().t
    assert row == "Saved unrendered source to a/b\nunknown type, 12 bytes (final: f)\n…source was capped at the fetch byte limit before saving"
    image = F.struct(F.lit("f").alias("final_url"), F.lit("image/png").alias("mime"), F.lit(3).alias("width"), F.lit(2).alias("height"), F.lit(b"x" * 1536).alias("data"), F.lit(True).alias("resized"), F.lit(6).alias("orig_w"), F.lit(4).alias("orig_h"))
    assert spark.range(1).select(sinks.image_text(F.lit("u"), image).alias("t")).first().t == "Fetched u (final: f)\nimage/png, 3×2, 1.5 KiB (resized from 6×4)"


def test_page_source(spark, base):
    spark.dataSource.register(web.PageSource)
    rows = spark.read.format("webpages").option("urls", f"{base}/page {base}/status/404 http://10.0.0.1/").option("allow_local_hosts", "127.0.0.1").load().collect()
    assert sorted((r.url[-5:], r.status, r.error[:8]) for r in rows) == [(".0.1/", None, "web_fetc"), ("/page", 200, ""), ("s/404", 404, "http 404")]


def test_pipeline(spark, base):
    now = F.timestamp_seconds(F.lit(1_000_000))
    df = spark.createDataFrame([(1, f"{base}/html?utm_source=a", None), (2, f"{base}/html", None), (3, "ftp://x/", None), (4, f"{base}/status/404", None), (5, f"{base}/large", "browser")], "request_id long, url string, user_agent string")
    Handler.seen.clear()
    settings = Settings(fetch_max_bytes=4000)
    pages, fresh = pipeline.load_pages(df, pipeline.empty_cache(df), now, settings, wait=lambda s: None)
    texts = {r.request_id: r.text for r in pipeline.page_texts(pages, 60).collect()}
    assert texts[1].startswith(f"# T\n{base}/html?utm_source=a\nFinal-URL: {base}/html") and "Images: 1 (shown as" in texts[1] and "more chars; continue with offset=60]" in texts[1]
    assert texts[3] == 'web_fetch failed: unsupported scheme "ftp" (only http/https)' and "http 404" in texts[4] and texts[5].endswith("more chars; continue with offset=60]")
    assert sorted(p for p, _ in Handler.seen) == ["/html", "/large", "/status/404"]  # one fetch for both addresses of a page
    assert {(r.request_id, r.pos, r.url, r.text) for r in pipeline.page_links(pages).collect()} == {(k, 1, f"{base}/x", "X") for k in (1, 2)}
    assert {(r.request_id, r.id, r.url, r.alt) for r in pipeline.page_images(pages).collect()} == {(k, 1, f"{base}/i.png", "A") for k in (1, 2)}
    kept = fresh.collect()
    assert sorted(r.body_truncated for r in kept) == [False, True] and all(gunzip(r.raw_gzip) for r in kept)
    Handler.seen.clear()
    again, none = pipeline.load_pages(df.where("request_id = 2"), fresh, now, settings)
    assert again.collect()[0].title == "T" and none.count() == 0 and Handler.seen == []
