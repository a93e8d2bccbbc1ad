"""Document parsers: literal cases of links, images, tables, charsets, feeds, PDF, pictures and rendering."""

import struct
import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.documents import charset, feeds, harvest, pdf, pixels, render, tables
from pagemill.documents.address import link_target, resolve
from pagemill.documents.dom import parse
from pagemill.documents.markdown import to_markdown

BASE = "https://example.test/a/b?c=1"


@pytest.mark.parametrize(
    ("ref", "want"),
    [
        ("x", "https://example.test/a/x"), ("../x", "https://example.test/x"), ("../../../x", "https://example.test/x"), ("/", "https://example.test/"), ("?d", "https://example.test/a/b?d"), ("//h.test", "https://h.test"), ("HTTP://H.test/./a", "http://H.test/a"),
        ("mailto:a@b.c", "mailto:a@b.c"), ("a:b/c", "a:b/c"), ("1:b", ""), ("%zz", ""), ("x#f g", "https://example.test/a/x#f%20g"), ("é?é", "https://example.test/a/%C3%A9?é"), (".", "https://example.test/a/"), ("", "https://example.test/a/b?c=1"), ("a\x01", ""),
    ],
)
def test_resolution(ref, want):
    assert resolve(ref, BASE) == want


def test_links():
    root = parse("<p><a href='/one'>First  <b>one</b></a><a href='/one'>again</a><a href=' #x'>no</a><a href='JAVASCRIPT:x'>no</a><a>no</a><div><a href=two>Two<a href=three>Three</div><a href='tel:1'></a>")
    assert harvest.links(root, BASE) == [("https://example.test/one", "First one"), ("https://example.test/a/two", "Two"), ("https://example.test/a/three", "Three"), ("tel:1", "")]
    assert len(harvest.links(root, BASE, limit=2)) == 2
    assert link_target("data:x", BASE) == ""


@pytest.mark.parametrize(
    ("markup", "want"),
    [
        ('<img src="a.png" data-src="b.png">', "a.png"), ('<img src="data:x" data-src="b.png">', "b.png"), ('<img data-original="c.png">', "c.png"), ('<img data-src="data:x" data-url="d.png">', "d.png"), ('<img srcset="e.png 1x, f.png 2x">', "e.png"),
        ('<img data-srcset=" g.png 1x">', "g.png"), ('<img src="data:x" srcset="h.png 1x">', ""), ("<img alt=x>", ""),
    ],
)
def test_image_precedence(markup, want):
    assert harvest.image_url(next(parse(markup).all("img")), "https://h.test/") == (f"https://h.test/{want}" if want else "")


def test_all_images():
    root = parse(
        '<head><meta property="og:image" content="/og.png"><link rel="image_src" href="/rel.png"></head><body><div data-background="url( \'bg.png\' )"></div><noscript><img src="ns.png" alt=N></noscript>'
        '<picture><source srcset="s.webp 1x"><img src="og.png"></picture><a href="full.JPG?x">Full <b>size</b></a><a href="page.html">no</a><img src="full.JPG?x">'
    )
    got = harvest.all_images(root, "https://h.test/")
    assert [(i.id, i.url.removeprefix("https://h.test/"), i.alt) for i in got] == [(1, "og.png", ""), (2, "rel.png", ""), (3, "bg.png", ""), (4, "ns.png", "N"), (5, "s.webp", ""), (6, "full.JPG?x", "Full size")]
    assert len(harvest.all_images(root, "https://h.test/", limit=2)) == 2


def test_marked_images():
    root = parse('<figure><a href="/File:x"><img src="a.png" alt=" A " width=3 height="4px"></a><figcaption>The\n cap</figcaption></figure><img src="a.png"><img src="b.png"><img src="c.png">')
    got = harvest.mark_images(root, "https://h.test/", lambda n: f"<{n}>", limit=2)
    assert [i.as_row() for i in got][0] == {"id": 1, "url": "https://h.test/a.png", "alt": "A", "caption": "The cap", "width": "3", "height": "4px", "source_page": "https://h.test/File:x"}
    assert root.words() == "<1>The\n cap<1><2>" and len(list(root.all("img"))) == 1


def test_tree_recovers():
    root = parse("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><p>one<p>two<div>x</p>y</div><b>bold<p>z</b>w</p><table><tr><td>1<td>2<tr><td>3</div>4</table></b></i>end")
    assert [n.words().strip() for n in root.all("li")] == ["a", "bc", "c", "d"]
    assert [len(n.children) for n in root.all("tr")] == [2, 1]
    assert root.words().endswith("34end")
    deep = parse("<div>" * 5000 + "deep" + "</div>" * 10)
    assert deep.words() == "deep" and "deep" in to_markdown(deep)


@given(st.lists(st.sampled_from(list("<>/=\"' &;#ab!-[]\x00\n") + ["<p>", "<li>", "</b>", "<table>", "<td>", "<noscript>", "&amp;", "<!--", "<![CDATA["]), max_size=40).map("".join))
def test_parsing_never_fails(markup):
    root = parse(markup)
    assert list(root.walk())
    render.render("https://h.test/", "text/html", markup.encode())


def test_tables():
    head = "<table><caption>Cap\n t</caption><tr><th>a<th>b<th>c"
    root = parse(f"{head}<tr><td>1<td><img alt=no>2<br>3|<tr><td>4</table><table class='x Infobox'>{head[7:]}<tr><td>1<td>2<tr><td>3<td>4</table><table role=presentation></table>")
    assert tables.table_section(root) == ""  # three data cells are too few
    root = parse(f"{head}<tr><td>1<td><img alt=no>2<br>3|<tr><td>4<td><table><tr><td>in</table></table>")
    assert tables.table_section(root) == "\n\n## Tables\n\n### Cap t\n\n| a | b | c |\n| --- | --- | --- |\n| 1 | 2 3\\| |  |\n| 4 | in |  |\n"
    assert tables.has_pipe_table("x\n | :-- | --- |\n") and not tables.has_pipe_table("| a | b |\n---")
    many = [["h", "i"]] + [["1", "2"]] * 60
    assert tables.pipe_table(many).count("\n| 1 | 2 |") == 50 and "first 50 of 60 rows" in tables.pipe_table(many)
    assert tables.pipe_table([["a", "b"]]) == tables.pipe_table([["a"], ["b"]]) == ""


def test_markdown():
    md = to_markdown(parse("<h2>T_x</h2><p>a <b>b </b>c<i></i> <a href='/p(1)'>l</a><br>next</p><ol start=3><li>x<li><p>y</p><p>z</p></ol><p>1. no list</p><pre>  a`b\n</pre><code>``</code><hr><table><tr><th colspan=2>h<tr><td>1<td>2</table>"), BASE)
    assert md == "## T\\_x\n\na **b** c [l](https://example.test/p(1%29)  \nnext\n\n3. x\n4. y\n\n   z\n\n1\\. no list\n\n```\n  a`b\n```\n\n``` `` ```\n\n* * *\n\n| h | h |\n| --- | --- |\n| 1 | 2 |"


@pytest.mark.parametrize(
    ("content_type", "body", "want"),
    [
        ("text/html; charset=windows-1252", "“é€”".encode("cp1252"), "“é€”"), ("text/html; charset=ISO-8859-1", b"\x93x\x81", "“x\x81"), ("text/html", '<meta charset="Shift_JIS">表'.encode("cp932"), '<meta charset="Shift_JIS">表'),
        ("text/html", "<meta charset=utf-16>é".encode(), "<meta charset=utf-16>é"), ("", "été".encode(), "été"), ("", "été".encode("cp1252"), "été"), ("x; charset=nonsense", "é".encode(), "é"), ("text/plain; charset=gb2312", "漢".encode("gbk"), "漢"),
        (None, b"\xff\xfea\0", "a"), (None, b"\xef\xbb\xbfx", "x"), (None, b"", ""), ("text/xml", '<?xml version="1.0" encoding="koi8-r"?>Ы'.encode("koi8-r"), '<?xml version="1.0" encoding="koi8-r"?>Ы'),
    ],
)
def test_charsets(content_type, body, want):
    assert charset.decode(body, content_type) == want


def test_feeds():
    rss = b"""<?xml version="1.0"?><rss xmlns:dc="d"><channel><title>T</title><title>Last & one</title><description>Sub
    line</description><item><title>A &amp; b</title><link> http://x.test/1 </link><description><![CDATA[<p>Hi <b>there</b></p><script>x</script>]]></description><pubDate>Mon, 2 Jan 2006 15:04:05 -0700</pubDate></item>
    <item><dc:date>2024-02-30</dc:date></item></channel></rss>"""
    f = feeds.read_feed("application/rss+xml", rss)
    assert f.title == "Last & one" and f.entries == [feeds.Entry("A & b", "http://x.test/1", "2006-01-02", "Hi there"), feeds.Entry("", "", "2024-02-30", "")]
    assert feeds.listing(f) == "Sub line\n\nFeed with 2 entries:\n\n- **A & b** — 2006-01-02\n  http://x.test/1\n  Hi there\n\n- **(untitled)** — 2024-02-30"
    atom = b'<feed><title>A</title><entry><link rel="self" href="s"/><link rel="alternate" href="h"/><updated>2024-05-06T23:00:00-07:00</updated><content>c</content></entry></feed>'
    assert feeds.read_feed("", atom).entries == [feeds.Entry("", "h", "2024-05-06", "c")]
    rdf = b'<rdf:RDF xmlns:rdf="r"><channel><title>R</title></channel><item><title>out</title></item></rdf:RDF>'
    assert feeds.read_feed("text/xml", rdf).entries[0].title == "out"
    for ct, body in (("image/svg+xml", b"<svg/>"), ("text/plain", b"just text"), ("application/json", rss), ("text/xml", b"<rss><channel>"), ("text/xml", b'<!DOCTYPE r [<!ENTITY a "b">]><rss>&a;</rss>')):
        assert feeds.read_feed(ct, body) is None
    many = feeds.Feed("t", "", [feeds.Entry(str(i)) for i in range(101)])
    assert "101 entries (showing the first 100):" in feeds.listing(many) and "**99**" in feeds.listing(many) and "**100**" not in feeds.listing(many)


@pytest.mark.parametrize(("stamp", "want"), [("2023-02-30T10:00:00Z", "2023-02-30T10:00:00Z"), ("2023-02-28T24:00:00Z", "2023-02-28T24:00:00Z"), (" 2023-02-28T23:00:00.5+02:00 ", "2023-02-28"), ("Fri, 31 feb 2023 10:00:00 GMT", "Fri, 31 feb 2023 10:00:00 GMT"), ("fri, 3 FEB 2023  10:00:00 +0200", "2023-02-03"), ("last\n week", "last week")])
def test_feed_dates(stamp, want):
    assert feeds.feed_date(stamp) == want


def _pdf(stream: bytes, flate: bool, extra: bytes = b"") -> bytes:
    data = zlib.compress(stream) if flate else stream
    return (
        b"%%PDF-1.4\n1 0 obj<</Type/Catalog/Pages 2 0 R>>endobj 2 0 obj<</Type/Pages/Kids[3 0 R]/Count 1>>endobj 3 0 obj<</Type/Page/Parent 2 0 R/Resources<</Font<</F1 5 0 R>>>>/Contents[4 0 R]>>endobj\n4 0 obj<</Length %d%s>>stream\n" % (len(data), b"/Filter/FlateDecode" if flate else b"")
        + data + b"\nendstream endobj 5 0 obj<</Type/Font/Subtype/Type0/ToUnicode 6 0 R>>endobj 6 0 obj<<>>stream\n1 beginbfchar <0001> <00e9> endbfchar 1 beginbfrange <0002> <0004> <0061> endbfrange\nendstream endobj " + extra + b"%%EOF"
    )


def test_pdf():
    assert pdf.pdf_text(_pdf(b"BT (One \\(two\\) \\351) Tj 0 -9 Td (three) Tj ET", True)) == ("--- page 1 ---\n\nOne (two) é\nthree", 1)
    assert pdf.pdf_text(_pdf(b"BT /F1 9 Tf <000100020003> Tj ET", False)) == ("--- page 1 ---\n\néab", 1)
    assert pdf.pdf_text(_pdf(b"q 1 0 0 1 0 0 cm Q", False)) is None
    assert pdf.pdf_text(b"garbage") is None and pdf.pdf_text(b"%PDF-1.4 nothing") is None
    assert pdf.pdf_text(_pdf(b"BT (x) Tj ET", False, b"trailer<</Encrypt 9 0 R>>")) is None
    assert render.render("u", "application/octet-stream", _pdf(b"BT (x) Tj ET", True) + b"\0")["markdown"] == "[PDF document, 1 pages — extracted text layer]\n\n--- page 1 ---\n\nx"
    assert render.render("u", "application/pdf", b"\0bad")["markdown"].startswith("[application/pdf content, 4 bytes — no")


@given(st.binary(max_size=200))
def test_pdf_never_fails(junk):
    pdf.pdf_text(b"%PDF-1.4\n4 0 obj<</Type/Page/Contents 5 0 R>>endobj 5 0 obj<<>>stream\nBT " + junk + b" Tj [ TJ ET\nendstream endobj")


def test_pictures():
    rgba = np.zeros((100, 300, 4), np.uint8)
    rgba[..., 0], rgba[..., 3] = 200, 255
    png = pixels.write_png(rgba)
    assert pixels.image_size(png) == (300, 100) and (pixels.read_png(png) == rgba).all()
    out = pixels.fetched_image("image/png", png, 150)
    assert (out["width"], out["height"], out["resized"], out["orig_w"], out["error"]) == (150, 50, True, 300, "")
    small = pixels.read_png(out["data"])
    assert small.shape == (50, 150, 4) and (small[..., 0] == 200).all() and (small[..., 3] == 255).all()
    assert pixels.fetched_image("image/png", png, 400)["data"] == png
    assert "over the 10 B cap" in pixels.fetched_image("", png, 0, 10)["error"]
    assert pixels.fetched_image("text/html", b"<html>")["error"].startswith("unsupported or non-image content (text/html)")
    huge = b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">II", 100_000, 100_000)
    assert "exceed the safe decode limit" in pixels.fetched_image("", huge)["error"]
    assert pixels.image_size(b"GIF89a" + struct.pack("<HH", 7, 9)) == (7, 9)
    assert pixels.image_size(b"\xff\xd8\xff\xe0\0\4xx\xff\xc0\0\x11\x08" + struct.pack(">HH", 5, 6) + b"\0" * 9) == (6, 5)
    assert pixels.image_size(b"RIFF\0\0\0\0WEBPVP8X" + b"\0" * 8 + b"\x09\0\0\x04\0\0") == (10, 5)
    assert "resize failed" in pixels.fetched_image("image/gif", b"GIF89a" + struct.pack("<HH", 900, 9), 10)["error"]
    assert "no decoder" in pixels.fetched_image("image/webp", b"RIFF\0\0\0\0WEBPVP8X" + b"\0" * 8 + b"\x09\0\0\x04\0\0", 3)["error"]


@given(st.binary(min_size=1, max_size=3000), st.integers(2, 8))
def test_lzw(data, least):
    data = bytes(b % (1 << least) for b in data)
    assert pixels._lzw_decoded(pixels._lzw_encoded(data, least), least, len(data)) == data


def test_gif():
    rng = np.random.default_rng(3)
    levels = [np.rint(np.arange(n) * 255 / (n - 1)) for n in (6, 7, 6)]
    rgba = np.stack([rng.choice(x, (90, 120)) for x in levels] + [np.full((90, 120), 255)], axis=-1).astype(np.uint8)
    rgba[:9, :9] = 0
    gif = pixels.write_gif(rgba)
    assert pixels.image_size(gif) == (120, 90) and (pixels.read_gif(gif) == rgba).all()
    flat = np.zeros((100, 200, 4), np.uint8) + np.array([255, 0, 255, 255], np.uint8)
    out = pixels.fetched_image("image/gif", pixels.write_gif(flat), 50)
    assert (out["mime"], out["width"], out["height"], out["error"]) == ("image/gif", 50, 25, "") and (pixels.read_gif(out["data"]) == flat[:25, :50]).all()
    # two colours, four interlaced lines, one clear
    small = b"GIF89a" + struct.pack("<HHBBB", 1, 4, 0x80, 0, 0) + bytes([9, 9, 9, 7, 7, 7]) + b"\x21\xf9\x04\x01\0\0\1\0\x2c" + struct.pack("<HHHHB", 0, 0, 1, 4, 0x40) + b"\2"
    data = pixels._lzw_encoded(bytes([0, 0, 1, 0]), 2)
    got = pixels.read_gif(small + bytes([len(data)]) + data + b"\0;")
    assert [tuple(x) for x in got[:, 0]] == [(9, 9, 9, 255), (0, 0, 0, 0), (9, 9, 9, 255), (9, 9, 9, 255)]
    for cut in (10, 20, len(gif) // 2):
        with pytest.raises(ValueError):
            pixels.read_gif(gif[:cut])


@pytest.mark.parametrize("kind", range(5))
def test_png_filters(kind):
    rng = np.random.default_rng(kind)
    lines = rng.integers(0, 256, (6, 12), np.uint8)
    coded, above = [], np.zeros(12, np.int64)
    for line in lines.astype(np.int64):
        left, corner = np.concatenate((np.zeros(3, np.int64), line[:-3])), np.concatenate((np.zeros(3, np.int64), above[:-3]))
        p = left + above - corner
        paeth = np.where((abs(p - left) <= abs(p - above)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - above) <= abs(p - corner), above, corner))
        coded.append(bytes([kind]) + ((line - (0, left, above, (left + above) // 2, paeth)[kind]) % 256).astype(np.uint8).tobytes())
        above = line
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + b"\0\0\0\0"
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 6, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(coded))) + chunk(b"IEND", b"")
    assert (pixels.read_png(png)[..., :3].reshape(6, 12) == lines).all()


def test_article():
    html = b"""<html><head><title>The title</title></head><body><nav><img src="/logo.png"><a href="/x">Menu</a></nav><article><p>The first paragraph of the article, long enough to count.</p><p>The second one has a
    <a href="rel">link</a>.</p><p>And here is the third one, for good measure.</p></article><footer>Footer</footer><script>var x = "no";</script></body></html>"""
    r = render.render("https://h.test/d/", "text/html", html)
    assert r["title"] == "The title" and "second one has a [link](https://h.test/d/rel)." in r["markdown"]
    assert not any(x in r["markdown"] for x in ("Menu", "Footer", "var x"))
    assert r["images"][0]["url"] == "https://h.test/logo.png" and not r["images_inline"] and [x["url"] for x in r["links"]] == ["https://h.test/x", "https://h.test/d/rel"]
    with_image = html.replace(b"<article>", b'<article><figure><img src="p.jpg" alt="P_x"></figure>')
    r = render.render("https://h.test/d/", "text/html", with_image)
    assert "[image:1: P_x]" in r["markdown"] and r["images_inline"] and [i["url"] for i in r["images"]] == ["https://h.test/d/p.jpg"]
    r = render.render("https://h.test/d/", "text/html", with_image, inline_images=True)
    assert "![P\\_x](https://h.test/d/p.jpg)" in r["markdown"] and r["images"] == []


def test_bodies_that_are_no_pages():
    r = lambda ct, b: render.render("u", ct, b)["markdown"]
    assert r("text/plain", b"  plain body \n") == "plain body"
    assert r("image/png", b"\x89PNG\0") == "[image/png content, 5 bytes — not rendered as text]" and r("", b"a\0") == "[binary content, 2 bytes — not rendered as text]"
    assert r("image/svg+xml", b"<svg>t</svg>") == "<svg>t</svg>"
    assert r("text/html", b"") == "" and r("", b"<HTML>x &amp; y") == "x & y"
    long = render.render("u", "text/plain", b"x" * 500_001)
    assert long["markdown_capped"] and long["markdown"].endswith("\n\n\xe2\x80\xa6[Markdown output capped at 500000 runes]".encode("latin-1").decode())


def test_rendered_tables(spark):
    rows = [(1, "https://h.test/", "text/html", b"<html><title>t</title><p>some words that are long enough", "x"), (1, None, None, None, "x"), (2, "u", "text/plain", b"", "x"), (3, None, "text/html", b"\xff" * 10, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, kind string, body binary, title string")
    got = render.rendered(df, F.col("url"), F.col("kind"), F.col("body"), [F.col("page_id"), F.col("title").alias("given")]).collect()
    assert [(r.page_id, r.given, r.title, r.markdown) for r in got] == [(1, "x", "t", "some words that are long enough"), (1, "x", None, None), (2, "x", "", ""), (3, None, "", "ÿ" * 10)]
    assert render.rendered(df.limit(0), F.col("url"), F.col("kind"), F.col("body"), []).count() == 0
