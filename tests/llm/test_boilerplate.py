"""p3: a generated host with known slots, HTML with a declared charset, and edge tables."""

import gzip
import random

from pagemill.llm import boilerplate as bp

NOUNS = "ledger lantern turbine footbridge timetable granary beehive notebook furnace orchard".split()
PAGES = "page_id long, host string, cache_key string, title string, content_type string, markdown string, raw_gzip binary, text string"


def page(k, r, as_html=False):
    """Lines with whether they are boilerplate."""
    title = f"About the {r.choice(NOUNS)} and the {r.choice(NOUNS)} {k}"
    para = lambda: f"The {r.choice(NOUNS)} of {k} was moved to the {r.choice(NOUNS)} by {r.randint(2, 900)} people. Nobody near the {r.choice(NOUNS)} objected to it until {r.randint(2, 900)} days later."
    out = [("Home", True), ("Contact us", True), ("Archive", True), (f"# {title}", False), (f"By Writer{k} Name{k}", False), (para(), False)]
    if r.random() < 0.6:
        out.append((f"Read also: The {r.choice(NOUNS)} of {r.randint(2, 900)}{r.choice('abcdef')}", True))
    out += [(para(), False), ("| a | b |", False), ("- item " + "".join(r.choices("abcdefgh", k=8)), False), (para(), False)]
    out += [("### More stories", True), (f"How a {r.choice(NOUNS)} met one {r.choice(NOUNS)} {k}", True), (f"A {r.choice(NOUNS)} was sold by {k}.", True), ("Privacy", True), ("© 2020 The Paper. All rights reserved.", True)]
    if as_html:
        body = [("<html><head><style>a{}</style></head>", None)] + [(f"<h1>{x[2:]}</h1>" if x.startswith("# ") else f"<p>{x.lstrip('#- ')} café</p>" if x[0] != "|" else f"<tr><td>{x}</td></tr>", d) for x, d in out]
        return title, body
    return title, out


def build(n=40):
    r = random.Random(5)
    rows, want = [], set()
    for k in range(n):
        title, lines = page(k, r)
        rows.append((k, "a.test", f"https://a.test/{k}", title, "text/html", "\n\n".join(x for x, _ in lines), None, "x"))
        want |= {("page.markdown", k, 2 * i) for i, (_, d) in enumerate(lines) if d}
    return rows, want


def test_template(spark):
    rows, want = build()
    rows += [rows[0], (900, None, None, None, None, "", None, "x"), (901, "b.test", None, None, None, None, None, "x"), (902, "b.test", "k", "t", "text/html", None, b"not gzip", "x"), (903, "c.test", "k", None, None, "x" * 100_000 + "\n\n\n", None, "x")]
    got = [tuple(r) for r in bp.boilerplate_lines(spark.createDataFrame(rows, PAGES)).collect()]
    assert len(got) == len(set(got))
    hit = set(got) & want
    assert len(hit) >= 0.97 * len(want) and len(hit) >= 0.97 * len(got)


def test_html_in_its_charset(spark):
    r = random.Random(9)
    rows, want = [], set()
    for k in range(40):
        title, lines = page(k, r, as_html=True)
        raw = gzip.compress("\n".join(x for x, _ in lines).encode("cp1252"))
        rows.append((k, "a.test", f"https://a.test/{k}", title, "text/html; charset=windows-1252", None, raw, "x"))
        want |= {("page.raw_gzip", k, i) for i, (_, d) in enumerate(lines) if d}
    assert all("café" in bp.page_text(None, x[6], x[4])[0] for x in rows)
    lines = bp.classified_lines(spark.createDataFrame(rows, PAGES)).collect()
    got = {(x.field_name, x.page_id, x.line_no) for x in lines if x["drop"]}
    assert len(got & want) >= 0.97 * max(len(got), len(want))


def test_plans_agree(spark):
    """Whether the template is broadcast or shuffled changes no row."""
    df = spark.createDataFrame(build()[0], PAGES)
    rows = lambda x: sorted(map(tuple, x.collect()))
    assert rows(bp.boilerplate_lines(df)) == rows(bp.boilerplate_lines(df, limit=0))


def test_republished_article(spark):
    """An article that stands under several addresses of its host keeps its paragraphs."""
    for copies in (2, 4):
        rows, want = build(42)
        again = [(500 + c, "a.test", f"https://a.test/print/{c}", *rows[0][3:]) for c in range(copies - 1)]
        want |= {("page.markdown", x[0], no) for x in again for f, k, no in want if k == 0}
        got = {tuple(r) for r in bp.boilerplate_lines(spark.createDataFrame(rows + again, PAGES)).collect()}
        ids = {0, *(x[0] for x in again)}
        assert {x for x in got if x[1] in ids} <= want


def test_lines():
    lines = bp.page_lines("# Head\n\n- [Menu](https://x.test/a)\n```\n# code\n```\n* * *\n> quote", False)
    assert [(x.no, x.text, x.held) for x in lines] == [(0, "Head", False), (2, "Menu", False), (4, "# code", True), (7, "quote", True)]
    assert [x.no for x in bp.page_lines("<div>\n<script>\nvar a='<p>x</p>'\n</script>\n<p>shown</p>", True)] == [4]


def test_bodies_of_several_members():
    parts = [b"<html>one\n", b"", b"two\n" * 5000]
    assert bp.page_text(None, b"".join(map(gzip.compress, parts)), "text/html; charset=utf-8") == (b"".join(parts).decode(), True)


def test_empty(spark):
    assert bp.boilerplate_lines(spark.createDataFrame([], PAGES)).count() == 0
