"""Queries of the document parsers. Most parse markup that is made of the tables' own columns, so that SQL can say what must come out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.documents import feeds, harvest, render, tables
from pagemill.documents.address import link_target
from pagemill.documents.charset import decode
from pagemill.documents.dom import parse
from pagemill.operators import pages, search
from pagemill.plans.reference import _CAP, _FEED_DATE, _LINE, _RANKED, _TRIM, PAGE_LINKS, QUERY_NORMALIZE, _plain
from pagemill.session import table


def escaped(c: Column) -> Column:
    """Text as markup; null as the empty string."""
    out = F.coalesce(c, F.lit(""))
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(char), F.lit(name))
    return out


def _utf8(*parts: Column | str) -> Column:
    return F.encode(F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts)), "UTF-8")


# -- links ---------------------------------------------------------------------------------------------------------------

_LINK = "url string, text string, pos int"


def _read_links(body: bytes) -> list[dict]:
    base, markup = body.decode("utf-8").split("\n", 1)
    return [{"url": u, "text": t, "pos": i} for i, (u, t) in enumerate(harvest.links(parse(markup), base), 1)]


def html_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of a document for each page: what ``links`` has of it, every second one on the page's own host as a reference to be resolved."""
    c = F.col
    rows = table(spark, d, "links").where("url is not null")
    own = F.concat(F.lit("https://"), c("host"), F.lit("/"))
    href = F.when((c("pos") % 2 == 0) & c("url").startswith(own), F.substring(c("url"), F.length(own), F.length("url"))).otherwise(c("url"))
    a = F.concat(F.lit('<li><a class="x" href=" '), escaped(href), F.lit(' ">'), escaped(c("text")), F.lit("</a>"))
    by_page = rows.groupBy("page_id", "host").agg(F.array_sort(F.collect_list(F.struct("pos", "link_id", a.alias("a")))).alias("as"))
    body = _utf8("https://", F.coalesce(c("host"), F.lit("none.test")), '/d/e\n<html><body><nav><ul><a href="#top">top</a><a href="JavaScript:x()">x</a><a>none</a>', F.array_join(F.transform("as", lambda x: x["a"]), "\n"), "</ul></nav></body></html>")
    return render.from_body(by_page, body, [c("page_id")], _LINK, _read_links)


# a page has one host; addresses in the table need no resolution
HTML_LINKS = f"""with f as ({PAGE_LINKS}), o as (select page_id, url, {_LINE("text")} as text, row_number() over (partition by page_id order by pos, lid) as pos from
(select page_id, url, text, pos, link_id as lid from (select *, row_number() over (partition by page_id, url order by pos nulls first, link_id) as n from links where url is not null) where n = 1))
select page_id, url, text, pos::int as pos from o"""


def link_resolution(spark: SparkSession, d: str) -> DataFrame:
    """References of several kinds against each page's address."""
    kinds = ("../up/x", "./same", "?q=1", "//other.test/a/../b", "/abs/./path", "für", "#frag", "MAILTO:a@b.test", "", "a%zz", "x y")
    c = F.col
    ref = F.element_at(F.array(*map(F.lit, kinds)), (c("page_id") % len(kinds) + 1).cast("int"))
    base = F.concat(F.lit("https://"), F.coalesce(c("host"), F.lit("none.test")), F.lit("/d/e/"), c("page_id").cast("string"))
    rows = table(spark, d, "rendered").select("page_id", _utf8(base, "\n", ref).alias("b"))
    return render.from_body(rows, c("b"), [c("page_id")], "url string", lambda b: [{"url": link_target(b.decode().split("\n", 1)[1], b.decode().split("\n", 1)[0])}])


LINK_RESOLUTION = """with r as (select page_id, page_id % 11 as k, 'https://' || coalesce(host, 'none.test') as h, '/d/e/' as p from rendered)
select page_id, case k when 0 then h || '/d/up/x' when 1 then h || p || 'same' when 2 then h || p || page_id || '?q=1' when 3 then 'https://other.test/b' when 4 then h || '/abs/path' when 5 then h || p || 'f%C3%BCr'
when 7 then 'mailto:a@b.test' when 10 then h || p || 'x%20y' else '' end as url from r"""


def link_domains(spark: SparkSession, d: str) -> DataFrame:
    """How many links of each page lead to hosts under its sites' domains, by semi-join, and how many elsewhere, by anti-join."""
    c = F.col
    from pagemill.functions import urls

    links = pages.first_links(table(spark, d, "links")).select("page_id", "url", F.lower(urls.url_part(c("url"), 2)).alias("target"))
    # a host and every domain above it, to be met by equality
    parts = F.split("target", r"\.")
    above = links.select("page_id", "url", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))).alias("domain"))
    known = table(spark, d, "sites").select(F.lower("host").alias("domain")).distinct()
    inside = above.join(known, "domain", "left_semi").select("page_id", "url").distinct().withColumn("inside", F.lit(1))
    return links.join(inside, ["page_id", "url"], "left").groupBy("page_id").agg(F.count("inside").alias("inside"), F.count_if(c("inside").isNull()).alias("outside"))


LINK_DOMAINS = """with l as (select distinct page_id, url, lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '')) as h from links where url is not null),
t as (select distinct h from l), k as (select h, exists (select 1 from sites s where t.h = lower(s.host) or ends_with(t.h, '.' || lower(s.host))) as i from t)
select page_id, count(*) filter (i) as inside, count(*) filter (not i) as outside from l join k on l.h = k.h group by page_id"""


# -- images --------------------------------------------------------------------------------------------------------------

_IMAGE = "id int, url string, alt string, caption string, width string, height string, source_page string"


def html_images(spark: SparkSession, d: str) -> DataFrame:
    """Images of a document for each page, written in six ways by the place: plain, lazy, as a source set, in noscript, as a background, in a figure with a link."""
    c = F.col
    rows = table(spark, d, "rendered").dropDuplicates(["page_id"]).where("size(images) > 0")

    def tag(im: Column, i: Column) -> Column:
        url, alt = escaped(im["url"]), escaped(im["alt"])
        size = F.concat(F.lit('" width="'), escaped(im["width"]), F.lit('" height="'), escaped(im["height"]), F.lit('">'))
        img = F.concat(F.lit('<img src="'), url, F.lit('" alt="'), alt, size)
        return (
            F.when(i % 6 == 0, img)
            .when(i % 6 == 1, F.concat(F.lit('<img src="data:image/gif;base64,R0=" data-src="'), url, F.lit('" alt="'), alt, size))
            .when(i % 6 == 2, F.concat(F.lit('<picture><source srcset="'), url, F.lit(' 2x, small.png 1x"></picture>')))
            .when(i % 6 == 3, F.concat(F.lit("<noscript>"), img, F.lit("</noscript>")))
            .when(i % 6 == 4, F.concat(F.lit("<div data-bg=\"url('"), url, F.lit("')\"></div>")))
            .otherwise(F.concat(F.lit('<figure><a href="/File:'), i.cast("string"), F.lit('">'), img, F.lit("</a><figcaption> "), escaped(im["caption"]), F.lit("\n</figcaption></figure>")))
        )

    body = _utf8("<html><body>", F.array_join(F.transform("images", tag), "\n"), "</body></html>")
    return render.from_body(rows, body, [c("page_id")], _IMAGE, lambda b: [i.as_row() for i in harvest.all_images(parse(b.decode()), "https://h.test/d/e")])


HTML_IMAGES = f"""with r as (select distinct on (page_id) page_id, images from rendered where len(images) > 0), e as (select page_id, unnest(images) as im, generate_subscripts(images, 1) - 1 as i from r),
f as (select *, im.url as url, row_number() over (partition by page_id, im.url order by i) as n from e where coalesce(im.url, '') <> ''), g as (select *, row_number() over (partition by page_id order by i) as id, i % 6 in (0, 1, 3, 5) as img from f where n = 1)
select page_id, id::int as id, url, case when img then {_TRIM("im.alt")} else '' end as alt, case when i % 6 = 5 then {_LINE("im.caption")} else '' end as caption, case when img then {_TRIM("im.width")} else '' end as width,
case when img then {_TRIM("im.height")} else '' end as height, case when i % 6 = 5 then 'https://h.test/File:' || i else '' end as source_page from g"""


# -- tables --------------------------------------------------------------------------------------------------------------


def _table_section(body: bytes) -> list[dict]:
    return [{"markdown": tables.table_section(parse(body.decode()))}]


def table_markdown(spark: SparkSession, d: str) -> DataFrame:
    """The nations of each region as a data table with a caption, in markup that leaves end tags out."""
    c = F.col
    row = F.concat(F.lit("<tr><td>"), c("n_nationkey").cast("string"), F.lit("<td><b>"), escaped(c("n_name")), F.lit("</b>\n<i>a|b</i><img src=x.png>"))
    rows = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", row.alias("r")))).alias("rs"))
    named = rows.join(F.broadcast(table(spark, d, "region")), rows.n_regionkey == c("r_regionkey"))  # a fixed table of five rows
    body = _utf8("<table><caption>Nations of\n ", escaped(c("r_name")), "</caption><tr><th>key<th>name<th>none", F.array_join(F.transform("rs", lambda x: x["r"]), ""), "</table>")
    return render.from_body(named, body, [c("r_regionkey")], "markdown string", _table_section)


TABLE_MARKDOWN = """select r_regionkey, chr(10) || chr(10) || '## Tables' || chr(10) || chr(10) || '### Nations of ' || r_name || chr(10) || chr(10) || '| key | name | none |' || chr(10) || '| --- | --- | --- |' || chr(10)
|| string_agg('| ' || n_nationkey || ' | ' || n_name || ' a\\|b |  |', chr(10) order by n_nationkey) || chr(10) as markdown from nation join region on n_regionkey = r_regionkey group by r_regionkey, r_name"""


def table_row_cap(spark: SparkSession, d: str) -> DataFrame:
    """The customers of each nation as a data table: fifty rows, and how many there are."""
    c = F.col
    row = F.concat(F.lit("<tr><td>"), c("c_custkey").cast("string"), F.lit("</td><td>"), escaped(c("c_name")), F.lit("</td></tr>"))
    rows = table(spark, d, "customer").groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("c_custkey", row.alias("r")))).alias("rs"))
    body = _utf8('<div role="main"><table class="data"><thead><tr><th>key</th><th>name</th></tr></thead><tbody>', F.array_join(F.transform("rs", lambda x: x["r"]), "\n"), "</tbody></table></div>")
    return render.from_body(rows, body, [c("c_nationkey")], "markdown string", _table_section)


TABLE_ROW_CAP = """with k as (select *, row_number() over (partition by c_nationkey order by c_custkey) as n, count(*) over (partition by c_nationkey) as total from customer),
t as (select c_nationkey, max(total) as total, string_agg('| ' || c_custkey || ' | ' || c_name || ' |', chr(10) order by n) filter (n <= 50) as rows from k group by c_nationkey)
select c_nationkey, case when total < 2 then '' else chr(10) || chr(10) || '## Tables' || chr(10) || chr(10) || '### Table 1' || chr(10) || chr(10) || '| key | name |' || chr(10) || '| --- | --- |' || chr(10) || rows
|| case when total > 50 then chr(10) || chr(10) || '*(table truncated to the first 50 of ' || total || ' rows; the rest are not reachable via offset — use web_fetch_raw for the full table)*' else '' end || chr(10) end as markdown from t"""


# -- feeds ---------------------------------------------------------------------------------------------------------------


def _read_feed(body: bytes) -> list[dict]:
    feed = feeds.read_feed("application/xml", body)
    return [{"title": feed.title if feed else None, "listing": feeds.listing(feed) if feed else None}]


def _xml_text(c: Column) -> Column:
    """Text as XML has it: what XML can't hold is left out."""
    return escaped(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x{fffe}\x{ffff}\r]", ""))


def _feed_bodies(rows: DataFrame, key: str, entry: Column, head: Column, tail: str) -> DataFrame:
    c = F.col
    lists = rows.dropDuplicates([key]).groupBy("feed_url").agg(F.array_sort(F.collect_list(F.struct(key, entry.alias("e")))).alias("es"))
    body = _utf8(head, F.array_join(F.transform("es", lambda x: x["e"]), "\n"), tail)
    return render.from_body(lists, body, [c("feed_url")], "title string, listing string", _read_feed)


def feed_render(spark: SparkSession, d: str) -> DataFrame:
    """RSS feeds written as XML of the items (with bare ampersands in their head), parsed and listed."""
    c = F.col
    tag = lambda name, v: F.concat(F.lit(f"<{name}>"), _xml_text(v), F.lit(f"</{name}>"))
    entry = F.concat(F.lit("<item>"), tag("title", c("title")), tag("link", c("link")), tag("description", c("description")), tag("pubDate", c("pub_date")), tag("dc:date", c("dc_date")), F.lit("</item>"))
    head = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<rss version="2.0" xmlns:dc="x"><channel><title> Feed &nbsp;& '), _xml_text(c("feed_url")), F.lit("\n</title><description>About\n it</description>"))
    return _feed_bodies(table(spark, d, "rss_items"), "item_id", entry, head, "</channel></rss>")


def atom_render(spark: SparkSession, d: str) -> DataFrame:
    """Atom feeds written as XML of the entries, parsed and listed."""
    c = F.col
    tag = lambda name, v: F.concat(F.lit(f"<{name}>"), _xml_text(v), F.lit(f"</{name}>"))
    link = F.concat(F.lit('<link rel="self" href="no"/><link href="'), _xml_text(c("link")), F.lit('"/>'))
    entry = F.concat(F.lit("<entry>"), tag("title", c("title")), link, tag("summary", c("summary")), tag("published", c("published")), tag("updated", c("updated")), F.lit("</entry>"))
    head = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>'), _xml_text(c("feed_url")), F.lit("</title><subtitle></subtitle>"))
    return _feed_bodies(table(spark, d, "atom_entries"), "entry_id", entry, head, "</feed>")


_XML = lambda c: rf"regexp_replace(coalesce({c}, ''), '[\x{{00}}-\x{{08}}\x{{0b}}\x{{0c}}\x{{0e}}-\x{{1f}}\x{{fffe}}\x{{ffff}}\r]', '', 'g')"


def _render_sql(source: str, key: str, first: str, second: str, markup: str, title: str, subtitle: str) -> str:
    line = _LINE(_plain(_XML(markup)))
    return f"""with r as (select distinct on ({key}) * replace ({_XML("title")} as title, {_XML("link")} as link) from {source}),
s as (select *, {line} as s0, case when {_XML(first)} = '' then {_XML(second)} else {_XML(first)} end as stamp from r), t as (select *, {_FEED_DATE("stamp")} as day, case when length(s0) > 400 then s0[:400] || '…' else s0 end as said from s),
k as (select feed_url, row_number() over (partition by feed_url order by {key}) as n, chr(10) || '- **' || case when {_LINE("title")} = '' then '(untitled)' else {_LINE("title")} end || '**' || case when day <> '' then ' — ' || day else '' end
|| case when {_TRIM("link")} <> '' then chr(10) || '  ' || {_TRIM("link")} else '' end || case when said <> '' then chr(10) || '  ' || said else '' end || chr(10) as e from t)
select feed_url, {title} as title, {_TRIM(subtitle + " || 'Feed with ' || count(*) || ' entries' || case when count(*) > 100 then ' (showing the first 100)' else '' end || ':' || chr(10) || string_agg(e, '' order by n) filter (n <= 100)")} as listing from k group by feed_url"""


FEED_RENDER = _render_sql("rss_items", "item_id", "pub_date", "dc_date", "description", f"{_TRIM("'Feed ' || chr(160) || '& ' || feed_url")}", "'About it' || chr(10) || chr(10)")
ATOM_RENDER = _render_sql("atom_entries", "entry_id", "published", "updated", "summary", "feed_url", "''")


# -- charsets, heuristic text, Markdown, PDF, images ---------------------------------------------------------------------


def charset_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Every mail's text in another charset: declared windows-1252 where that has all its characters, UTF-16 with its mark, or undeclared UTF-8."""
    c, text = F.col, F.coalesce("text", F.lit(""))
    latin = text.rlike(r"^[\x00-\x7e\xa0-\xff]*$")
    body = F.when(latin & (c("doc_id") % 3 != 0), F.concat(F.lit(b"1"), F.encode(text, "ISO-8859-1"))).when(c("doc_id") % 3 == 1, F.concat(F.lit(b"0"), F.encode(text, "UTF-16"))).otherwise(F.concat(F.lit(b"0"), F.encode(text, "UTF-8")))

    def read(b: bytes) -> list[dict]:
        return [{"text": decode(b[1:], "text/plain; charset=latin1" if b[:1] == b"1" else "text/plain")}]

    rows = render.from_body(table(spark, d, "documents"), body, [c("doc_id")], "text string", read)
    return rows.select("doc_id", F.length("text").alias("length"), F.md5("text").alias("digest"))


CHARSET_ROUNDTRIP = "select doc_id, length(coalesce(text, ''))::int as length, md5(coalesce(text, '')) as digest from documents"


def heuristic_extract(spark: SparkSession, d: str) -> DataFrame:
    """The text of the items' markup without a parser of it."""
    c = F.col
    return render.from_body(table(spark, d, "rss_items"), F.encode(F.coalesce("description", F.lit("")), "UTF-8"), [c("item_id")], "text string", lambda b: [{"text": feeds.plain_of_markup(b.decode())}])


_LINES_TRIMMED = rf"array_to_string(list_transform(string_split(regexp_replace({_plain('description')}, '[ \t]+', ' ', 'g'), chr(10)), lambda x: {_TRIM('x')}), chr(10))"
HEURISTIC_EXTRACT = f"select item_id, {_TRIM(f"regexp_replace({_LINES_TRIMMED}, '\\n{{3,}}', chr(10) || chr(10), 'g')")} as text from rss_items"


def _words(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z]+", " "))


_WORDS_SQL = "trim(regexp_replace(lower(coalesce(text, '')), '[^a-z]+', ' ', 'g'))"


def markdown_main(spark: SparkSession, d: str) -> DataFrame:
    """Each mail's words as a page among menus and footers, as Markdown: its heading, paragraphs, list and link come out, the rest doesn't."""
    c = F.col
    number = c("doc_id").cast("string")
    body = _utf8(
        "<html><head><title>Mail ", number, '</title><style>p{}</style></head><body><nav><ul><li><a href="/">Home</a><li><a href="/all">All mails</a></ul></nav><div id="content"><h1>Mail ', number,
        "</h1><p>This first paragraph stands in every page, so that each of them has <b>some</b> text, and a few commas, too.<p>", _words(c("text")), '<p>See <a href="../list">the list</a> for more of it.<ul><li>one<li>two</ul></div><div class="footer">Imprint and terms</div><script>var p = "</p>";</script></body></html>',
    )
    rows = render.rendered(table(spark, d, "documents"), F.lit("https://mail.test/a/b/c"), F.lit("text/html"), body, [c("doc_id")])
    return rows.select("doc_id", "title", F.md5("markdown").alias("digest"), F.size("links").alias("links"))


MARKDOWN_MAIN = f"""with w as (select doc_id, {_WORDS_SQL} as w from documents) select doc_id, 'Mail ' || doc_id as title, 3 as links,
md5('# Mail ' || doc_id || chr(10) || chr(10) || 'This first paragraph stands in every page, so that each of them has **some** text, and a few commas, too.' || chr(10) || chr(10) || case when w = '' then '' else w || chr(10) || chr(10) end
|| 'See [the list](https://mail.test/a/list) for more of it.' || chr(10) || chr(10) || '- one' || chr(10) || '- two') as digest from w"""


def rendered_pages(spark: SparkSession, d: str) -> DataFrame:
    """Every page's served body as a page: (page_id, title, chars, capped, images, inline, links). No SQL: DuckDB has no parser of HTML."""
    c = F.col
    bodies = pages.with_bodies(table(spark, d, "rendered"), ["page_id", "final_url", "cache_key", "content_type"])
    rows = render.rendered(bodies, F.coalesce("final_url", "cache_key"), c("content_type"), c("body"), [c("page_id")])
    return rows.select("page_id", "title", F.length("markdown").alias("chars"), c("markdown_capped").alias("capped"), F.size("images").alias("images"), c("images_inline").alias("inline"), F.size("links").alias("links"))


def pdf_text(spark: SparkSession, d: str) -> DataFrame:
    """Each mail's words as a PDF of two pages, the second without text, rendered; every fifth is cut off before its text."""
    c = F.col
    stream = F.concat(F.lit("BT /F1 12 Tf 72 700 Td ("), _words(c("text")), F.lit(") Tj 0 -14 Td [(a)-300(b) 20 (c)] TJ ET"))
    body = _utf8(
        "%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n2 0 obj << /Type /Pages /Kids [3 0 R 5 0 R] /Count 2 >> endobj\n3 0 obj << /Type /Page /Parent 2 0 R /Contents 4 0 R >> endobj\n5 0 obj << /Type /Page /Parent 2 0 R >> endobj\n",
        F.when(c("doc_id") % 5 == 0, "").otherwise(F.concat(F.lit("4 0 obj << /Length "), F.length(stream).cast("string"), F.lit(" >>\nstream\n"), stream, F.lit("\nendstream\nendobj\n"))), "%%EOF",
    )
    rows = render.rendered(table(spark, d, "documents"), F.lit("https://h.test/x.pdf"), F.lit("application/pdf"), body, [c("doc_id"), F.length(body).alias("bytes")])
    return rows.select("doc_id", F.md5("markdown").alias("digest"), "bytes")


_STREAM = f"'BT /F1 12 Tf 72 700 Td (' || {_WORDS_SQL} || ') Tj 0 -14 Td [(a)-300(b) 20 (c)] TJ ET'"
PDF_TEXT = f"""with w as (select doc_id, {_WORDS_SQL} as w, length({_STREAM}) as n from documents),
b as (select *, 236 + case when doc_id % 5 = 0 then 0 else 19 + length(n::varchar) + 11 + n + 18 end as bytes from w)
select doc_id, bytes::int as bytes, md5(case when doc_id % 5 = 0 then '[application/pdf content, ' || bytes || ' bytes — no extractable text layer (encrypted, malformed, or scanned images); use web_fetch_raw to save the file]'
else '[PDF document, 2 pages — extracted text layer]' || chr(10) || chr(10) || '--- page 1 ---' || chr(10) || chr(10) || case when w = '' then '' else w || chr(10) end || 'a bc' end) as digest from b"""


def document_queries() -> dict:
    return {
        "html_links": (html_links, HTML_LINKS), "link_resolution": (link_resolution, LINK_RESOLUTION), "link_domains": (link_domains, LINK_DOMAINS), "html_images": (html_images, HTML_IMAGES), "table_markdown": (table_markdown, TABLE_MARKDOWN), "table_row_cap": (table_row_cap, TABLE_ROW_CAP),
        "feed_render": (feed_render, FEED_RENDER), "atom_render": (atom_render, ATOM_RENDER), "charset_roundtrip": (charset_roundtrip, CHARSET_ROUNDTRIP), "heuristic_extract": (heuristic_extract, HEURISTIC_EXTRACT), "markdown_main": (markdown_main, MARKDOWN_MAIN),
        "rendered_pages": (rendered_pages, None), "pdf_text": (pdf_text, PDF_TEXT),
    }
