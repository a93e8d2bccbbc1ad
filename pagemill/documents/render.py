"""Served bodies as pages: title, Markdown, links and images. Every body is parsed once."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.documents import harvest
from pagemill.documents.charset import decode
from pagemill.documents.dom import one_line, parse, trim
from pagemill.documents.feeds import listing, plain_of_markup, read_feed
from pagemill.documents.markdown import to_markdown
from pagemill.documents.pdf import is_pdf, pdf_text
from pagemill.documents.readable import main_content
from pagemill.documents.tables import has_pipe_table, table_section

# Types that are text, the cap of a page's text with its note, and what is said of bodies that aren't text.
TEXT_TYPES = ("application/json", "application/xml", "application/xhtml+xml", "application/javascript", "application/ecmascript", "image/svg+xml")
MAX_RUNES, TITLE = 500_000, 300
CAPPED = "\n\n…[Markdown output capped at {} runes]"
NO_TEXT_LAYER = "[application/pdf content, {} bytes — no extractable text layer (encrypted, malformed, or scanned images); use web_fetch_raw to save the file]"
NOT_TEXT = "[{} content, {} bytes — not rendered as text]"
PDF_HEAD = "[PDF document, {} pages — extracted text layer]\n\n"

_HEADER_CELL = re.compile("<th", re.I)
#: An image's mark in a tree that becomes Markdown; its first and last characters are for private use and stand on no page's own behalf.
_MARK = re.compile("\ue0f0(\\d+)\ue0f1")

IMAGE = "struct<id: int, url: string, alt: string, caption: string, width: string, height: string, source_page: string>"
PAGE = f"title string, markdown string, markdown_capped boolean, images array<{IMAGE}>, images_inline boolean, links array<struct<url: string, text: string>>"
_STRINGS = lambda *names: [(n, pa.string()) for n in names]
PAGE_FIELDS = [
    ("title", pa.string()), ("markdown", pa.string()), ("markdown_capped", pa.bool_()),
    ("images", pa.list_(pa.struct([("id", pa.int32()), *_STRINGS("url", "alt", "caption", "width", "height", "source_page")]))),
    ("images_inline", pa.bool_()), ("links", pa.list_(pa.struct(_STRINGS("url", "text")))),
]


def title_line(title: str) -> str:
    title = one_line(title)
    return title[:TITLE] + "…" if len(title) > TITLE else title


def _bare(content_type: str | None) -> str:
    return trim(trim(content_type or "").split(";", 1)[0])


def is_textual(content_type: str | None, body: bytes) -> bool:
    kind = _bare(content_type).lower()
    if not kind:
        return b"\x00" not in body[:1024]
    return kind.startswith("text/") or kind in TEXT_TYPES or kind.endswith(("+json", "+xml"))


def _page(title: str = "", markdown: str = "", images: list | None = None, inline: bool = False, links: list | None = None) -> dict:
    capped = len(markdown) > MAX_RUNES
    return {
        "title": title, "markdown": markdown[:MAX_RUNES] + CAPPED.format(MAX_RUNES) if capped else markdown, "markdown_capped": capped,
        "images": [i.as_row() for i in images or []], "images_inline": inline, "links": [{"url": u, "text": t} for u, t in links or []],
    }


def _html(text: str, base: str, inline_images: bool) -> dict:
    root = parse(text)
    links = harvest.links(root, base)
    everywhere = harvest.all_images(root, base) if not inline_images and harvest.may_have_images(text) else []
    tables = table_section(root) if _HEADER_CELL.search(text) else ""
    title, content = main_content(root)
    if content is None:
        return _page("", plain_of_markup(text), everywhere, False, links)
    images = [] if inline_images else harvest.mark_images(content, base, lambda n: f" \ue0f0{n}\ue0f1 ")
    markdown = to_markdown(content, base, _MARK, inline_images)
    named = {i.id: i.placeholder for i in images}
    markdown = _MARK.sub(lambda m: named.get(int(m[1]), ""), markdown)
    if not markdown:
        return _page("", plain_of_markup(text), everywhere, False, links)
    if not has_pipe_table(markdown):
        markdown += tables
    return _page(title_line(title), markdown, images or everywhere, bool(images), links)


def render(url: str, content_type: str | None, body: bytes, inline_images: bool = False) -> dict:
    """A body as a page.

    HTML gives the main content as Markdown with the whole document's links, and its
    images as ``[image:n]`` (or, with ``inline_images``, as Markdown images and no list).
    Feeds give their entries, other text itself, PDF its text layer, anything else a
    summary. HTML without main content gives all its text and no title.
    """
    kind = (content_type or "").lower()
    if "html" in kind or not kind and b"<html" in body.lower():
        return _html(decode(body, content_type), url, inline_images)
    if not is_textual(content_type, body):
        if is_pdf(content_type, body):
            found = pdf_text(body)
            return _page(markdown=PDF_HEAD.format(found[1]) + found[0] if found else NO_TEXT_LAYER.format(len(body)))
        return _page(markdown=NOT_TEXT.format(_bare(content_type) or "binary", len(body)))
    feed = read_feed(content_type, body)
    if feed is not None:
        return _page(title_line(feed.title), listing(feed))
    return _page(markdown=trim(decode(body, content_type)))


def rendered(responses: DataFrame, url: Column, content_type: Column, body: Column, keep: list[Column], inline_images: bool = False) -> DataFrame:
    """The columns ``keep`` and a page's (title, markdown, markdown_capped, images, images_inline, links) for each row of ``responses``.

    ``url`` is the address after redirects, against which references resolve. A null body
    gives a page of nulls, an empty one an empty page. A body that can't be parsed never
    fails the job: its page holds the text that is left without tags.
    """
    picked = responses.select(url.cast("string").alias("__url"), content_type.cast("string").alias("__type"), body.cast("binary").alias("__body"), *keep)
    names = picked.schema.names[3:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pages = []
            for u, t, x in zip(*(b.column(i).to_pylist() for i in range(3))):
                try:
                    pages.append({} if x is None else render(u or "", t, x, inline_images))
                except (ValueError, RecursionError, AssertionError):
                    pages.append(_page(markdown=plain_of_markup(decode(x, t))))
            cols = [pa.array([p.get(n) for p in pages], kind) for n, kind in PAGE_FIELDS]
            yield pa.RecordBatch.from_arrays([*b.columns[3:], *cols], names=[*names, *(n for n, _ in PAGE_FIELDS)])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[3:])
    return picked.mapInArrow(run, f"{kept}, {PAGE}" if kept else PAGE)


def from_body(df: DataFrame, body: Column, keep: list[Column], schema: str, read) -> DataFrame:
    """The columns ``keep`` and those of ``schema``; ``read(body)`` gives the rows of one body as dicts, none for a null body."""
    picked = df.select(body.alias("__body"), *keep)
    types = F.lit(None).cast(f"struct<{schema}>")
    target = df.sparkSession.range(0).select(types.alias("x")).select("x.*").schema
    kept = picked.schema.fields[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, rows = [], []
            for i, x in enumerate(b.column(0).to_pylist()):
                found = [] if x is None else read(x)
                rows += found
                at += [i] * len(found)
            part = b.take(pa.array(at, pa.int64()))
            cols = [pa.array([r[f.name] for r in rows], kinds[f.name]) for f in target.fields]
            yield pa.RecordBatch.from_arrays([*part.columns[1:], *cols], names=[*(f.name for f in kept), *target.names])

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = {f.name: to_arrow_type(f.dataType) for f in target.fields}
    return picked.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*kept, *target.fields]))
