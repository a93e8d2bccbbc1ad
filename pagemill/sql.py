"""The document parsers as SQL functions: after ``register(spark)``, for example

    SELECT page_id, l.url, l.text FROM pages, LATERAL html_links(html, url) l

Table functions give a row for each thing found, scalar functions run in Arrow batches. Null
arguments give no rows, or null.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pagemill.documents import address, charset, feeds, harvest, markdown, pdf, pixels, tables
from pagemill.documents.dom import parse
from pagemill.documents.readable import main_content

_IMAGE = "id int, url string, alt string, caption string, width string, height string, source_page string"


class HtmlLinks:
    def eval(self, markup: str, base: str):
        if markup is not None:
            yield from ((i, u, t) for i, (u, t) in enumerate(harvest.links(parse(markup), base or ""), 1))


class HtmlImages:
    def eval(self, markup: str, base: str):
        if markup is not None:
            for i in harvest.all_images(parse(markup), base or ""):
                yield tuple(i.as_row().values())


class HtmlTables:
    def eval(self, markup: str):
        if markup is not None:
            for n, (caption, rows) in enumerate(tables.data_tables(parse(markup)), 1):
                yield n, caption, rows, tables.pipe_table(rows)


class FeedEntries:
    def eval(self, body: bytes, content_type: str):
        feed = feeds.read_feed(content_type, bytes(body)) if body is not None else None
        for n, e in enumerate(feed.entries if feed else (), 1):
            yield n, e.title, e.link, e.date, e.summary


#: Table functions by name, with the columns they give.
TABLES: dict[str, tuple[type, str]] = {
    "html_links": (HtmlLinks, "pos int, url string, text string"), "html_images": (HtmlImages, _IMAGE), "html_tables": (HtmlTables, "place int, caption string, cells array<array<string>>, markdown string"),
    "feed_entries": (FeedEntries, "place int, title string, link string, date string, summary string"),
}


def _main_markdown(markup: str, base: str) -> str:
    _, content = main_content(parse(markup))
    return markdown.to_markdown(content, base or "", images=True) if content is not None else feeds.plain_of_markup(markup)


#: Scalar functions by name: what they do with one row, and their type.
SCALARS: dict[str, tuple[Callable, int, str]] = {
    "html_markdown": (_main_markdown, 2, "string"), "html_text": (feeds.plain_of_markup, 1, "string"), "resolve_url": (lambda ref, base: address.link_target(ref, base or ""), 2, "string"),
    "decode_body": (lambda body, kind: charset.decode(bytes(body), kind), 2, "string"), "pdf_text": (lambda body: (pdf.pdf_text(bytes(body)) or (None,))[0], 1, "string"), "image_kind": (lambda body: pixels.image_kind(None, bytes(body)), 1, "string"),
}


def _batched(run: Callable, arguments: int, kind: str):
    if arguments == 1:

        def one(a: pd.Series) -> pd.Series:
            return pd.Series([None if x is None else run(x) for x in a], dtype=object)

        return F.pandas_udf(one, kind)

    def two(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else run(x, y) for x, y in zip(a, b)], dtype=object)

    return F.pandas_udf(two, kind)


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to a session; their names."""
    for name, (handler, schema) in TABLES.items():
        spark.udtf.register(name, F.udtf(handler, returnType=schema))
    for name, (run, arguments, kind) in SCALARS.items():
        spark.udf.register(name, _batched(run, arguments, kind))
    return [*TABLES, *SCALARS]
