"""From requested addresses to pages, texts, links and images: admission, cache, fetching, rendering, listing.

Every step is one of the package's operators; this module only puts them together. Pages
that were fetched are a stored table, so nothing is fetched twice however often a result
is read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.documents.render import IMAGE, rendered
from pagemill.functions.urls import admission_error, cache_key
from pagemill.operators.admission import parse_allow_list
from pagemill.operators.pages import MAX_LINKS, page_view
from pagemill.operators.stateful import load_through
from pagemill.session import stored
from pagemill.sources.http import fetched
from pagemill.sources.settings import Settings

#: A page as it is cached; ``stored`` is when it came.
PAGE = f"cache_key string, final_url string, title string, content_type string, status int, markdown string, images array<{IMAGE}>, images_inline boolean, links array<struct<url: string, text: string>>, raw_gzip binary, body_truncated boolean, markdown_capped boolean, stored timestamp"
NAMES = ["cache_key", "final_url", "title", "content_type", "status", "markdown", "images", "images_inline", "links", "raw_gzip", "body_truncated", "markdown_capped", "stored"]


def gzipped(df: DataFrame, body: str) -> DataFrame:
    """``df`` with ``raw_gzip``: the column ``body`` compressed quickly; null for null and empty bodies."""
    kept = df.schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column(body).to_pylist():
                c = zlib.compressobj(1, wbits=31)
                out.append(c.compress(x) + c.flush() if x else None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*b.schema.names, "raw_gzip"])

    return df.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", raw_gzip binary")


def empty_cache(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], PAGE)


def load_pages(requests: DataFrame, cached: DataFrame, as_of: Column, settings: Settings = Settings(), **options) -> tuple[DataFrame, DataFrame]:
    """(pages, fresh) for requests (request_id, url, user_agent).

    ``pages`` has a row for each request: request_id, url, the columns of a page, and
    error, '' unless the address isn't admitted or the fetch failed; then the page is null.
    ``fresh`` has the pages that were fetched, to be appended to the cache. Requests of one
    address fetch it once. ``options`` are those of ``sources.http.fetch``.
    """
    c = F.col
    asked = requests.select("request_id", F.trim("url").alias("url"), F.coalesce("user_agent", F.lit("")).alias("user_agent")).withColumn("error", admission_error(c("url"))).withColumn("cache_key", cache_key(c("url")))
    refused = asked.where("error <> ''")
    hits, misses = load_through(asked.where("error = ''").drop("error"), cached, as_of, settings.fetch_cache_ttl_sec)
    once = misses.groupBy("cache_key", "user_agent").agg(F.min("url").alias("url"))
    allow = parse_allow_list(list(settings.allow_local_hosts))
    options = {"most": settings.fetch_max_bytes, "seconds": float(settings.fetch_timeout_sec), "allow": allow, **({"agent": settings.user_agent} if settings.user_agent else {}), **options}
    got = stored(gzipped(fetched(once, ["cache_key", "user_agent", "url"], **options), "body"))
    base = F.coalesce(F.when(c("final_url") != "", c("final_url")), c("url"))
    keep = [c(k) for k in ("cache_key", "user_agent", "final_url", "content_type", "status", "raw_gzip", "body_truncated", "error")]
    made = stored(rendered(got, base, c("content_type"), c("body"), keep, settings.fetch_inline_images).withColumn("stored", as_of))
    page = F.struct(*NAMES)
    new = made.select("cache_key", "user_agent", F.when(c("error") == "", page).alias("page"), "error")
    answered = misses.join(new, ["cache_key", "user_agent"]).select("request_id", "url", "page", "error")
    found = hits.select("request_id", "url", F.struct(*[c(f"page.{n}").alias(n) for n in NAMES]).alias("page"), F.lit("").alias("error"))
    none = refused.select("request_id", "url", F.lit(None).cast(dict(found.dtypes)["page"]).alias("page"), "error")
    pages = found.unionByName(answered).unionByName(none).select("request_id", "url", "page.*", "error")
    return pages, made.where("error = ''").select(*NAMES)


def page_texts(pages: DataFrame, max_chars: int = 20_000, offset: int = 0) -> DataFrame:
    """(request_id, text): what is said of each loaded page, a window of its text included, or its error."""
    c = F.col
    no = lambda name: F.coalesce(c(name), F.lit(False))
    view = page_view(c("url"), c("final_url"), c("title"), c("content_type"), c("markdown"), c("images"), no("images_inline"), no("markdown_capped"), no("body_truncated"), offset, max_chars)
    return pages.select("request_id", F.when(c("error") != "", F.concat(F.lit("web_fetch failed: "), "error")).otherwise(view).alias("text"))


def page_links(pages: DataFrame) -> DataFrame:
    """(request_id, pos, url, text): the links of each loaded page in their order."""
    return pages.select("request_id", F.posexplode(F.slice("links", 1, MAX_LINKS)).alias("p", "l")).select("request_id", (F.col("p") + 1).alias("pos"), "l.url", "l.text")


def page_images(pages: DataFrame) -> DataFrame:
    """(request_id, id, url, alt, caption, width, height, source_page): the images of each loaded page."""
    return pages.select("request_id", F.explode("images").alias("i")).select("request_id", "i.*")
