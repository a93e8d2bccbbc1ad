"""Relations of rendered pages: text windows, links, images and the page cache."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions import content
from pagemill.functions.text import one_line, text, title_line, trim_space
from pagemill.functions.urls import url_part

# List limits, and the notes of the listings.
MAX_LINKS, MAX_IMAGES = 5000, 2000
CAPPED = "(list capped at {} — the page may contain more; use web_fetch_raw to inspect the full source)\n"


def windows(pages: DataFrame, key: str, body: str, size: int = 20_000) -> DataFrame:
    """(key, offset, ends, total, window): all windows of each text; an empty or null text has one empty window."""
    rows = pages.select(key, text(F.col(body)).alias("__t")).withColumn("total", F.length("__t"))
    each = rows.withColumn("offset", F.explode(F.sequence(F.lit(0), F.greatest(F.col("total") - 1, F.lit(0)), F.lit(size))))
    ends = F.least(F.col("offset") + size, F.col("total"))
    return each.select(key, "offset", ends.alias("ends"), "total", F.col("__t").substr(F.col("offset") + 1, F.lit(size)).alias("window"))


def page_view(url: Column, final_url: Column, title: Column, ct: Column, body: Column, images: Column, inline: Column, capped: Column, truncated: Column, offset: int = 0, size: int = 20_000) -> Column:
    """A page as text: header lines, one window of the body, and how to go on. The texts of the lines."""
    size = 20_000 if size <= 0 else size
    total = F.length(text(body))
    start = F.least(F.lit(max(offset, 0)), total)
    end = F.least(start + size, total)
    head = title_line(title)
    n = F.size(F.coalesce(images, F.array()))
    return F.concat(
        F.when(head != "", F.concat(F.lit("# "), head, F.lit("\n"), url, F.lit("\n"))).otherwise(F.concat(F.lit("# "), url, F.lit("\n"))),
        F.when((text(final_url) != "") & (final_url != url), F.concat(F.lit("Final-URL: "), final_url, F.lit("\n"))).otherwise(""),
        F.when(text(ct) != "", F.concat(F.lit("Content-Type: "), ct, F.lit("\n"))).otherwise(""),
        F.format_string("Chars: %d-%d of %d\n", start, end, total),
        F.when(capped, "Note: the render hit the 500000-rune output cap, so the page's tail is missing and not reachable via offset; use web_fetch_raw for the complete source\n").otherwise(""),
        F.when(n == 0, "").when(inline, F.format_string("Images: %d (shown as [image:N]; resolve with web_images)\n", n)).otherwise(F.format_string("Images: %d (not inlined; list URLs with web_images)\n", n)),
        F.lit("\n"), text(body).substr(start + 1, F.lit(size)),
        F.when(end < total, F.format_string("\n\n…[%d more chars; continue with offset=%d]", total - end, end))
        .when(truncated, "\n\n…[the source response was capped at the byte limit before rendering]").otherwise(""),
    )


def first_links(links: DataFrame) -> DataFrame:
    """Each page's distinct URLs, with the text and place of their first link; null URLs are left out."""
    return links.where("url is not null").groupBy("page_id", "url").agg(F.min("pos").alias("pos"), F.min_by("text", F.struct("pos", "link_id")).alias("text"))


# The texts of the listings of links and images.
def _listing(count: Column, word: str, page: Column, limit: int, entries: Column) -> Column:
    note = F.when(count >= limit, CAPPED.format(limit)).otherwise("")
    full = F.concat(count.cast("string"), F.lit(f" {word}(s) on "), text(page), F.lit(":\n"), note, F.array_join(entries, ""))
    return F.when(count > 0, trim_space(full)).otherwise(F.concat(F.lit(f"No {word}s found on "), text(page), F.lit(".")))


def link_listing(pages: DataFrame, links: DataFrame) -> DataFrame:
    """(page_id, listing): the links of each page as text, the first ones up to the limit; pages without links say so."""
    shown = F.row_number().over(Window.partitionBy("page_id").orderBy("pos", "url"))
    kept = first_links(links).withColumn("n", shown).where(F.col("n") <= MAX_LINKS)
    entry = F.concat(F.lit("\n"), "url", F.when(one_line(F.col("text")) != "", F.concat(F.lit("\n   text: "), one_line(F.col("text")))).otherwise(""))
    lists = kept.groupBy("page_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("n", entry.alias("e")))).alias("es"))
    each = pages.groupBy("page_id").agg(F.min("cache_key").alias("page")).join(lists, "page_id", "left")
    return each.select("page_id", _listing(F.coalesce("n", F.lit(0)), "link", F.col("page"), MAX_LINKS, F.transform("es", lambda x: x["e"])).alias("listing"))


def image_listing(pages: DataFrame) -> DataFrame:
    """(page_id, listing): the images of each page as text, keyed by their handles, the first ones up to the limit."""
    none = F.array().cast(dict(pages.dtypes)["images"])
    images = F.slice(F.coalesce("images", none), 1, MAX_IMAGES)

    def entry(im: Column) -> Column:
        w, h, alt, caption = one_line(im["width"]), one_line(im["height"]), one_line(im["alt"]), one_line(im["caption"])
        some = lambda test, *parts: F.when(test, F.concat(*parts)).otherwise("")
        return F.concat(
            F.lit("\n[image:"), im["id"].cast("string"), F.lit("] "), text(im["url"]), some((w != "") & (h != ""), F.lit(" ("), w, F.lit("×"), h, F.lit(")")),
            some(F.lower(url_part(im["url"], 4)).endswith(".svg"), F.lit("\n   svg — web_fetch_image cannot decode it; web_fetch_raw can save the source")),
            some(alt != "", F.lit("\n   alt: "), alt), some((caption != "") & (caption != alt), F.lit("\n   caption: "), caption), some(text(im["source_page"]) != "", F.lit("\n   source: "), im["source_page"]),
        )

    return pages.select("page_id", _listing(F.size(images), "image", F.col("cache_key"), MAX_IMAGES, F.transform(images, entry)).alias("listing"))


def image_rows(pages: DataFrame) -> DataFrame:
    """Each image of each page: (page_id, id, url, dimensions, svg, placeholder)."""
    rows = pages.select("page_id", F.explode("images").alias("im")).select("page_id", "im.*")
    w, h = one_line(F.col("width")), one_line(F.col("height"))
    named = F.when(text(F.col("alt")) != "", F.concat(F.lit("[image:"), F.col("id").cast("string"), F.lit(": "), F.col("alt"), F.lit("]"))).otherwise(F.concat(F.lit("[image:"), F.col("id").cast("string"), F.lit("]")))
    dims = F.when((w != "") & (h != ""), F.concat(w, F.lit("×"), h)).otherwise("")
    return rows.select("page_id", "id", "url", dims.alias("dimensions"), F.lower(url_part(F.col("url"), 4)).endswith(".svg").alias("svg"), named.alias("placeholder"))


def latest_pages(pages: DataFrame) -> DataFrame:
    """One page for each cache key: the one that came last, as a cache that overwrites keeps it."""
    return pages.groupBy("cache_key").agg(F.max_by("page_id", F.struct("arrived_at", "page_id")).alias("page_id"), F.count_distinct("page_id").alias("versions"))


def gunzip(raw: bytes | None) -> bytes | None:
    """The decompressed body, all members of it; None for none and for one that isn't compressed soundly. A cut-off body gives what there is of it."""
    import zlib

    if raw is None:
        return None
    parts = []
    try:
        while True:
            member = zlib.decompressobj(wbits=47)
            parts.append(member.decompress(raw))
            raw = member.unused_data.lstrip(b"\0") if member.eof else b""
            if not raw:
                return b"".join(parts)
    except zlib.error:
        return None


#: Bytes of bodies after which a batch is handed on.
BATCH_BYTES = 16 << 20


def with_bodies(pages: DataFrame, keep: list[str], raw: Column | None = None) -> DataFrame:
    """The columns ``keep`` and the decompressed ``body``; batches are cut where bodies grow large."""
    import pyarrow as pa

    picked = pages.select((F.col("raw_gzip") if raw is None else raw).alias("__raw"), *keep)

    def run(batches):
        for b in batches:
            start, bodies, held = 0, [], 0
            for x in b.column(0).to_pylist():
                bodies.append(gunzip(x))
                held += len(bodies[-1] or b"")
                if held >= BATCH_BYTES or start + len(bodies) == b.num_rows:
                    part = b.slice(start, len(bodies))
                    yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(bodies, pa.binary())], names=[*keep, "body"])
                    start, bodies, held = start + len(bodies), [], 0

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[1:])
    return picked.mapInArrow(run, f"{kinds}, body binary")


def routed_pages(pages: DataFrame) -> DataFrame:
    """(page_id, type, route) of each page; only bodies that the route depends on are decompressed."""
    ct = F.col("content_type")
    rows = with_bodies(pages, ["page_id", "content_type"], F.when(content.asks_body(ct), F.col("raw_gzip")))
    return rows.select("page_id", content.display_type(ct).alias("type"), content.route(ct, F.col("body")).alias("route"))


def _gunzipped(batches):
    import hashlib

    import pyarrow as pa

    for b in batches:
        sizes, digests = [], []
        for raw in b.column(1).to_pylist():
            body = gunzip(raw)
            sizes.append(None if body is None else len(body))
            digests.append(None if body is None else hashlib.md5(body).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], names=["page_id", "size", "digest"])


def raw_bodies(pages: DataFrame) -> DataFrame:
    """(page_id, size, digest) of each page's decompressed body; null for none and for one that isn't compressed soundly."""
    return pages.select("page_id", "raw_gzip").mapInArrow(_gunzipped, "page_id long, size long, digest string")


def page_size(raw: Column, body: Column, images: Column) -> Column:
    """Bytes that a cached page counts as, without its links: body, text, and each image's strings with a fixed share."""
    each = F.aggregate(
        F.coalesce(images, F.array()), F.lit(0).cast("long"),
        lambda a, im: a + 32 + sum(F.octet_length(text(im[k])) for k in ("url", "alt", "caption", "width", "height", "source_page")),
    )
    return F.coalesce(F.octet_length(raw), F.lit(0)) + F.octet_length(text(body)) + each


def sized_pages(pages: DataFrame, links: DataFrame) -> DataFrame:
    """``pages``, repeated ids once, with ``size``: the bytes of a page and of its first five thousand distinct links, each with a share of 16."""
    shown = F.row_number().over(Window.partitionBy("page_id").orderBy("pos", "url"))
    kept = first_links(links).withColumn("n", shown).where(F.col("n") <= MAX_LINKS)
    of_links = kept.groupBy("page_id").agg(F.sum(F.octet_length("url") + F.octet_length(text(F.col("text"))) + 16).alias("__links"))
    joined = pages.dropDuplicates(["page_id"]).join(of_links, "page_id", "left")
    return joined.withColumn("size", page_size(F.col("raw_gzip"), F.col("markdown"), F.col("images")) + F.coalesce("__links", F.lit(0))).drop("__links")


def age(seconds: Column) -> Column:
    """Seconds as hours, minutes and seconds: 1h2m3s."""
    h, m, s = F.floor(seconds / 3600), F.floor(F.pmod(seconds, F.lit(3600)) / 60), F.pmod(seconds, F.lit(60))
    parts = lambda *xs: F.concat(*[p for c, unit in xs for p in (c.cast("long").cast("string"), F.lit(unit))])
    return F.when(seconds >= 3600, parts((h, "h"), (m, "m"), (s, "s"))).when(seconds >= 60, parts((m, "m"), (s, "s"))).otherwise(parts((seconds, "s")))


def cache_lines(sized: DataFrame, as_of: Column, scope: str = "host") -> DataFrame:
    """(scope, page_id, stored, line): a row for each cached page of each scope, and one with null ``page_id`` for the scope's head line.

    Fixed values: the texts of the lines. A listing is the head, then the lines by ``stored``, latest first. Rows are never
    gathered, so a scope may have any number of pages. Times after ``as_of`` have no age.
    """
    seconds = F.greatest(F.unix_timestamp(as_of) - F.unix_timestamp(F.col("fetched_at").cast("timestamp")), F.lit(0))
    head = title_line(F.col("title"))
    kib = lambda c: F.format_string("%.1f", F.bround(c / 1024.0, 1))
    line = F.concat(F.lit("  "), text(F.col("cache_key")), F.lit("  ("), kib(F.col("size")), F.lit(" KiB, "), age(F.coalesce(seconds, F.lit(0))), F.lit(" old)"), F.when(head != "", F.concat(F.lit("  — "), head)).otherwise(""))
    rows = sized.select(scope, "page_id", F.col("fetched_at").alias("stored"), line.alias("line"))
    heads = sized.groupBy(scope).agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    totals = heads.select(scope, F.lit(None).cast("long").alias("page_id"), F.lit(None).cast(dict(rows.dtypes)["stored"]).alias("stored"), F.concat(F.format_string("web cache: %d entries, ", "n"), kib(F.col("total")), F.lit(" KiB total")).alias("line"))
    return totals.unionByName(rows)


def clean_path(path: Column) -> Column:
    """A relative path without empty and dot parts, each '..' taken back with what it leaves; leading ones stay. '.' for nothing."""
    parts = F.aggregate(
        F.split(text(path), "/"), F.array().cast("array<string>"),
        lambda a, x: F.when(x.isin("", "."), a).when((x == "..") & (F.size(a) > 0) & (F.element_at(F.concat(F.array(F.lit("..")), a), -1) != ".."), F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(x))),
    )
    return F.when(F.size(parts) == 0, ".").otherwise(F.array_join(parts, "/"))


def save_path_error(path: Column) -> Column:
    """Why a path may not be written under a workspace, by its text alone, or ''. Links and existing files are the writer's to check (``pagemill.sinks``).

    The workspace's own .git and what lies in it are refused, as written.
    """
    clean = clean_path(path)
    # fixed values: the texts of the errors
    return (
        F.when(text(path).startswith("/"), "save_path must be relative to the workspace, not absolute")
        .when((clean == "..") | clean.startswith("../"), "save_path escapes the workspace")
        .when((clean == ".git") | clean.startswith(".git/"), "writing to .git/ is not permitted").otherwise("")
    )
