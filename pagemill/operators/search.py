"""Relations of search: normalised queries, permitted results, ranked lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.text import one_line, short_date, text, trim_space
from pagemill.functions.urls import clean_domains, domain_permitted


def clamped_count(n: Column) -> Column:
    """How many results are shown: 5 unless asked for, 10 at most."""
    return F.when(F.coalesce(n, F.lit(0)) <= 0, 5).otherwise(F.least(n, F.lit(10)))


def normalised_queries(queries: DataFrame) -> DataFrame:
    """Distinct queries with canonical values and an ``error`` instead of values no backend knows; '' is no error."""
    low = lambda c: F.lower(trim_space(F.col(c)))
    # fixed values: the texts of the errors
    error = (
        F.when(trim_space(F.col("query_text")) == "", "query is required")
        .when(~low("freshness").isin("", "day", "week", "month", "year"), F.concat(F.lit('invalid freshness "'), low("freshness"), F.lit('" (use "day", "week", "month", or "year")')))
        .when(~low("depth").isin("", "basic", "advanced"), F.concat(F.lit('invalid depth "'), low("depth"), F.lit('" (use "basic" or "advanced")')))
        .otherwise("")
    )
    return queries.select(
        "query_id", trim_space(F.col("query_text")).alias("query_text"), clamped_count(F.col("max_results")).alias("max_results"), low("freshness").alias("freshness"), low("depth").alias("depth"),
        clean_domains(F.col("include_domains")).alias("include_domains"), clean_domains(F.col("exclude_domains")).alias("exclude_domains"), error.alias("error"),
    ).dropDuplicates(["query_id"])


def ranked_results(queries: DataFrame, results: DataFrame) -> DataFrame:
    """The first permitted results of each sound query, in their backend's order, up to the query's count."""
    wanted = normalised_queries(queries).where("error = ''").select("query_id", "query_text", "max_results", "include_domains", "exclude_domains")
    joined = results.dropDuplicates(["result_id"]).join(wanted, "query_id").where(domain_permitted(F.col("url"), F.col("include_domains"), F.col("exclude_domains")))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("result_rank", "result_id"))
    return joined.withColumn("place", place).where("place <= max_results").select("query_id", "query_text", "place", "result_id", "title", "url", "snippet", "published")


def quoted(c: Column) -> Column:
    """Text in quotation marks with what would break them escaped."""
    out = text(c)
    for char, shown in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(char), F.lit(shown))
    return F.concat(F.lit('"'), out, F.lit('"'))


def result_listing(ranked: DataFrame) -> DataFrame:
    """(query_id, listing): the ranked results as text that no title or snippet can break."""
    date, snippet = short_date(F.col("published")), one_line(F.col("snippet"), 300)
    entry = F.concat(
        F.format_string("\n%d. %s", "place", one_line(F.col("title"), 300)), F.when(date != "", F.concat(F.lit(" ("), date, F.lit(")"))).otherwise(""),
        F.lit("\n   "), one_line(F.col("url")), F.lit("\n"), F.when(snippet != "", F.concat(F.lit("   "), snippet, F.lit("\n"))).otherwise(""),
    )
    lists = ranked.groupBy("query_id").agg(F.first("query_text").alias("q"), F.array_sort(F.collect_list(F.struct("place", entry.alias("e")))).alias("es"))
    return lists.select("query_id", trim_space(F.concat(F.lit("Search results for "), quoted(F.col("q")), F.lit(":\n"), F.array_join(F.transform("es", lambda e: e["e"]), ""))).alias("listing"))


# Fixed value: what is said of a query without results.
NO_RESULTS = ". Try broader or different terms, or relax any freshness/domain filters."


def answers(queries: DataFrame, results: DataFrame) -> DataFrame:
    """(query_id, listing) of every query: its results, that there are none, or what is wrong with it."""
    known = normalised_queries(queries).select("query_id", "query_text", "error")
    none = F.concat(F.lit("No results for "), quoted(F.col("query_text")), F.lit(NO_RESULTS))
    return known.join(result_listing(ranked_results(queries, results)), "query_id", "left").select("query_id", F.when(F.col("error") != "", F.col("error")).otherwise(F.coalesce("listing", none)).alias("listing"))


#: The answers of both kinds of backend, as far as they are read.
SEARXNG = "struct<results: array<struct<title: string, url: string, content: string, publishedDate: string>>>"
TAVILY = "struct<results: array<struct<title: string, url: string, content: string, published_date: string>>>"


def decoded_payloads(payloads: DataFrame, queries: DataFrame, backend: str) -> DataFrame:
    """(query_id, place, title, url, snippet, published, error) of (query_id, status, payload): a backend's answers as results.

    SearXNG's are filtered by the query's domains and then cut to its count, Tavily's come
    as they are, as that backend filters itself. A failed status or a payload that isn't
    what it should be gives one row with an error and null results.
    """
    published = "publishedDate" if backend == "searxng" else "published_date"
    read = payloads.withColumn("__r", F.from_json("payload", SEARXNG if backend == "searxng" else TAVILY, {"mode": "PERMISSIVE"}))
    failed = F.when(F.col("status") != 200, backend_error(backend, F.col("status"), F.col("payload"))).when(F.col("__r").isNull() | (F.col("__r.results").isNull() & ~text(F.col("payload")).rlike(r"^\s*\{")), f"{backend}: decode: malformed payload")
    errors = read.where(failed.isNotNull()).select("query_id", F.lit(None).cast("int").alias("place"), *[F.lit(None).cast("string").alias(c) for c in ("title", "url", "snippet", "published")], failed.alias("error"))
    each = read.where(failed.isNull()).select("query_id", F.posexplode("__r.results").alias("pos", "r")).select("query_id", "pos", F.col("r.title").alias("title"), F.col("r.url").alias("url"), F.col("r.content").alias("snippet"), F.col(f"r.{published}").alias("published"))
    if backend == "searxng":
        wanted = normalised_queries(queries).select("query_id", "max_results", "include_domains", "exclude_domains")
        each = each.join(wanted, "query_id").where(domain_permitted(F.col("url"), F.col("include_domains"), F.col("exclude_domains")))
        place = F.row_number().over(Window.partitionBy("query_id").orderBy("pos"))
        each = each.withColumn("place", place).where("place <= max_results")
    else:
        each = each.withColumn("place", F.col("pos") + 1)
    return each.select("query_id", F.col("place").cast("int").alias("place"), "title", "url", "snippet", "published", F.lit("").alias("error")).unionByName(errors)


def backend_error(backend: str, status: Column, payload: Column) -> Column:
    """What is said of a backend's failed status."""
    if backend == "searxng":
        return F.concat(F.lit("searxng: HTTP "), status.cast("string"), F.lit(" (is `json` enabled in search.formats?)"))
    hint = F.when(status.isin(401, 403), " (invalid or missing API key — check TAVILY_API_KEY / tavily_api_key)").when(status == 429, " (Tavily rate or credit limit — wait before retrying)").otherwise("")
    return F.concat(F.lit("tavily: HTTP "), status.cast("string"), hint, F.lit(": "), trim_space(F.substring(text(payload), 1, 512)))


def backend_request(backend: str) -> list[Column]:
    """The columns (search_text, parameters) that a normalised query is sent with: parameters as JSON for Tavily, as a query string for SearXNG."""
    q, n, fresh, include, exclude = F.col("query_text"), F.col("max_results"), F.col("freshness"), F.col("include_domains"), F.col("exclude_domains")
    if backend == "searxng":
        # one domain becomes a hint to the engines; the filter afterwards holds for all
        asked = F.concat(q, F.when(F.size(include) == 1, F.concat(F.lit(" site:"), F.get(include, 0))).otherwise(""))
        escaped = F.replace(F.replace(F.url_encode(asked), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
        return [asked.alias("search_text"), F.concat(F.lit("format=json&q="), escaped, F.when(fresh != "", F.concat(F.lit("&time_range="), fresh)).otherwise("")).alias("parameters")]
    some = lambda a: F.when(F.size(a) > 0, a)
    body = F.struct(q.alias("query"), n.alias("max_results"), F.when(F.col("depth") == "advanced", "advanced").otherwise("basic").alias("search_depth"), F.when(fresh != "", fresh).alias("time_range"), some(include).alias("include_domains"), some(exclude).alias("exclude_domains"))
    return [q.alias("search_text"), F.to_json(body).alias("parameters")]
