"""Queries of the page, link, feed and search operators, each with the SQL that gives the same rows in DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions import content, urls
from pagemill.functions import text as tx
from pagemill.operators import admission, feeds, pages, search, stateful
from pagemill.session import table

_WS = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_TRIM = lambda c: f"regexp_replace(coalesce({c}, ''), '^{_WS}+|{_WS}+$', '', 'g')"
_LINE = lambda c: _TRIM(f"regexp_replace(coalesce({c}, ''), '{_WS}+', ' ', 'g')")
# Stamps in SQL: the day of the layouts that are read, of those that are real dates.
_MONTHS = "['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec']"
_CLOCK = r"([01]\d|2[0-3]):[0-5]\d:[0-5]\d"
_ISO = r"^\d{4}-\d\d-\d\dT" + _CLOCK + r"([.,]\d+)?(Z|[+-]([01]\d|2[0-3]):[0-5]\d)$"
_POSTED = r"^(?i:mon|tue|wed|thu|fri|sat|sun), +(DAY) +([A-Za-z]{3}) +(\d{4}) +" + _CLOCK + r" +([+-]\d{4}|GMT[+-]\d{1,2}|[+-]\d{2}|ChST|MeST|WITA|[A-Z]{3}|[A-Z]{3,4}T)$"


def _written_day(c: str, digits: str, plain: str) -> str:
    """SQL for the day that the stamp ``c`` is written with, or null: ISO stamps, ``plain`` ones, and mail dates with days of ``digits``."""
    s, mail = _TRIM(c), _POSTED.replace("DAY", digits)
    part = lambda k: f"regexp_extract({s}, '{mail}', {k})"
    month = f"list_position({_MONTHS}, lower({part(2)}))"
    real = lambda day: f"case when try_cast({day} as date) is not null then {day} end"
    return f"""coalesce(case when regexp_matches({s}, '{_ISO}') or regexp_matches({s}, '{plain}') then {real(s + "[:10]")} end,
case when regexp_matches({s}, '{mail}') and {month} > 0 then {real(f"({part(3)} || '-' || lpad({month}::varchar, 2, '0') || '-' || lpad({part(1)}, 2, '0'))")} end)"""


_DAY_ONLY = r"^\d{4}-\d\d-\d\d$"
_FEED_DATE = lambda c: f"coalesce({_written_day(c, r'\d{1,2}', _DAY_ONLY)}, {_LINE(c)})"
_CUT = lambda s: f"list_max(list_filter(range(0, 21), lambda k: strlen(({s})[:k]) <= 20 and k <= length({s})))"
_SHORT_DATE = lambda c: f"coalesce({_written_day(c, r'\d{2}', _DAY_ONLY[:-1] + '( +' + _CLOCK + r'([.,]\d+)?)?$')}, ({_CAP(c)})[:{_CUT(_CAP(c))}] || case when strlen(({_CAP(c)})[:{_CUT(_CAP(c))}]) < 20 and length({_CAP(c)}) > {_CUT(_CAP(c))} then '�' else '' end)"
_QUOTED = lambda c: f"chr(34) || replace(replace(replace(replace(replace({c}, chr(92), chr(92) || chr(92)), chr(34), chr(92) || chr(34)), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't') || chr(34)"
_CAP = lambda c: f"case when length({_LINE(c)}) > 300 then {_LINE(c)}[:300] || '…' else {_LINE(c)} end"


def url_parts(spark: SparkSession, d: str) -> DataFrame:
    """Parts of the links' addresses, every seventh with an address in brackets instead of its host."""
    u = F.when(F.col("link_id") % 7 == 0, F.regexp_replace("url", "^([a-z]+://)[^/]*", "$1[2001:db8::7]:8080")).otherwise(F.col("url"))
    return table(spark, d, "links").select("link_id", urls.url_part(u, 1).alias("scheme"), urls.url_part(u, 2).alias("host"), urls.url_part(u, 3).alias("port"), urls.url_part(u, 4).alias("path"))


URL_PARTS = r"""with l as (select link_id, url, regexp_matches(url, '^[a-z]+://') and link_id % 7 = 0 as b from links)
select link_id, coalesce(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1), '') as scheme,
case when b then '2001:db8::7' else coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '') end as host,
case when b then '8080' else coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?[^/?#:]*:(\d*)', 1), '') end as port,
coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '') as path from l"""


def url_admission(spark: SparkSession, d: str) -> DataFrame:
    """Admission of the links' addresses: as they are, with other schemes, with ports on names and on bracketed addresses, without a host."""
    n, u = F.col("link_id"), F.col("url")
    port = F.element_at(F.array(*map(F.lit, PORTS)), (n % len(PORTS) + 1).cast("int"))
    with_port = lambda host: F.regexp_replace(u, "^([a-z]+://)([^/]*)", F.concat(F.lit("$1"), F.lit(host), F.lit(":"), port))
    made = F.when(n % 6 == 1, F.regexp_replace(u, "^[a-z]+:", "FTP:")).when(n % 6 == 2, with_port("$2")).when(n % 6 == 3, with_port("[::1]")).when(n % 6 == 4, "https:///no/host").when(n % 6 == 5, F.concat(F.lit("  "), u, F.lit("\n"))).otherwise(u)
    return table(spark, d, "links").select("link_id", urls.admission_error(made).alias("error"))


PORTS = ("80", "22", "443", "3306", "8080", "022", "25", "11211", "27017", "3000", "993")
URL_ADMISSION = r"""with l as (select link_id, url, (array['80', '22', '443', '3306', '8080', '022', '25', '11211', '27017', '3000', '993'])[(link_id % 11 + 1)::int] as p from links)
select link_id, case when link_id % 6 = 4 then 'url has no host' when url is null or url = '' or not regexp_matches(url, '^[a-z]+://') then 'unsupported scheme "" (only http/https)'
when link_id % 6 = 1 then 'unsupported scheme "ftp" (only http/https)' when link_id % 6 in (2, 3) and p in ('22', '3306', '25', '11211', '27017', '993') then 'port ' || p || ' is not permitted (it is a well-known non-web service port)' else '' end as error from l"""


def cache_key(spark: SparkSession, d: str) -> DataFrame:
    tail = F.when(F.col("page_id") % 3 == 0, "?utm_source=feed&b=2&a=x%20y&utm_id=7").when(F.col("page_id") % 3 == 1, "?b=2&a=1").otherwise("")
    return table(spark, d, "rendered").select("page_id", urls.cache_key(F.concat("cache_key", tail)).alias("key"))


CACHE_KEY = "select page_id, cache_key || case when page_id % 3 = 0 then '?a=x+y&b=2' when page_id % 3 = 1 then '?b=2&a=1' else '' end as key from rendered"


def query_normalize(spark: SparkSession, d: str) -> DataFrame:
    q = search.normalised_queries(table(spark, d, "queries"))
    return q.withColumn("include_domains", F.array_join("include_domains", ",")).withColumn("exclude_domains", F.array_join("exclude_domains", ","))


_DOMAINS = lambda c: f"coalesce(array_to_string(list_filter(list_transform({c}, lambda x: regexp_replace(regexp_replace(regexp_replace(lower({_TRIM('x')}), '^https://', ''), '^http://', ''), '/.*$', '')), lambda x: x <> ''), ','), '')"
QUERY_NORMALIZE = f"""with q as (select distinct on (query_id) query_id, {_TRIM("query_text")} as query_text, max_results as m, lower({_TRIM("freshness")}) as freshness, lower({_TRIM("depth")}) as depth, include_domains as i, exclude_domains as x from queries)
select query_id, query_text, (case when coalesce(m, 0) <= 0 then 5 when m > 10 then 10 else m end)::int as max_results, freshness, depth, {_DOMAINS("i")} as include_domains, {_DOMAINS("x")} as exclude_domains,
case when query_text = '' then 'query is required' when freshness not in ('', 'day', 'week', 'month', 'year') then 'invalid freshness "' || freshness || '" (use "day", "week", "month", or "year")'
when depth not in ('', 'basic', 'advanced') then 'invalid depth "' || depth || '" (use "basic" or "advanced")' else '' end as error from q"""


def search_topk(spark: SparkSession, d: str) -> DataFrame:
    return search.ranked_results(table(spark, d, "queries"), table(spark, d, "results")).select("query_id", "place", "result_id", "url")


_UNDER = lambda c: f"len(list_filter(string_split({c}, ','), lambda e: e <> '' and (h = e or ends_with(h, '.' || e)))) > 0"
_RANKED = f"""n as ({QUERY_NORMALIZE}), j as (select distinct on (r.result_id) r.*, n.query_text, n.max_results, n.include_domains as i, n.exclude_domains as x,
lower(coalesce(regexp_extract(r.url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#:]*)', 1), '')) as h from results r join n on r.query_id = n.query_id and n.error = ''),
k as (select * from j where (i = '' and x = '') or (h <> '' and not ({_UNDER("x")}) and (i = '' or {_UNDER("i")}))),
ranked as (select *, row_number() over (partition by query_id order by result_rank nulls first, result_id) as place from k)"""
SEARCH_TOPK = f"with {_RANKED} select query_id, place::int as place, result_id, url from ranked where place <= max_results"


def search_format(spark: SparkSession, d: str) -> DataFrame:
    return search.result_listing(search.ranked_results(table(spark, d, "queries"), table(spark, d, "results")))


_ANSWERS = f"""{_RANKED}, t as (select *, {_SHORT_DATE("published")} as day from ranked where place <= max_results),
e as (select query_id, query_text, place, chr(10) || place || '. ' || {_CAP("title")} || case when day <> '' then ' (' || day || ')' else '' end || chr(10) || '   ' || {_LINE("url")} || chr(10)
|| case when {_LINE("snippet")} = '' then '' else '   ' || {_CAP("snippet")} || chr(10) end as e from t),
f as (select query_id, {_TRIM(f"'Search results for ' || {_QUOTED('min(query_text)')} || ':' || chr(10) || string_agg(e, '' order by place)")} as listing from e group by query_id)"""
SEARCH_FORMAT = f"with {_ANSWERS} select query_id, listing from f"


def search_answers(spark: SparkSession, d: str) -> DataFrame:
    """What is said to every query: its results, that there are none, or what is wrong with it."""
    return search.answers(table(spark, d, "queries"), table(spark, d, "results"))


SEARCH_ANSWERS = f"""with {_ANSWERS}
select n.query_id, case when n.error <> '' then n.error else coalesce(f.listing, 'No results for ' || {_QUOTED("n.query_text")} || '. Try broader or different terms, or relax any freshness/domain filters.') end as listing from n left join f on f.query_id = n.query_id"""


def iso_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates of both kinds from one instant written in the layouts that each of them reads."""
    t = F.col("ts")
    written = F.element_at(F.array(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.date_format(t, "yyyy-MM-dd"), F.date_format(t, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"), F.date_format(t, "yyyy-MM-dd HH:mm:ss"), F.lit("  last\n week ")), (F.col("event_id") % 5 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", tx.short_date(written).alias("short"), tx.feed_date(written).alias("feed"))


ISO_DATES = """select event_id, case when event_id % 5 = 4 then 'last week' else strftime(ts, '%Y-%m-%d') end as short,
case event_id % 5 when 4 then 'last week' when 3 then strftime(ts, '%Y-%m-%d %H:%M:%S') else strftime(ts, '%Y-%m-%d') end as feed from events"""


def feed_summary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rss_items").select("item_id", tx.one_line(tx.plain_of_markup(F.col("description")), 400).alias("summary"))


def _plain(c: str) -> str:
    out = f"regexp_replace(regexp_replace(coalesce({c}, ''), '(?is)<(script|style|noscript|template)\\b.*?</(script|style|noscript|template)\\s*>', chr(10), 'g'), '(?s)<[^>]*>', ' ', 'g')"
    for name, char in (("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "chr(34)"), ("&#39;", "chr(39)"), ("&copy;", "'©'"), ("&middot;", "'·'"), ("&amp;", "'&'")):
        out = f"replace({out}, '{name}', {char})"
    return out


FEED_SUMMARY = f"with p as (select item_id, {_LINE(_plain('description'))} as s from rss_items) select item_id, case when length(s) > 400 then s[:400] || '…' else s end as summary from p"


def page_title(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rendered").select("page_id", tx.title_line(F.col("title")).alias("title"))


PAGE_TITLE = f"select page_id, {_CAP('title')} as title from rendered"


def cap_text(spark: SparkSession, d: str) -> DataFrame:
    c = tx.cap_text(F.col("text"), 1000)
    return table(spark, d, "documents").select("doc_id", F.length(c["text"]).alias("length"), c["capped"].alias("capped"), F.md5(c["text"]).alias("digest"))


CAP_TEXT = """with t as (select doc_id, coalesce(text, '') as t from documents), c as (select doc_id, length(t) > 1000 as capped, case when length(t) > 1000 then t[:1000] || chr(10) || chr(10) || '…[Markdown output capped at 1000 runes]' else t end as c from t)
select doc_id, length(c)::int as length, capped, md5(c) as digest from c"""


def fetch_all_windows(spark: SparkSession, d: str) -> DataFrame:
    w = pages.windows(table(spark, d, "documents"), "doc_id", "text", 2000)
    return w.select("doc_id", "offset", "ends", "total", F.md5("window").alias("digest"))


WINDOWS = """with t as (select doc_id, coalesce(text, '') as t from documents), o as (select doc_id, t, unnest(range(0, greatest(length(t), 1), 2000)) as o from t)
select doc_id, o::int as "offset", least(o + 2000, length(t))::int as ends, length(t)::int as total, md5(substr(t, o + 1, 2000)) as digest from o"""


def fetch_window(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    view = pages.page_view(c("cache_key"), c("final_url"), c("title"), c("content_type"), c("markdown"), c("images"), F.coalesce(c("images_inline"), F.lit(False)), F.coalesce(c("markdown_capped"), F.lit(False)), F.coalesce(c("body_truncated"), F.lit(False)), 100, 500)
    return table(spark, d, "rendered").select("page_id", view.alias("view"))


FETCH_WINDOW = f"""with p as (select *, coalesce(markdown, '') as m, {_CAP("title")} as h, least(100, length(coalesce(markdown, ''))) as s from rendered), q as (select *, least(s + 500, length(m)) as e from p)
select page_id, case when h <> '' then '# ' || h || chr(10) || cache_key || chr(10) else '# ' || cache_key || chr(10) end
|| case when coalesce(final_url, '') <> '' and final_url <> cache_key then 'Final-URL: ' || final_url || chr(10) else '' end
|| case when coalesce(content_type, '') <> '' then 'Content-Type: ' || content_type || chr(10) else '' end
|| 'Chars: ' || s || '-' || e || ' of ' || length(m) || chr(10)
|| case when coalesce(markdown_capped, false) then 'Note: the render hit the 500000-rune output cap, so the page''s tail is missing and not reachable via offset; use web_fetch_raw for the complete source' || chr(10) else '' end
|| case when coalesce(len(images), 0) = 0 then '' when coalesce(images_inline, false) then 'Images: ' || len(images) || ' (shown as [image:N]; resolve with web_images)' || chr(10) else 'Images: ' || len(images) || ' (not inlined; list URLs with web_images)' || chr(10) end
|| chr(10) || substr(m, s + 1, 500)
|| case when e < length(m) then chr(10) || chr(10) || '…[' || (length(m) - e) || ' more chars; continue with offset=' || e || ']' when coalesce(body_truncated, false) then chr(10) || chr(10) || '…[the source response was capped at the byte limit before rendering]' else '' end as view from q"""


def page_links(spark: SparkSession, d: str) -> DataFrame:
    return pages.first_links(table(spark, d, "links")).select("page_id", "url", "pos", "text")


PAGE_LINKS = """select page_id, url, pos, text from (select *, row_number() over (partition by page_id, url order by pos nulls first, link_id) as n from links where url is not null) where n = 1"""


def links_format(spark: SparkSession, d: str) -> DataFrame:
    return pages.link_listing(table(spark, d, "rendered"), table(spark, d, "links"))


LINKS_FORMAT = f"""with f as ({PAGE_LINKS}), k as (select *, row_number() over (partition by page_id order by pos, url) as n from f),
t as (select page_id, count(*) as n, string_agg(chr(10) || url || case when {_LINE("text")} <> '' then chr(10) || '   text: ' || {_LINE("text")} else '' end, '' order by n) as e from k where n <= 5000 group by page_id),
p as (select page_id, min(cache_key) as page from rendered group by page_id)
select p.page_id, case when t.n is null then 'No links found on ' || page || '.' else {_TRIM("t.n || ' link(s) on ' || page || ':' || chr(10) || case when t.n >= 5000 then '(list capped at 5000 — the page may contain more; use web_fetch_raw to inspect the full source)' || chr(10) else '' end || e")} end as listing from p left join t on p.page_id = t.page_id"""


def images_format(spark: SparkSession, d: str) -> DataFrame:
    return pages.image_listing(table(spark, d, "rendered"))


IMAGES_FORMAT = f"""with e as (select page_id, cache_key, coalesce(len(images), 0) as n, coalesce(images, []) as images from rendered)
select page_id, case when n = 0 then 'No images found on ' || cache_key || '.' else {_TRIM("n || ' image(s) on ' || cache_key || ':' || chr(10) || array_to_string(list_transform(images, lambda m: chr(10) || '[image:' || m.id || '] ' || coalesce(m.url, '')"
    f" || case when {_LINE('m.width')} <> '' and {_LINE('m.height')} <> '' then ' (' || {_LINE('m.width')} || '×' || {_LINE('m.height')} || ')' else '' end"
    r" || case when regexp_matches(lower(coalesce(m.url, '')), '^[^?#]*\.svg([?#]|$)') then chr(10) || '   svg — web_fetch_image cannot decode it; web_fetch_raw can save the source' else '' end"
    f" || case when {_LINE('m.alt')} <> '' then chr(10) || '   alt: ' || {_LINE('m.alt')} else '' end || case when {_LINE('m.caption')} <> '' and {_LINE('m.caption')} <> {_LINE('m.alt')} then chr(10) || '   caption: ' || {_LINE('m.caption')} else '' end"
    " || case when coalesce(m.source_page, '') <> '' then chr(10) || '   source: ' || m.source_page else '' end), '')")} end as listing from e"""


def link_fanout(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "links").groupBy("host").agg(F.count("*").alias("links"), F.count_distinct("page_id").alias("pages"), F.count_distinct("url").alias("urls"))


LINK_FANOUT = "select host, count(*) as links, count(distinct page_id) as pages, count(distinct url) as urls from links group by host"


def images_harvest(spark: SparkSession, d: str) -> DataFrame:
    return pages.image_rows(table(spark, d, "rendered"))


IMAGES_HARVEST = f"""with i as (select page_id, unnest(images) as im from rendered)
select page_id, im.id as id, im.url as url, case when {_LINE("im.width")} <> '' and {_LINE("im.height")} <> '' then {_LINE("im.width")} || '×' || {_LINE("im.height")} else '' end as dimensions,
regexp_matches(lower(im.url), '^[^?#]*\\.svg([?#]|$)') as svg, case when coalesce(im.alt, '') <> '' then '[image:' || im.id || ': ' || im.alt || ']' else '[image:' || im.id || ']' end as placeholder from i"""


def cache_key_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return pages.latest_pages(table(spark, d, "rendered"))


CACHE_DEDUPE = "select cache_key, max_by(page_id, (arrived_at, page_id)) as page_id, count(distinct page_id) as versions from rendered group by cache_key"


def content_route(spark: SparkSession, d: str) -> DataFrame:
    return pages.routed_pages(table(spark, d, "rendered"))


def type_route(spark: SparkSession, d: str) -> DataFrame:
    """The route by type alone, as of pages without a body; ``content_route`` looks into bodies, which SQL can't decompress."""
    ct = F.col("content_type")
    return table(spark, d, "rendered").select("page_id", content.display_type(ct).alias("type"), content.route(ct, F.lit(None).cast("binary")).alias("route"))


TYPE_ROUTE = f"""with t as (select page_id, lower(coalesce(content_type, '')) as c, {_TRIM("split_part(lower(content_type), ';', 1)")} as b from rendered)
select page_id, case when b = '' then 'binary' else b end as type, case when contains(c, 'html') then 'html' when b = '' or starts_with(b, 'text/') or b in ('application/json', 'application/xml', 'application/xhtml+xml', 'application/javascript', 'application/ecmascript', 'image/svg+xml')
or ends_with(b, '+json') or ends_with(b, '+xml') then 'text' when b = 'application/pdf' then 'pdf' else 'binary' end as route from t"""


def status_hint(spark: SparkSession, d: str) -> DataFrame:
    """What is said of the statuses of pages, raised by two hundred on every second page, so that all classes of failures occur."""
    status = F.col("status") + F.when(F.col("page_id") % 2 == 0, 200).otherwise(0)
    browser = F.col("page_id") % 3 == 0
    return table(spark, d, "rendered").select("page_id", content.status_error(status, F.col("cache_key"), browser).alias("error"), content.retryable(status, F.lit("")).alias("retry"))


STATUS_HINT = """with e as (select page_id, cache_key, page_id % 3 = 0 as b, status + case when page_id % 2 = 0 then 200 else 0 end as s from rendered)
select page_id, case when s is null or s < 400 then '' else 'http ' || s || ' fetching ' || coalesce(cache_key, '') || ' (' || case when s in (401, 403) and b then 'access denied — the site is blocking this fetch even with the browser user_agent; try another source'
when s in (401, 403) then 'access denied — the site may be blocking automated clients; retry with user_agent: "browser", or try another source'
when s in (404, 410) then 'page not found — check the URL; the page may have moved or been removed' when s = 429 then 'rate limited by the site — wait before retrying this host'
when s >= 500 then 'server error — usually transient; retrying later may succeed' else 'client error' end || ')' end as error, coalesce(s in (502, 503, 504), false) as retry from e"""

ERRORS = ("stopped after 10 redirects", "dial tcp: no such host", "context deadline exceeded", "connect: connection refused", "tls: bad certificate", "read: connection reset")


def error_class(spark: SparkSession, d: str) -> DataFrame:
    e = F.element_at(F.array(*map(F.lit, ERRORS)), (F.col("event_id") % 6 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", content.error_class(e).alias("error"))


ERROR_CLASS = f"""with e as (select event_id, event_id % 6 as k, (array{list(ERRORS)})[(event_id % 6 + 1)::int] as s from events)
select event_id, (array['too many redirects: ', 'dns error: ', 'timeout: ', 'connection refused: ', '', ''])[(k + 1)::int] || s as error from e"""


def ipv4_blocked(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("event_id")
    ip = F.concat_ws(".", (n * 7 % 256).cast("string"), (n * 13 % 256).cast("string"), (n % 256).cast("string"), (n * 31 % 256).cast("string"))
    return table(spark, d, "events").select("event_id", urls.ipv4_number(ip).alias("number"), urls.ipv4_blocked(ip).alias("blocked"))


_N = "(event_id * 7 % 256)::bigint * 16777216 + (event_id * 13 % 256) * 65536 + (event_id % 256) * 256 + event_id * 31 % 256"
IPV4_BLOCKED = f"with e as (select event_id, ({_N})::bigint as n from events) select event_id, n as number, " + """n < 16777216 or n between 167772160 and 184549375 or n between 1681915904 and 1686110207 or n between 2130706432 and 2147483647 or n between 2851995648 and 2852061183 or n between 2886729728 and 2887778303
or n between 3221225472 and 3221225727 or n between 3221225984 and 3221226239 or n between 3232235520 and 3232301055 or n between 3323068416 and 3323199487 or n between 3325256704 and 3325256959 or n between 3405803776 and 3405804031 or n >= 3758096384 as blocked from e"""


ALLOW = (" 10.0.0.0/9", "127.1.2.3", "Host.Test", "", "224.0.0.0/5", "fd00::/8")


def allow_list(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("event_id")
    ip = F.concat_ws(".", (n * 7 % 256).cast("string"), (n * 13 % 256).cast("string"), (n % 256).cast("string"), (n * 31 % 256).cast("string"))
    host = F.when(n % 17 == 0, "HOST.test.").otherwise("other.test")
    return table(spark, d, "events").select("event_id", admission.permitted(host, ip, admission.parse_allow_list(list(ALLOW))).alias("permitted"))


ALLOW_LIST = f"with e as ({IPV4_BLOCKED}) select event_id, not blocked or event_id % 17 = 0 or " + "number between 167772160 and 176160767 or number = 2130772483 or number between 3758096384 and 3892314111 as permitted from e"


#: Prefixes of addresses, each followed by the event's number in hexadecimal, or in IPv4 notation where they end with a dot.
PREFIXES = ("2606:4700::", "fd00::", "fe80::", "::ffff:10.", "::ffff:8.", "2001:db8::", "64:ff9b::", "::", "10.", "9.", "ff02::", "no address ")


def address_admission(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of both versions, IPv4 in IPv6 too, against the special ranges and the allow list."""
    n = F.col("event_id")
    prefix = F.element_at(F.array(*map(F.lit, PREFIXES)), (n % len(PREFIXES) + 1).cast("int"))
    quad = F.concat_ws(".", (n * 13 % 256).cast("string"), (n % 256).cast("string"), (n * 31 % 256).cast("string"))
    ip = F.concat(prefix, F.when(prefix.endswith("."), quad).otherwise(F.lower(F.hex(n % 65536))))
    found = admission.addresses(table(spark, d, "events"), ip, [n], admission.parse_allow_list(list(ALLOW)))
    return found.select("event_id", "blocked", "allowed", (~F.col("blocked") | F.col("allowed")).alias("permitted"))


ADDRESS_ADMISSION = """with e as (select event_id, event_id % 12 as k, event_id * 13 % 256 as q, event_id % 65536 as h from events),
f as (select event_id, k in (1, 2, 3, 5, 6, 8, 10, 11) or k = 7 and h < 2 as blocked, k = 1 or k in (3, 8) and q < 128 as allowed from e) select event_id, blocked, allowed, not blocked or allowed as permitted from f"""


def image_scale(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("event_id")
    w, h, size = (n * 37 % 9000).cast("int"), (n * 11 % 5000 + 1).cast("int"), (n * 4001 % 20_000_000).cast("long")
    s = content.scaled(w, h, F.lit(1568))
    return table(spark, d, "events").select("event_id", s["w"].alias("w"), s["h"].alias("h"), content.suggested_edge(w, h, size, F.lit(5 << 20)).alias("edge"), content.pixels_admitted(w, h).alias("admitted"), tx.human_bytes(size).alias("bytes"))


IMAGE_SCALE = """with e as (select event_id, (event_id * 37 % 9000)::int as w, (event_id * 11 % 5000 + 1)::int as h, (event_id * 4001 % 20000000)::bigint as z from events), f as (select *, greatest(w, h) as m from e),
g as (select *, case when z = 0 then m else trunc(m * (sqrt(5242880::double / z) * 0.9))::bigint end as d from f)
select event_id, (case when m <= 1568 then w else greatest(1, round(w::double * (1568::double / m))) end)::int as w, (case when m <= 1568 then h else greatest(1, round(h::double * (1568::double / m))) end)::int as h,
(case when z = 0 then m else greatest(64, case when d >= m then m * 3 // 4 else d end) end)::int as edge, w > 0 and h > 0 and w::bigint * h <= 40000000 as admitted,
case when z < 1024 then z || ' B' when z < 1048576 then printf('%.1f KiB', z / 1024.0) else printf('%.1f MiB', z / 1048576.0) end as bytes from g"""


def rate_limit(spark: SparkSession, d: str) -> DataFrame:
    """Ten calls of an event type in eight seconds, an event every tenth of a second, with a pause of nine seconds after each thousand."""
    calls = table(spark, d, "events")
    at = F.col("event_id") * 100 + F.floor(F.col("event_id") / 1000) * 9000
    return stateful.rate_limited(calls, F.col("event_type"), at, F.col("event_id"), 10, 8000).select(F.col("id").alias("event_id"), "allowed")


RATE_LIMIT = """with recursive e as (select event_id, event_type as k, event_id * 100 + event_id // 1000 * 9000 as ms, row_number() over (partition by event_type order by event_id) as n from events),
w as (select event_id, k, n, true as allowed, [ms] as used from e where n = 1
union all select e.event_id, e.k, e.n, len(list_filter(w.used, lambda u: u + 8000 > e.ms)) < 10, case when len(list_filter(w.used, lambda u: u + 8000 > e.ms)) < 10 then list_append(list_filter(w.used, lambda u: u + 8000 > e.ms), e.ms) else w.used end
from w join e on e.k = w.k and e.n = w.n + 1)
select event_id, allowed from w"""


def lru_hits(spark: SparkSession, d: str) -> DataFrame:
    out = stateful.cache_hits(table(spark, d, "events"), F.col("event_type"), F.col("event_id"), F.col("event_id"), F.col("user_id").cast("string"), 8)
    return out.select(F.col("id").alias("event_id"), "outcome")


# a read hits if fewer than eight other entries were read since the entry's last read
LRU_HITS = """with e as (select event_id, event_type as k, user_id, row_number() over (partition by event_type order by event_id) as n from events), p as (select *, lag(n) over (partition by k, user_id order by n) as prev from e),
x as (select p.event_id, count(distinct m.user_id) as others from p join e m on m.k = p.k and m.n > p.prev and m.n < p.n group by p.event_id)
select p.event_id, case when p.prev is not null and coalesce(x.others, 0) < 8 then 'hit' else 'miss' end as outcome from p left join x on p.event_id = x.event_id"""


def ttl_hits(spark: SparkSession, d: str) -> DataFrame:
    """Reads of a cache that never fills, whose entries expire three thousand events after they were stored."""
    out = stateful.cache_hits(table(spark, d, "events"), F.col("event_type"), F.col("event_id"), F.col("event_id"), F.col("user_id").cast("string"), 1 << 30, 3000)
    return out.select(F.col("id").alias("event_id"), "outcome")


TTL_HITS = """with recursive e as (select event_id, event_type as k, user_id as u, row_number() over (partition by event_type, user_id order by event_id) as n from events),
w as (select event_id, k, u, n, 'miss' as outcome, event_id as stored from e where n = 1
union all select e.event_id, e.k, e.u, e.n, case when e.event_id - w.stored > 3000 then 'expired' else 'hit' end, case when e.event_id - w.stored > 3000 then e.event_id else w.stored end from w join e on e.k = w.k and e.u = w.u and e.n = w.n + 1)
select event_id, outcome from w"""


def cache_trace(spark: SparkSession, d: str) -> DataFrame:
    """A cache bounded by entries, bytes and age for each event type, with refreshes, listings and clearings among its reads. No SQL: each outcome depends on all before it."""
    n = F.col("event_id")
    op = F.when(n % 997 == 0, "clear").when(n % 101 == 0, "list").when(n % 37 == 0, "refresh")
    out = stateful.cache_hits(table(spark, d, "events"), F.col("event_type"), n * 1000, n, F.col("user_id").cast("string"), 32, 600_000, n * 7919 % 5000, 64_000, op)
    return out.select(F.col("id").alias("event_id"), "outcome")


def session_cwd(spark: SparkSession, d: str) -> DataFrame:
    e = stateful.as_of(table(spark, d, "events"), "user_id", ["event_id"], F.col("event_type") == "signup", F.when(F.col("event_id") % 2 == 0, "").otherwise(F.concat(F.lit("/w/"), F.col("event_id").cast("string"))), F.floor(F.col("event_id") / 4096))
    return e.select("event_id", F.coalesce(F.when(F.col("current") != "", F.col("current")), F.lit("/host")).alias("cwd"))


SESSION_CWD = """with s as (select user_id, event_id as sid, case when event_id % 2 = 0 then '/host' else '/w/' || event_id end as cwd from events where event_type = 'signup')
select e.event_id, coalesce(s.cwd, '/host') as cwd from events e asof left join s on e.user_id = s.user_id and e.event_id >= s.sid"""


def feed_page(spark: SparkSession, d: str) -> DataFrame:
    """Each RSS feed's entries in order, with the date, link and summary that the entry gives, the first hundred and how many there are."""
    c = F.col
    return feeds.listings(table(spark, d, "rss_items"), "feed_url", "item_id", c("title"), c("link"), feeds.given(c("pub_date"), c("dc_date")), c("description"))


def atom_page(spark: SparkSession, d: str) -> DataFrame:
    """The same of each Atom feed."""
    c = F.col
    return feeds.listings(table(spark, d, "atom_entries"), "feed_url", "entry_id", c("title"), c("link"), feeds.given(c("published"), c("updated")), c("summary"))


def _feed_sql(source: str, key: str, first: str, second: str, markup: str) -> str:
    line = _LINE(_plain(markup))
    return f"""with r as (select distinct on ({key}) * from {source}),
s as (select *, {line} as s0, case when {first} is null or {first} = '' then coalesce({second}, '') else {first} end as stamp from r), t as (select *, {_FEED_DATE("stamp")} as day, case when length(s0) > 400 then s0[:400] || '…' else s0 end as said from s),
k as (select feed_url, row_number() over (partition by feed_url order by {key}) as n, chr(10) || '- **' || case when {_LINE("title")} = '' then '(untitled)' else {_CAP("title")} end || '**' || case when day <> '' then ' — ' || day else '' end
|| case when {_TRIM("link")} <> '' then chr(10) || '  ' || {_TRIM("link")} else '' end || case when said <> '' then chr(10) || '  ' || said else '' end || chr(10) as e from t)
select feed_url, {_TRIM("'Feed with ' || count(*) || ' entries' || case when count(*) > 100 then ' (showing the first 100)' else '' end || ':' || chr(10) || string_agg(e, '' order by n) filter (n <= 100)")} as listing from k group by feed_url"""


FEED_PAGE = _feed_sql("rss_items", "item_id", "pub_date", "dc_date", "description")
ATOM_PAGE = _feed_sql("atom_entries", "entry_id", "published", "updated", "summary")


def save_paths(spark: SparkSession, d: str) -> DataFrame:
    """Save paths made of the pages' addresses: as they are, absolute, climbing out and back, into the workspace's .git and another's."""
    n, p = F.col("page_id"), F.regexp_replace("cache_key", "^[a-z]+://", "")
    made = (
        F.when(n % 8 == 0, p).when(n % 8 == 1, F.concat(F.lit("/"), p)).when(n % 8 == 2, F.concat(F.lit("../"), p)).when(n % 8 == 3, F.concat(F.lit("a/./..//b/../"), p)).when(n % 8 == 4, F.concat(F.lit("a/../.git/"), p))
        .when(n % 8 == 5, F.concat(F.lit("sub/.git/"), p)).when(n % 8 == 6, F.concat(F.lit(".gitignore/"), p)).otherwise(F.concat(p, F.regexp_replace(p, "[^/]+", ".."), F.lit("/../..")))
    )
    return table(spark, d, "rendered").select("page_id", pages.clean_path(made).alias("clean"), pages.save_path_error(made).alias("error"))


# a page's address has neither dot parts nor doubled slashes; each of its parts is left by one '..' of the last case, the first of which joins the last part
SAVE_PATHS = """with r as (select page_id, page_id % 8 as k, regexp_replace(cache_key, '^[a-z]+://', '') as p, rtrim(regexp_replace(cache_key, '^[a-z]+://', ''), '/') as q from rendered)
select page_id, case when k in (0, 1, 3) then q when k = 2 then '../' || q when k = 4 then '.git/' || q when k = 5 then 'sub/.git/' || q when k = 6 then '.gitignore/' || q
else case when len(string_split(p, '/')) = 1 then '../..' else '..' end end as clean,
case when k = 1 then 'save_path must be relative to the workspace, not absolute' when k in (2, 7) then 'save_path escapes the workspace' when k = 4 then 'writing to .git/ is not permitted' else '' end as error from r"""

ATTRIBUTES = ("url('a.png')", ' url( "b.png" ) ', "c.png", "d.png 1x, e.png 2x", "f.png,g.png", "")


def attribute_urls(spark: SparkSession, d: str) -> DataFrame:
    v = F.element_at(F.array(*map(F.lit, ATTRIBUTES)), (F.col("event_id") % 6 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", urls.bare_css_url(v).alias("css"), urls.first_of_srcset(v).alias("srcset"), urls.user_agent(F.col("event_type"), F.lit("pagemill"), F.lit("browser agent")).alias("agent"))


ATTRIBUTE_URLS = """select event_id, (array['a.png', 'b.png', 'c.png', 'd.png 1x, e.png 2x', 'f.png,g.png', ''])[(event_id % 6 + 1)::int] as css,
(array['url(''a.png'')', 'url(', 'c.png', 'd.png', 'f.png', ''])[(event_id % 6 + 1)::int] as srcset, event_type as agent from events"""


def page_size(spark: SparkSession, d: str) -> DataFrame:
    return pages.sized_pages(table(spark, d, "rendered"), table(spark, d, "links")).select("page_id", "size")


_SIZES = f"""f as ({PAGE_LINKS}), k as (select *, row_number() over (partition by page_id order by pos, url) as n from f), ls as (select page_id, sum(strlen(url) + strlen(coalesce(text, '')) + 16) as z from k where n <= 5000 group by page_id),
sized as (select r.*, (coalesce(octet_length(raw_gzip), 0) + strlen(coalesce(markdown, '')) + coalesce(list_sum(list_transform(images, lambda m: 32 + strlen(coalesce(m.url, '')) + strlen(coalesce(m.alt, ''))
+ strlen(coalesce(m.caption, '')) + strlen(coalesce(m.width, '')) + strlen(coalesce(m.height, '')) + strlen(coalesce(m.source_page, '')))), 0) + coalesce(ls.z, 0))::bigint as size from (select distinct on (page_id) * from rendered) r left join ls on r.page_id = ls.page_id)"""
PAGE_SIZE = f"with {_SIZES} select page_id, size from sized"


def cache_list(spark: SparkSession, d: str) -> DataFrame:
    """Each host's cache as lines, with the head that counts them; the day is one after most pages came."""
    sized = pages.sized_pages(table(spark, d, "rendered"), table(spark, d, "links"))
    return pages.cache_lines(sized, F.lit("2026-01-01 00:00:00").cast("timestamp")).drop("stored")


_AGE = "case when a >= 3600 then (a // 3600) || 'h' || (a % 3600 // 60) || 'm' || (a % 60) || 's' when a >= 60 then (a // 60) || 'm' || (a % 60) || 's' else a || 's' end"
CACHE_LIST = f"""with {_SIZES}, l as (select *, greatest(coalesce(epoch(timestamp '2026-01-01 00:00:00')::bigint - floor(epoch(fetched_at))::bigint, 0), 0) as a from sized)
select host, page_id, '  ' || coalesce(cache_key, '') || '  (' || printf('%.1f', round_even(size / 1024.0, 1)) || ' KiB, ' || {_AGE} || ' old)' || case when {_CAP("title")} <> '' then '  — ' || {_CAP("title")} else '' end as line from l
union all select host, null, 'web cache: ' || count(*) || ' entries, ' || printf('%.1f', round_even(sum(size) / 1024.0, 1)) || ' KiB total' from l group by host"""


def raw_bytes(spark: SparkSession, d: str) -> DataFrame:
    return pages.raw_bodies(table(spark, d, "rendered"))


def reference_queries() -> dict:
    return {
        "url_parts": (url_parts, URL_PARTS), "url_admission": (url_admission, URL_ADMISSION), "cache_key": (cache_key, CACHE_KEY), "query_normalize": (query_normalize, QUERY_NORMALIZE),
        "search_topk": (search_topk, SEARCH_TOPK), "search_format": (search_format, SEARCH_FORMAT), "search_answers": (search_answers, SEARCH_ANSWERS), "iso_dates": (iso_dates, ISO_DATES), "feed_summary": (feed_summary, FEED_SUMMARY), "feed_page": (feed_page, FEED_PAGE), "atom_page": (atom_page, ATOM_PAGE),
        "page_title": (page_title, PAGE_TITLE), "cap_text": (cap_text, CAP_TEXT), "fetch_all_windows": (fetch_all_windows, WINDOWS), "fetch_window": (fetch_window, FETCH_WINDOW), "page_links": (page_links, PAGE_LINKS),
        "links_format": (links_format, LINKS_FORMAT), "link_fanout": (link_fanout, LINK_FANOUT), "images_harvest": (images_harvest, IMAGES_HARVEST), "cache_key_dedupe": (cache_key_dedupe, CACHE_DEDUPE),
        "content_route": (content_route, None), "type_route": (type_route, TYPE_ROUTE), "images_format": (images_format, IMAGES_FORMAT), "status_hint": (status_hint, STATUS_HINT), "error_class": (error_class, ERROR_CLASS), "ipv4_blocked": (ipv4_blocked, IPV4_BLOCKED), "allow_list": (allow_list, ALLOW_LIST), "address_admission": (address_admission, ADDRESS_ADMISSION), "image_scale": (image_scale, IMAGE_SCALE),
        "save_paths": (save_paths, SAVE_PATHS), "attribute_urls": (attribute_urls, ATTRIBUTE_URLS), "page_size": (page_size, PAGE_SIZE), "cache_list": (cache_list, CACHE_LIST), "raw_bytes": (raw_bytes, None),
        "rate_limit": (rate_limit, RATE_LIMIT), "lru_hits": (lru_hits, LRU_HITS), "ttl_hits": (ttl_hits, TTL_HITS), "cache_trace": (cache_trace, None), "session_cwd": (session_cwd, SESSION_CWD),
    }
