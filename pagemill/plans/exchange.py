"""Queries of what is exchanged with hosts and search backends: frames, replies, answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators import search
from pagemill.plans.reference import _RANKED, _TRIM
from pagemill.registry import default_registry
from pagemill.session import table
from pagemill.sources import frames


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Events as a host's lines: a greeting at each sign-up, sessions (every other without a directory), calls of known and unknown tools, and lines that are no frames."""
    n, kind = F.col("event_id"), F.col("event_type")
    text = n.cast("string")
    line = (
        F.when(n % 41 == 0, F.concat(F.lit('{"type": "tool_call", broken'), text)).when(n % 43 == 0, "not json").when(n % 47 == 0, F.concat(F.lit('["type", '), text, F.lit("]")))
        .when(kind == "signup", F.concat(F.lit('{"type":"hello_ack","protocol_version":2,"cwd":"/host/'), text, F.lit('","unknown":1}')))
        .when(n % 5 == 0, F.concat(F.lit('{"type":"event","event":"session_start","session_id":"s'), text, F.when(n % 2 == 0, F.concat(F.lit('","cwd":"/w/'), text)).otherwise(""), F.lit('"}')))
        .when(n % 5 == 1, F.concat(F.lit('{"type":"tool_call","id":"c'), text, F.lit('","name":"'), F.when(n % 2 == 0, "web_fetch").otherwise("web_\\u0066lood"), F.lit('","args":{"url":"https://h.test/'), text, F.lit('"}}')))
        .when(n % 5 == 2, F.concat(F.lit('{"type":"command_invoked","id":"c'), text, F.lit('","name":"'), F.when(n % 2 == 0, "web-cache").otherwise("other"), F.lit('","args":"list"}')))
        .when(n % 97 == 3, '{"type":"shutdown"}').otherwise(F.concat(F.lit('{"type":"ping","id":"'), text, F.lit('"}')))
    )
    return frames.read_frames(table(spark, d, "events"), F.col("user_id"), n, line)


_SOUND = "event_id % 41 <> 0 and event_id % 43 <> 0 and event_id % 47 <> 0"


def frame_sessions(spark: SparkSession, d: str) -> DataFrame:
    """The working directory as of each frame of each connection."""
    return frames.sessions(_lines(spark, d)).select(F.col("seq").alias("event_id"), "type", "working_dir")


FRAME_SESSIONS = f"""with f as (select *, case when event_type = 'signup' then 'hello_ack' when event_id % 5 = 0 then 'event' when event_id % 5 = 1 then 'tool_call' when event_id % 5 = 2 then 'command_invoked' when event_id % 97 = 3 then 'shutdown' else 'ping' end as type
from events where {_SOUND}),
h as (select user_id, event_id as hid, '/host/' || event_id as dir from f where type = 'hello_ack'), s as (select user_id, event_id as sid, case when event_id % 2 = 0 then '/w/' || event_id else '' end as dir from f where type = 'event'),
j as (select f.event_id, f.user_id, f.type, h.dir as hd from f asof left join h on f.user_id = h.user_id and f.event_id >= h.hid)
select j.event_id, j.type, coalesce(nullif(s.dir, ''), j.hd, '') as working_dir from j asof left join s on j.user_id = s.user_id and j.event_id >= s.sid"""


def frame_replies(spark: SparkSession, d: str) -> DataFrame:
    """The replies to calls that nothing answers, and to shutdown."""
    return frames.refusals(_lines(spark, d), default_registry()).select(F.col("seq").alias("event_id"), "reply")


FRAME_REPLIES = f"""with f as (select event_id, event_type = 'signup' as hello, event_id % 5 as k, event_id % 2 = 1 as odd from events where {_SOUND}),
r as (select event_id, case when hello then null when k = 1 and odd then '{{"type":"tool_result","id":"c' || event_id || '","content":[{{"type":"text","text":"no handler for tool \\"web_flood\\""}}],"is_error":true}}'
when k = 2 and odd then '{{"type":"command_response","id":"c' || event_id || '","action":"noop","error":"no handler for command \\"other\\""}}' when k in (3, 4) and event_id % 97 = 3 then '{{"type":"shutdown_ack"}}' end as reply from f)
select event_id, reply from r where reply is not null"""


def search_decode(spark: SparkSession, d: str) -> DataFrame:
    """Results as SearXNG's answers to their queries, decoded, filtered by the queries' domains and cut to their counts; every tenth query fails, every eleventh answer isn't JSON."""
    c = F.col
    one = F.struct(c("title").alias("title"), c("url").alias("url"), c("snippet").alias("content"), c("published").alias("publishedDate"), F.lit(1).alias("score"))
    by_query = table(spark, d, "results").dropDuplicates(["result_id"]).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("result_rank", "result_id", one.alias("r")))).alias("rs"))
    sound = F.to_json(F.struct(F.lit("q").alias("query"), F.transform("rs", lambda x: x["r"]).alias("results")))
    answers = by_query.select("query_id", F.when(c("query_id") % 10 == 0, 403).otherwise(200).alias("status"), F.when(c("query_id") % 11 == 0, "<html>").otherwise(sound).alias("payload"))
    queries = search.normalised_queries(table(spark, d, "queries")).where("error = ''").select("query_id")
    return search.decoded_payloads(answers.join(queries, "query_id", "left_semi"), table(spark, d, "queries"), "searxng")


SEARCH_DECODE = f"""with {_RANKED}, w as (select distinct r.query_id from results r join n on n.query_id = r.query_id and n.error = '')
select query_id, place::int as place, title, url, snippet, published, '' as error from ranked where place <= max_results and query_id % 10 <> 0 and query_id % 11 <> 0
union all select query_id, null, null, null, null, null, case when query_id % 10 = 0 then 'searxng: HTTP 403 (is `json` enabled in search.formats?)' else 'searxng: decode: malformed payload' end from w where query_id % 10 = 0 or query_id % 11 = 0"""


def backend_queries(spark: SparkSession, d: str) -> DataFrame:
    """What each sound query is sent to Tavily with."""
    known = search.normalised_queries(table(spark, d, "queries")).where("error = ''")
    return known.select("query_id", *search.backend_request("tavily")).select("query_id", "search_text", F.get_json_object("parameters", "$.max_results").cast("int").alias("max_results"), F.get_json_object("parameters", "$.search_depth").alias("search_depth"), F.get_json_object("parameters", "$.time_range").alias("time_range"), F.get_json_object("parameters", "$.include_domains").alias("include_domains"))


BACKEND_QUERIES = f"""with {_RANKED} select query_id, query_text as search_text, max_results, case when depth = 'advanced' then 'advanced' else 'basic' end as search_depth, nullif(freshness, '') as time_range,
case when include_domains <> '' then '["' || replace(include_domains, ',', '","') || '"]' end as include_domains from n where error = ''"""


def exchange_queries() -> dict:
    return {
        "frame_sessions": (frame_sessions, FRAME_SESSIONS), "frame_replies": (frame_replies, FRAME_REPLIES), "search_decode": (search_decode, SEARCH_DECODE), "backend_queries": (backend_queries, BACKEND_QUERIES),
    }
