"""Search backends as sources: normalised queries in, decoded and filtered results out."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.operators.search import backend_request, decoded_payloads, normalised_queries
from pagemill.sources.settings import Settings

#: Bytes of an answer that are read.
MAX_ANSWER = 1 << 20

#: (method, url, headers, body) -> (status, body).
Post = Callable[[str, str, dict[str, str], bytes | None], tuple[int, bytes]]


def chosen_backend(settings: Settings) -> tuple[str, str]:
    """(backend, why it can't be used or ''); see the settings' search_backend."""
    name = settings.search_backend
    if name == "tavily":
        return name, "" if settings.tavily_api_key else "tavily backend selected but no API key (set TAVILY_API_KEY or tavily_api_key in config.json)"
    if name == "searxng":
        if not settings.searxng_url:
            return name, "searxng backend selected but no instance URL (set PAGEMILL_SEARXNG_URL or searxng_url in config.json)"
        try:
            parts = urlsplit(settings.searxng_url)
            sound = parts.scheme in ("http", "https") and bool(parts.netloc)
        except ValueError:
            sound = False
        return name, "" if sound else f'searxng: invalid URL "{settings.searxng_url}" (must be http(s)://host…)'
    return name, f'unknown search backend "{name}" (use "tavily" or "searxng")'


def _send(method: str, url: str, headers: dict[str, str], body: bytes | None) -> tuple[int, bytes]:
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url, body, headers, method=method), timeout=25) as r:
            return r.status, r.read(MAX_ANSWER)
    except HTTPError as e:
        return e.code, e.read(512)


def searched(queries: DataFrame, settings: Settings, send: Post = _send, concurrency: int = 4) -> DataFrame:
    """(query_id, place, title, url, snippet, published, error) of each distinct query.

    Queries that aren't sound, and all of them if the backend can't be used, give a row
    with an error. Domains, depth, freshness and counts go to the backend as far as it
    takes them; what it doesn't is applied to its answers.
    """
    backend, unusable = chosen_backend(settings)
    c = F.col
    known = normalised_queries(queries).withColumn("error", F.when(c("error") == "", unusable).otherwise(c("error")))
    sound = known.where("error = ''").select("query_id", *backend_request(backend) if backend in ("tavily", "searxng") else [F.lit("").alias("search_text"), F.lit("").alias("parameters")])
    base = settings.searxng_url.rstrip("/") + "/search?"
    key = settings.tavily_api_key

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            status, payload = [], []
            for p in b.column(1).to_pylist():
                try:
                    if backend == "searxng":
                        code, answer = send("GET", base + p, {"Accept": "application/json"}, None)
                    else:
                        code, answer = send("POST", "https://api.tavily.com/search", {"Content-Type": "application/json", "Authorization": f"Bearer {key}"}, p.encode())
                except OSError as e:
                    code, answer = 0, str(e).encode()
                status.append(code)
                payload.append(answer.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(status, pa.int32()), pa.array(payload, pa.string())], names=["query_id", "status", "payload"])

    answers = sound.select("query_id", "parameters").repartition(concurrency).mapInArrow(run, "query_id long, status int, payload string")
    found = decoded_payloads(answers, queries, backend)
    none = lambda n, t="string": F.lit(None).cast(t).alias(n)
    return found.unionByName(known.where("error <> ''").select("query_id", none("place", "int"), none("title"), none("url"), none("snippet"), none("published"), "error"))


def payload_of(results: list[dict], backend: str) -> str:
    """An answer as the backend would give it, for tests and replays."""
    date = "publishedDate" if backend == "searxng" else "published_date"
    return json.dumps({"results": [{"title": r.get("title"), "url": r.get("url"), "content": r.get("snippet"), date: r.get("published")} for r in results]})
