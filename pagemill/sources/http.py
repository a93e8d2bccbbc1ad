"""Fetching pages as rows: admission, guarded dialling, redirects, one retry, capped bodies.

The transport is a parameter. The one that is built in speaks HTTP with the standard library
and connects to no address that isn't permitted, whatever a name resolves to and wherever a
redirect leads.
"""

from __future__ import annotations

import http.client
import ipaddress
import socket
import ssl
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pagemill.documents.address import resolve
from pagemill.functions.urls import BLOCKED_IPV4, BLOCKED_PORTS
from pagemill.operators.admission import BLOCKED, BLOCKED_IPV6, AllowList, parse_allow_list

# Limits of one fetch, and what requests say they accept.
MAX_BYTES, REDIRECTS, RETRY_AFTER = 2 << 20, 10, 1.0
ACCEPT = "text/html,application/xhtml+xml,text/plain;q=0.9,*/*;q=0.8"
BROWSER = "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/126.0.0.0 Safari/537.36"
AGENT = "pagemill/1"

_NEVER = tuple(map(ipaddress.ip_network, BLOCKED_IPV4 + BLOCKED_IPV6))


@dataclass
class Response:
    status: int
    headers: dict[str, str] = field(default_factory=dict)
    body: bytes = b""


class FetchError(Exception):
    """What went wrong, as the fetched row says it."""


#: (url, user agent, most bytes to read, seconds, allow list) -> the response, redirects not followed; at most one byte more is read.
Transport = Callable[[str, str, int, float, AllowList], Response]


def permitted_address(host: str, address: str, allow: AllowList) -> bool:
    ip = ipaddress.ip_address(address.split("%", 1)[0])
    ip = getattr(ip, "ipv4_mapped", None) or ip
    if not any(ip in n for n in _NEVER if n.version == ip.version):
        return True
    return host.lower().removesuffix(".") in allow.hosts or any(ip in n for n in map(ipaddress.ip_network, allow.nets) if n.version == ip.version)


def dial_address(host: str, port: int, allow: AllowList) -> tuple:
    """The first permitted of a host's addresses, as (family, address)."""
    for family, _, _, _, at in socket.getaddrinfo(host, port, type=socket.SOCK_STREAM):
        if permitted_address(host, at[0], allow):
            return family, at
    raise FetchError(BLOCKED)


def request(url: str, agent: str, most: int, seconds: float, allow: AllowList) -> Response:
    """One GET with the standard library; the connection goes to the checked address itself."""
    parts = urlsplit(url)
    port = parts.port or (443 if parts.scheme == "https" else 80)
    host = parts.hostname or ""
    family, at = dial_address(host, port, allow)
    sock = socket.socket(family, socket.SOCK_STREAM)
    try:
        sock.settimeout(min(seconds, 10))
        sock.connect(at)
        sock.settimeout(seconds)
        if parts.scheme == "https":
            sock = ssl.create_default_context().wrap_socket(sock, server_hostname=host)
        connection = http.client.HTTPConnection(host, port, timeout=seconds)
        connection.sock = sock
        connection.request("GET", (parts.path or "/") + (f"?{parts.query}" if parts.query else ""), headers={"Host": parts.netloc.rsplit("@", 1)[-1], "User-Agent": agent, "Accept": ACCEPT, "Accept-Encoding": "identity"})
        r = connection.getresponse()
        return Response(r.status, {k.lower(): v for k, v in r.getheaders()}, r.read(most + 1))
    finally:
        sock.close()


def admission_error(url: str) -> str:
    try:
        parts = urlsplit(url.strip())
        port = parts.port
    except ValueError:
        return "invalid url"
    if parts.scheme not in ("http", "https"):
        return f'unsupported scheme "{parts.scheme}" (only http/https)'
    if not parts.hostname:
        return "url has no host"
    return f"port {port} is not permitted (it is a well-known non-web service port)" if port in BLOCKED_PORTS else ""


def agent_of(asked: str | None, fallback: str = AGENT) -> str:
    asked = (asked or "").strip() or fallback
    return BROWSER if asked.lower() == "browser" else asked


def error_text(e: BaseException) -> str:
    """An error with the prefix of its class."""
    if isinstance(e, FetchError):
        return str(e)
    text = str(e) or type(e).__name__
    if isinstance(e, socket.gaierror):
        return f"dns error: {text}"
    if isinstance(e, TimeoutError):
        return f"timeout: {text}"
    if isinstance(e, ConnectionRefusedError):
        return f"connection refused: {text}"
    return f"connection reset: {text}" if isinstance(e, (ConnectionResetError, http.client.RemoteDisconnected)) else text


def status_text(status: int, url: str, agent: str) -> str:
    if status in (401, 403):
        hint = "the site is blocking this fetch even with the browser user_agent; try another source" if agent == BROWSER else 'the site may be blocking automated clients; retry with user_agent: "browser", or try another source'
        hint = f"access denied — {hint}"
    elif status in (404, 410):
        hint = "page not found — check the URL; the page may have moved or been removed"
    elif status == 429:
        hint = "rate limited by the site — wait before retrying this host"
    else:
        hint = "server error — usually transient; retrying later may succeed" if status >= 500 else "client error"
    return f"http {status} fetching {url} ({hint})"


def _once(url: str, agent: str, most: int, seconds: float, allow: AllowList, transport: Transport) -> tuple[Response, str]:
    """The response after redirects and its address. Ports and schemes are checked on every hop."""
    at = url
    for _ in range(REDIRECTS + 1):
        if error := admission_error(at):
            raise FetchError(error)
        r = transport(at, agent, most, seconds, allow)
        if r.status not in (301, 302, 303, 307, 308) or not r.headers.get("location"):
            return r, at
        at = resolve(r.headers["location"], at) or at
    raise FetchError(f"too many redirects: stopped after {REDIRECTS} redirects")


def fetch(url: str | None, user_agent: str | None = None, most: int = MAX_BYTES, seconds: float = 25.0, allow: AllowList = AllowList((), ()), transport: Transport = request, wait: Callable[[float], None] = time.sleep, agent: str = AGENT) -> dict:
    """One fetched row: final_url, status, content_type, body, body_truncated, error ('' if all went well, else the rest is null).

    A 502, 503 or 504 and a dropped connection are tried once more after a second.
    """
    url, said = (url or "").strip(), agent_of(user_agent, agent)
    out = dict.fromkeys(("final_url", "status", "content_type", "body", "body_truncated"))
    for attempt in (0, 1):
        try:
            r, final = _once(url, said, most, seconds, allow, transport)
        except (OSError, http.client.HTTPException, FetchError, ValueError) as e:
            if attempt == 0 and isinstance(e, (ConnectionResetError, http.client.RemoteDisconnected, http.client.IncompleteRead)):
                wait(RETRY_AFTER)
                continue
            return out | {"error": error_text(e)}
        if r.status < 400:
            return {"final_url": final, "status": r.status, "content_type": r.headers.get("content-type", ""), "body": r.body[:most], "body_truncated": len(r.body) > most, "error": ""}
        if attempt == 0 and r.status in (502, 503, 504):
            wait(RETRY_AFTER)
            continue
        return out | {"status": r.status, "error": status_text(r.status, final, said)}
    raise AssertionError("unreachable")


FIELDS = [("final_url", pa.string()), ("status", pa.int32()), ("content_type", pa.string()), ("body", pa.binary()), ("body_truncated", pa.bool_()), ("error", pa.string())]
SCHEMA = "final_url string, status int, content_type string, body binary, body_truncated boolean, error string"


def fetched(requests: DataFrame, keep: list[str], concurrency: int = 4, **options) -> DataFrame:
    """The columns ``keep`` of requests (url, user_agent, ...) with what ``fetch`` gives for each; never an exception.

    All requests in flight are one for each of ``concurrency`` partitions, whatever the
    cluster. A partition lost is fetched again. ``options`` are those of ``fetch``.
    """
    agent = F.col("user_agent") if "user_agent" in requests.columns else F.lit(None).cast("string")
    picked = requests.select(F.col("url").cast("string").alias("__url"), agent.alias("__agent"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, (url, said) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                row = fetch(url, said, **options)
                yield pa.RecordBatch.from_arrays([*b.slice(i, 1).columns[2:], *(pa.array([row[n]], kind) for n, kind in FIELDS)], names=[*b.schema.names[2:], *(n for n, _ in FIELDS)])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[2:])
    return picked.repartition(concurrency).mapInArrow(run, f"{kinds}, {SCHEMA}" if kinds else SCHEMA)


def fetched_images(requests: DataFrame, keep: list[str], edge: int = 0, most: int = 5 << 20, concurrency: int = 3, **options) -> DataFrame:
    """The columns ``keep`` with each image ready for use (``pagemill.documents.pixels.fetched_image``) and final_url.

    Downloads may be four times as large as ``most``, 25 MiB at least, so that a large image can be scaled down.
    """
    from pagemill.documents import pixels

    ceiling = pixels.download_ceiling(most)
    got = fetched(requests, keep, concurrency, most=ceiling, **options)
    names = [("data", pa.binary()), ("mime", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("resized", pa.bool_()), ("orig_w", pa.int32()), ("orig_h", pa.int32()), ("error", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for kind, body, cut, error in zip(*(b.column(c).to_pylist() for c in ("content_type", "body", "body_truncated", "error"))):
                if error:
                    rows.append({"error": error})
                elif cut:
                    rows.append({"error": f"image exceeds the {pixels.human_bytes(ceiling)} download ceiling and was not fully retrieved"})
                else:
                    rows.append(pixels.fetched_image(kind, body, edge, most))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), b.column("final_url"), *(pa.array([r.get(n) for r in rows], t) for n, t in names)], names=[*keep, "final_url", *(n for n, _ in names)])

    kinds = ", ".join(f"`{k}` {dict(got.dtypes)[k]}" for k in keep)
    return got.mapInArrow(run, f"{kinds + ', ' if kinds else ''}final_url string, data binary, mime string, width int, height int, resized boolean, orig_w int, orig_h int, error string")


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.urls = options.get("urls", "").split()
        self.agent = options.get("user_agent")
        self.most = int(options.get("max_bytes", MAX_BYTES))
        self.allow = parse_allow_list(options.get("allow_local_hosts", "").split(","))
        self.parts = max(1, min(int(options.get("concurrency", "4")), len(self.urls)))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(k) for k in range(self.parts)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for url in self.urls[partition.value :: self.parts]:
            row = fetch(url, self.agent, self.most, allow=self.allow)
            yield (url, *(row[n] for n, _ in FIELDS))


class PageSource(DataSource):
    """``spark.read.format("webpages")`` after ``spark.dataSource.register(PageSource)``: a row for each of the addresses in the option ``urls``, parted by white space.

    Other options: user_agent, max_bytes, allow_local_hosts (parted by commas), concurrency.
    For addresses in a table there is ``fetched``.
    """

    @classmethod
    def name(cls) -> str:
        return "webpages"

    def schema(self) -> str:
        return f"url string, {SCHEMA}"

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)
