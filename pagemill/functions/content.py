"""Content types, statuses, errors and image sizes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions.text import text, trim_space

# Content types beside text/* that are text.
TEXT_TYPES = ("application/json", "application/xml", "application/xhtml+xml", "application/javascript", "application/ecmascript", "image/svg+xml")
MAX_PIXELS = 40_000_000


def bare_type(ct: Column) -> Column:
    return trim_space(F.substring_index(F.lower(trim_space(ct)), ";", 1))


def display_type(ct: Column) -> Column:
    return F.when(bare_type(ct) == "", "binary").otherwise(bare_type(ct))


def looks_binary(body: Column) -> Column:
    return F.coalesce(F.position(F.lit(b"\x00"), F.substring(body, 1, 1024)) > 0, F.lit(False))


def _text_type(t: Column) -> Column:
    return t.startswith("text/") | t.isin(*TEXT_TYPES) | t.endswith("+json") | t.endswith("+xml")


def is_textual(ct: Column, body: Column) -> Column:
    t = bare_type(ct)
    return F.when(t == "", ~looks_binary(body)).otherwise(_text_type(t))


def is_pdf(ct: Column, body: Column) -> Column:
    return (bare_type(ct) == "application/pdf") | F.coalesce(F.substring(body, 1, 5) == F.lit(b"%PDF-"), F.lit(False))


def asks_body(ct: Column) -> Column:
    """Whether the route depends on the body: for no type, and for types other than HTML and text, as a PDF may come under any."""
    t = bare_type(ct)
    return ~F.contains(F.lower(text(ct)), F.lit("html")) & ((t == "") | ~_text_type(t) & (t != "application/pdf"))


def route(ct: Column, body: Column) -> Column:
    """html, text, pdf or binary: how a response is rendered. A PDF of no type and without NUL bytes counts as text."""
    t = F.lower(text(ct))
    html = F.contains(t, F.lit("html")) | ((t == "") & F.coalesce(F.contains(F.lower(F.decode(body, "ISO-8859-1")), F.lit("<html")), F.lit(False)))
    return F.when(html, "html").when(is_textual(ct, body), "text").when(is_pdf(ct, body), "pdf").otherwise("binary")


# Hints, error prefixes and what they are found by.
def status_hint(status: Column, browser: Column) -> Column:
    """The hint for a failed status, null below 400."""
    return (
        F.when(status < 400, None)
        .when(status.isin(401, 403) & browser, "access denied — the site is blocking this fetch even with the browser user_agent; try another source")
        .when(status.isin(401, 403), 'access denied — the site may be blocking automated clients; retry with user_agent: "browser", or try another source')
        .when(status.isin(404, 410), "page not found — check the URL; the page may have moved or been removed")
        .when(status == 429, "rate limited by the site — wait before retrying this host")
        .when(status >= 500, "server error — usually transient; retrying later may succeed")
        .when(status.isNotNull(), "client error")
    )


def status_error(status: Column, url: Column, browser: Column) -> Column:
    """What is said of a failed status, or the empty string."""
    return F.when(status >= 400, F.concat(F.lit("http "), status.cast("string"), F.lit(" fetching "), text(url), F.lit(" ("), status_hint(status, browser), F.lit(")"))).otherwise("")


def retryable(status: Column, error: Column) -> Column:
    return F.coalesce(status.isin(502, 503, 504), F.lit(False)) | F.contains(text(error), F.lit("connection reset")) | F.contains(text(error), F.lit("unexpected EOF"))


def error_class(error: Column) -> Column:
    """The error with the prefix of its class."""
    e = text(error)
    has = lambda s: F.contains(e, F.lit(s))
    return (
        F.when(has("stopped after") & has("redirects"), F.concat(F.lit("too many redirects: "), e))
        .when(has("no such host") | has("server misbehaving") | has("name resolution"), F.concat(F.lit("dns error: "), e))
        .when(has("Client.Timeout") | has("deadline exceeded") | has("timeout"), F.concat(F.lit("timeout: "), e))
        .when(has("connection refused"), F.concat(F.lit("connection refused: "), e))
        .otherwise(e)
    )


def scaled(w: Column, h: Column, longest: Column) -> Column:
    """The struct (w, h) fitted to a longest edge, never enlarged, each 1 at least."""
    edge = F.greatest(w, h)
    fit = lambda x: F.greatest(F.lit(1), F.round(x.cast("double") * (longest.cast("double") / edge)).cast("int"))
    small = (edge <= longest) | (edge == 0)
    return F.struct(F.when(small, w).otherwise(fit(w)).alias("w"), F.when(small, h).otherwise(fit(h)).alias("h"))


def suggested_edge(w: Column, h: Column, size: Column, cap: Column) -> Column:
    """A longest edge that should bring an encoded image of ``size`` bytes under ``cap``."""
    edge = F.greatest(w, h)
    d = (edge * (F.sqrt(cap.cast("double") / size) * 0.9)).cast("int")
    return F.when((edge == 0) | (size == 0), edge).otherwise(F.greatest(F.lit(64), F.when(d >= edge, F.floor(edge * 3 / 4).cast("int")).otherwise(d)))


def pixels_admitted(w: Column, h: Column) -> Column:
    return (w > 0) & (h > 0) & (w.cast("long") * h <= MAX_PIXELS)
