"""Frames of a host (a line of JSON each) as rows, and the replies to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.registry import Registry

#: Bytes from which a line is no frame.
MAX_LINE = 8 << 20
FRAME = "struct<type: string, id: string, name: string, args: string, protocol_version: int, data_dir: string, extension_dir: string, provider: string, model: string, cwd: string, event: string, session_id: string, session_path: string, session_title: string, project_id: string>"


def read_frames(lines: DataFrame, connection: Column, seq: Column, value: Column) -> DataFrame:
    """(connection, seq, type, id, name, args, ...) of the lines that are frames; others, and lines too long, are left out.

    ``args`` stays JSON. Works on streams as on tables.
    """
    sound = lines.select(connection.alias("connection"), seq.alias("seq"), value.alias("__line")).where(F.octet_length("__line") <= MAX_LINE)
    read = sound.withColumn("__f", F.from_json("__line", FRAME, {"mode": "PERMISSIVE"})).where(F.col("__line").rlike(r"^\s*\{") & F.try_parse_json("__line").isNotNull())
    return read.select("connection", "seq", "__f.*")


def sessions(frames: DataFrame) -> DataFrame:
    """``frames`` with ``working_dir``: the connection's last session_start's directory if it isn't empty, else its greeting's, as of each frame."""
    c, so_far = F.col, Window.partitionBy("connection").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda test: F.last(F.when(test, F.struct(F.coalesce("cwd", F.lit("")).alias("v"))), ignorenulls=True).over(so_far)["v"]
    session, host = last((c("type") == "event") & (c("event") == "session_start")), last(c("type") == "hello_ack")
    return frames.withColumn("working_dir", F.coalesce(F.when(session != "", session), host, F.lit("")))


def greeting(spark: SparkSession, registry: Registry) -> DataFrame:
    """(place, frame): what is sent first, in order: hello, the tools, the commands, the subscription, ready."""
    import json

    known = ["tools", "events"] + (["commands"] if registry.commands else [])
    frames: list[dict] = [{"type": "hello", "name": registry.name, "version": registry.version, "capabilities": known}]
    frames += [{"type": "register_tool", "name": t.name, "description": t.description, "schema": t.schema} | ({"authority": t.authority} if t.authority else {}) for t in registry.tools]
    frames += [{"type": "register_command", "name": n, "description": d} for n, d in registry.commands.items()]
    frames += [{"type": "subscribe", "events": ["session_start"]}, {"type": "ready"}]
    return spark.createDataFrame([(i, json.dumps(f, sort_keys=True)) for i, f in enumerate(frames)], "place int, frame string")


def encoded(data: Column) -> Column:
    """Bytes as base64 on one line."""
    return F.regexp_replace(F.base64(data), r"[\r\n]", "")


def tool_result(call: Column, text: Column, error: Column, mime: Column | None = None, data: Column | None = None) -> Column:
    """A tool's reply as a line: the image first if there is one, then the text unless it is empty beside an image."""
    block = lambda kind, **more: F.struct(F.lit(kind).alias("type"), *[v.alias(k) for k, v in more.items()])
    none = F.lit(None).cast("string")
    image = block("image", mime_type=mime if mime is not None else none, data=encoded(data) if data is not None else none, text=none)
    words = block("text", mime_type=none, data=none, text=F.coalesce(text, F.lit("")))
    pictured = data.isNotNull() if data is not None else F.lit(False)
    content = F.when(~pictured, F.array(words)).when(F.coalesce(text, F.lit("")) == "", F.array(image)).otherwise(F.array(image, words))
    return F.to_json(F.struct(F.lit("tool_result").alias("type"), call.alias("id"), content.alias("content"), error.alias("is_error")))


def command_response(call: Column, action: Column, text: Column, error: Column) -> Column:
    """A command's reply as a line; its text stands under the name of the action that shows it."""
    done = F.when(F.coalesce(action, F.lit("")) == "", "noop").otherwise(action)
    shown = lambda name: F.when(done == name, F.coalesce(text, F.lit(""))).alias(name)
    return F.to_json(F.struct(F.lit("command_response").alias("type"), call.alias("id"), done.alias("action"), shown("display"), shown("prompt"), shown("insert"), F.when(F.coalesce(error, F.lit("")) != "", error).alias("error")))


def refusals(frames: DataFrame, registry: Registry) -> DataFrame:
    """(connection, seq, reply) of calls that no tool or command answers, and of shutdown."""
    c = F.col
    tools, commands = [t.name for t in registry.tools], list(registry.commands)
    quoted = lambda kind: F.concat(F.lit(f'no handler for {kind} "'), F.coalesce("name", F.lit("")), F.lit('"'))
    known = lambda names: F.coalesce(c("name").isin(*names), F.lit(False)) if names else F.lit(False)
    reply = (
        F.when((c("type") == "tool_call") & ~known(tools), tool_result(c("id"), quoted("tool"), F.lit(True)))
        .when((c("type") == "command_invoked") & ~known(commands), command_response(c("id"), F.lit("noop"), F.lit(""), quoted("command")))
        .when(c("type") == "shutdown", '{"type":"shutdown_ack"}')
    )
    return frames.select("connection", "seq", reply.alias("reply")).where("reply is not null")
