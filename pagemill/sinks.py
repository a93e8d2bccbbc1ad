"""Saving bodies to files under a workspace, never outside it and never through links."""

from __future__ import annotations

import os
import posixpath
import stat
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class SaveError(Exception):
    """Why a path may not be written."""


def _within(root: str, path: str) -> bool:
    return path == root or path.startswith(root.rstrip("/") + "/")


def checked_target(workspace: str | None, path: str, overwrite: bool = False, create: bool = False) -> tuple[str, str]:
    """(file to write, its path in the workspace), or SaveError.

    Without ``create`` nothing is touched; with it missing folders are made. Fixed values: the texts of the errors.
    """
    if not (workspace or "").strip():
        raise SaveError("no workspace directory available to save into")
    if posixpath.isabs(path):
        raise SaveError("save_path must be relative to the workspace, not absolute")
    root = os.path.abspath(workspace)
    real_root = os.path.realpath(root)
    if not os.path.isdir(real_root):
        raise SaveError("workspace directory is not accessible")
    relative = posixpath.normpath(path or ".")
    if relative == ".." or relative.startswith("../"):
        raise SaveError("save_path escapes the workspace")
    if relative == ".git" or relative.startswith(".git/"):
        raise SaveError("writing to .git/ is not permitted")
    at = root
    for part in [p for p in posixpath.dirname(relative).split("/") if p not in ("", ".")]:
        at = os.path.join(at, part)
        if not os.path.lexists(at):
            if not create:
                break
            os.makedirs(at, 0o755, exist_ok=True)
        mode = os.lstat(at).st_mode
        if stat.S_ISLNK(mode):
            raise SaveError(f'save_path parent "{part}" is a symlink, which is not permitted')
        if not stat.S_ISDIR(mode):
            raise SaveError(f'save_path parent "{part}" is not a directory')
        if not _within(real_root, os.path.realpath(at)):
            raise SaveError("save_path escapes the workspace")
    target = os.path.join(root, *relative.split("/"))
    if os.path.lexists(target):
        if os.path.islink(target):
            raise SaveError("save_path points to a symlink, which is not permitted")
        if not overwrite:
            raise SaveError(f"{relative} already exists (set overwrite=true to replace it)")
    return target, relative


def path_error(workspace: str | None, path: str, overwrite: bool = False) -> str:
    """The check alone, before anything is fetched: why the path may not be written, or ''."""
    try:
        checked_target(workspace, path, overwrite)
    except (SaveError, OSError) as e:
        return str(e)
    return ""


def save(workspace: str | None, path: str, data: bytes, overwrite: bool = False) -> str:
    """Writes a file and gives its path in the workspace. The open itself follows no link and, without ``overwrite``, replaces nothing."""
    target, relative = checked_target(workspace, path, overwrite, create=True)
    flags = os.O_WRONLY | os.O_CREAT | getattr(os, "O_NOFOLLOW", 0) | (os.O_TRUNC if overwrite else os.O_EXCL)
    with os.fdopen(os.open(target, flags, 0o644), "wb") as f:
        f.write(data)
    return relative


def saved(rows: DataFrame, workspace: str, path: Column, data: Column, keep: list[str], overwrite: bool = False) -> DataFrame:
    """The columns ``keep`` with (saved, error) for each row: writes its bytes under a workspace that all executors share.

    Null paths and null data are errors. A task that runs again after a loss meets its own
    files, so pass ``overwrite`` where that may happen; without it such rows say that the file exists.
    """
    picked = rows.select(path.cast("string").alias("__path"), data.cast("binary").alias("__data"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done, errors = [], []
            for p, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    if p is None or d is None:
                        raise SaveError("nothing to save")
                    done.append(save(workspace, p, d, overwrite))
                    errors.append("")
                except (SaveError, OSError) as e:
                    done.append(None)
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([*b.columns[2:], pa.array(done, pa.string()), pa.array(errors, pa.string())], names=[*b.schema.names[2:], "saved", "error"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in picked.schema.fields[2:])
    return picked.mapInArrow(run, f"{kinds}saved string, error string")


def raw_saved_text(saved_as: Column, content_type: Column, size: Column, final_url: Column, url: Column, truncated: Column) -> Column:
    """What is said of a saved source."""
    kind = F.when(F.trim(F.coalesce(content_type, F.lit(""))) == "", "unknown type").otherwise(F.trim(content_type))
    elsewhere = F.when((F.coalesce(final_url, F.lit("")) != "") & (final_url != url), F.concat(F.lit(" (final: "), final_url, F.lit(")"))).otherwise("")
    return F.concat(F.lit("Saved unrendered source to "), saved_as, F.lit("\n"), kind, F.format_string(", %d bytes", size), elsewhere, F.when(truncated, "\n…source was capped at the fetch byte limit before saving").otherwise(""))


def image_text(url: Column, image: Column) -> Column:
    """What is said of a fetched image (a struct as of ``fetched_images``)."""
    final = image["final_url"]
    elsewhere = F.when((F.coalesce(final, F.lit("")) != "") & (final != url), F.concat(F.lit(" (final: "), final, F.lit(")"))).otherwise("")
    told = F.format_string("\n%s, %d×%d, %.1f KiB", image["mime"], image["width"], image["height"], F.bround(F.octet_length(image["data"]) / 1024.0, 1))
    return F.concat(F.lit("Fetched "), url, elsewhere, told, F.when(image["resized"], F.format_string(" (resized from %d×%d)", image["orig_w"], image["orig_h"])).otherwise(""))
