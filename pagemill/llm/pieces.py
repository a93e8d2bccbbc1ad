"""Splitting of long texts by content-defined chunking.

A rolling hash over the last tokens marks landmarks that depend on the text around
them only. A piece ends at the natural boundary nearest to the first landmark that
lies between the minimum and the maximum size, so an edit moves the cuts near it
and leaves the others where they are. Boundaries are, from best to worst, the ends
of paragraphs, lines, sentences and words; a text without any is cut at the
landmark, between two characters. The next piece starts so many tokens before the
cut as the overlap asks for.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from pagemill.llm.tokens import BLOCK_CHARS, BlockIds, bytes_of, join_back, tokenizer_path, word_blocks
from pagemill.session import cut_lineage

#: Tokens under the rolling hash.
WINDOW = 8
LEVELS = ("inside", "character", "word", "sentence", "line", "paragraph")
#: Parts of the room between minimum and maximum size within which each level draws a cut.
REACH = (0.0, 1.0, 1.0, 0.5, 0.4, 0.5)

SCHEMA = "spec_id int, doc_id long, piece_no int, token_start int, token_end int, n_tokens int, cut string, text string"


def boundary_levels(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each token start the level of the boundary before it: an index into LEVELS."""
    padded = np.concatenate((np.full(4, 10, np.uint8), data, np.zeros(1, np.uint8)))
    at = starts + 4
    c, b1, b2, b3 = padded[at], padded[at - 1], padded[at - 2], padded[at - 3]
    blank = lambda x: (x == 32) | (x == 9) | (x == 10) | (x == 13)
    level = ((c & 0xC0) != 0x80).astype(np.int8)
    gap = blank(c) | blank(b1)
    level[gap] = 2
    western = ((b1 == 46) | (b1 == 33) | (b1 == 63)) & blank(c)
    western |= ((b2 == 46) | (b2 == 33) | (b2 == 63)) & blank(b1) & ~blank(c)
    wide = ((b3 == 0xE3) & (b2 == 0x80) & (b1 == 0x82)) | ((b3 == 0xEF) & (b2 == 0xBC) & ((b1 == 0x81) | (b1 == 0x9F)))
    level[western | wide] = 3
    line = (b1 == 10) & (c != 10) & (c != 13)
    level[line] = 4
    level[line & ((b2 == 10) | ((b2 == 13) & (b3 == 10)))] = 5
    return level


def rolling_hash(ids: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``WINDOW`` tokens before each position."""
    with np.errstate(over="ignore"):
        x = (ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        h = np.zeros(len(ids), np.uint64)
        for k in range(1, WINDOW + 1):
            h[k:] = h[k:] * np.uint64(0x100000001B3) + x[:-k] if k < len(ids) else h[k:]
        return h ^ (h >> np.uint64(32))


def cuts(n: int, limit: int, overlap: int, marks: Sequence[int], by_level: list[Sequence[int]]) -> list[tuple[int, int]]:
    """The ends of the pieces of a text of ``n`` tokens, with their levels.

    ``marks`` and ``by_level`` (the positions of each level) are sorted and relative
    to the text. Every piece has ``limit`` tokens at most, its overlap included.
    """
    longest = limit - overlap
    shortest = max(1, overlap, longest // 2) if overlap < longest else max(1, longest // 2)
    room = longest - shortest
    out, at = [], 0
    while n - at > longest:
        lo, hi = at + shortest, at + longest
        k = bisect_left(marks, lo)
        target = marks[k] if k < len(marks) and marks[k] <= hi else hi
        best, level = None, 0
        for lv in range(len(LEVELS) - 1, 0, -1):
            reach = REACH[lv] * room
            own = by_level[lv]
            k = bisect_left(own, target)
            below = own[k - 1] if k > 0 and own[k - 1] >= lo and target - own[k - 1] <= reach else None
            above = own[k] if k < len(own) and own[k] <= hi and own[k] - target <= reach else None
            if below is not None or above is not None:
                best, level = below if above is None or below is not None and target - below <= above - target else above, lv
                break
        at = target if best is None else best
        out.append((at, level))
    out.append((n, 5))
    return out


def _split(specs: list[tuple[int, int, int]], path: str):
    def finish(b: BlockIds) -> pa.Table:
        ends = b.ends
        sizes = np.diff(ends, prepend=0)
        least = min(t for _, t, _ in specs)
        cols: list[list] = [[] for _ in range(8)]
        if (sizes > least).any():
            ids = b.ids
            for i in np.flatnonzero(sizes > least):
                own = ids[ends[i] - sizes[i] : ends[i]]
                # the text follows from its ids
                joined, piece_ends = bytes_of(own, path)
                data, byte_at = joined.tobytes(), np.concatenate(([0], piece_ends))
                level = boundary_levels(joined, byte_at[:-1])
                by_level = [np.flatnonzero(level == lv).tolist() for lv in range(len(LEVELS))]
                h = rolling_hash(own)
                for spec, limit, overlap in specs:
                    if sizes[i] <= limit:
                        continue
                    every = max(2, (limit - overlap) // 8)
                    start = 0
                    for no, (end, lv) in enumerate(cuts(len(own), limit, overlap, np.flatnonzero(h % np.uint64(every) == 0).tolist(), by_level)):
                        text = data[byte_at[start] : byte_at[end]].decode("utf-8", "replace")
                        for col, v in zip(cols, (spec, b.keys[i], no, start, end, end - start, LEVELS[lv], text)):
                            col.append(v)
                        start = end - overlap
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string())
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, cols, kinds)})

    return finish


def split_texts(df: DataFrame, key: Column, text: Column, specs: list[tuple[int, int, int]], path: str | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Pieces of the texts with more tokens than the limit, for each (spec_id, limit, overlap) of ``specs``.

    Columns: spec_id, doc_id, piece_no (from 0), token_start, token_end, n_tokens,
    cut (the level of the boundary at the end; the end of the text is a paragraph's)
    and text. Pieces come in order, the first starts at token 0, the last ends at the
    last token, and each other starts ``overlap`` tokens before the end of the one
    before. A start may lie inside a character, whose rest is then U+FFFD in ``text``;
    the token positions are exact. Null, empty and short texts have no rows. The
    overlap must be less than the limit.
    """
    for _, limit, overlap in specs:
        if not 0 <= overlap < limit:
            raise ValueError("the overlap must be at least 0 and less than the limit")
    if not specs:
        return df.sparkSession.createDataFrame([], SCHEMA)
    path = path or tokenizer_path()
    blocks = cut_lineage(word_blocks(df, key, text, block_chars))
    return join_back(blocks, path, _split(specs, path), SCHEMA)
