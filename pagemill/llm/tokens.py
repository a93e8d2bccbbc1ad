"""Encoding of a corpus with a public tokenizer through a distinct-word table.

A *word* is a run of white space and the run of other characters after it. The
vocabulary's own pre-tokenizer always breaks before a run of white space that
follows another character, so the ids of a text are those of its words, one after
the other, and each distinct word needs to be encoded only once:

1. ``word_blocks`` splits texts into words. Texts go into blocks of bounded
   length; a block keeps its distinct words and the position of each of them in
   its texts.
2. ``encode_words`` brings equal words together and encodes each of them once,
   which is the table of distinct words, kept with the places of each word.
3. ``join_back`` joins the ids to the blocks and puts them together by position,
   one block at a time.

The two shuffles carry distinct words per block, never one row per token. A word
occurs once in a block at most, and a block is bounded (a longer text is a block of
its own); where there are so many blocks that a common word would still be a hot key,
the blocks are cut into slices and a word is encoded once for each slice. The number of
partitions follows the number of blocks, so that no task grows with the corpus.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.session import cut_lineage

#: Characters after which a block of texts is closed.
BLOCK_CHARS = 4_000_000

#: Blocks of one task while that makes no more tasks than this, else the most blocks of one task; blocks that share one table of distinct words.
TASK_BLOCKS, TASKS, MOST_TASK_BLOCKS, SLICE_BLOCKS = 4, 4096, 64, 100_000

#: Fixed value: Unicode's White_Space, which the pre-tokenizer's ``\s`` stands for.
SPACE = "\\t\\n\\v\\f\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORD = f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+"

BLOCKS = "block long, keys array<long>, lengths binary, codes binary, words array<string>"


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """The vocabulary file: in the folder that PAGEMILL_TOKENIZERS names, else of the installed package."""
    folder = os.environ.get("PAGEMILL_TOKENIZERS", "/opt/tokenizers")
    return os.path.join(folder, name)


def load_ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


#: Fixed value: the pre-tokenization pattern of the public byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encoders: dict[str, object] = {}


def encoder(path: str):
    """The encoder of a rank file, one for each worker process."""
    if path not in _encoders:
        import tiktoken

        _encoders[path] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
    return _encoders[path]


_sizes: dict[str, np.ndarray] = {}


def piece_sizes(path: str) -> np.ndarray:
    """The bytes of each id's piece, one array for each worker process."""
    if path not in _sizes:
        ranks = load_ranks(path)
        _sizes[path] = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
        for piece, i in ranks.items():
            _sizes[path][i] = len(piece)
    return _sizes[path]


def squeeze(codes: np.ndarray) -> bytes:
    """32-bit integers as compressed byte planes, which for word codes are a third as long."""
    planes = np.ascontiguousarray(codes.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return len(codes).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unsqueeze(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 4 * n, "zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


class _Codes(dict):
    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        return code


def _block(keys: list, texts: list[str], find: Callable[[str], list[str]]) -> pa.RecordBatch:
    codes = _Codes()
    at = codes.__getitem__
    parts = [np.fromiter(map(at, words), np.int32, len(words)) for words in map(find, texts)]
    lengths = np.fromiter(map(len, parts), np.int32, len(parts))
    flat = np.concatenate(parts) if parts else np.empty(0, np.int32)
    digest = hashlib.blake2b(repr(keys).encode(), digest_size=8)
    digest.update(flat.tobytes())
    digest.update("".join(codes).encode("utf-8", "surrogatepass"))
    name = int.from_bytes(digest.digest(), "little", signed=True)
    return pa.RecordBatch.from_arrays(
        [pa.array([name], pa.int64()), pa.array([keys], pa.list_(pa.int64())), pa.array([lengths.tobytes()], pa.binary()), pa.array([squeeze(flat)], pa.binary()), pa.array([list(codes)], pa.list_(pa.string()))],
        names=["block", "keys", "lengths", "codes", "words"],
    )


def _to_blocks(block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        find = re.compile(WORD).findall
        keys: list = []
        texts: list[str] = []
        size = 0
        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if keys and size + len(t) > block_chars:
                    yield _block(keys, texts, find)
                    keys, texts, size = [], [], 0
                keys.append(k)
                texts.append(t)
                size += len(t)
        if keys:
            yield _block(keys, texts, find)

    return run


def word_blocks(df: DataFrame, key: Column, text: Column, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of the texts of ``df``: null texts count as empty; ``key`` is a long that names a text."""
    rows = df.select(key.cast("long").alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    return rows.mapInArrow(_to_blocks(block_chars), BLOCKS)


def id_type(path: str) -> np.dtype:
    """The narrowest unsigned type that holds every id of the vocabulary."""
    return np.dtype(np.uint16 if len(piece_sizes(path)) <= 1 << 16 else np.uint32)


def _encode_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind = encoder(path).encode_ordinary, id_type(path)
        last, packed = None, b""
        for b in batches:
            out = []
            for w in b.column(2).to_pylist():
                if w != last:
                    last, packed = w, np.asarray(encode(w), kind).tobytes()
                out.append(packed)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["of_block", "pos", "ids"])

    return run


def partitions(blocks: DataFrame) -> tuple[int, int]:
    """(partitions, slices) for the blocks of a stored table, which are counted."""
    n = blocks.count()
    return max(blocks.sparkSession.sparkContext.defaultParallelism, min(-(-n // TASK_BLOCKS), TASKS), -(-n // MOST_TASK_BLOCKS)), 1 + n // SLICE_BLOCKS


def encode_words(blocks: DataFrame, path: str, parts: int | None = None, slices: int = 1) -> DataFrame:
    """The distinct words of all blocks with their places: (of_block, pos, ids), ids packed.

    Equal words come together by one shuffle and a sort, and each is encoded once (for each slice of the blocks).
    """
    words = blocks.select("block", F.posexplode("words").alias("pos", "word"))
    by = ["word"] if slices == 1 else ["word", F.pmod("block", F.lit(slices))]
    return (words.repartition(parts, *by) if parts else words.repartition(*by)).sortWithinPartitions("word").mapInArrow(_encode_batches(path), "of_block long, pos int, ids binary")


class BlockIds:
    """The ids of a block's texts: ``ids`` is flat, text ``i`` has ``ids[ends[i - 1]:ends[i]]``."""

    def __init__(self, block: dict, pos: np.ndarray, packed: pa.Array, kind: np.dtype):
        offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1] // kind.itemsize
        self._pool = np.frombuffer(packed.buffers()[2] or b"", kind, offsets[-1]) if len(packed) else np.empty(0, kind)
        size = int(pos.max(initial=-1)) + 1
        start, count = np.zeros(size, np.int64), np.zeros(size, np.int64)
        start[pos], count[pos] = offsets[:-1], np.diff(offsets)
        self.keys = block["keys"]
        self.codes = unsqueeze(block["codes"])
        self.lengths = np.frombuffer(block["lengths"], np.int32)
        self._n = count[self.codes]
        self._start = start
        self._upto = np.concatenate(([0], np.cumsum(self._n)))
        self.ends = self._upto[np.cumsum(self.lengths)]

    @property
    def ids(self) -> np.ndarray:
        return self._pool[np.repeat(self._start[self.codes] - self._upto[:-1], self._n) + np.arange(self._upto[-1])]


def join_back(blocks: DataFrame, path: str, finish: Callable[[BlockIds], pa.Table], schema: str) -> DataFrame:
    """``finish`` of each block with its ids; ``blocks`` should be a stored table, as it is read three times."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        # Blocks of one name have the same words in the same places, so they share the ids.
        packed = right.column("ids").combine_chunks()
        packed = packed.chunk(0) if isinstance(packed, pa.ChunkedArray) else packed
        pos = right.column("pos").to_numpy()
        return pa.concat_tables(finish(BlockIds(r, pos, packed, id_type(path))) for r in left.to_pylist())

    parts, slices = partitions(blocks)
    left = blocks.drop("words").repartition(parts, "block")
    right = encode_words(blocks, path, parts, slices).repartition(parts, "of_block")
    return left.groupBy("block").cogroup(right.groupBy("of_block")).applyInArrow(run, schema)


def _ids_table(b: BlockIds) -> pa.Table:
    offsets = np.concatenate(([0], b.ends)).astype(np.int32)
    return pa.table({"key": pa.array(b.keys, pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(b.ids.astype(np.int32)))})


def _count_table(b: BlockIds) -> pa.Table:
    return pa.table({"key": pa.array(b.keys, pa.int64()), "n_tokens": pa.array(np.diff(b.ends, prepend=0), pa.int64())})


def encode_corpus(df: DataFrame, key: Column, text: Column, path: str | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``key`` and ``ids`` (array of int) for every row of ``df``.

    Null and empty texts have an empty list. Special tokens' strings are ordinary
    text. Repeated rows give repeated rows. An empty table gives an empty table.
    """
    blocks = cut_lineage(word_blocks(df, key, text, block_chars))
    return join_back(blocks, path or tokenizer_path(), _ids_table, "key long, ids array<int>")


def count_tokens(df: DataFrame, key: Column, text: Column, path: str | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``key`` and ``n_tokens`` for every row of ``df``, without making the ids; null and empty texts have 0."""
    blocks = cut_lineage(word_blocks(df, key, text, block_chars))
    return join_back(blocks, path or tokenizer_path(), _count_table, "key long, n_tokens long")


_pieces: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def pieces_of(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The id-to-piece table: all pieces' bytes one after the other, and where each id's piece ends; one for each worker process."""
    if path not in _pieces:
        by_id = dict(sorted((i, p) for p, i in load_ranks(path).items()))
        size = max(by_id, default=-1) + 1
        ends = np.cumsum([len(by_id.get(i, b"")) for i in range(size)], dtype=np.int64)
        _pieces[path] = np.frombuffer(b"".join(by_id.values()), np.uint8), ends
    return _pieces[path]


def bytes_of(ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of ``ids`` joined by position: their bytes one after the other, and where each ends. Ids outside the vocabulary have none."""
    pool, upto = pieces_of(path)
    if len(upto) == 0 or len(ids) == 0:
        return np.empty(0, np.uint8), np.zeros(len(ids), np.int64)
    known = (ids >= 0) & (ids < len(upto))
    at = np.where(known, ids, 0).astype(np.int64)
    starts = np.where(at > 0, upto[at - 1], 0)
    sizes = np.where(known, upto[at] - starts, 0)
    ends = np.cumsum(sizes)
    return pool[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])], ends


def decode_corpus(df: DataFrame, key: str = "key", ids: str = "ids", path: str | None = None) -> DataFrame:
    """``key`` and ``text`` of encoded rows, through the join of each position's id with the table of pieces.

    The table has a row for each id of the vocabulary, whatever the corpus, so every task
    holds it and a batch's positions are joined to it at once; no row is shuffled, and
    repeated keys keep their rows apart. Bytes that aren't UTF-8 come out as U+FFFD; an
    empty list gives an empty text, a null list a null text. Ids outside the vocabulary
    and null ids are left out.
    """
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            offsets = lists.offsets.to_numpy()
            flat = lists.values.fill_null(-1).to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
            data, ends = bytes_of(flat, path)
            cut = np.concatenate(([0], ends))[offsets - offsets[0]]
            whole, none = data.tobytes(), lists.is_null().to_pylist()
            texts = [None if no else whole[x:y].decode("utf-8", "replace") for x, y, no in zip(cut[:-1], cut[1:], none)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["key", "text"])

    rows = df.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, f"key {dict(df.dtypes)[key]}, text string")
