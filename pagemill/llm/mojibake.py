"""Finding and restoring text that was decoded with the wrong character encoding.

1. ``pair_table`` counts in how many distinct texts each adjacent character pair, character
   and word stands, exactly and over all texts, apart from those in which some run already
   proves to be bytes of another encoding. Neither copies nor repetition within a text make
   a pair probable. What stands in less than a fixed share of the texts counts as unseen, so
   that at most (pairs of a mean text) / share pairs are kept, whatever the corpus.
2. Each pair is scored by its mutual information, discounted where the corpus has
   few of it. Maximum-scoring segments of the negative score are the improbable runs;
   lost characters (U+FFFD) and control characters are improbable beside anything.
3. Only inside those runs the inverse mappings are tried: the run is encoded as the
   wrong encoding and decoded as the right one. Several bytes that form valid
   multi-byte characters prove the mapping; a mapping between single-byte encodings
   must turn improbable pairs into frequent ones.

A garbled word in quotation marks whose restored form stands elsewhere in the same
text is quoted, not garbled. U+FFFD marks text of which something was lost.
"""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.session import stored

#: Share of the texts under which a pair's own count is not trusted.
RARE = 0.002
#: Shares of the texts (and the fewest texts) from which a pair, and a character or word, is seen at all.
SEEN_PAIR, SEEN, SEEN_LEAST = RARE / 40, 1e-5, 2
#: Score of a pair that the corpus says nothing about.
UNKNOWN = 3.0
#: Least mean gain (natural logarithm of frequencies) of a single-byte mapping.
GAIN = 2.0

# Encodings that text is wrongly read as, and those that it may have been written in.
NARROW = ("cp1252", "mac_roman", "cp437", "cp850", "cp1251", "koi8_r", "cp1250", "cp866", "iso8859_15")
WIDE = ("gbk", "cp932", "big5", "euc_kr", "euc_jp")
CYRILLIC = ("cp1251", "koi8_r", "cp866")
RIGHT = {
    "cp1252": ("cp1252", "mac_roman", "cp437", "cp850", "cp1251", "koi8_r", "cp866", "cp932", "euc_jp", "gbk", "cp1250"),
    "mac_roman": ("cp1252", "cp437", "cp850", "cp1251", "cp932", "euc_jp", "gbk"),
    "cp437": ("cp1252", "mac_roman", "cp932", "euc_jp", "gbk"), "cp850": ("cp1252", "mac_roman", "cp932", "euc_jp", "gbk"), "cp1250": ("cp1252", "mac_roman", "cp1251"), "iso8859_15": ("mac_roman", "cp850"),
    "cp1251": ("cp1252", "koi8_r", "cp866", "mac_roman"), "koi8_r": ("cp1251", "cp866", "cp1252"), "cp866": ("cp1251", "koi8_r"),
}

_ODD = re.compile(r"[^\x00-\x7f]+")
_ODD_CHAR = re.compile(r"[^\x00-\x7f]")
_ENTITY = re.compile(r"&#?\w{1,31};")
_IDEOGRAPHS = re.compile("[\u2e80-\ud7ff\uf900-\ufaff\uff00-\uffef]+")
_LOST = re.compile("\ufffd+")
_C1 = re.compile("[\x80-\x9f]")
#: Characters that restored text may have whatever the corpus' statistics: the others prove nothing.
_COMMON = re.compile("[\x00-\u024f\u0400-\u045f\u2000-\u22ff\u3000-\u9fff\uac00-\ud7ff\uff00-\uffef\U0001f000-\U0001faff]")
#: UTF-8's multi-byte characters, as bytes of one character each.
_SEQUENCES = re.compile("(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})+")


@lru_cache(maxsize=None)
def _to_latin1(encoding: str) -> dict[int, str]:
    """Translation of an encoding's characters to those of the same byte in Latin-1.

    Bytes that the encoding leaves open are control characters of the same number;
    other characters beyond ASCII become U+0100, which is no byte.
    """
    table: dict[int, str] = {}
    for b in range(128, 256):
        c = bytes([b]).decode(encoding, "ignore")
        table.setdefault(ord(c or chr(b)), chr(b))
    if encoding == "cp1252":
        for b in range(128, 160):
            table.setdefault(b, chr(b))
    for b in range(128, 256):
        table.setdefault(b, "\u0100")
    return table


def _as_latin1(text: str, encoding: str) -> str:
    return text.translate(_to_latin1(encoding))


def encode_as(text: str, encoding: str) -> bytes | None:
    try:
        return text.encode(encoding) if encoding in WIDE else _as_latin1(text, encoding).encode("latin-1")
    except UnicodeEncodeError:
        return None


def _sane(text: str) -> bool:
    return not any(c == "\ufffd" or "\x80" <= c < "\xa0" or (c < " " and c not in "\t\n\r") or "\ue000" <= c <= "\uf8ff" for c in text)


def _is_cyrillic(c: str) -> bool:
    return "\u0400" <= c <= "\u052f"


@lru_cache(maxsize=200_000)
def _unwrap(sequence: str, wrong: str) -> str | None:
    """UTF-8 bytes, given as characters of Latin-1, as text; what was read wrongly several times is undone each time."""
    text = None
    for _ in range(4):
        try:
            inner = sequence.encode("latin-1").decode("utf-8")
        except UnicodeError:
            break
        if text is not None and not all(_COMMON.match(c) for c in inner):
            break
        text = inner
        sequence = _as_latin1(text, wrong)
        if not _SEQUENCES.fullmatch(sequence):
            break
    return text if text is not None and _sane(text) else None


def utf8_parts(text: str, known=None) -> list[tuple[int, int, str]]:
    """The parts of ``text`` that are UTF-8 read as another encoding, restored, in order and apart from each other.

    ``known`` tells whether a character occurs in the corpus: characters of two
    bytes, and all that come out of a wide encoding, must.
    """
    best: list[tuple[int, int, str]] = []
    covered = 0
    for wrong in NARROW:
        parts = []
        for m in _SEQUENCES.finditer(_as_latin1(text, wrong)):
            fixed = _unwrap(m[0], wrong)
            a, b = m.span()
            if fixed is None or fixed == text[a:b]:
                continue
            if wrong in CYRILLIC and len(fixed) == 1 and (a > 0 and _is_cyrillic(text[a - 1]) or b < len(text) and _is_cyrillic(text[b])):
                continue
            if not all(_COMMON.match(c) and (known is None or c >= "\u0800" and wrong not in CYRILLIC or known(c)) for c in fixed):
                continue
            parts.append((a, b, fixed))
        if (n := sum(b - a for a, b, _ in parts)) > covered:
            best, covered = parts, n
    if not best and known is not None:
        for m in _IDEOGRAPHS.finditer(text):
            beside = text[max(0, m.start() - 1) : m.start()] + text[m.end() : m.end() + 1]
            if len(m[0]) == 1 and not any(c.isascii() and c.isalpha() for c in beside):
                continue
            for wrong in WIDE:
                data = encode_as(m[0], wrong)
                try:
                    fixed = data.decode("utf-8") if data else ""
                except UnicodeDecodeError:
                    continue
                if fixed and _sane(fixed) and all(c < "\x80" or known(c) for c in fixed):
                    best.append((m.start(), m.end(), fixed))
                    break
    return best


def suspicious(text: str) -> bool:
    """Whether some part of the text may be bytes of UTF-8 read as something else, or has lost characters."""
    if "\ufffd" in text or _C1.search(text):
        return True
    runs = "\n".join(r for r in _ODD.findall(text) if len(r) > 1)
    return bool(runs) and bool(utf8_parts(runs))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _codes(p: np.ndarray) -> np.ndarray:
    """Each adjacent pair as one number."""
    return (p[:-1].astype(np.int64) << 21) | p[1:].astype(np.int64)


def plain_text(text: str) -> str:
    """Character references resolved, as text that was escaped after it was garbled hides the garbling."""
    return html.unescape(text) if "&" in text and _ENTITY.search(text) else text


_WORDS = re.compile(r"[^\W\d_]+(?:[’'\-][^\W\d_]+)*")


def word_key(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.casefold().encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


#: Kinds of what is counted.
PAIR, CHAR, WORD, TEXT = range(4)
#: Counted items after which a task hands on what it has.
FLUSH = 4_000_000


def _counted(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["kind", "key", "n"])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chars, texts, held = np.zeros(0x110000, np.int64), 0, 0
    pairs: list[np.ndarray] = []
    words: dict[str, int] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal held
        if pairs:
            yield _counted(PAIR, *np.unique(np.concatenate(pairs), return_counts=True))
        if words:
            yield _counted(WORD, np.array([word_key(w) for w in words], np.int64), np.array(list(words.values()), np.int64))
        pairs.clear()
        words.clear()
        held = 0

    for b in batches:
        for t in b.column(0).to_pylist():
            t = plain_text(t)
            if t.isascii():
                p = np.frombuffer(f" {t} ".encode(), np.uint8).astype(np.int32)
                present = np.zeros(1 << 14, bool)
                present[p[:-1] << 7 | p[1:]] = True
                chars[:128] += np.bincount(np.flatnonzero(present) >> 7, minlength=128)
                texts += 1
                continue
            if suspicious(t):
                continue
            texts += 1
            both = np.unique(_codes(_points(f" {t} ")))
            first = both >> 21
            np.add.at(chars, first, 1)
            pairs.append(both[(first > 127) | ((both & 0x1FFFFF) > 127)])
            held += len(pairs[-1])
            for w in set(_WORDS.findall(t)):
                if not w.isascii():
                    words[w] = words.get(w, 0) + 1
            if held + len(words) > FLUSH:
                yield from flush()
    yield from flush()
    at = np.flatnonzero(chars)
    yield _counted(CHAR, at, chars[at])
    yield _counted(TEXT, np.zeros(1), np.array([texts]))


class PairTable:
    """In how many texts pairs (with a character beyond ASCII) and words stand, and in how many pairs of texts a
    character stands first; pairs, characters and words as sorted numbers, those of pairs and characters with counts."""

    def __init__(self, pairs: np.ndarray, pair_counts: np.ndarray, chars: np.ndarray, char_counts: np.ndarray, words: np.ndarray, texts: int, total: int):
        self.pairs, self.pair_counts, self.words, self.texts, self.total = pairs, pair_counts, words, max(1, texts), max(1, total)
        self.chars, self.char_counts = chars, char_counts
        self.firsts = np.zeros(0x110000, np.int64)
        self.firsts[chars] = char_counts
        self.trust = max(2.0, RARE * self.texts)
        self.seen = max(SEEN_LEAST, SEEN * self.texts)

    @staticmethod
    def _look_up(keys: np.ndarray, counts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if len(keys) == 0:
            return np.zeros(len(wanted), np.int64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, counts[at], 0)

    def counts(self, p: np.ndarray) -> np.ndarray:
        """The texts of each adjacent pair; 0 within ASCII, which isn't counted."""
        out = np.zeros(max(0, len(p) - 1), np.int64)
        odd = np.flatnonzero((p[:-1] > 127) | (p[1:] > 127))
        out[odd] = self._look_up(self.pairs, self.pair_counts, (p[odd].astype(np.int64) << 21) | p[odd + 1].astype(np.int64))
        return out

    def knows(self, c: str) -> bool:
        return self.firsts[ord(c)] >= self.seen

    def knows_word(self, word: str) -> bool:
        key = word_key(word)
        at = int(np.searchsorted(self.words, key))
        return at < len(self.words) and int(self.words[at]) == key

    def improbability(self, p: np.ndarray) -> np.ndarray:
        """The negative discounted mutual information of each adjacent pair; pairs within ASCII and
        pairs that many texts have count as probable at least slightly, lost and control characters never."""
        n = self.counts(p).astype(np.float64)
        c = self.firsts[p] + 1.0
        mutual = np.log((n + 0.01) * self.total / (c[:-1] * c[1:]))
        share = n / (n + self.trust)
        score = share * -np.clip(mutual, -UNKNOWN, UNKNOWN) + (1 - share) * UNKNOWN
        score[n >= self.trust] = np.minimum(score[n >= self.trust], -0.5)
        score[(p[:-1] < 128) & (p[1:] < 128)] = -0.7
        broken = (p == 0xFFFD) | ((p >= 0x80) & (p < 0xA0))
        score[broken[:-1] | broken[1:]] = UNKNOWN
        return score


def segments(score: np.ndarray) -> list[tuple[int, int]]:
    """All maximal scoring segments [start, end) with a positive sum, by the linear-time method of Ruzzo and Tompa."""
    stack: list[list[float]] = []  # start, end, sum before, sum after
    total = 0.0
    for i, s in enumerate(score.tolist()):
        if s <= 0:
            total += s
            continue
        new = [i, i + 1, total, total + s]
        total += s
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j -= 1
            if j < 0 or stack[j][3] >= new[3]:
                break
            new = [stack[j][0], new[1], stack[j][2], new[3]]
            del stack[j:]
        stack.append(new)
    return [(int(a), int(b)) for a, b, _, _ in stack]


def _log_counts(table: PairTable, text: str) -> np.ndarray:
    q = _points(text)
    odd = (q[1:] > 127) | (q[:-1] > 127)
    return np.log(table.counts(q)[odd] + 0.05)


def _narrow_inverse(table: PairTable, text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """The runs read anew under the one mapping between other encodings that makes them most probable, or [].

    All runs of a text must share the mapping: it has to turn four fifths of their
    characters beyond ASCII into text that the corpus knows, pair by pair, and every
    changed word of an alphabet with spaces into a known word.
    """
    best, best_gain = [], GAIN
    extents = [(a + m.start(), a + m.end()) for a, b in runs if (m := re.search(r"[^\x00-\x7f](?:.*[^\x00-\x7f])?", text[a:b], re.S))]
    odd = sum(len(_ODD_CHAR.findall(text, a, b)) for a, b in extents)
    if not extents or odd == 1 and not _telling(text, *extents[0]):
        return []
    before = [_log_counts(table, text[a - 1 : b + 1]).mean() for a, b in extents]
    for wrong in NARROW:
        encoded = [encode_as(text[a:b], wrong) for a, b in extents]
        if sum(e is not None for e in encoded) < 0.8 * len(encoded):
            continue
        for right in RIGHT[wrong]:
            if right == wrong and not _C1.search(text):
                continue
            done, improved, gains = [], 0, []
            for (a, b), data, was in zip(extents, encoded, before):
                fixed, end = _decode(data, right, text, b, wrong)
                if fixed is None or fixed == text[a:end] or not _sane(fixed):
                    continue
                after = _log_counts(table, text[a - 1] + fixed + text[end])
                if odd == 1 and not (fixed.isalpha() or fixed in "–—’‘“”…"):
                    continue
                if len(after) == 0 or after.min() < math.log(max(1.0, table.trust / 40)) - 0.05:
                    continue
                if not _words_known(table, text, a, end, fixed):
                    continue
                done.append((a, end, fixed))
                gains.append(float(after.mean() - was))
                improved += len(_ODD_CHAR.findall(text, a, b))
            if done and improved >= 0.8 * odd and (g := sum(gains) / len(gains)) > best_gain:
                best, best_gain = done, g
    return best


def _telling(text: str, a: int, b: int) -> bool:
    """Whether a lone character may show a wrong reading: one within a word, or a letter between spaces that is no word of Cyrillic or Greek look."""
    beside = text[a - 1] + text[b]
    return any(c.isascii() and c.isalpha() for c in beside) and not _is_cyrillic(text[a]) or text[a] < "\u0370"


def _decode(data: bytes | None, right: str, text: str, end: int, wrong: str) -> tuple[str | None, int]:
    """``data`` decoded; a wide encoding may need the ASCII character after the run as a second byte."""
    if data is None:
        return None, end
    try:
        return data.decode(right), end
    except UnicodeDecodeError:
        pass
    if right in WIDE and end < len(text) - 1 and text[end].isascii():
        try:
            return (data + text[end].encode()).decode(right), end + 1
        except UnicodeDecodeError:
            pass
    return None, end


def _in_word(c: str) -> bool:
    return c.isalpha() or c in "’'-"


def _words_known(table: PairTable, text: str, a: int, b: int, fixed: str) -> bool:
    """Whether every word that the restored run touches stands in the corpus."""
    lo, hi = a, b
    while lo > 0 and _in_word(text[lo - 1]):
        lo -= 1
    while hi < len(text) and _in_word(text[hi]):
        hi += 1
    new = text[lo:a] + fixed + text[b:hi]
    for m in _WORDS.finditer(new):
        w = m[0]
        if m.end() > a - lo and m.start() < a - lo + len(fixed) and not w.isascii() and w[0] < "\u2e80" and not table.knows_word(w):
            return False
    return True


_OPEN, _CLOSE = "“\"„«‘'‚「‹`", "”\"“»’'‘」›`"


def _word(text: str, a: int, b: int) -> tuple[int, int]:
    while a > 0 and not text[a - 1].isspace() and text[a - 1] not in _OPEN:
        a -= 1
    while b < len(text) and not text[b].isspace() and text[b] not in _CLOSE:
        b += 1
    return a, b


def _quoted(text: str, a: int, b: int, fixed: str | None) -> bool:
    """Whether the run [a, b) lies in quotation marks and its right form stands elsewhere in the text."""
    wa, wb = _word(text, a, b)
    if not (wa > 0 and text[wa - 1] in _OPEN and wb < len(text) and text[wb] in _CLOSE):
        return False
    rest = text[:wa] + " " + text[wb:]
    if fixed is not None:
        return (text[wa:a] + fixed + text[b:wb]).casefold() in rest.casefold()
    # of a lost word the ASCII parts must stand in one other word, in order, with something else between them
    shape = _ODD.sub("\x00", text[wa:wb]).casefold()
    return any(_ODD.sub("\x00", w).casefold() == shape for w in _QUOTABLE.findall(rest) if not w.isascii() and "\ufffd" not in w)


_QUOTABLE = re.compile(r"\w(?:[^\s.,;:!?“”„«»‘‚「」‹›\"()]*\w)?")


def repair(text: str, table: PairTable) -> tuple[bool, str | None]:
    """(whether the text is garbled in full or part, the restored text or None if something was lost)."""
    plain = plain_text(text)
    if plain.isascii():
        return False, None
    padded = f" {plain} "
    p = _points(padded)
    score = table.improbability(p)
    found: list[tuple[int, int, str | None]] = []
    lost: list[tuple[int, int, str | None]] = []
    controls: list[tuple[int, int, str | None]] = []
    rest: list[tuple[int, int]] = []
    if (score > 0).any():
        for a, b in segments(score):
            a, b = max(a, 1), min(b + 1, len(padded) - 1)
            run = padded[a:b]
            parts = utf8_parts(run, table.knows)
            found += [(a + s, a + e, fixed) for s, e, fixed in parts]
            lost += [(a + m.start(), a + m.end(), None) for m in _LOST.finditer(run)]
            if not parts and "\ufffd" not in run:
                rest.append((a, b))
                controls += [(a + m.start(), a + m.end(), None) for m in _C1.finditer(run)]
    quoted = [x for x in found + lost if _quoted(padded, *x)]
    if not found and not lost and rest:
        found = _narrow_inverse(table, padded, rest)
        if not found:
            lost += controls
    found = sorted(x for x in found if x not in quoted)
    lost = [x for x in lost if x not in quoted]
    if not found and not lost:
        return False, None
    if lost:
        return True, None
    for a, b, fixed in reversed(found):
        padded = padded[:a] + fixed + padded[b:]
    return True, padded[1:-1]


def _repair_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PairTable(*shared.value)
        for b in batches:
            done = [repair(t, table) for t in b.column(2).to_pylist()]
            keep = [i for i, (bad, _) in enumerate(done) if bad]
            part = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([done[i][1] for i in keep], pa.string())], names=["field_name", "rec_id", "restored"])

    return run


def suspects(rows: DataFrame) -> DataFrame:
    """The rows whose text has characters beyond ASCII or references to such; no others can be garbled."""
    return rows.where(F.col("text").rlike(r"[^\x00-\x7f]|&#?\w+;")).select("field_name", "rec_id", "text")


def pair_table(rows: DataFrame) -> PairTable:
    """The statistics over the distinct texts of ``rows``. To the driver come the pairs, characters and words
    that a share of the texts has, so their number is bounded by that share."""
    distinct = rows.select(F.xxhash64("text").alias("hash"), "text").dropDuplicates(["hash"])
    counted = stored(distinct.select("text").mapInArrow(_count_batches, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")))
    sums = {r.kind: r.n for r in counted.where(F.col("kind").isin(CHAR, TEXT)).groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    texts = sums.get(TEXT, 0)
    least = F.when(F.col("kind") == PAIR, max(1.0, SEEN_PAIR * texts)).when(F.col("kind") == WORD, max(float(SEEN_LEAST), SEEN * texts)).otherwise(0.0)
    seen = counted.where((F.col("kind") != TEXT) & (F.col("n") >= least)).toArrow()
    return table_of(seen, texts)


def table_of(counted: pa.Table, texts: int) -> PairTable:
    """The table of (kind, key, n), each key once."""
    kind, key, n = (counted.column(c).to_numpy() for c in ("kind", "key", "n"))
    order = np.argsort(key, kind="stable")
    kind, key, n = kind[order], key[order], n[order]
    of = lambda k: (key[kind == k], n[kind == k])
    return PairTable(*of(PAIR), *of(CHAR), of(WORD)[0], texts, int(n[kind == CHAR].sum()))


def garbled(rows: DataFrame) -> DataFrame:
    """(field_name, rec_id, restored) of the garbled texts of ``rows`` (field_name, rec_id, text).

    ``restored`` is null where something was lost. Repeated rows count once; null and
    empty texts are never garbled; an empty table gives an empty table.
    """
    t = pair_table(rows.where("text is not null and text <> ''"))
    shared = rows.sparkSession.sparkContext.broadcast((t.pairs, t.pair_counts, t.chars, t.char_counts, t.words, t.texts, t.total))
    return suspects(rows).mapInArrow(_repair_batches(shared), "field_name string, rec_id long, restored string").distinct()
