"""One consistent form for texts that look the same but differ in their characters.

Script-aware repair: characters that show nothing go, glyph widths, ligatures and
kinds of space and hyphen become one, and text is composed (NFC). A token whose
letters come from several scripts is then rewritten in its dominant script, if every
foreign letter has a look-alike there and the result occurs in the corpus as a token
of one script. Letter case, visible accents and raised digits stay.

The repaired form decides whether two texts look the same. Only what the repair leaves
open is compared letter by letter besides: tokens still of several scripts, as their
candidates occur nowhere, and tokens of one script all of whose letters are look-alikes,
as nothing in them shows their script. All other tokens stay as their form has them.

``look_members`` gives the classes of texts that look the same and their members;
``same_looking_pairs`` derives pairs of members from it.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.session import bounded_broadcast, size_of, stored

#: Bytes (as stored, compressed) up to which tables of forms, looks and candidates are broadcast.
LOOK_LIMIT = 1 << 20

# Letters of other scripts and the Latin letters they look like.
CYRILLIC = "аaеeоoрpсcхxуyіiјjѕsһhԁdԛqԝwүy" "АAВBЕEКKМMНHОOРPСCТTХXУYІIЅSЈJԚQԜWҮY"
GREEK = "αaοoνvρpϲcϳj" "ΑAΒBΕEΖZΗHΙIΚKΜMΝNΟOΡPΤTΥYΧXϹCͿJ"
TO_LATIN = {s[i]: s[i + 1] for s in (CYRILLIC, GREEK) for i in range(0, len(s), 2)}
FROM_LATIN = {"cyrillic": {CYRILLIC[i + 1]: CYRILLIC[i] for i in range(len(CYRILLIC) - 2, -1, -2)}, "greek": {GREEK[i + 1]: GREEK[i] for i in range(len(GREEK) - 2, -1, -2)}}

# Characters that show nothing, spaces, and hyphens of one look.
INVISIBLE = "­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ\U000e0000-\U000e0fff"
SPACES = "\\t\\n\\v\\f\\r\u0085   -     　"
HYPHENS = "‐‑﹣"
#: Compatibility forms that differ in width only, and ligatures.
WIDTHS = "ﬀ-ﬆ！-ﾟﾡ-￮"

_INVISIBLE, _SPACES, _HYPHENS, _WIDTHS = (re.compile(f"[{x}]") for x in (INVISIBLE, SPACES, HYPHENS, WIDTHS))
_TOKEN = re.compile(r"[^\W\d_]+")
#: A text that is its own form and its own key.
PLAIN = "^(?:[!-~](?:[ -~]*[!-~])?)?$"


@lru_cache(maxsize=100_000)
def script(letter: str) -> str:
    """latin, cyrillic, greek or other."""
    name = unicodedata.name(letter, "").split(" ", 1)[0]
    return {"LATIN": "latin", "CYRILLIC": "cyrillic", "GREEK": "greek", "KELVIN": "latin"}.get(name, "other")


def clean(text: str) -> str:
    """The text without what a reader can't see: first stage of the repair."""
    if text.isascii():
        return _SPACES.sub(" ", text).strip()
    text = _WIDTHS.sub(lambda m: unicodedata.normalize("NFKC", m[0]), _INVISIBLE.sub("", text))
    return unicodedata.normalize("NFC", _HYPHENS.sub("-", _SPACES.sub(" ", text))).strip()


def _swap(token: str, target: str) -> str | None:
    out = []
    for c in unicodedata.normalize("NFD", token):
        own = script(c) if c.isalpha() else target
        if own != target:
            latin = c if own == "latin" else TO_LATIN.get(c)
            c = latin if target == "latin" else FROM_LATIN.get(target, {}).get(latin)
            if c is None:
                return None
        out.append(c)
    return unicodedata.normalize("NFC", "".join(out))


def repairs(token: str) -> list[str]:
    """The token in each of its scripts that can take all its letters, dominant script first; [] if it isn't mixed."""
    counts: dict[str, int] = {}
    for c in unicodedata.normalize("NFD", token):
        if c.isalpha():
            counts[script(c)] = counts.get(script(c), 0) + 1
    if len(counts) < 2 or "other" in counts:
        return []
    order = sorted(counts, key=lambda s: (-counts[s], s != "latin", s))
    return [r for s in order if (r := _swap(token, s)) is not None]


def prototype(text: str) -> str:
    """Each letter as the Latin one it looks like: equal for texts that look the same."""
    if text.isascii():
        return text
    return unicodedata.normalize("NFC", "".join(TO_LATIN.get(c, c) for c in unicodedata.normalize("NFD", text)))


#: Letters of one script that look the same: each as the first of them.
TWINS = {c: FROM_LATIN[name][latin] for c, latin in TO_LATIN.items() for name in ("cyrillic", "greek") if latin in FROM_LATIN[name] and script(c) == name and FROM_LATIN[name][latin] != c}


@lru_cache(maxsize=200_000)
def _token_key(token: str) -> str:
    scripts, shared = set(), True
    for c in unicodedata.normalize("NFD", token):
        if c.isalpha():
            scripts.add(script(c))
            shared = shared and c in TO_LATIN
    if len(scripts) > 1 or shared and scripts:
        return prototype(token)
    return "".join(TWINS.get(c, c) for c in token)


def look_of(form: str) -> str:
    """The key of a repaired text: only open tokens and those of look-alikes as a whole are reduced to Latin letters."""
    if form.isascii():
        return form
    return unicodedata.normalize("NFC", _TOKEN.sub(lambda m: m[0] if m[0].isascii() else _token_key(m[0]), form))


def _clean_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(0)
        cleaned = [clean(t) for t in texts.to_pylist()]
        mixed = [list({t: None for t in _TOKEN.findall(c) if not t.isascii() and repairs(t)}) for c in cleaned]
        yield pa.RecordBatch.from_arrays([texts, pa.array(cleaned, pa.string()), pa.array(mixed, pa.list_(pa.string()))], names=["text", "cleaned", "mixed"])


def _candidate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(t, c, k) for t in b.column(0).to_pylist() for k, c in enumerate(repairs(t))]
        yield pa.RecordBatch.from_pylist([dict(zip(("token", "word", "rank"), r)) for r in rows], schema=pa.schema([("token", pa.string()), ("word", pa.string()), ("rank", pa.int32())]))


def _finish_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        forms, keys = [], []
        for c, swaps in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            if swaps:
                known = {s["token"]: s["word"] for s in swaps}
                c = _TOKEN.sub(lambda m: known.get(m[0], m[0]), c)
            forms.append(c)
            keys.append(look_of(c))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(forms, pa.string()), pa.array(keys, pa.string())], names=["text", "form", "look"])


def odd_forms(odd: DataFrame, plain: DataFrame) -> DataFrame:
    """(text, form, look) for each distinct text of ``odd``; ``plain`` has the other texts, which only add to the vocabulary.

    The vocabulary is scanned where it lies: the candidates of mixed tokens, few of all
    words, are broadcast into the scan if they are small, and what matches is made distinct.
    """
    cleaned = stored(odd.select("text").distinct().mapInArrow(_clean_batches, "text string, cleaned string, mixed array<string>"))
    words = lambda df, c: df.select(F.explode(F.regexp_extract_all(c, F.lit(r"(\p{L}[\p{L}\p{M}]*)"), 1)).alias("word"))
    tokens = cleaned.select(F.explode("mixed").alias("token")).distinct()
    candidates = stored(tokens.mapInArrow(_candidate_batches, "token string, word string, rank int"))
    wanted = candidates.select("word").distinct()
    vocabulary = words(plain, "text").unionByName(words(cleaned, "cleaned"))
    small = size_of(candidates) <= LOOK_LIMIT
    # a large set of candidates meets the distinct words, not each word of each text
    known = vocabulary.join(F.broadcast(wanted), "word", "left_semi").distinct() if small else vocabulary.distinct().join(wanted, "word", "left_semi")
    vouched = candidates.join(known, "word").groupBy("token").agg(F.min_by("word", "rank").alias("word"))
    swaps = cleaned.select("text", F.explode("mixed").alias("token")).join(vouched, "token").groupBy("text").agg(F.collect_list(F.struct("token", "word")).alias("swaps"))
    rest = cleaned.where("size(mixed) = 0").select("text", "cleaned", F.lit(None).cast("array<struct<token:string,word:string>>").alias("swaps"))
    repaired = cleaned.where("size(mixed) > 0").select("text", "cleaned").join(swaps, "text", "left").unionByName(rest)
    return repaired.mapInArrow(_finish_batches, "text string, form string, look string")


def _is_plain() -> "F.Column":
    return F.col("text").rlike(PLAIN)


def text_forms(texts: DataFrame) -> DataFrame:
    """(text, form, look) for each distinct non-null ``text`` of ``texts``.

    ``form`` is the repaired text, ``look`` the key under which texts that look the
    same are equal. Plain ASCII never leaves the JVM. Empty texts have an empty form,
    as have texts that show nothing; very long texts are treated whole.
    """
    known = texts.select("text").where("text is not null")
    plain = known.where(_is_plain())
    return odd_forms(known.where(~_is_plain()), plain).unionByName(plain.distinct().select("text", F.col("text").alias("form"), F.col("text").alias("look")))


def look_members(rows: DataFrame) -> DataFrame:
    """(field_name, look, rec_id, text) of the rows in classes of two or more texts of a field that look the same.

    A class is named by (field_name, look); its variants are its distinct texts, its
    members the records that hold them. ``rows`` has field_name, rec_id and text; rows
    with a null id or text are in no class, repeated rows may come repeated. Only texts
    that aren't plain are ever brought together row by row: of plain texts, the distinct
    ones are matched first, so that a label on every page is one row there.
    """
    rows = rows.where("rec_id is not null and text is not null").select("field_name", "rec_id", "text")
    plain, odd = rows.where(_is_plain()), rows.where(~_is_plain())
    forms = stored(odd_forms(odd, plain).select("text", "look"))
    members = stored(odd.join(bounded_broadcast(forms, LOOK_LIMIT), "text").select("field_name", "look", "rec_id", "text"))
    # a class needs a text that isn't plain, so plain rows matter only beside such a one
    looks = members.select("field_name", F.col("look").alias("text")).distinct()
    within = (lambda df: F.broadcast(df)) if size_of(members) <= LOOK_LIMIT else (lambda df: df)  # both tables are no larger than the members
    beside = stored(plain.select("field_name", "text").distinct().join(within(looks), ["field_name", "text"], "left_semi"))
    labelled = plain.join(bounded_broadcast(beside, LOOK_LIMIT), ["field_name", "text"], "left_semi").select("field_name", F.col("text").alias("look"), "rec_id", "text")
    every = members.unionByName(labelled)
    variants = members.select("field_name", "look", "text").unionByName(beside.select("field_name", F.col("text").alias("look"), "text"))
    several = variants.groupBy("field_name", "look").agg(F.min("text").alias("low"), F.max("text").alias("high")).where("low <> high").select("field_name", "look")
    return every.join(within(several), ["field_name", "look"], "left_semi")


def same_looking_pairs(rows: DataFrame) -> DataFrame:
    """(field_name, id_a, id_b), id_a < id_b, for unequal texts of one field that look the same.

    The members of ``look_members``, each with those of its class that hold another
    variant: equal copies are never set against each other, so a label on every page
    costs nothing. The rows are as many as the classes' pairs of records, by definition.
    """
    members = stored(look_members(rows).distinct())
    variants = members.select("field_name", "look", "text").distinct()
    two = variants.select("field_name", "look", F.col("text").alias("text_a")).join(variants.select("field_name", "look", F.col("text").alias("text_b")), ["field_name", "look"]).where("text_a < text_b")
    side = lambda x: members.select("field_name", F.col("text").alias(f"text_{x}"), F.col("rec_id").alias(f"rec_{x}"))
    pairs = two.join(side("a"), ["field_name", "text_a"]).join(side("b"), ["field_name", "text_b"]).where("rec_a <> rec_b")
    return pairs.select("field_name", F.least("rec_a", "rec_b").alias("id_a"), F.greatest("rec_a", "rec_b").alias("id_b")).distinct()
