"""p4: round trips through wrong encodings, quoted garbling, rare letters, and edge tables."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from pagemill.llm import mojibake as mj

CLEAN = [
    "Die Brückenwache zählte die Hälfte der Webstühle für etwa 90 Taler. Größere Äpfel über dem Tor.",
    "La coopérative a réparé l’horloge; le musée préfère été, crème et façade – à l’étiage.",
    "El comité olvidó la compañía de aguas; el guardián contó los medidores. Año nuevo.",
    "The café’s “long wall” isn’t new; the naïve décor – a crème-coloured façade.",
    "Старый мельник описывает расписание паромов. Учёный картограф считает колокола до первых морозов.",
    "古い水車小屋は静かな朝に銅の計器を数えた。印刷所は検査のすぐ後で梨の箱を調べた。",
]


@pytest.fixture(scope="module")
def table():
    counted = pa.Table.from_batches(mj._count_batches(iter([pa.record_batch([pa.array(CLEAN * 50)], names=["t"])])))
    return mj.table_of(counted, 50 * len(CLEAN))


@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251"])
@pytest.mark.parametrize("text", CLEAN[:4])
def test_utf8_read_as_another(table, text, wrong):
    garbled = text.encode().decode("latin-1" if wrong == "cp1252" else wrong, "replace")
    if "�" not in garbled:
        assert mj.repair(garbled, table) == (True, text)


@pytest.mark.parametrize(("text", "right", "wrong"), [(CLEAN[0], "mac_roman", "cp1252"), (CLEAN[1], "cp1252", "mac_roman"), (CLEAN[4], "cp1251", "cp1252"), (CLEAN[4], "koi8_r", "cp1251"), (CLEAN[3], "cp1252", "latin-1")])
def test_narrow_encodings(table, text, right, wrong):
    assert mj.repair(text.encode(right).decode(wrong), table) == (True, text)


def test_partly_twice_and_lossy(table):
    assert mj.repair("The cafÃ© and the façade.", table) == (True, "The café and the façade.")
    twice = "für".encode().decode("latin-1").encode().decode("latin-1")
    assert mj.repair(f"Der Prüfer zahlt {twice} alle.", table) == (True, "Der Prüfer zahlt für alle.")
    assert mj.repair("The caf� on the quay", table) == (True, None)
    assert mj.repair("z&Atilde;&curren;hlte", table) == (True, "zählte")


@pytest.mark.parametrize("text", [*CLEAN, "", "plain", "“dÃ©cor” is what décor looks like after a wrong conversion", "The word café turned into “caf√©” because", "SÃO PAULO: NÃO ABRE À NOITE, SÓ ATÉ ÀS 9 H.", "−18 °C ± 2 °C; price £3 · ©Œ®", "Ærø, Århus, Łódka and Åre are places", "A £5 note", "А closer look", "«СССР»"])
def test_rightly_decoded(table, text):
    assert mj.repair(text, table) == (False, None)


def test_long_lost_word_is_quick(table):
    assert mj.repair("“" + "ã�®é��" * 2000 + "” and more", table) == (True, None)


@given(st.text(max_size=80))
def test_never_fails(text):
    mj.repair(text.encode("utf-8", "replace").decode(), mj.table_of(pa.table({"kind": pa.array([], pa.int32()), "key": pa.array([], pa.int64()), "n": pa.array([], pa.int64())}), 0))


def test_counts_are_exact(spark):
    """Pairs, characters and texts against brute force; ASCII texts count, copies count once."""
    texts = [*CLEAN, CLEAN[0], "plain text", "plain text", "été"]
    t = mj.pair_table(spark.createDataFrame([(x,) for x in [*texts, None, ""]], "text string").where("text <> ''"))
    distinct = set(texts)
    pairs = [{(f" {x} "[i], f" {x} "[i + 1]) for i in range(len(x) + 1)} for x in distinct]
    assert t.texts == len(distinct) and t.total == sum(map(len, pairs))
    for a, b in set().union(*pairs):
        if not (a + b).isascii():
            assert t.counts(mj._points(a + b))[0] == sum((a, b) in p for p in pairs)
    assert t.knows("e") and not t.knows("ß") and t.knows_word("façade") and not t.knows_word("zählt")


def test_context_and_quotation_have_no_limit(table):
    """A restored word is looked up whole however long it is, and a quoted one may be of any length."""
    long = "ä" * 70 + "z"
    assert mj.repair(f"“{long.encode().decode('latin-1')}” is what {long} became", table) == (False, None)


def test_segments():
    assert mj.segments(np.array([1.0, -2, 3, -1, 3, -9, 2])) == [(0, 1), (2, 5), (6, 7)]
    assert mj.segments(np.array([-1.0])) == []


def test_tables(spark):
    rows = [("a", i, t, "x") for i, t in enumerate(CLEAN * 20)] + [("a", 900, "cafÃ©", "x"), ("a", 900, "cafÃ©", "x"), ("a", 901, None, "x"), ("a", 902, "", "x"), ("a", None, "cafÃ©", "x"), ("b", 900, "x" * 90_000 + " cafÃ©", "x")]
    df = spark.createDataFrame(rows, "field_name string, rec_id long, text string, restored string")
    got = {(r.field_name, r.rec_id, r.restored) for r in mj.garbled(df).collect()}
    assert got == {("a", 900, "café"), ("a", None, "café"), ("b", 900, "x" * 90_000 + " café")}
    assert mj.garbled(df.limit(0)).count() == 0


@pytest.mark.parametrize(("text", "right", "wrong"), [(CLEAN[4], "koi8_r", "cp1251"), (CLEAN[0], "mac_roman", "cp1252")])
def test_copies_prove_nothing(spark, text, right, wrong):
    """A garbled text that a third of the rows hold, and one that repeats itself, are found all the same."""
    bad = text.encode(right).decode(wrong)
    rows = [(i, f"{t} {i}") for i, t in enumerate(CLEAN * 40)]
    df = spark.createDataFrame([("a", i, t) for i, t in rows + [(1000 + i, bad) for i in range(120)]], "field_name string, rec_id long, text string")
    got = {(r.rec_id, r.restored) for r in mj.garbled(df).collect()}
    assert got == {(1000 + i, text) for i in range(120)}
    long = spark.createDataFrame([("a", i, t) for i, t in [*rows, (1000, " ".join([bad] * 60))]], "field_name string, rec_id long, text string")
    assert {(r.rec_id, r.restored) for r in mj.garbled(long).collect()} == {(1000, " ".join([text] * 60))}
