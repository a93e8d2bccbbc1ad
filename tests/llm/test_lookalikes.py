"""p2: literal cases, vocabulary-bound repair, and pairs against a brute-force comparison."""

import itertools

import pytest
from hypothesis import given
from hypothesis import strategies as st

from pagemill.llm.lookalikes import PLAIN, clean, prototype, look_members, look_of, repairs, same_looking_pairs, text_forms


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("Why the old ledger", "Whу the оld lеdgеr", True),
        ("café", "café", True),
        ("café", "cafe", False),
        ("Ｆｉｌｅ　１２", "File 12", True),
        ("ﬁle", "file", True),
        ("re­paired​", "repaired", True),
        ("a b", "a b", True),
        ("long‑wall", "long-wall", True),
        ("a – b", "a - b", False),
        ("no. 12³", "no. 123", False),
        ("Title", "title", False),
        ("O0", "OO", False),
        ("l1", "ll", False),
        ("K", "K", True),
        ("パ", "パ", True),
        ("は", "ば", False),
        ("​", "", True),
        ("Расписание", "Paсписание", True),
    ],
)
def test_looks(a, b, same):
    assert (prototype(clean(a)) == prototype(clean(b))) is same


def test_repairs():
    assert repairs("museum") == [] and repairs("музей") == []
    assert repairs("оld")[0] == "old"
    assert repairs("pасписание") == ["расписание"]
    assert repairs("жold") == []


@given(st.text(st.characters(codec="ascii")))
def test_plain_is_its_own_form(t):
    import re

    if re.fullmatch(PLAIN, t):
        assert clean(t) == t == prototype(t)


def test_forms_need_the_vocabulary(spark):
    df = spark.createDataFrame([("the оld ledger",), ("old",), ("zwоrd here",), (None,), ("",), ("x" * 50_000 + "é",)], "text string")
    got = {r.text: (r.form, r.look) for r in text_forms(df).collect()}
    assert got["the оld ledger"] == ("the old ledger", "the old ledger")
    assert got["zwоrd here"] == ("zwоrd here", "zword here")  # occurs nowhere in one script
    assert got[""] == ("", "") and None not in got and len(got) == 5


def test_only_open_tokens_are_reduced():
    assert look_of("музей") == "музей" and look_of("Ложка") == "Ложка"  # one script, and it shows
    assert look_of("сор") == "cop" and look_of("А") == "A" and look_of("ΑΒ") == "AB"  # nothing shows the script
    assert look_of("музeй") == prototype("музeй")  # still of two scripts
    assert look_of("ү з").startswith("y ") and look_of("үз") == look_of("уз")


def test_repair_decides(spark):
    """A mixed token is equal to the word that vouches for it, in its own script; without the word it is open."""
    texts = ["музей", "музeй", "Расписание", "Paсписание", "жoрк", "жоpк"]
    got = {r.text: (r.form, r.look) for r in text_forms(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    assert got["музeй"] == ("музей", "музей") and got["Paсписание"] == ("Расписание", "Расписание")
    assert got["жoрк"][0] == "жoрк" and got["жoрк"][1] == got["жоpк"][1] == "жopк"


def test_classes(spark):
    rows = [("f", i, "Home") for i in range(300)] + [("f", 1000 + i, "Ноme") for i in range(300)] + [("f", 5000, "Away"), ("f", 5000, "Away"), ("g", 1, "Ноme")]
    got = look_members(spark.createDataFrame(rows, "field_name string, rec_id long, text string")).distinct().collect()
    assert len(got) == 600 and {(r.field_name, r.look) for r in got} == {("f", "Home")} and {r.text for r in got} == {"Home", "Ноme"}


def test_pairs(spark):
    texts = ["Home", "Home", "Ноme", "Home​", "", None, "​", "the оld", "the old", "plain", "ﬁle", "file", "file", "été", "été", "ete"]
    rows = [("page.title", i, t, "x") for i, t in enumerate(texts)] + [("link.text", i, t, "x") for i, t in enumerate(texts[:4])] + [("page.title", 0, "Home", "x"), ("page.title", None, "Home", "x")]
    df = spark.createDataFrame(rows, "field_name string, rec_id long, text string, look string")
    want = set()
    for (fa, ia, ta, _), (fb, ib, tb, _) in itertools.combinations([r for r in rows if r[1] is not None], 2):
        if fa == fb and ia != ib and None not in (ta, tb) and ta != tb and prototype(clean(ta)) == prototype(clean(tb)):
            want.add((fa, min(ia, ib), max(ia, ib)))
    got = [tuple(r) for r in same_looking_pairs(df).collect()]
    assert set(got) == want and len(got) == len(want)
    assert same_looking_pairs(df.limit(0)).count() == 0


def test_plans_agree(spark, monkeypatch):
    """Whether tables are broadcast or shuffled changes no row."""
    from pagemill.llm import lookalikes

    texts = ["Home", "Ноme", "Home​", "the оld", "the old", "музей", "музeй", "жoрк", "жоpк", "ﬁle", "file", "été", None, ""] * 3
    df = spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], "field_name string, rec_id long, text string")
    rows = lambda: sorted(map(tuple, same_looking_pairs(df).collect()))
    want = rows()
    monkeypatch.setattr(lookalikes, "LOOK_LIMIT", 0)
    assert rows() == want and len(want) > 20
