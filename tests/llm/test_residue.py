"""p5: kinds of message, records of several messages, recurrence, and edge tables."""

import pytest

from pagemill.llm import boilerplate
from pagemill.llm import residue as rs


@pytest.mark.parametrize(
    ("message", "kind"),
    [
        ("Page not found", rs.NOTICE),
        ("Error 404: Die gewünschte Seite gibt es nicht mehr.", rs.NOTICE),
        ("Accès refusé Request id 0a1f22", rs.NOTICE),
        ("502 – The address may be mistyped or the page has moved. Error establishing a connection to the data store Nothing here yet.", rs.NOTICE),
        ("JavaScriptを有効にしてください。", rs.NOTICE),
        ("Включите JavaScript, чтобы продолжить.", rs.NOTICE),
        ("Massa amet massa felis nec sim.", rs.NOTICE),
        ("asdf asdf jkl", rs.NOTICE),
        ("The {{ body }} water board counted twice.", rs.PLACE),
        ("Hello %NAME%, thanks for visiting.", rs.PLACE),
        ("undefined – undefined (NaN comments)", rs.UNFILLED),
        ("Das Heft erklärt, wozu {0} in Vorlagen dient, und zeigt 3 Beispiele.", rs.MENTION),
        ("Our designers gave the “Page not found” screen a picture of the ferry, and visits to it doubled.", rs.CONTENT),
        ("The course explains why printers set lorem ipsum before the real text arrives.", rs.CONTENT),
        ("Error 404 cost the ticket office 9 sales last winter, the report says.", rs.CONTENT),
        ("By Ann Writer", rs.ASIDE),
        ("Reference: 0a1f22", rs.ASIDE),
    ],
)
def test_kinds(message, kind):
    assert rs.kind_of(message) == kind


@pytest.mark.parametrize(
    "text",
    [
        "The requested URL was not found on this server.", "Sorry, you have been blocked.", "We'll be right back after maintenance.", "Oops! That page can't be found.",
        "Verifying you are human. This may take a few seconds.", "HTTP Status 500 – Internal Server Error", "Le serveur est indisponible, veuillez réessayer plus tard.", "El servidor no está disponible en este momento.",
    ],
)
def test_notices_in_words_of_no_list(text):
    bits, doubtful = rs.text_evidence(text)
    assert bits == rs.HAS_NOTICE and not doubtful


@pytest.mark.parametrize("hosts", [1, 2, 3, 50])
def test_unfilled_on_any_number_of_hosts(spark, hosts):
    df = spark.createDataFrame([("f", k, f"h{k}", "Dear {{first_name}}, your order is now on the way to you today.", False) for k in range(hosts)], "field_name string, rec_id long, source string, text string, code boolean")
    assert rs.residue_records(df).count() == hosts


def test_masks():
    assert rs.mask("At 12 May the Path /a/b of x.test met {{a}}") == rs.mask("At 7 May the Path /c of y.example met {{bcd}}")


def test_records(spark):
    said = "In {{name}} the whole village is pleased with what it sees today."
    rows = [
        ("f", 1, "a", "Access denied. Page not found", False), ("f", 2, "a", "Access denied", False), ("f", 2, "a", "A long paragraph about the old ledger stands here.", False),
        ("f", 3, "a", "The [[date]] survey team traded the path.", False), ("f", 4, "a", None, False), ("f", 5, "a", "", False), ("f", 6, None, "null: [object Object]", False), ("f", 6, None, "null: [object Object]", False),
        ("f", 7, "a", "{{ shown }} as code", True), ("f", None, "a", "Page not found", False), ("g", 1, "a", "y" * 100_000, False), *[("f", 20 + k, f"h{k}", said, False) for k in range(3)],
    ]
    df = spark.createDataFrame(rows, "field_name string, rec_id long, source string, text string, code boolean")
    assert {tuple(r) for r in rs.residue_records(df).collect()} == {("f", 1), ("f", 3), ("f", 6), ("f", None), *(("f", 20 + k) for k in range(3))}
    assert rs.residue_records(df.limit(0)).count() == 0


def test_recurrence(spark):
    """A placeholder stays unfilled however many sources have it; a notice in other words shows by recurring."""
    unfilled = "The parish choir quietly replaced the façade of the granary [%name%] and nobody objected."
    notice = "Access denied by the gate keeper of {}, so come back with a ticket next week."
    shown = "The course explains why printers set lorem ipsum before the real text arrives."
    quoted = "Our designers gave the “Page not found” screen a picture of the ferry, and visits to it doubled."
    syntax = "The handbook of {} tells how the template sets [%name%] into a letter."
    texts = [unfilled, notice, shown, quoted, syntax, "Error 503 cost the ticket office {} sales last winter, the report says."]
    rows = [("f", 10 * i + k, f"h{k}", t.format(f"{k}{k}"), False) for i, t in enumerate(texts) for k in range(4)]
    rows += [("g", k, f"h{k % 2}", "Access denied was all that the clerk had to say of it.", False) for k in range(4)]
    df = spark.createDataFrame(rows, "field_name string, rec_id long, source string, text string, code boolean")
    assert {tuple(r) for r in rs.residue_records(df).collect()} == {("f", k) for k in range(4)} | {("f", 10 + k) for k in range(4)}


def test_every_message_is_grouped():
    text = "Access denied by the gate keeper of Ann, so come back with a ticket next week. A long paragraph about the old ledger stands here. By Ann. Hello {{name}}."
    assert len(rs.message_hashes(text)) == len(rs.messages(text)) == 4
    assert {h >> rs.KIND_BITS for h in rs.message_hashes(text)} == {h >> rs.KIND_BITS for h in rs.message_hashes(text.replace("Ann", "Goran").replace("name", "user"))}


def test_masks_keep_the_words_of_the_rules():
    assert rs.mask("Seit gestern ist die Seite gelöscht") != rs.mask("Seit gestern ist die Brücke gelöscht")
    assert rs.mask("Seit gestern ist die Brücke gelöscht") == rs.mask("Seit gestern ist die Straße gelöscht")
    assert rs.mask("In the Handbook of Ann") == rs.mask("In the Handbook of Bob") != rs.mask("In the Town of Bob")


def test_recurrence_beside_content(spark):
    """Sources that show a message beside content count for it where it stands alone."""
    notice, content = "Access denied by the gate keeper of {}, so come back with a ticket next week.", " The old ledger of the mill was mended with great care."
    rows = [("f", k, f"h{k}", notice.format(f"{k}{k}") + (content if k else ""), False) for k in range(4)]
    rows += [("g", k, f"h{k}", content, False) for k in range(4)]
    df = spark.createDataFrame(rows, "field_name string, rec_id long, source string, text string, code boolean")
    assert {tuple(r) for r in rs.residue_records(df).collect()} == {("f", 0)}
    assert rs.residue_records(df.where("rec_id < 2")).count() == 0


def test_groups_are_judged_by_most_of_their_sources(spark):
    said = [(1, rs.DOUBTFUL_CONTENT, s) for s in range(4)] + [(2, rs.DOUBTFUL_CONTENT, s) for s in range(4)] + [(2, rs.CONTENT, s) for s in range(4, 9)] + [(3, rs.CONTENT, s) for s in range(9)] + [(4, rs.NOTICE, 1)] * 5
    df = spark.createDataFrame(said, "message long, kind int, source long")
    assert {r.message for r in rs.notice_groups(df, 300).collect()} == {1}
    assert rs.notice_groups(df, 500).count() == 0


def test_rules_read_each_recurring_thing_once(monkeypatch):
    """Lines of templates and words recur on most pages; the rules look at each of them once, not once a page."""
    monkeypatch.setattr(rs, "messages", lambda text, whole=rs.messages: (read.append(text), whole(text))[1])
    read, menu = [], "Read the {} of the Zanthorpe observatory"
    lines = [rs.line_evidence(boilerplate.page_lines(menu.format(k % 4), False)[0]) for k in range(200)]
    assert sorted(read) == sorted(menu.format(k) for k in range(4)) and len({tuple(h) for _, h in lines}) == 1


@pytest.mark.parametrize(
    "message",
    [
        "Yesterday Ann met Bob, and Carol left", "Ann met  Bob Carol", "/a/b is at /c/d of https://x.test/e.", "Ref 0a1f22 of Page 12", "see {{ first name }} and [[ Ann Bob ]]", "the Page, the Handbook, “Ann said",
        "Kept at ß İstanbul ŉx ٣٤ \x1c Ann", "x.test Ann U Bob 12 Carol", "The Seite gelöscht; Ann's", "…", "a" * 5000,
    ],
)
def test_masks_by_pieces_and_as_a_whole_agree(message):
    """A mask put together from the known pieces of a message is the one that its whole text gives."""
    for _ in range(2):
        assert rs.mask(message) == rs._mask_whole(message)


def test_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(rs._Pieces, "LIMIT", 50)
    said = [f"Word{chr(97 + k // 26)}{chr(97 + k % 26)} met the Page not found" for k in range(400)]
    kinds = [rs.kind_of(m) for m in said]
    assert len(rs._PIECES) <= 50 and kinds == [rs.kind_of(m) for m in said]
