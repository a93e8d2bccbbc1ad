"""p8: pieces cover the text in order within the limit; edits stay local."""

import random

import numpy as np
from pyspark.sql import functions as F

from pagemill.llm import pieces, tokens

SPECS = [(4, 64, 8), (5, 200, 0)]


def rows(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("piece_no", F.lit("x"))
    return sorted(pieces.split_texts(df, F.col("doc_id"), F.col("text"), SPECS).collect(), key=lambda r: (r.spec_id, r.doc_id, r.piece_no))


def prose(seed, n=400):
    r = random.Random(seed)
    words = "the old ledger of a tram museum was moved by two quiet wardens over naïve bells".split()
    return "".join(r.choice(words) + r.choice([" ", " ", " ", " ", ". ", ".\n", ".\n\n"]) for _ in range(n))


def test_pieces(spark):
    texts = [prose(1), prose(2), "x" * 5000, "語" * 900, "", None, "short", prose(1), "\n" * 700]
    got = rows(spark, texts)
    encode = tokens.encoder(tokens.tokenizer_path())
    for spec, limit, overlap in SPECS:
        for k, t in enumerate(texts):
            ids = encode.encode_ordinary(t or "")
            own = [r for r in got if r.spec_id == spec and r.doc_id == k]
            if len(ids) <= limit:
                assert own == []
                continue
            assert [r.piece_no for r in own] == list(range(len(own)))
            assert own[0].token_start == 0 and own[-1].token_end == len(ids)
            for a, b in zip(own, own[1:]):
                assert b.token_start == a.token_end - overlap > a.token_start or overlap == 0 and b.token_start == a.token_end
            for r in own:
                assert r.n_tokens == r.token_end - r.token_start and 0 < r.n_tokens <= limit
                assert r.text == encode.decode_bytes(ids[r.token_start : r.token_end]).decode("utf-8", "replace")
            if " " in (t or ""):
                assert all(r.cut in ("word", "sentence", "line", "paragraph") for r in own)


def test_edits_stay_local(spark):
    a = prose(3, 3000)
    b = a[:200] + "inserted words here " + a[200:]
    got = rows(spark, [a, b])
    first, second = ({r.text for r in got if r.spec_id == 5 and r.doc_id == k} for k in (0, 1))
    assert len(first & second) >= 0.7 * len(first)


def test_levels():
    text = "One two. Three\nfour\n\nfive".encode()
    level = pieces.boundary_levels(np.frombuffer(text, np.uint8), np.array([0, 3, 8, 15, 21]))
    assert [pieces.LEVELS[x] for x in level[1:]] == ["word", "sentence", "line", "paragraph"]


def test_no_specs_and_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.split_texts(df, F.col("doc_id"), F.col("text"), SPECS).count() == 0
    assert pieces.split_texts(df, F.col("doc_id"), F.col("text"), []).count() == 0


def test_few_pieces_change(spark):
    """Over many texts with two words inserted in the middle: all before the edit stay, and few pieces after it differ."""
    texts = []
    for seed in range(20):
        words = prose(100 + seed, 1500).split(" ")
        at = len(words) // 2
        texts += [" ".join(words), " ".join([*words[:at], "inserted", "words", *words[at:]])]
    of = {}
    for r in rows(spark, texts):
        of.setdefault((r.spec_id, r.doc_id), []).append(r.text)
    for spec, _, _ in SPECS:
        changed = []
        for k in range(0, len(texts), 2):
            a, b = of[spec, k], of[spec, k + 1]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            tail = next((i for i, (x, y) in enumerate(zip(a[::-1], b[::-1])) if x != y), min(len(a), len(b)))
            changed.append(max(0, len(a) - same - tail))
        assert sorted(changed)[len(changed) // 2] <= 2 and sorted(changed)[int(0.8 * len(changed))] <= 5
