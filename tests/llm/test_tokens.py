"""p6: word by word equals whole-text encoding; exact round trip; edge tables."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.llm import tokens

CHARS = st.lists(st.sampled_from(list("ab Z9'\n\t\r\x1c\x85\xa0　é一🙂.,-_") + ["'s", "'ll"]), max_size=60).map("".join)


@settings(max_examples=500, deadline=None)
@given(CHARS)
def test_words_encode_like_the_whole(text):
    encode = tokens.encoder(tokens.tokenizer_path()).encode_ordinary
    words = re.findall(tokens.WORD, text)
    assert "".join(words) == text
    assert [i for w in words for i in encode(w)] == encode(text)


ROWS = [(1, "The tram museum\n\n  moved 9 crates’ lids.", "x"), (2, "", "x"), (3, None, "x"), (4, "<|endoftext|> 文字 🙂", "x"), (4, "<|endoftext|> 文字 🙂", "x"), (5, "a" * 30000 + " b " * 9000, "x"), (None, "no key", "x")]


@pytest.mark.parametrize("block_chars", [1, 100, 4_000_000])
def test_corpus(spark, block_chars):
    df = spark.createDataFrame(ROWS, "id long, text string, words string")
    got = tokens.encode_corpus(df, F.col("id"), F.col("text"), block_chars=block_chars)
    encode = tokens.encoder(tokens.tokenizer_path()).encode_ordinary
    want = sorted(((k, encode(t or "")) for k, t, _ in ROWS), key=str)
    assert sorted(((r.key, list(r.ids)) for r in got.collect()), key=str) == want
    counts = tokens.count_tokens(df, F.col("id"), F.col("text"), block_chars=block_chars)
    assert sorted(((r.key, r.n_tokens) for r in counts.collect()), key=str) == sorted(((k, len(i)) for k, i in want), key=str)
    back = tokens.decode_corpus(got)
    assert sorted(((r.key, r.text) for r in back.collect()), key=str) == sorted(((k, t or "") for k, t, _ in ROWS), key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, text string")
    assert tokens.encode_corpus(df, F.col("id"), F.col("text")).count() == 0


def test_query_on_all_documents(spark, small):
    from pagemill.llm.catalog import llm_queries

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: list(r.ids) for r in llm_queries()["p6_ids"][0](spark, small).collect()}
    encode = tokens.encoder(tokens.tokenizer_path()).encode_ordinary
    assert got == {d.doc_id: encode(d.text or "") for d in docs}


def test_decoding_keeps_rows_apart(spark):
    """Repeated keys, null, empty and unknown ids; rows come through a shuffle."""
    texts = ["one two", "zwei 語", "", "x" * 5000]
    df = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (2, texts[2]), (3, texts[3])], "doc_id long, text string")
    ids = tokens.encode_corpus(df, F.col("doc_id"), F.col("text")).repartition(3, "key")
    assert sorted((r.key, r.text) for r in tokens.decode_corpus(ids).collect()) == sorted(zip((1, 1, 2, 3), texts))
    odd = spark.createDataFrame([(1, None), (2, [None, -5, 10**8])], "key long, ids array<int>")
    assert {(r.key, r.text) for r in tokens.decode_corpus(odd).collect()} == {(1, None), (2, "")}


def test_slices_change_nothing(spark):
    df = spark.createDataFrame([(i, f"a b c {i} the") for i in range(60)], "doc_id long, text string")
    blocks = tokens.word_blocks(df, F.col("doc_id"), F.col("text"), 50)
    rows = lambda **k: sorted((r.of_block, r.pos, bytes(r.ids)) for r in tokens.encode_words(blocks, tokens.tokenizer_path(), **k).collect())
    assert rows() == rows(parts=3, slices=4)
