"""The registered queries of the llm operators: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import boilerplate, lookalikes, mojibake, packing, pieces, residue, tokens
from pagemill.session import table

Query = Callable[[SparkSession, str], DataFrame]


def fields(spark: SparkSession, sf_dir: str, names: dict[str, tuple[str, str, str]]) -> DataFrame:
    """(field_name, rec_id, text) of the fields given as name -> (table, id, column)."""
    parts = [table(spark, sf_dir, t).select(F.lit(name).alias("field_name"), F.col(i).alias("rec_id"), F.col(c).alias("text")) for name, (t, i, c) in names.items()]
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    return df


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fields(spark, sf_dir, {"page.title": ("rendered", "page_id", "title"), "result.title": ("results", "result_id", "title"), "link.text": ("links", "link_id", "text")})
    return lookalikes.same_looking_pairs(rows)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.boilerplate_lines(table(spark, sf_dir, "rendered"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = residue.page_evidence(table(spark, sf_dir, "rendered")).unionByName(residue.evidence(residue.snippet_texts(table(spark, sf_dir, "results"))))
    return residue.judged_records(found)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fields(spark, sf_dir, {"page.markdown": ("rendered", "page_id", "markdown"), "page.title": ("rendered", "page_id", "title"), "result.snippet": ("results", "result_id", "snippet")})
    return mojibake.garbled(rows).select("field_name", "rec_id").distinct()


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokens.encode_corpus(docs, F.col("doc_id"), F.col("text")).select(F.col("key").alias("doc_id"), "ids")


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [(r.spec_id, r.token_limit) for r in packing.spec_rows(table(spark, sf_dir, "size_specs"), "container")]
    return packing.pack_texts(table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text"), specs)


def p7_constrained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same under all three capacities: a document for each 128 tokens of the limit, and three quarters of the attention cost of one full text."""
    specs = [(r.spec_id, r.token_limit) for r in packing.spec_rows(table(spark, sf_dir, "size_specs"), "container")]
    return packing.pack_texts(table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text"), specs, max_documents=lambda limit: max(1, limit // 128), max_attention=lambda limit: max(1, 3 * limit * limit // 4))


def p6_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text back from its ids."""
    decoded = tokens.decode_corpus(p6_ids(spark, sf_dir), "doc_id", "ids")
    return decoded.select(F.col("key").alias("doc_id"), F.length("text").alias("length"), F.md5("text").alias("digest"))


P6_DECODED = "select doc_id, length(coalesce(text, ''))::int as length, md5(coalesce(text, '')) as digest from documents"


def p8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [tuple(r) for r in packing.spec_rows(table(spark, sf_dir, "size_specs"), "piece")]
    return pieces.split_texts(table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text"), specs)


def llm_queries() -> dict[str, tuple[Query, str | None]]:
    return {"p2_found": (p2_found, None), "p3_found": (p3_found, None), "p5_found": (p5_found, None), "p4_found": (p4_found, None), "p6_ids": (p6_ids, None), "p6_decoded": (p6_decoded, P6_DECODED), "p7_containers": (p7_containers, None), "p7_constrained": (p7_constrained, None), "p8_pieces": (p8_pieces, None)}
