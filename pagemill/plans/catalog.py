"""The registered queries of the core: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagemill.operators.timestamps import found_instants
from pagemill.plans.documents import document_queries
from pagemill.plans.exchange import exchange_queries
from pagemill.plans.reference import reference_queries
from pagemill.session import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    return found_instants(t("results"), t("rss_items"), t("atom_entries"), t("sites"))


def core_queries() -> dict[str, tuple[Query, str | None]]:
    return {"p1_found": (p1_found, None), **reference_queries(), **document_queries(), **exchange_queries()}
