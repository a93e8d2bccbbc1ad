"""Every query of the core with SQL gives DuckDB's rows on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from pagemill.plans.catalog import core_queries

WITH_SQL = {k: v for k, v in core_queries().items() if v[1]}


@pytest.fixture(scope="module")
def db(small):
    con = duckdb.connect()
    for f in Path(small).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", WITH_SQL)
def test_same_rows(spark, small, db, name):
    query, sql = WITH_SQL[name]
    df = query(spark, small)
    cols = sorted(df.columns)
    want = db.sql(sql)
    assert sorted(want.columns) == cols
    rows = lambda it: Counter(tuple(map(str, r)) for r in it)
    got, expected = rows(df.select(*cols).collect()), rows(want.select(*(f'"{c}"' for c in cols)).fetchall())
    assert got - expected == Counter() and expected - got == Counter()
    assert sum(got.values()) > 0
