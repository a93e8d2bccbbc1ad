"""Addresses of both versions, and allow lists."""

import pytest
from pyspark.sql import functions as F

from pagemill.operators.admission import AllowList, addresses, parse_allow_list

CASES = [("8.8.8.8", False), ("127.0.0.1", True), ("10.1.2.3", True), ("169.254.169.254", True), ("172.32.0.1", False), ("::1", True), ("2606:4700::1", False), ("fe80::1", True), ("::ffff:10.0.0.1", True), ("fd12::1", True), ("", True), (None, True), ("999.1.1.1", True)]


def test_addresses(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(CASES)], "blocked long, ip string")
    got = {r.k: r.blocked for r in addresses(df, F.col("ip"), [F.col("blocked").alias("k")]).collect()}
    assert got == {i: b for i, (_, b) in enumerate(CASES)}


@pytest.mark.parametrize(("entries", "want"), [([" A.test ", "", "10.0.0.1", "fd00::/8", "10.1.2.3/8"], AllowList(("a.test",), ("10.0.0.1/32", "fd00::/8", "10.0.0.0/8"))), ([], AllowList((), ()))])
def test_parse(entries, want):
    assert parse_allow_list(entries) == want


def test_registered_query(spark, small):
    """Both versions reach the registered query: each address by its prefix, as all of a prefix lie in one range."""
    from pagemill.plans.reference import PREFIXES, reference_queries

    query, sql = reference_queries()["address_admission"]
    got = {(r.event_id % len(PREFIXES), r.blocked, r.allowed, r.permitted) for r in query(spark, small).where("event_id % 65536 > 1").collect()}
    open_, shut, listed = (False, False, True), (True, False, False), (True, True, True)
    want = {"2606:4700::": {open_}, "fd00::": {listed}, "fe80::": {shut}, "::ffff:10.": {shut, listed}, "::ffff:8.": {open_}, "2001:db8::": {shut}, "64:ff9b::": {shut}, "::": {open_}, "10.": {shut, listed}, "9.": {open_}, "ff02::": {shut}, "no address ": {shut}}
    assert sql and got == {(i, *x) for i, p in enumerate(PREFIXES) for x in want[p]}
