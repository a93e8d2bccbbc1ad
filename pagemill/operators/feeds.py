"""Feeds of ready entries as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.text import feed_date, one_line, plain_of_markup, text, title_line, trim_space

# Entries of a listing, characters of a summary.
MAX_ITEMS, SUMMARY = 100, 400


def given(first: Column, second: Column) -> Column:
    """``first`` unless it is missing or empty."""
    return F.when(text(first) == "", text(second)).otherwise(first)


def entry_text(title: Column, link: Column, date: Column, markup: Column) -> Column:
    """One entry of a listing; titles come on one line."""
    title, link, date, summary = title_line(title), trim_space(link), feed_date(date), one_line(plain_of_markup(markup), SUMMARY)
    some = lambda c, before: F.when(c != "", F.concat(F.lit(before), c)).otherwise("")
    return F.concat(F.lit("\n- **"), F.when(title == "", "(untitled)").otherwise(title), F.lit("**"), some(date, " — "), some(link, "\n  "), some(summary, "\n  "), F.lit("\n"))


def listings(entries: DataFrame, feed: str, key: str, title: Column, link: Column, date: Column, markup: Column, subtitle: Column | None = None) -> DataFrame:
    """(feed, listing): each feed's entries by ``key``, the first hundred and how many there are; repeated keys count once.

    The first hundred are found before entries are gathered, and only those are. An empty
    table gives an empty table.
    """
    rows = entries.dropDuplicates([key]).select(F.col(feed).alias("feed"), F.col(key).alias("key"), title.alias("title"), link.alias("link"), date.alias("date"), markup.alias("markup"), one_line(subtitle if subtitle is not None else F.lit("")).alias("subtitle"))
    totals = rows.groupBy("feed").agg(F.count("*").alias("total"), F.max("subtitle").alias("subtitle"))
    first = rows.withColumn("n", F.expr("row_number() over (partition by feed order by key)")).where(F.col("n") <= MAX_ITEMS)
    shown = first.groupBy("feed").agg(F.array_sort(F.collect_list(F.struct("n", entry_text(F.col("title"), F.col("link"), F.col("date"), F.col("markup")).alias("e")))).alias("es"))
    note = F.when(F.col("total") > MAX_ITEMS, f" (showing the first {MAX_ITEMS})").otherwise("")
    head = F.when(F.col("subtitle") != "", F.concat("subtitle", F.lit("\n"))).otherwise("")
    joined = totals.alias("t").join(shown.alias("s"), F.expr("t.feed <=> s.feed")).select("t.feed", "total", "subtitle", "es")
    return joined.select(F.col("feed").alias(feed), trim_space(F.concat(head, F.lit("\n"), F.format_string("Feed with %d entries", "total"), note, F.lit(":\n"), F.array_join(F.transform("es", lambda x: x["e"]), ""))).alias("listing"))
