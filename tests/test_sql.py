"""The SQL functions over a small view."""

from pagemill import sql

PAGE = "<html><head><title>T</title></head><body><article><p>Words enough for the main content of a page.</p><a href='../x'>X</a> <img src=i.png alt=A></article><table><caption>C</caption><tr><th>a<th>b<tr><td>1<td>2<tr><td>3<td>4</table></body></html>"


def test_functions(spark):
    names = sql.register(spark)
    feed = bytearray(b"<rss><channel><item><title>t</title><link>l</link></item></channel></rss>")
    spark.createDataFrame([(1, PAGE, "https://h.test/a/b", feed), (2, None, None, None)], "id long, html string, url string, body binary").createOrReplaceTempView("pages_for_sql")
    rows = lambda q: [tuple(r) for r in spark.sql(q).collect()]
    assert rows("select id, l.* from pages_for_sql, lateral html_links(html, url) l") == [(1, 1, "https://h.test/x", "X")]
    assert rows("select pages_for_sql.id, i.url, i.alt from pages_for_sql, lateral html_images(html, url) i") == [(1, "https://h.test/a/i.png", "A")]
    assert rows("select t.place, t.caption, t.cells from pages_for_sql, lateral html_tables(html) t") == [(1, "C", [["a", "b"], ["1", "2"], ["3", "4"]])]
    assert rows("select e.title, e.link from pages_for_sql, lateral feed_entries(body, 'text/xml') e") == [("t", "l")]
    got = rows("select html_text(html), html_markdown(html, url), resolve_url('?q', url), decode_body(body, 'x; charset=latin1'), pdf_text(body), image_kind(body) from pages_for_sql order by id")
    assert got[0][0].startswith("T") and "Words enough for the main content" in got[0][1] and got[0][2:] == ("https://h.test/a/b?q", feed.decode(), None, "") and got[1][:2] == (None, None) and got[1][3:] == (None, None, None)
    assert set(names) == {*sql.TABLES, *sql.SCALARS}
