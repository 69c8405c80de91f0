from pyspark.sql import functions as F

from corpusforge.sources.csv import read_corpus_csv, read_tolerant, write_corpus_csv
from corpusforge.sources.feeds import feed_items, search_feed_titles

RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>t</title>
<item><title>  Goal in the cup final today </title><link> https://a/1 </link><pubDate> Mon, 01 Jan 2024 </pubDate></item>
<item><link>https://a/2</link></item>
<item><title>Virus warning from WHO now</title><link>https://a/3</link></item>
<item><title>Nothing matches in here</title><link>https://a/4</link></item>
<item><title>Sicir-barar cusub - BBC News</title><link>https://a/5</link></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title>
<entry><title>Cup and goal entry title</title><updated>2024-01-02</updated><link href="https://b/1"/></entry>
</feed>"""


def test_feed_items(spark):
    feeds = spark.createDataFrame(
        [(1, RSS), (2, ATOM), (3, "<html>not a feed</html>"), (4, "<rss><channel></channel></rss>"), (5, None)],
        "fid long, xml string")
    got = sorted(tuple(r) for r in feed_items(feeds, ["fid"], None, ["goal", "cup"], ["virus", "WHO"]).select(
        "fid", "item_no", "text", "label", "url", "published").collect())
    assert got == [
        (1, 1, "Goal in the cup final today", "Sports", "https://a/1", "Mon, 01 Jan 2024"),
        (1, 3, "Virus warning from WHO now", "Health", "https://a/3", ""),
        (2, 1, "Cup and goal entry title", "Sports", "", "2024-01-02"),
    ]
    # max_items slices before the filters
    first2 = feed_items(feeds, ["fid"], "Sports", max_items=2).filter(F.col("fid") == 1).collect()
    assert [r.item_no for r in first2] == [1]
    cut = {r.item_no: r.text for r in search_feed_titles(feeds.filter("fid = 1"), ["fid"], 5).collect()}
    assert cut[5] == "Sicir" if len("Sicir") > 5 else 5 not in cut
    assert cut[1] == "Goal in the cup final today"


def test_csv_roundtrip_edges(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_bytes(
        "﻿text,label,source,url\n"
        '"Quoted, comma",Sports,s1,u1\n'
        '"Doubled ""quotes"" here",World,s2,\n'
        '"Embedded\nnewline",NA,null,nan\n'
        "  spaced  ,Economy,,\n".encode("utf-8"))
    df = read_corpus_csv(spark, str(p), "text string, label string, source string, url string")
    rows = [tuple(r) for r in df.collect()]
    assert rows == [
        ("Quoted, comma", "Sports", "s1", "u1"),
        ('Doubled "quotes" here', "World", "s2", None),
        ("Embedded\nnewline", None, None, None),
        ("  spaced  ", "Economy", None, None),
    ]
    out = write_corpus_csv(df, str(tmp_path / "out"))
    back = [tuple(r) for r in read_corpus_csv(spark, out, "text string, label string, source string, url string").collect()]
    assert sorted(back, key=str) == sorted(rows, key=str)
    empty = read_tolerant(spark, str(tmp_path / "missing.csv"), "text string, label string")
    assert empty.count() == 0


def test_scan_with_report(spark, tmp_path):
    from corpusforge.sources.csv import read_with_report

    p = tmp_path / "c.csv"
    p.write_text("text,label\nfirst headline,A\nsecond headline,B\nthird headline,A\n")
    df, rep = read_with_report(spark, str(p), "text string, label string")
    assert rep == {"rows": 3, "labels": ["A", "B"], "n_labels": 2}
    _, rep2 = read_with_report(spark, str(tmp_path / "nope.csv"), "text string, label string")
    assert rep2 == {"rows": 0, "labels": [], "n_labels": 0}
    _, rep3 = read_with_report(spark, str(p), "text string")
    assert rep3["message"] == "no label column"


def test_feed_entries_in_any_shape(spark):
    from corpusforge.sources.feeds import feed_entries

    shapes = {
        1: "<rss><channel><item><title>a</title></item></channel><channel><item><title>b</title></item></channel></rss>",
        2: "<rss><item><title>root</title></item></rss>",
        3: "<rss><channel><item><title>first</title><title>second</title></item></channel></rss>",
        4: "<rss><channel><item><title>a <b>bold</b> tail</title></item></channel></rss>",
        5: '<?xml version="1.0"?><a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:entry><a:title>atom</a:title>'
           "<a:updated>2024</a:updated></a:entry></a:feed>",
        6: "<rss><channel><item><link>u</link></item></channel></rss>",
        7: "<rss><channel><item><title>cut off",
        8: "<rss/>",
        9: "",
        10: None,
    }
    feeds = spark.createDataFrame(list(shapes.items()), "fid long, xml string")
    got = sorted((r.fid, r.item_no, r.title, r.link, r.published) for r in feed_entries(feeds, ["fid"]).collect())
    assert got == [
        (1, 1, "a", "", None), (1, 2, "b", "", None), (2, 1, "root", "", None),
        (3, 1, "first", "", None), (4, 1, "a", "", None), (5, 1, "atom", "", "2024"), (6, 1, None, "u", None),
    ]


def test_csv_columns_bind_by_name(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text("label,text,website,n\nSports,some headline text,site1,7\n")
    for quoted in (True, False):
        df = read_corpus_csv(spark, str(p), "text string, label string, source string, n long", quoted)
        assert df.columns == ["text", "label", "source", "n"]
        assert [tuple(r) for r in df.collect()] == [("some headline text", "Sports", None, 7)]


def test_growth_base_of_other_rows_is_refused(spark, tmp_path):
    import pytest

    from corpusforge.operators.collect import RunMismatchError
    from corpusforge.streaming.growth import prepare_base

    path = str(tmp_path / "base")
    one = spark.createDataFrame([("first headline", "A")], "text string, label string")
    two = one.union(spark.createDataFrame([("second headline", "A")], one.schema))
    assert prepare_base(spark, one, path).counts == {"A": 1}
    assert prepare_base(spark, one, path).counts == {"A": 1}
    with pytest.raises(RunMismatchError):
        prepare_base(spark, two, path)
