import pytest
from pyspark.sql import functions as F

from corpusforge.functions.urls import label_from_key, page_url, param_page_url, suffixed_page_url, wp_page_url
from corpusforge.operators.clean import MissingColumnsError, clean_corpus, pick_column


def test_clean_corpus_edges(spark):
    rows = [("12345", "A"), ("123456", "A"), (" 12345 ", "A"), (" 123456\n", " B "), (None, "A"), ("text long", None)]
    df = spark.createDataFrame(rows, "text string, label string")
    out = clean_corpus(df).collect()
    assert [(r.text, r.label, r.source, r.url) for r in out] == [("123456", "A", "", ""), ("123456", "B", "", "")]


def test_existing_null_source_is_not_filled(spark):
    df = spark.createDataFrame([("abcdefg", "A", None, None)], "text string, label string, source string, url string")
    r = clean_corpus(df).first()
    assert r.source is None and r.url is None


def test_required_columns(spark):
    df = spark.createDataFrame([("x",)], "text string")
    with pytest.raises(MissingColumnsError):
        clean_corpus(df)
    assert pick_column(spark.createDataFrame([("a",)], "website string")) == "website"
    assert pick_column(spark.createDataFrame([("a",)], "x string")) is None


def test_page_urls(spark):
    rows = [("https://a.so/cat", 1), ("https://a.so/cat/", 1), ("https://a.so/cat//", 2), ("https://a.so/cat/", 7)]
    df = spark.createDataFrame(rows, "b string, p long")
    got = [r[0] for r in df.select(wp_page_url("b", "p")).collect()]
    assert got == ["https://a.so/cat/", "https://a.so/cat/", "https://a.so/cat/page/2/", "https://a.so/cat/page/7/"]
    assert df.select(param_page_url("b", "p")).first()[0] == "https://a.so/cat1"
    assert df.select(suffixed_page_url(F.lit("https://x/page/"), "p")).first()[0] == "https://x/page/1/"
    m = spark.createDataFrame([("wp", "https://a/", 2), ("param", "https://a/?p=", 3)], "m string, b string, p long")
    assert [r[0] for r in m.select(page_url("m", "b", "p")).collect()] == ["https://a/page/2/", "https://a/?p=3"]
    bad = spark.createDataFrame([("zz", "https://a/", 2)], "m string, b string, p long")
    with pytest.raises(Exception, match="Unknown pagination mode"):
        bad.select(page_url("m", "b", "p")).collect()
    k = spark.createDataFrame([("Sports_goobjoog",), ("Health",)], "k string")
    assert [r[0] for r in k.select(label_from_key("k")).collect()] == ["Sports", "Health"]


def test_frontier_of_all_modes_and_empty_ranges(spark):
    from corpusforge.sources.registry import frontier

    reg = spark.createDataFrame(
        [
            (1, "a", "L", "wp", "https://a.x//", 1, 3), (2, "b", "L", "param", "https://b.x/?p=", 0, 1), (3, "c", "M", "suffixed", "https://c.x/page/", 1, 1),
            (4, "none", "M", "wp", "https://d.x", 3, 2), (5, "null", "M", "wp", "https://e.x", 1, None),
        ],
        "priority int, name string, label string, pagination string, base_url string, start_page int, max_pages int",
    )
    got = sorted((r["priority"], r["page_no"], r["url"]) for r in frontier(reg).collect())
    assert got == [
        (1, 1, "https://a.x/"), (1, 2, "https://a.x/page/2/"), (1, 3, "https://a.x/page/3/"),
        (2, 0, "https://b.x/?p=0"), (2, 1, "https://b.x/?p=1"), (3, 1, "https://c.x/page/1/"),
    ]
    assert frontier(reg.limit(0)).count() == 0


def test_parse_labels():
    from corpusforge.operators.clean import parse_labels

    assert parse_labels(" Sports, ,World ,,Health and more") == ["Sports", "World", "Health and more"]
    assert parse_labels(" , ") == []
