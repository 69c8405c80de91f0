from pyspark.sql import functions as F

from corpusforge.plans import jobs


def test_extend_to_target_and_base_duplicates(spark, tmp_path):
    base = spark.createDataFrame(
        [(1, "Same headline here", "A"), (2, "same   headline here", "A"), (3, "Other headline here", "B")],
        "row_id long, text string, label string")
    pages = spark.createDataFrame([("s", 1, 200), ("s", 2, 200)], "source string, page_no long, http_status int")
    items = spark.createDataFrame(
        [("s", 1, 0, "fresh headline one", "/1"), ("s", 1, 1, "fresh headline two", "/2"),
         ("s", 2, 0, "fresh headline three", "/3")],
        "source string, page_no long, pos long, title string, href string")
    reg = [{"name": "s", "label": "A", "base_url": "https://s/"}]
    r = jobs.extend_to_target(spark, base, pages, items, reg, ["A", "B"], 3, run_dir=str(tmp_path / "r1"))
    # base duplicates count toward the target (needs before the final dedupe)
    assert r.needs == {"A": 1, "B": 2}
    assert {x.label: x["count"] for x in r.corpus.groupBy("label").count().collect()} == {"A": 2, "B": 1}
    assert {x.label: x.need for x in r.shortfall.collect()} == {"A": 1, "B": 2}
    r2 = jobs.extend_to_target(spark, base, pages, items, reg, ["A", "B"], 3, dedupe_base_first=True,
                               run_dir=str(tmp_path / "r2"))
    assert r2.needs == {"A": 2, "B": 2}
    assert {x.label: x["count"] for x in r2.corpus.groupBy("label").count().collect()} == {"A": 3, "B": 1}


def test_merge_and_balance_jobs(spark):
    a = spark.createDataFrame([(1, "t1", "sports"), (2, "t2", "world")], "row_id long, text string, label string")
    b = spark.createDataFrame([(1, "t1", "sports"), (2, "t3 longer", "world")], "row_id long, text string, label string")
    m = jobs.merge_job([a, b], dedupe_by="text", title_case_labels=True)
    assert sorted((r.part_no, r.text, r.label) for r in m.collect()) == [
        (0, "t1", "Sports"), (0, "t2", "World"), (1, "t3 longer", "World")]
    assert jobs.merge_job([a, b], dedupe_by=None).count() == 4
    df = spark.createDataFrame([(i, f"headline number {i}", "AB"[i % 3 == 0]) for i in range(30)],
                               "row_id long, text string, label string")
    out = jobs.balance_job(df, 12)
    assert {r.label: r["count"] for r in out.groupBy("label").count().collect()} == {"A": 12, "B": 12}
    top = jobs.label_report(df).first()
    assert (top.label, top["count"]) == ("A", 20)


_PAGE = '<ul><li><a href="/l{0}">list headline {0}</a></li></ul><h2><a href="/h{0}">heading headline {0}</a></h2>'
_REG = [{"name": "s", "label": "A", "base_url": "https://s/", "selectors": ["li a"]},
        {"name": "s", "label": "B", "base_url": "https://s/"},  # default selectors
        {"name": "t", "label": "B", "base_url": "https://t/", "selectors": ["h2 a", "li a"], "start_page": 2}]


def _captures(spark):
    rows = [("s", 1, "u", 200, _PAGE.format(1)), ("s", 2, "u", None, _PAGE.format(2)), ("s", 3, "u", 404, _PAGE.format(3)),
            ("s", 4, "u", 200, _PAGE.format(4)), ("t", 1, "u", 200, _PAGE.format(5)), ("t", 2, "u", 200, _PAGE.format(6)),
            ("t", 3, "u", 200, None)]
    return spark.createDataFrame(rows, "source string, page_no long, url string, http_status int, html string")


def test_each_source_reads_its_pages_with_its_own_selectors(spark):
    base = spark.createDataFrame([(1, "list headline 6", "A")], "row_id long, text string, label string")
    r = jobs.extend_from_pages(spark, base, _captures(spark), _REG, ["A", "B"], 10)
    got = sorted((x.step, x.label, x.source, x.page_no, x.text, x.url) for x in r.accepted.collect())
    assert got == [(1, "A", "s", 1, "list headline 1", "/l1"), (2, "B", "s", 1, "heading headline 1", "/h1"),
                   (3, "B", "t", 2, "heading headline 6", "/h6")]


def test_pages_of_one_registry_row(spark):
    from corpusforge.operators.extract import links_by_source
    from corpusforge.sources.registry import sources_frame

    pages = _captures(spark).withColumn("priority", F.lit(2))
    got = links_by_source(pages, sources_frame(spark, _REG)).filter("page_no = 1").select("priority", "source", "title").collect()
    assert sorted(tuple(x) for x in got) == [(2, "s", "heading headline 1"), (2, "t", "heading headline 5")]


def test_stream_of_pages(spark, tmp_path):
    from corpusforge.sources.registry import sources_frame
    from corpusforge.streaming.growth import prepare_base, start_growth

    base = spark.createDataFrame([("list headline 1", "A")], "text string, label string")
    _captures(spark).write.parquet(str(tmp_path / "pages"))
    q = start_growth(spark, str(tmp_path / "pages"), prepare_base(spark, base, str(tmp_path / "base")), sources_frame(spark, _REG),
                     ["A", "B"], 3, str(tmp_path / "out"), str(tmp_path / "ckpt"), pages=True)
    q.awaitTermination()
    got = sorted((x.label, x.source, x.text) for x in spark.read.parquet(str(tmp_path / "out")).collect())
    # stop rules play no part in a stream: pages after an error count too
    assert got == [("A", "s", "list headline 4"), ("B", "s", "heading headline 1"), ("B", "s", "heading headline 4"),
                   ("B", "t", "list headline 6")]
