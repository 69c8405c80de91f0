"""Versions of a corpus, files in shuffled order, CSV files with broken rows."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import balance as B
from corpusforge.plans import jobs
from corpusforge.sources.corpus import CorpusStore, NoVersionError, write_in_order_csv
from corpusforge.sources.csv import read_rows_tolerant


def corpus(spark, n):
    rows = [(i, f"headline number {i}", "AB"[i % 3 == 0], "s", None) for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, text string, label string, source string, url string").repartition(5)


def test_readers_take_the_newest_complete_version(spark, tmp_path):
    store = CorpusStore(spark, str(tmp_path / "corpus"))
    with pytest.raises(NoVersionError):
        store.read()
    assert store.write(corpus(spark, 30)).counts == {"A": 20, "B": 10}
    store.write(corpus(spark, 40))
    # an interrupted run: data, but no manifest
    corpus(spark, 50).write.parquet(str(tmp_path / "corpus/version=000003/data"))
    assert (store.versions(), store.read().count(), store.read(1).count()) == ([1, 2], 40, 30)
    assert store.needs(["A", "B", "C"], 25) == {"A": 0, "B": 11, "C": 25}
    assert store.write(corpus(spark, 60)).number == 4
    assert store.read().count() == 60
    with pytest.raises(NoVersionError):
        store.read(3)


def test_labels_of_any_kind_and_empty_tables(spark, tmp_path):
    store = CorpusStore(spark, str(tmp_path / "corpus"))
    store.write(corpus(spark, 0))
    assert (store.read().count(), store.read_numbered().count(), store.manifest().rows) == (0, 0, 0)
    store.write(corpus(spark, 6).withColumn("label", F.when(F.col("row_id") > 2, 'x"y')))
    assert store.manifest().counts == {None: 3, 'x"y': 3}


def test_files_by_name_give_the_shuffled_order(spark, tmp_path):
    order = ["shuffle_key", "row_id"]
    df = B.shuffle(corpus(spark, 2000), 7)
    expected = [r["row_id"] for r in df.sort(*order).collect()]
    store = CorpusStore(spark, str(tmp_path / "corpus"))
    v = store.write(df, order, files=12)
    files = sorted(x for x in os.listdir(v.path) if x.endswith(".parquet"))
    assert len(files) > 6
    got = [r["row_id"] for f in files for r in spark.read.parquet(f"{v.path}/{f}").collect()]
    assert got == expected
    numbered = store.read_numbered()
    assert [r["row_id"] for r in numbered.sort("row_no").collect()] == expected
    assert sorted(r["row_no"] for r in numbered.collect()) == list(range(2000))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    path = write_in_order_csv(df, str(tmp_path / "csv"), order, files=5)
    lines = [x.split(",")[0] for f in sorted(os.listdir(path)) if f.endswith(".csv") for x in open(f"{path}/{f}").read().splitlines()[1:]]
    assert [int(x) for x in lines] == expected


def test_a_job_extends_its_own_last_output(spark, tmp_path):
    store = CorpusStore(spark, str(tmp_path / "corpus"))
    store.write(corpus(spark, 6), ["row_id"])
    reg = [{"name": "s", "label": "B", "base_url": "https://s/"}]
    pages = spark.createDataFrame([("s", p, 200) for p in (1, 2)], "source string, page_no long, http_status int")
    items = spark.createDataFrame(
        [("s", 1, 0, "Headline   number 3", "/0"), ("s", 1, 1, "a brand new headline", "/1"), ("s", 2, 0, "another new headline", "/2")],
        "source string, page_no long, pos long, title string, href string")
    for target, rows in ((3, 7), (3, 7), (4, 8)):  # the second run finds its target reached
        v = jobs.extend_version(spark, store, pages, items, reg, labels=["B"], target=target)
        assert (v.rows, v.counts["B"]) == (rows, target)
    texts = [r["text"] for r in store.read_numbered().sort("row_no").collect()]
    assert texts[:6] == [f"headline number {i}" for i in range(6)] and texts[6:] == ["a brand new headline", "another new headline"]


SCHEMA = "row_id long, text string, label string"


def test_broken_rows_are_rejects(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.csv").write_text('label,row_id,text\nA,1,one\nB,2\nA,3,three,more\nA,x4,four\n\nB,5,"fi,""ve"\nB,,six\n')
    (d / "b.csv").write_text("label,row_id,text\nA,7,seven\n")
    good, rejects = read_rows_tolerant(spark, str(d), SCHEMA)
    rows = {(r["row_id"], r["text"], r["label"]) for r in good.collect()}
    assert rows == {(1, "one", "A"), (5, 'fi,"ve', "B"), (None, "six", "B"), (7, "seven", "A")}
    assert {(r["line"], r["reason"]) for r in rejects.collect()} == {("B,2", "fields"), ("A,3,three,more", "fields"), ("A,x4,four", "row_id")}
    assert (good.count(), rejects.count(), good.select("label").count()) == (4, 3, 4)


def test_a_truncated_archive_gives_its_rows_up_to_there(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    text = "row_id,text,label\n" + "".join(f"{i},text {i * 7919 % 100003} {i * 104729 % 1000003},A\n" for i in range(20_000))
    whole = gzip.compress(text.encode())
    (d / "torn.csv.gz").write_bytes(whole[: len(whole) // 2])
    (d / "whole.csv.gz").write_bytes(gzip.compress(b"row_id,text,label\n-1,last,A\n"))
    good, rejects = read_rows_tolerant(spark, str(d), SCHEMA)
    n = good.count()
    assert 1000 < n < 20_000 and good.filter("row_id = -1").count() == 1 and rejects.count() <= 1


def test_a_path_that_is_missing_or_goes_away(spark, tmp_path):
    good, rejects = read_rows_tolerant(spark, str(tmp_path / "nothing.csv"), SCHEMA)
    assert (good.count(), rejects.count(), good.columns) == (0, 0, ["row_id", "text", "label"])
    d = tmp_path / "in"
    d.mkdir()
    for i in range(3):
        (d / f"{i}.csv").write_text(f"row_id,text,label\n{i},text,A\n")
    good, _ = read_rows_tolerant(spark, str(d), SCHEMA)
    (d / "1.csv").unlink()
    assert {r["row_id"] for r in good.collect()} == {0, 2}


def test_draws_reach_every_row_of_a_huge_label(spark):
    key = B._hex_to_long(B._md5_key(1, F.col("id")))
    n = 1 << 40
    got = spark.range(20_000).select(F.pmod(key, F.lit(n)).alias("r")).agg(F.min("r"), F.max("r"), F.countDistinct("r")).first()
    assert got[0] < n / 1000 and got[1] > n - n / 1000 and got[2] == 20_000
