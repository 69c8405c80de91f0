"""Driver contract and plan-shape checks."""

import duckdb

import __spark_entry__ as E
from corpusforge.plans import queries as Q
from tests.conftest import SF_SMALL

ROWS_ONLY: set[str] = set()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_contract(spark):
    # The library's own queries; tests/llm names those of the optional part.
    own, orc = set(Q.QUERIES), E.oracle_sql()
    assert own <= set(E.queries())
    assert own - set(orc) == ROWS_ONLY
    df = E.entry(spark)
    assert df.count() > 0


def _duck():
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


FAST = ["clean_corpus", "normalize_text", "dedupe_norm", "label_needs", "unseen_items", "balance_full",
        "keyword_filter", "frontier_urls", "page_links", "feed_items", "profile_report", "csv_roundtrip"]


def test_oracles_small(spark):
    con = _duck()
    qs, orc = E.queries(), E.oracle_sql()
    for name in FAST:
        df = qs[name](spark, SF_SMALL)
        cols = sorted(df.columns)
        got = sorted(tuple(r[c] for c in cols) for r in df.collect())
        res = con.execute(orc[name])
        names = [d[0] for d in res.description]
        want = sorted(tuple(row[names.index(c)] for c in cols) for row in res.fetchall())
        assert got == want, name


def test_no_python_outside_extraction(spark):
    qs = E.queries()
    for name in ["dedupe_norm", "balance_full", "unseen_items", "keyword_filter", "profile_report", "feed_items"]:
        p = _plan(qs[name](spark, SF_SMALL))
        assert "EvalPython" not in p and "MapInPandas" not in p, name
    assert "MapInPandas" in _plan(qs["page_links"](spark, SF_SMALL))


def test_window_group_limit_and_pushdown(spark, tmp_path):
    from corpusforge.operators.clean import filter_labels
    from corpusforge.operators.profile import head_per_group

    df = spark.createDataFrame([(i, f"t{i}", "AB"[i % 2]) for i in range(50)], "row_id long, text string, label string")
    path = str(tmp_path / "c")
    df.write.parquet(path)
    scan = filter_labels(spark.read.parquet(path), ["A"]).select("text")
    s = _plan(scan)
    assert "PushedFilters: [IsNotNull(label), EqualTo(label,A)]" in s
    assert "ReadSchema: struct<text:string,label:string>" in s
    assert "WindowGroupLimit" in _plan(head_per_group(spark.read.parquet(path), 3))


def test_no_single_partition_over_rows(spark):
    """Scale check: outside the fold's page-level table, no query funnels
    its rows through one partition (global windows / sorts)."""
    qs = E.queries()
    for name in ["clean_corpus", "dedupe_norm", "dedupe_text", "unseen_items", "balance_full", "job_balance",
                 "samples_per_label", "keyword_filter", "label_needs", "merge_tolerant", "feed_items",
                 "page_links", "page_headings", "category_members", "profile_report", "shuffle_seeded"]:
        lines = _plan(qs[name](spark, SF_SMALL)).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                # Only the final step of a global aggregate (one partial row
                # per partition) may gather into one partition.
                assert "Aggregate" in lines[i - 1], (name, lines[i - 1])
