from corpusforge.operators.dedupe import dedupe_norm, dedupe_text, dedupe_text_url, seen_set, unseen
from corpusforge.operators.merge import union_distinct_text, union_parts
from corpusforge.functions.text import norm_key


def test_keep_first_across_labels_and_parts(spark):
    p0 = spark.createDataFrame([(1, "Same  Title", "Sports"), (2, "other", "World")], "row_id long, text string, label string")
    p1 = spark.createDataFrame([(0, "same title", "Economy"), (1, "new one", "Economy")], "row_id long, text string, label string")
    u = union_parts([p0, p1])
    got = sorted((r.part_no, r.row_id, r.label) for r in dedupe_norm(u).collect())
    # the same norm under two labels survives once, earliest part/row wins
    assert got == [(0, 1, "Sports"), (0, 2, "World"), (1, 1, "Economy")]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "t", "L", "u")], "row_id long, text string, label string, url string")
    b = spark.createDataFrame([(1, "t2", "L")], "row_id long, text string, label string")
    rows = {r.part_no: r.url for r in union_parts([a, b]).collect()}
    assert rows == {0: "u", 1: None}


def test_text_url_null_safe(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (2, "a", None), (3, "a", "u"), (4, None, None), (5, None, None)],
        "row_id long, text string, url string",
    )
    assert sorted(r.row_id for r in dedupe_text_url(df, order_cols=("row_id",)).collect()) == [1, 3, 4]
    assert sorted(r.row_id for r in dedupe_text(df, order_cols=("row_id",)).collect()) == [1, 4]


def test_unseen(spark):
    base = spark.createDataFrame([("Hello World",)], "text string")
    items = spark.createDataFrame([("hello   world",), ("fresh",)], "title string").withColumn("nkey", norm_key("title"))
    assert [r.title for r in unseen(items, seen_set(base)).collect()] == ["fresh"]


def test_union_distinct_text_keeps_the_earliest_part(spark):
    a = spark.createDataFrame([(2, "t", "L"), (1, "t", "K"), (3, "T", "L")], "row_id long, text string, label string")
    b = spark.createDataFrame([(0, "t", "M"), (1, "new", None), (2, None, "L"), (3, None, "M")], "row_id long, text string, label string")
    got = sorted((r.part_no, r.row_id, r.text) for r in union_distinct_text([a, b]).collect())
    assert got == [(0, 1, "t"), (0, 3, "T"), (1, 1, "new"), (1, 2, None)]
