import pytest
from pyspark.sql import functions as F

from corpusforge.operators.balance import NotEnoughRowsError, balance, balance_strict, down_sample, over_sample, reindex, shuffle


def _corpus(spark, sizes):
    rows, rid = [], 0
    for label, n in sizes.items():
        for i in range(n):
            rows.append((rid, f"{label} text {i}", label))
            rid += 1
    return spark.createDataFrame(rows, "row_id long, text string, label string")


def test_exact_target_per_label(spark):
    df = _corpus(spark, {"A": 50, "B": 20, "C": 19, "D": 1})
    out = balance(df, 20, seed=42)
    counts = {r[0]: r[1] for r in out.groupBy("label").count().collect()}
    assert counts == {"A": 20, "B": 20, "C": 20, "D": 20}
    # A (above) and B (equal) are sampled without replacement
    assert out.filter(F.col("label").isin("A", "B")).select("row_id").distinct().count() == 40
    assert out.filter(F.col("label") == "D").select("row_id").distinct().count() == 1


def test_deterministic_across_partitionings(spark):
    df = _corpus(spark, {"A": 300, "B": 40})
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    a = sorted(tuple(r) for r in balance(df, 100, seed=7).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    b = sorted(tuple(r) for r in balance(df.repartition(5), 100, seed=7).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a == b
    c = sorted(tuple(r) for r in balance(df, 100, seed=8).collect())
    assert a != c


def test_strict(spark):
    df = _corpus(spark, {"A": 30, "B": 10})
    with pytest.raises(NotEnoughRowsError, match="B"):
        balance_strict(df, 20, ["A", "B"])
    with pytest.raises(NotEnoughRowsError, match="Z"):
        balance_strict(df, 5, ["A", "Z"])
    out = balance_strict(df, 10, ["A", "B"])
    assert {r[0]: r[1] for r in out.groupBy("label").count().collect()} == {"A": 10, "B": 10}


def test_no_window_holds_a_label(spark):
    df = _corpus(spark, {"A": 50, "B": 5})
    for out in (down_sample(df, 20), over_sample(df, 20)):
        windows = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "row_number()" in x and "Window" in x]
        assert windows and all("_b#" in x.split("windowspecdefinition(")[1].split(" ASC")[0] for x in windows)


def test_same_rows_as_one_window_over_each_label(spark):
    df = _corpus(spark, {"A": 700, "B": 40, "C": 1})
    key = F.md5(F.concat(F.lit("5:"), F.col("row_id").cast("string")))
    order = {}
    for r in df.withColumn("k", key).sort("k").collect():
        order.setdefault(r["label"], []).append(r["row_id"])
    got = down_sample(df, 33, seed=5).select("label", "row_id").collect()
    assert sorted(tuple(r) for r in got) == sorted((x, i) for x in "AB" for i in order[x][:33])


def test_rows_are_numbered_in_shuffled_order(spark):
    df = shuffle(_corpus(spark, {"A": 300, "B": 9}), 3)
    rows = reindex(df).collect()
    assert [r["row_id"] for r in sorted(rows, key=lambda r: r["row_no"])] == [r["row_id"] for r in df.sort("shuffle_key", "row_id").collect()]
    assert sorted(r["row_no"] for r in rows) == list(range(309))
    assert reindex(df.limit(0)).count() == 0
