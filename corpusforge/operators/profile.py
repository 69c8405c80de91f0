"""Profiling (A1-A8, A12, A13, L2) as distributed aggregates.

Everything here is an aggregate with map-side partial combine; nothing is
iterated on the driver except the (tiny) schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions.text import clamp_need


def value_counts(df: DataFrame, col: str = "label", count_name: str = "count") -> DataFrame:
    """A1: count per value, nulls excluded (``value_counts``); sort with
    ``orderBy(desc(count), col)`` when printing."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(count_name))


def distinct_count(df: DataFrame, col: str = "label", name: str | None = None) -> DataFrame:
    """A2: ``nunique()`` (nulls excluded)."""
    return df.agg(F.count_distinct(F.col(col)).alias(name or f"n_{col}"))


def distinct_values(df: DataFrame, col: str = "label", order_col: str = "row_id") -> DataFrame:
    """A3: ``unique()``: null kept, with the first-appearance position so the
    reference order is ``orderBy(first_row)``."""
    return df.groupBy(col).agg(F.min(order_col).alias("first_row"))


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """A4."""
    return df.agg(F.count(F.lit(1)).alias(name))


def null_profile(df: DataFrame) -> DataFrame:
    """A5: ``isnull().sum()`` for every column in one pass, unpivoted to
    ``(column_name, nulls)``; ``col_pos`` keeps the frame's column order."""
    cols = df.columns
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(f"c{i}") for i, c in enumerate(cols)])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.lit(i).cast("long").alias("col_pos"),
                      F.coalesce(F.col(f"c{i}"), F.lit(0).cast("long")).alias("nulls"))
             for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def null_summary(df: DataFrame) -> DataFrame:
    """Total nulls and the ``no nulls`` flag."""
    return null_profile(df).agg(
        F.sum("nulls").cast("long").alias("total_nulls"),
        (F.sum("nulls") == 0).alias("no_nulls"),
    )


def null_columns(df: DataFrame) -> DataFrame:
    """Columns having nulls."""
    return null_profile(df).filter(F.col("nulls") > 0)


def frame_summary(df: DataFrame) -> DataFrame:
    """``info()``: per column dtype, non-null count and row count."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.lit(i).cast("long").alias("col_pos"),
                      F.lit(types[c]).alias("dtype"), F.col(f"c{i}").alias("non_null"))
             for i, c in enumerate(cols)]
    return wide.select(F.col("_rows").alias("rows"), F.explode(F.array(*pairs)).alias("p")).select("p.*", "rows")


def head_per_group(df: DataFrame, n: int, group_col: str = "label", order_col: str = "row_id") -> DataFrame:
    """L2: first ``n`` rows per group in row order (``df[df.label==x].head(n)``).

    ``row_number() <= n`` is planned with a ``WindowGroupLimit`` below the
    shuffle, so each map task forwards at most ``n`` rows per group: a
    group holding a third of the data does not make one hot task.
    """
    w = Window.partitionBy(group_col).orderBy(order_col)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def head(df: DataFrame, n: int, order_col: str = "row_id") -> DataFrame:
    """L2 (frame form): ``orderBy(row_id).limit(n)`` -> TakeOrderedAndProject."""
    return df.orderBy(order_col).limit(n)


def count_if_label(df: DataFrame, label: str, label_col: str = "label", name: str = "n") -> DataFrame:
    """A12."""
    return df.agg(F.count_if(F.col(label_col) == label).alias(name))


def label_needs(
    df: DataFrame,
    labels: Sequence[str],
    target: int,
    label_col: str = "label",
) -> DataFrame:
    """A9 = J3 + P22: ``(label, have, need)`` for each requested label.

    The requested labels are a literal frame (<= tens of rows), the counts
    an aggregate; the result is tiny and may be collected to drive the fold.
    """
    spark = df.sparkSession
    req = spark.createDataFrame([(i, l) for i, l in enumerate(labels)], "label_pos long, label string")
    # Filtered to the requested labels before the join: the counts side
    # then has at most len(labels) rows, a proven bound for the broadcast.
    counts = value_counts(df.filter(F.col(label_col).isin(list(labels))), label_col, "have").withColumnRenamed(
        label_col, "label"
    )
    return (
        req.join(F.broadcast(counts), "label", "left")
        .select("label_pos", "label", F.coalesce("have", F.lit(0)).cast("long").alias("have"))
        .withColumn("need", clamp_need(F.lit(target).cast("long"), "have"))
    )


def shortfall(df: DataFrame, labels: Sequence[str], target: int, label_col: str = "label") -> DataFrame:
    """Labels still short of the target after a run."""
    return label_needs(df, labels, target, label_col).filter(F.col("need") > 0)


def profile_report(
    df: DataFrame,
    label_col: str = "label",
    source_col: str = "source",
    order_col: str = "row_id",
    sample_labels: Sequence[str] = ("Politics", "World", "Sports", "Economy"),
    n_samples: int = 5,
) -> DataFrame:
    """K19 as one long table ``(metric, key, value)``: row count, distinct
    labels/sources with their first rows, per-column nulls, their total and
    the number of columns with nulls, and the first rows of each sampled
    label.

    One aggregate by ``(label, source)`` reads the data; everything but the
    samples follows from its rows (labels x sources at most), whose shuffle
    Spark reuses.  The per-label samples are a second pass with
    ``WindowGroupLimit``.
    """
    cols = df.columns
    g = df.groupBy(label_col, source_col).agg(
        F.min(order_col).alias("first_row"),
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(c).isNull().cast("long")).alias(f"_null{i}") for i, c in enumerate(cols)],
    )

    def row(metric: str, key, value) -> Column:
        return F.struct(F.lit(metric).alias("metric"), key.cast("string").alias("key"), value.cast("long").alias("value"))

    def first_rows(col: str, metric: str) -> DataFrame:
        firsts = g.groupBy(col).agg(F.min("first_row").alias("first_row"))
        return firsts.select(row(metric, F.col(col), F.col("first_row")).alias("r")).select("r.*")

    totals = g.agg(
        F.sum("n").alias("n"), F.count_distinct(label_col).alias("n_labels"), F.count_distinct(source_col).alias("n_sources"),
        *[F.sum(f"_null{i}").alias(f"_null{i}") for i in range(len(cols))],
    )
    nulls = [F.coalesce(F.col(f"_null{i}"), F.lit(0)) for i in range(len(cols))]
    whole = totals.select(F.explode(F.array(
        row("rows", F.lit(""), F.coalesce("n", F.lit(0))),
        row("n_labels", F.lit(""), F.col("n_labels")),
        row("n_sources", F.lit(""), F.col("n_sources")),
        *[row("nulls", F.lit(c), nulls[i]) for i, c in enumerate(cols)],
        row("total_nulls", F.lit(""), sum(nulls[1:], nulls[0])),
        row("columns_with_nulls", F.lit(""), sum(((x > 0).cast("long") for x in nulls[1:]), (nulls[0] > 0).cast("long"))),
    )).alias("r")).select("r.*")
    aggs = whole.unionByName(first_rows(label_col, "label_first_row")).unionByName(first_rows(source_col, "source_first_row"))
    w = Window.partitionBy(label_col).orderBy(order_col)
    samples = (
        df.filter(F.col(label_col).isin(list(sample_labels)))
        .select(label_col, order_col, F.row_number().over(w).alias("_rn"))
        .filter(F.col("_rn") <= n_samples)
        .select(row("sample", F.concat(F.col(label_col), F.lit(":"), F.col("_rn").cast("string")), F.col(order_col)).alias("r"))
        .select("r.*")
    )
    return aggs.unionByName(samples)
