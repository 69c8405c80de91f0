"""Class balancing and seeded shuffles.

Randomness is a hash of ``(seed, row identity)`` so a retried task, a rerun
or a different ``spark.sql.shuffle.partitions`` gives the same rows.

Scale notes (few labels, many rows): no window holds a label.  Rows fall into
buckets that respect the order asked for (a prefix of the md5 key, or a range
of ``row_id``); buckets are counted, and running sums over the counts say
where each bucket begins.

* Down-sampling keeps whole buckets as they are scanned, with no shuffle, and
  ranks only the one bucket of each label in which the target falls.
* Over-sampling only touches labels with fewer rows than the target; a row's
  number is its bucket's beginning plus its rank inside the bucket.
* ``reindex`` numbers a whole shuffled table the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.operators.profile import value_counts

DEFAULT_SEED = 42
KEY_DIGITS = 4  # of the md5 key, for the buckets of a label
INDEX_DIGITS = 3  # of the shuffle key, for the buckets of a whole table
RANGES = 256  # of row_id


def _md5_key(seed: int, *parts: Column) -> Column:
    pieces: list[Column] = [F.lit(str(seed))]
    for p in parts:
        pieces += [F.lit(":"), p.cast("string")]
    return F.md5(F.concat(*pieces))


def _hex_to_long(h: Column) -> Column:
    """60 bits: no label has so many rows that some could not be drawn, and the
    remainders are as good as even."""
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def order_key(seed: int = DEFAULT_SEED, id_col: str = "row_id") -> Column:
    """Per-row seeded order: ``md5('<seed>:<row_id>')``."""
    return _md5_key(seed, F.col(id_col))


def shuffle(df: DataFrame, seed: int = DEFAULT_SEED, id_cols: Sequence[str] = ("row_id",),
            key_name: str = "shuffle_key") -> DataFrame:
    """L3/L4: seeded shuffle.  The order is stored as a column (sort by it
    to read the shuffled order); no global single-partition sort is run."""
    return df.withColumn(key_name, _md5_key(seed, *[F.col(c) for c in id_cols]))


def _counts(df: DataFrame, label_col: str) -> dict[str, int]:
    # One row per label: a tiny, bounded collect that sizes the plan.
    return {r[0]: int(r[1]) for r in value_counts(df, label_col, "n").collect()}


def _begun(sizes: DataFrame, by: Sequence[str], bucket: str) -> DataFrame:
    """``sizes(by..., bucket, n)`` with ``before``: the rows in earlier buckets.
    The window runs over bucket counts, never over rows."""
    w = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)).cast("long"))


def down_sample(
    df: DataFrame,
    target: int,
    seed: int = DEFAULT_SEED,
    label_col: str = "label",
    counts: dict[str, int] | None = None,
) -> DataFrame:
    """B1: for labels with ``n >= target`` keep the ``target`` rows first in
    ``md5(seed:row_id)`` order (without replacement)."""
    counts = _counts(df, label_col) if counts is None else counts
    big = [l for l, n in counts.items() if n >= target]
    if not big or target <= 0:
        return df.limit(0).withColumn("draw", F.lit(0).cast("long"))
    keyed = df.filter(F.col(label_col).isin(big)).withColumn("_k", order_key(seed))
    keyed = keyed.withColumn("_b", F.substring("_k", 1, KEY_DIGITS))
    sizes = keyed.groupBy(label_col, "_b").agg(F.count(F.lit(1)).alias("n"))
    # The bucket in which the target falls: one row per label.
    edges = _begun(sizes, [label_col], "_b").filter((F.col("before") < target) & (F.col("before") + F.col("n") >= target))
    edge = room = None
    for r in edges.collect():
        here = F.col(label_col) == r[label_col]
        edge = F.when(here, F.lit(r["_b"])) if edge is None else edge.when(here, F.lit(r["_b"]))
        left = F.lit(target - r["before"])
        room = F.when(here, left) if room is None else room.when(here, left)
    whole = keyed.filter(F.col("_b") < edge)
    w = Window.partitionBy(label_col, "_b").orderBy("_k", "row_id")
    cut = keyed.filter(F.col("_b") == edge).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= room).drop("_rn")
    return whole.unionByName(cut).drop("_k", "_b").withColumn("draw", F.lit(0).cast("long"))


def _numbered(df: DataFrame, label_col: str) -> DataFrame:
    """``df`` with ``_rn``: the number of each row in its label, from 1, in
    ``row_id`` order.  Buckets are ranges of ``row_id`` that hold about equally
    many rows of all labels together."""
    parts = [F.lit(i / RANGES) for i in range(1, RANGES)]
    cuts = df.agg(F.percentile_approx("row_id", F.array(*parts)).alias("cuts")).first()["cuts"] or []  # RANGES numbers
    cuts = F.array(*[F.lit(c) for c in sorted(set(cuts))])
    ranged = df.withColumn("_b", F.size(F.filter(cuts, lambda c: c <= F.col("row_id"))))
    sizes = ranged.groupBy(label_col, "_b").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(label_col, "_b").orderBy("row_id")
    return (
        ranged.withColumn("_rk", F.row_number().over(w))
        .join(_begun(sizes, [label_col], "_b"), [label_col, "_b"])
        .withColumn("_rn", F.col("before") + F.col("_rk"))
        .drop("_b", "_rk", "n", "before")
    )


def reindex(df: DataFrame, key: str = "shuffle_key", ties: Sequence[str] = ("row_id",), name: str = "row_no") -> DataFrame:
    """The 0-based position of each row in the order of its (hexadecimal)
    ``key``, rows of equal keys in the order of ``ties``."""
    bucketed = df.withColumn("_b", F.substring(key, 1, INDEX_DIGITS))
    sizes = bucketed.groupBy("_b").agg(F.count(F.lit(1)).alias("n"))
    begun, at = [], 0
    for r in sizes.orderBy("_b").collect():  # at most 16 ** INDEX_DIGITS counts
        begun.append((r["_b"], at))
        at += r["n"]
    offsets = df.sparkSession.createDataFrame(begun, "_b string, _before long")
    rank = F.row_number().over(Window.partitionBy("_b").orderBy(key, *ties))
    return (
        bucketed.withColumn("_rk", rank).join(F.broadcast(offsets), "_b")
        .withColumn(name, F.col("_before") + F.col("_rk") - 1).drop("_b", "_rk", "_before")
    )


def over_sample(
    df: DataFrame,
    target: int,
    seed: int = DEFAULT_SEED,
    label_col: str = "label",
    counts: dict[str, int] | None = None,
) -> DataFrame:
    """B2: for labels with ``0 < n < target``, ``target`` draws with
    replacement; draw ``d`` takes row ``md5(seed:label:d) mod n + 1`` of the
    label in ``row_id`` order (J4).  Originals are not guaranteed to appear;
    ``draw`` makes repeats visible."""
    counts = _counts(df, label_col) if counts is None else counts
    small = {l: n for l, n in counts.items() if 0 < n < target}
    spark = df.sparkSession
    if not small:
        return df.limit(0).withColumn("draw", F.lit(0).cast("long"))
    # One range per label: no array of ``target`` draws, so no limit on it.
    draws = None
    for l, n in small.items():
        own = spark.range(1, target + 1).select(F.lit(l).alias(label_col), F.col("id").alias("draw"), F.lit(n).cast("long").alias("n"))
        draws = own if draws is None else draws.unionByName(own)
    draws = draws.withColumn(
        "_rn", F.pmod(_hex_to_long(_md5_key(seed, F.col(label_col), F.col("draw"))), F.col("n")) + 1
    ).select(label_col, "draw", "_rn")
    rows = _numbered(df.filter(F.col(label_col).isin(list(small))), label_col)
    return rows.join(draws, [label_col, "_rn"], "inner").drop("_rn")


def balance(
    df: DataFrame,
    target: int,
    seed: int = DEFAULT_SEED,
    label_col: str = "label",
) -> DataFrame:
    """B1 for big labels, B2 for small ones, then the seeded shuffle key.
    Contract: exactly ``target`` rows for every label present."""
    counts = _counts(df, label_col)
    out = down_sample(df, target, seed, label_col, counts).unionByName(over_sample(df, target, seed, label_col, counts))
    return shuffle(out, seed, ("row_id", "draw"))


class NotEnoughRowsError(ValueError):
    """Some label has fewer rows than the target."""


def balance_strict(
    df: DataFrame,
    target: int,
    labels: Sequence[str] | None = None,
    seed: int = DEFAULT_SEED,
    label_col: str = "label",
) -> DataFrame:
    """B4 (with P14): keep the listed labels; raise if any has fewer than
    ``target`` rows, else down-sample each to ``target`` and shuffle."""
    if labels is not None:
        df = df.filter(F.col(label_col).isin(list(labels)))
    counts = _counts(df, label_col)
    want = list(labels) if labels is not None else list(counts)
    short = [f"{l} ({counts.get(l, 0)})" for l in want if counts.get(l, 0) < target]
    if short:
        raise NotEnoughRowsError(f"Not enough rows for target {target}: {', '.join(short)}")
    return shuffle(down_sample(df, target, seed, label_col, counts), seed, ("row_id", "draw"))
