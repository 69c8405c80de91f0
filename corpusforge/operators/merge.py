"""Union of corpus parts (U1-U3) with explicit order columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_order(df: DataFrame, part_no: int, row_id_col: str = "row_id") -> DataFrame:
    """Attach ``part_no`` and make sure a ``row_id`` exists.

    A part read straight from one file without a ``row_id`` gets
    ``monotonically_increasing_id()`` right after the scan, before any
    shuffle, where it follows file order (split index, then row).
    """
    if row_id_col not in df.columns:
        df = df.withColumn(row_id_col, F.monotonically_increasing_id())
    return df.withColumn("part_no", F.lit(part_no).cast("int"))


def union_parts(parts: Sequence[DataFrame], start_part: int = 0) -> DataFrame:
    """Row-wise concat aligned by name, missing columns null, each input
    tagged with its position.  Bag semantics (U3: a part already contained
    in another is *not* removed)."""
    if not parts:
        raise ValueError("union_parts needs at least one part")
    out = None
    for i, p in enumerate(parts):
        p = with_order(p, start_part + i)
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def union_distinct_text(parts: Sequence[DataFrame]) -> DataFrame:
    """Concat then keep-first by raw text."""
    from corpusforge.operators.dedupe import dedupe_text

    return dedupe_text(union_parts(parts))
