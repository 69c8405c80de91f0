"""Keep-first de-duplication and seen-set membership.

Keep-first is an aggregate ``min_by(row, order)`` per key, never a window
partitioned by the key: the aggregate combines map-side, so a key shared by
a third of all rows is reduced inside every map task before the shuffle.
``dropDuplicates`` is not used because it keeps an arbitrary row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import norm_key


def keep_first(
    df: DataFrame,
    keys: Sequence[str | Column],
    order_cols: Sequence[str] = ("part_no", "row_id"),
) -> DataFrame:
    """Keep the first row (by ``order_cols``) of every key.

    Null keys are equal to each other (pandas ``drop_duplicates``), which is
    what ``groupBy`` does.  Column order of the input is kept.
    """
    cols = df.columns
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    key_names = [f"_k{i}" for i in range(len(key_cols))]
    keyed = df.select(*[c.alias(n) for c, n in zip(key_cols, key_names)], *cols)
    order = F.struct(*[F.col(c) for c in order_cols])
    row = F.struct(*[F.col(c) for c in cols])
    return keyed.groupBy(*key_names).agg(F.min_by(row, order).alias("_r")).select("_r.*")


def dedupe_norm(df: DataFrame, text_col: str = "text", order_cols: Sequence[str] = ("part_no", "row_id")) -> DataFrame:
    """Keep-first by normalised text across all labels and sources.

    The shuffle key is ``sha2(norm)`` (fixed 64 bytes) instead of the long
    text itself.
    """
    return keep_first(df, [norm_key(text_col)], order_cols)


def dedupe_text(df: DataFrame, text_col: str = "text", order_cols: Sequence[str] = ("part_no", "row_id")) -> DataFrame:
    """Keep-first by raw text (case-sensitive, nulls equal).  The
    shuffle key is ``sha2(text)`` (null stays null, so nulls group)."""
    return keep_first(df, [F.sha2(F.col(text_col), 256)], order_cols)


def dedupe_text_url(df: DataFrame, order_cols: Sequence[str] = ("part_no", "row_id")) -> DataFrame:
    """D3: keep-first by ``(text, url)``, null-safe."""
    return keep_first(df, [F.sha2(F.col("text"), 256), "url"], order_cols)


def dedupe_text_label(df: DataFrame, order_cols: Sequence[str] = ("part_no", "row_id")) -> DataFrame:
    """Keep-first by ``(text, label)``."""
    return keep_first(df, [F.sha2(F.col("text"), 256), "label"], order_cols)


def seen_set(df: DataFrame, text_col: str = "text") -> DataFrame:
    """A10: distinct normalised texts, as their fixed-width key ``nkey``."""
    return df.select(norm_key(text_col).alias("nkey")).distinct()


def unseen(items: DataFrame, seen: DataFrame, norm_col: str = "nkey") -> DataFrame:
    """Items whose normalised title is not in ``seen`` (left anti join;
    AQE turns it into a broadcast join when the seen side is small at run
    time, a shuffled hash/sort-merge join otherwise)."""
    return items.join(seen.select(F.col(norm_col)), norm_col, "left_anti")


def dedupe_in_page(items: DataFrame, page_keys: Sequence[str] = ("source", "page_no")) -> DataFrame:
    """First occurrence of ``(title, href)`` inside each page (hashed
    keys: titles can be long; null hashes to null, so nulls still group)."""
    return keep_first(items, [*page_keys, F.sha2(F.col("title"), 256), F.sha2(F.col("href"), 256)],
                      order_cols=("pos",))
