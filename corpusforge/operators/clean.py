"""Cleaning and projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import strip_ws, text_len


class MissingColumnsError(ValueError):
    """The corpus lacks a required column."""


def require_columns(df: DataFrame, cols: Sequence[str] = ("text", "label")) -> None:
    """Checked when the plan is built, before any job runs."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"Input must contain {', '.join(repr(c) for c in cols)} columns; missing {missing}")


def add_default_columns(df: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    """Add ``source=''`` / ``url=''`` when absent (existing nulls stay)."""
    defaults = {"source": "", "url": ""} if defaults is None else defaults
    for c, v in defaults.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(v))
    return df


def clean_corpus(
    df: DataFrame,
    text_col: str = "text",
    label_col: str = "label",
    min_len_exclusive: int | None = 5,
    add_defaults: bool = True,
) -> DataFrame:
    """P18 -> P4 -> P2 -> P3 -> P17 (``ensure_columns``).

    Drops rows with null text/label, strips both (Python white space), keeps
    ``len(text) > min_len_exclusive`` (``None`` skips the length filter, as
    the encyclopedia stage does).  Narrow projection-friendly: only the two
    touched columns are rewritten, so Parquet pruning is unaffected.
    """
    require_columns(df, (text_col, label_col))
    out = (
        df.filter(F.col(text_col).isNotNull() & F.col(label_col).isNotNull())
        .withColumn(text_col, strip_ws(text_col))
        .withColumn(label_col, strip_ws(label_col))
    )
    if min_len_exclusive is not None:
        out = out.filter(text_len(text_col) > min_len_exclusive)
    return add_default_columns(out) if add_defaults else out


def project(df: DataFrame, cols: Sequence[str] = ("text", "label")) -> DataFrame:
    """P15."""
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Sequence[str] = ("url",)) -> DataFrame:
    """P16."""
    return df.drop(*cols)


def pick_column(df: DataFrame, candidates: Sequence[str] = ("source", "website")) -> str | None:
    """First of ``candidates`` present in the frame, else ``None``."""
    for c in candidates:
        if c in df.columns:
            return c
    return None


def filter_labels(df: DataFrame, labels: Sequence[str], label_col: str = "label") -> DataFrame:
    """Equality / ``isin`` label filter (pushed to the scan)."""
    if len(labels) == 1:
        return df.filter(F.col(label_col) == labels[0])
    return df.filter(F.col(label_col).isin(list(labels)))


def parse_labels(spec: str) -> list[str]:
    """Comma-separated label list, items stripped, empties dropped."""
    return [x.strip() for x in spec.split(",") if x.strip()]
