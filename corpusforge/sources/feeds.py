"""RSS / Atom feed items (S9, E8, E9, P9, P10, W10) with ``from_xml``.

A captured feed table ``(…keys, xml)`` is parsed JVM-side; malformed or
non-XML text gives a null record (no items), never a failed job.  Items are
those of every channel, in order, then those at the root; any namespace
prefix will do.  Of a repeated child the first counts, and of text with
markup inside, the text before the markup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import classify_label, cut_first_hyphen, looks_like_xml, strip_ws

_TEXTS = "ARRAY<STRUCT<_VALUE: ARRAY<STRING>>>"  # a child's occurrences, each with its pieces of text
_ITEMS = f"ARRAY<STRUCT<title: {_TEXTS}, link: {_TEXTS}, pubDate: {_TEXTS}>>"
FEED_SCHEMA = (
    f"channel ARRAY<STRUCT<item: {_ITEMS}>>, item {_ITEMS}, entry ARRAY<STRUCT<title: {_TEXTS}, updated: {_TEXTS}>>"
)


def _first_text(child: Column) -> Column:
    return F.get(F.get(child, 0)["_VALUE"], 0)


def feed_entries(feeds: DataFrame, key_cols: Sequence[str], xml_col: str = "xml",
                 max_items: int | None = None) -> DataFrame:
    """Sniff (P10), parse, take RSS ``item``s or else Atom ``entry``s, keep the
    first ``max_items`` *before* any filter (W10); one row per entry with
    ``item_no`` (1-based), raw ``title``, ``link`` (Atom: ``""``), ``published``."""
    parsed = F.from_xml(F.col(xml_col), FEED_SCHEMA, {"ignoreNamespace": "true"})
    none = F.from_json(F.lit("[]"), _ITEMS)
    in_channels = F.flatten(F.transform(parsed["channel"], lambda c: F.coalesce(c["item"], none)))
    rss = F.transform(
        F.concat(F.coalesce(in_channels, none), F.coalesce(parsed["item"], none)),
        lambda it: F.struct(_first_text(it["title"]).alias("title"),
                            F.coalesce(_first_text(it["link"]), F.lit("")).alias("link"),
                            _first_text(it["pubDate"]).alias("published")),
    )
    atom = F.transform(
        parsed["entry"],
        lambda it: F.struct(_first_text(it["title"]).alias("title"), F.lit("").alias("link"),
                            _first_text(it["updated"]).alias("published")),
    )
    items: Column = F.when(F.size(rss) > 0, rss).otherwise(atom)
    items = F.when(looks_like_xml(F.col(xml_col)), items)
    if max_items is not None:
        items = F.slice(items, 1, max_items)
    return feeds.select(*key_cols, F.posexplode(items).alias("_i", "_it")).select(
        *key_cols,
        (F.col("_i") + 1).cast("long").alias("item_no"),
        F.col("_it.title").alias("title"),
        F.col("_it.link").alias("link"),
        F.col("_it.published").alias("published"),
    )


def feed_items(
    feeds: DataFrame,
    key_cols: Sequence[str],
    fixed_label: str | None = None,
    first_kw: Sequence[str] = (),
    second_kw: Sequence[str] = (),
    max_items: int | None = None,
    min_len: int = 12,
    xml_col: str = "xml",
) -> DataFrame:
    """Stripped title with ``len >= min_len``, label fixed or by keyword
    vote (P7), ``Other`` dropped; ``url`` = RSS link (Atom: ``""``),
    ``published`` = pubDate / updated, stripped, kept as text."""
    e = feed_entries(feeds, key_cols, xml_col, max_items)
    title = strip_ws(F.coalesce(F.col("title"), F.lit("")))
    label = F.lit(fixed_label) if fixed_label else classify_label(title, first_kw, second_kw)
    return (
        e.select(
            *key_cols, "item_no", title.alias("text"), label.alias("label"),
            strip_ws(F.col("link")).alias("url"),
            strip_ws(F.coalesce(F.col("published"), F.lit(""))).alias("published"),
        )
        .filter(F.length("text") >= min_len)
        .filter(F.col("label") != "Other")
    )


def search_feed_titles(feeds: DataFrame, key_cols: Sequence[str], min_len_exclusive: int = 15,
                       xml_col: str = "xml") -> DataFrame:
    """Every item; the title is cut at its first ``-`` and stripped;
    keep ``len > min_len_exclusive``.  An item without a title yields no row
    (the reference aborts the rest of that feed: documented difference)."""
    e = feed_entries(feeds, key_cols, xml_col)
    return (
        e.filter(F.col("title").isNotNull())
        .select(*key_cols, "item_no", cut_first_hyphen(F.col("title")).alias("text"))
        .filter(F.length("text") > min_len_exclusive)
    )
