"""Extraction jobs: captured pages / feeds -> items.

One Python stage (``mapInPandas``, Arrow batches) parses pages and emits one
row per selector match; every rule after that (length filters, tiers,
first-of, dedupe, URL prefixing) is a Spark built-in.  The page table is
processed in its own partitions, so the work spreads with the number of
pages; a worker holds one batch of pages and ``HELD`` characters of matches,
of which one page can have many times its size (elements inside each other).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark import cloudpickle

import corpusforge
from corpusforge.functions import html as _html
from corpusforge.functions.text import contains_none, path_accepted, strip_ws
from corpusforge.operators.dedupe import dedupe_in_page, keep_first
from corpusforge.session import spread

# The parser helper travels to the Python workers by value: executors need
# neither this repository on their path nor an installed package.
cloudpickle.register_pickle_by_value(corpusforge)

HIT_FIELDS = [
    T.StructField("sel_idx", T.IntegerType()),
    T.StructField("doc_pos", T.LongType()),
    T.StructField("text_spaced", T.StringType()),
    T.StructField("text_joined", T.StringType()),
    T.StructField("text_whole", T.StringType()),
    T.StructField("href", T.StringType()),
    T.StructField("end_pos", T.LongType()),
]
HELD = 2 << 20  # characters of matches that a worker sends on together
TEXT_MODES = {"spaced": "text_spaced", "joined": "text_joined", "whole": "text_whole"}


def _hit_rows(names: list[str], selectors: list[str], own: bool, union: bool, modes):
    """From batches of keys, html and, if ``own``, selectors: the matches, sent
    on whenever they hold ``HELD`` characters."""
    n = len(names) - len(HIT_FIELDS)

    def rows(batches):
        for pdf in batches:
            out, held = [], 0
            for page in pdf.itertuples(index=False, name=None):
                mine = selectors if not own or page[n + 1] is None or not len(page[n + 1]) else list(page[n + 1])
                wanted = [[modes]] * len(mine) if isinstance(modes, str) else modes
                for hit in _html.matches(page[n], mine, union, wanted):
                    out.append(page[:n] + hit)
                    held += 100 + sum(len(x) for x in hit[2:6] if x)
                    if held >= HELD:
                        yield pd.DataFrame(out, columns=names)
                        out, held = [], 0
            yield pd.DataFrame(out, columns=names)

    return rows


def html_matches(
    pages: DataFrame,
    key_cols: Sequence[str],
    selectors: Sequence[str] | str,
    union: bool = True,
    html_col: str = "html",
    modes: Sequence[Sequence[str]] | str | None = None,
) -> DataFrame:
    """Selector matches of every page: ``key_cols`` + ``HIT_FIELDS``.  A string
    as ``selectors`` names a column with each page's own list (null or empty:
    the default list).  ``modes``: the texts to be built (``TEXT_MODES``; null
    else), one mode for all selectors or a list for each; none: all of them."""
    from corpusforge.sources.registry import DEFAULT_SELECTORS

    keys = list(key_cols)
    own = selectors if isinstance(selectors, str) else None
    sels = DEFAULT_SELECTORS if own else list(selectors)
    read = [*keys, html_col, *([own] if own else [])]
    in_schema = pages.select(*keys).schema
    out_schema = T.StructType(list(in_schema.fields) + HIT_FIELDS)
    names = [f.name for f in out_schema.fields]

    # Parsing is CPU-bound Python: spread a small page table over all task
    # slots first (no-op for a large one).
    return spread(pages.select(*read)).mapInPandas(_hit_rows(names, sels, own is not None, union, modes), out_schema)


def extract_links(
    pages: DataFrame,
    key_cols: Sequence[str],
    selectors: Sequence[str] | str | None = None,
    min_len: int = 12,
    text_mode: str = "spaced",
    order_mode: str = "document",
    dedupe: bool = True,
    strict_len: bool = False,
    href_default: str | None = "",
) -> DataFrame:
    """``(keys..., pos, title, href)`` items of each page.

    * ``selectors`` empty -> the default heading/title-class list; a string
      names a column with each page's own list;
    * ``order_mode``: ``document`` (CSS union, E1) or ``selector`` (one
      selector after the other, E5);
    * ``text_mode``: ``spaced`` / ``joined`` / ``whole`` (E1 / E2 / E7);
    * keep ``len(title) >= min_len`` (``> min_len`` with ``strict_len``);
    * ``dedupe``: first ``(title, href)`` of each page (D4; off in E6).
    ``href`` is stripped; a missing one becomes ``href_default`` (``""`` as
    in E1, ``None`` keeps it null as the E6 scrapers do).
    """
    from corpusforge.sources.registry import DEFAULT_SELECTORS

    union = order_mode == "document"
    if order_mode not in ("document", "selector"):
        raise ValueError(f"Unknown order_mode: {order_mode}")
    m = html_matches(pages, key_cols, selectors or DEFAULT_SELECTORS, union, modes=text_mode)
    title = F.col(TEXT_MODES[text_mode])
    big = F.lit(1 << 32).cast("long")
    pos = F.col("doc_pos") if union else F.col("sel_idx").cast("long") * big + F.col("doc_pos")
    items = m.select(
        *key_cols,
        pos.alias("pos"),
        title.alias("title"),
        (strip_ws(F.col("href")) if href_default is None
         else F.coalesce(strip_ws(F.col("href")), F.lit(href_default))).alias("href"),
    )
    ln = F.length("title")
    items = items.filter((ln > min_len) if strict_len else (ln >= min_len)).filter(ln > 0)
    if dedupe:
        items = dedupe_in_page(items, key_cols)
    return items


@dataclass(frozen=True)
class LinkRule:
    """One way of taking items off a page (see ``extract_links``)."""

    name: str
    selectors: Sequence[str]
    min_len: int = 12
    text_mode: str = "spaced"
    order_mode: str = "document"
    dedupe: bool = True
    strict_len: bool = False


def extract_variants(pages: DataFrame, key_cols: Sequence[str], rules: Sequence[LinkRule]) -> DataFrame:
    """``(variant, keys..., pos, title, href)``: the items of several rules,
    each page being parsed once."""
    sels: list[str] = []
    owner: list[int] = []  # rule of each selector
    for i, r in enumerate(rules):
        mine = [", ".join(r.selectors)] if r.order_mode == "document" else list(r.selectors)
        sels += mine
        owner += [i] * len(mine)
    rule = F.get(F.array(*[F.lit(i) for i in owner]), F.col("sel_idx"))

    def of(values: Sequence) -> F.Column:
        return F.get(F.array(*[v if isinstance(v, F.Column) else F.lit(v) for v in values]), F.col("_rule"))

    big = F.lit(1 << 32).cast("long")
    m = html_matches(pages, key_cols, sels, union=False, modes=[[rules[i].text_mode] for i in owner]).withColumn("_rule", rule)
    items = m.select(
        of([r.name for r in rules]).alias("variant"), *key_cols,
        (F.col("sel_idx").cast("long") * big + F.col("doc_pos")).alias("pos"),
        of([F.col(TEXT_MODES[r.text_mode]) for r in rules]).alias("title"),
        F.coalesce(strip_ws(F.col("href")), F.lit("")).alias("href"),
        of([r.min_len + r.strict_len for r in rules]).alias("_least"), of([r.dedupe for r in rules]).alias("_dedupe"),
    )
    items = items.filter((F.length("title") >= F.col("_least")) & (F.length("title") > 0))
    # A rule that keeps repeats keys every item by its position.
    place = F.when(~F.col("_dedupe"), F.col("pos"))
    keys = ["variant", *key_cols, F.sha2(F.col("title"), 256), F.sha2(F.col("href"), 256), place]
    return keep_first(items, keys, order_cols=("pos",)).drop("_least", "_dedupe")


def links_by_source(
    pages: DataFrame, reg: DataFrame, text_mode: str = "spaced", order_mode: str = "document", href_default: str | None = ""
) -> DataFrame:
    """E1 for a crawl: raw items ``(priority, source, page_no, pos, title,
    href)`` of captured ``pages`` (``schema.PAGES``), by the selectors of each
    registry row that reads the page.  Pages with a ``priority`` column belong
    to that row alone, others to every row of their source name.  Only pages
    that were fetched (status 200) and lie in the row's range are parsed."""
    rows = reg.select("priority", F.col("name").alias("source"), "selectors", "start_page", "max_pages")
    on = ["priority"] if "priority" in pages.columns else ["source"]
    rows = rows.drop("source") if on == ["priority"] else rows
    mine = (
        pages.filter("http_status = 200").select(*on, *({"source", "page_no", "html"} - set(on))).join(rows, on)
        .filter(F.col("page_no").between(F.col("start_page"), F.col("max_pages")))
    )
    return extract_links(
        mine, ["priority", "source", "page_no"], "selectors", 0, text_mode, order_mode, dedupe=False, href_default=href_default
    )


def number_items(items: DataFrame, key_cols: Sequence[str], pos_col: str = "pos", name: str = "item_no") -> DataFrame:
    """Dense 1-based position of each item inside its page (window per page)."""
    w = Window.partitionBy(*key_cols).orderBy(pos_col)
    return items.withColumn(name, F.row_number().over(w).cast("long"))


def headings_with_fallback(
    pages: DataFrame,
    key_cols: Sequence[str],
    tiers: Sequence[str] = ("h2.post-title", "h3"),
    min_count: int = 1,
    min_len_exclusive: int = 15,
    text_mode: str = "whole",
) -> DataFrame:
    """Take the first tier that has at least ``min_count`` elements
    on the page (the last tier is taken whatever its count), then keep
    ``len(text) > min_len_exclusive``."""
    m = html_matches(pages, key_cols, list(tiers), union=False, modes=text_mode)
    last = len(tiers) - 1
    # The pages are parsed once: tier sizes and the chosen tier come from
    # windows over each page's matches (bounded by the page).
    n_in_tier = F.count(F.lit(1)).over(Window.partitionBy(*key_cols, "sel_idx"))
    ok = (F.col("_n") >= min_count) | (F.col("sel_idx") == last)
    chosen = F.min(F.when(ok, F.col("sel_idx"))).over(Window.partitionBy(*key_cols))
    return (
        m.withColumn("_n", n_in_tier)
        .withColumn("_chosen", chosen)
        .filter(F.col("sel_idx") == F.col("_chosen"))
        .select(*key_cols, F.col("sel_idx").alias("tier"), F.col("doc_pos").alias("pos"),
                F.col(TEXT_MODES[text_mode]).alias("text"))
        .filter(F.length("text") > min_len_exclusive)
    )


def title_and_intro(
    pages: DataFrame,
    key_cols: Sequence[str],
    title_sel: str = "h1",
    intro_sels: Sequence[str] = ("div.mw-parser-output > p", "#mw-content-text p"),
    min_intro: int = 15,
) -> DataFrame:
    """E12 + P21: first ``title_sel`` text, first intro candidate (selector
    order, then document order) with ``len >= min_intro``; text is
    ``title + '. ' + intro``; pages without either yield no row."""
    m = html_matches(pages, key_cols, [title_sel, *intro_sels], union=False, modes=[["joined"], *[["spaced"]] * len(intro_sels)])
    # One pass, one aggregate per page: title = first title match (pieces
    # joined without separator), intro = first candidate long enough
    # (pieces joined by " "); rows outside a role have a null ordering and
    # are ignored by min_by.
    txt = F.col("text_spaced")
    is_title = F.col("sel_idx") == 0
    is_intro = (F.col("sel_idx") > 0) & (F.length(txt) > 0) & (F.length(txt) >= min_intro)
    agg = m.groupBy(*key_cols).agg(
        F.min_by(F.col("text_joined"), F.when(is_title, F.col("doc_pos"))).alias("title"),
        F.min_by(txt, F.when(is_intro, F.struct("sel_idx", "doc_pos"))).alias("intro"),
    )
    return agg.filter(F.col("title").isNotNull() & F.col("intro").isNotNull()).select(
        *key_cols, "title", "intro", F.concat("title", F.lit(". "), "intro").alias("text")
    )


def category_members(
    pages: DataFrame,
    key_cols: Sequence[str],
    selector: str = "#mw-pages a",
    reject_words: Sequence[str] = (),
    accept_prefix: str = "/wiki/",
    reject_prefixes: Sequence[str] = (),
    host: str = "",
    limit: int = 500,
    min_len_exclusive: int | None = None,
    text_mode: str = "joined",
) -> DataFrame:
    """E10/E11 + P11, P12, E13, W9: member links of category pages, with
    navigation titles and namespace paths dropped, the host prefixed, the
    first ``limit`` per page kept (``row_number`` per page)."""
    m = html_matches(pages, key_cols, [selector], union=True, modes=text_mode)
    href = F.col("href")
    items = m.select(
        *key_cols, F.col("doc_pos").alias("pos"), F.col(TEXT_MODES[text_mode]).alias("title"),
        F.coalesce(href, F.lit("")).alias("href"),
    )
    if min_len_exclusive is not None:
        items = items.filter(F.length("title") > min_len_exclusive)
    items = items.filter(contains_none("title", reject_words) & path_accepted("href", accept_prefix, reject_prefixes))
    items = items.withColumn("url", F.concat(F.lit(host), F.col("href")))
    w = Window.partitionBy(*key_cols).orderBy("pos")
    return items.withColumn("member_no", F.row_number().over(w).cast("long")).filter(F.col("member_no") <= limit)


def discover_feed(
    pages: DataFrame,
    key_cols: Sequence[str],
    category: str,
    href_part: str = "/api/",
) -> DataFrame:
    """The ``<li>`` elements in document order whose text contains
    ``category`` (case-insensitive): the first one that holds, at any depth,
    a link whose href contains ``href_part`` gives its first such link; else
    the first such link anywhere whose own text contains ``category``.
    ``(keys..., feed_url)`` for every page (null when none)."""
    cat = category.lower()
    # One parse: li elements (selector 0) and links (selector 1).  Positions
    # are in document order, so the next wanted link after an li lies inside
    # it exactly if it comes no later than the li's end: one running window
    # per page, no pairs of lists and links.
    m = html_matches(pages, key_cols, ["li", "a"], union=False, modes=[["spaced"], ["joined"]])
    wanted = (F.col("sel_idx") == 1) & F.col("href").isNotNull() & F.col("href").contains(href_part)
    after = Window.partitionBy(*key_cols).orderBy(F.desc("doc_pos")).rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("_next", F.last(F.when(wanted, F.struct("doc_pos", "href")), ignorenulls=True).over(after))
    in_list = (F.col("sel_idx") == 0) & F.lower("text_spaced").contains(cat) & (F.col("_next.doc_pos") <= F.col("end_pos"))
    own_text = wanted & F.lower("text_joined").contains(cat)
    tier = F.when(in_list, F.lit(1)).when(own_text, F.lit(2))
    best = (
        m.withColumn("_tier", tier)
        .filter(F.col("_tier").isNotNull())
        .groupBy(*key_cols)
        .agg(F.min_by(F.when(F.col("_tier") == 1, F.col("_next.href")).otherwise(F.col("href")),
                      F.struct("_tier", "doc_pos")).alias("feed_url"))
    )
    return pages.select(*key_cols).join(best, list(key_cols), "left")
