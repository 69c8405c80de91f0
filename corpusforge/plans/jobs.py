"""End-to-end jobs (K1, K6-K10, K19) as plain functions over DataFrames.

These are what a user of the reference's command-line job and notebooks
runs; each is a composition of the operators, returning DataFrames (nothing
is printed or collected beyond per-label scalars).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge import schema
from corpusforge.functions.text import title_case
from corpusforge.operators import balance as B
from corpusforge.operators import clean, collect, dedupe, extract, merge, profile
from corpusforge.session import scratch_path
from corpusforge.sources.corpus import CorpusStore, Version
from corpusforge.sources.feeds import search_feed_titles
from corpusforge.sources.registry import sources_frame


@dataclass
class ExtendResult:
    corpus: DataFrame  # final corpus, keep-first by normalised text
    accepted: DataFrame  # rows collected per step
    metrics: DataFrame  # per step: pages visited, rows added
    fold: collect.FoldResult
    needs: dict  # label -> rows requested at the start
    shortfall: DataFrame  # labels still below the target

    @property
    def pages(self) -> DataFrame:
        """Per visited page: rows added, running total."""
        return self.fold.pages


def extend_to_target(
    spark: SparkSession,
    base: DataFrame,
    pages: DataFrame,
    items: DataFrame,
    registry: Sequence[Mapping] | DataFrame,
    labels: Sequence[str] = tuple(schema.DEFAULT_LABELS),
    target: int = schema.DEFAULT_TARGET,
    cfg: collect.CollectConfig = collect.CollectConfig(),
    dedupe_base_first: bool = False,
    run_dir: str | None = None,
    input_version: str | None = None,
    dedupe_final: bool = True,
) -> ExtendResult:
    """K1: extend a corpus until each label reaches ``target``.

    ``base`` must have ``text``/``label`` (P18) and a ``row_id`` order
    column; it is cleaned (P4, P2, P3, P17).  Needs are computed before the
    final dedupe, as the reference does (Q1); ``dedupe_base_first=True``
    dedupes the base first so duplicates do not count toward the target.
    ``pages(source, page_no, http_status)`` and ``items(source, page_no,
    pos, title, href)`` are the captured listing pages and their extracted
    items (see ``operators.extract``); ``run_dir`` and ``input_version`` as in
    ``collect.collect_fold``; without ``dedupe_final`` new rows are appended to
    the base as it is.
    """
    b = clean.clean_corpus(base)
    if dedupe_base_first:
        b = dedupe.dedupe_norm(b, order_cols=("row_id",))
    reg = registry if isinstance(registry, DataFrame) else sources_frame(spark, registry)
    needs_df = profile.label_needs(b, labels, target)
    needs = {r["label"]: int(r["need"]) for r in needs_df.collect()}  # one row per label
    res = collect.collect_fold(spark, pages, items, reg, b, needs, labels, cfg, run_dir, input_version)
    final = collect.extend_corpus(b, res.accepted, dedupe_final)
    return ExtendResult(final, res.accepted, res.metrics, res, needs,
                        profile.shortfall(final, labels, target))


def extend_from_pages(
    spark: SparkSession,
    base: DataFrame,
    pages: DataFrame,
    registry: Sequence[Mapping] | DataFrame,
    labels: Sequence[str] = tuple(schema.DEFAULT_LABELS),
    target: int = schema.DEFAULT_TARGET,
    cfg: collect.CollectConfig = collect.CollectConfig(),
    dedupe_base_first: bool = False,
    run_dir: str | None = None,
    input_version: str | None = None,
) -> ExtendResult:
    """K1 from captured pages (``schema.PAGES``): each source's own selectors
    give the items of its pages (written once, so no page is parsed again), and
    ``extend_to_target`` does the rest."""
    reg = registry if isinstance(registry, DataFrame) else sources_frame(spark, registry)
    items = _written(extract.links_by_source(pages, reg))
    status = pages.drop("html", "url")
    return extend_to_target(spark, base, status, items, reg, labels, target, cfg, dedupe_base_first, run_dir, input_version)


CORPUS_ORDER = ("part_no", "row_id", "step", "page_no", "pos")


def extend_version(
    spark: SparkSession, store: CorpusStore, pages: DataFrame, items: DataFrame, registry: Sequence[Mapping] | DataFrame, **options
) -> Version:
    """K1 as it is re-run: extend the newest version of ``store`` and add the
    result as the next one, in corpus order (rows of the base first); a row's
    place there is its ``row_id`` in the next run.  ``options`` as in
    ``extend_to_target``."""
    base = store.read_numbered(name="row_id").select("row_id", "text", "label", "source", "url")
    res = extend_to_target(spark, base, pages, items, registry, **options)
    return store.write(res.corpus.select(*CORPUS_ORDER, "text", "label", "source", "url"), CORPUS_ORDER)


def _written(items: DataFrame) -> DataFrame:
    path = scratch_path(items.sparkSession, "page-items")
    items.write.parquet(path)
    return items.sparkSession.read.schema(items.schema).parquet(path)


@dataclass(frozen=True)
class TopUp:
    """One top-up (K11-K15, K17, K18): sources in order, each with its label,
    selectors and keywords, and how their pages are read."""

    sources: Sequence[Mapping]
    cfg: collect.CollectConfig
    text_mode: str = "joined"
    order_mode: str = "document"

    @property
    def labels(self) -> list[str]:
        return list(dict.fromkeys(s["label"] for s in self.sources))


def top_up(
    spark: SparkSession, base: DataFrame, pages: DataFrame, job: TopUp, target: int = schema.DEFAULT_TARGET,
    run_dir: str | None = None, input_version: str | None = None,
) -> ExtendResult:
    """Fill the job's labels up to ``target`` from its sources, one after the
    other, and append what is new to the base (no final dedupe)."""
    reg = sources_frame(spark, job.sources)
    items = _written(extract.links_by_source(pages, reg, job.text_mode, job.order_mode))
    return extend_to_target(spark, base, pages.drop("html", "url"), items, reg, job.labels, target, job.cfg,
                            run_dir=run_dir, input_version=input_version, dedupe_final=False)


def harvest_pages(spark: SparkSession, pages: DataFrame, registry: Sequence[Mapping], cfg: collect.CollectConfig) -> DataFrame:
    """K4: every item of the pages that the stop rules leave, labelled by its
    source, keep-first by ``(text, url)`` (E6, W2, W3, D3); no quota and no seen
    set.  A missing link stays null."""
    reg = sources_frame(spark, registry)
    items = _written(extract.links_by_source(pages, reg, "joined", href_default=None))
    items, pages = collect.by_id(items, reg), collect.by_id(pages.drop("html", "url"), reg)
    ids = reg.withColumn("name", F.col("priority").cast("string"))
    kept, counts = collect.prepare_items(items, cfg)
    visited = collect.visible_pages(pages, counts, ids, cfg).select("source", "page_no")
    names = reg.select(F.col("priority").cast("string").alias("source"), "priority", "name", "label")
    rows = kept.join(visited, ["source", "page_no"], "left_semi").join(names, "source").select(
        "priority", F.col("name").alias("source"), "label", "page_no", "pos", F.col("title").alias("text"), F.col("href").alias("url")
    )
    return dedupe.dedupe_text_url(rows, order_cols=("priority", "page_no", "pos"))


def harvest_categories_and_search(
    category_pages: DataFrame,
    search_feeds: DataFrame,
    page_keys: Sequence[str],
    feed_keys: Sequence[str],
    selector: str = "#mw-pages a",
    min_len: int = 5,
    category_source: str = "Wikipedia",
    search_source: str = "Google News RSS",
) -> DataFrame:
    """K5: member titles of category pages (E10) and titles of search feeds cut
    at the hyphen (E9), each with its page's or feed's ``label``, keep-first by
    text in that order (D2): (part_no, text, label, source)."""
    pages = category_pages.select(*page_keys, "label", "html")
    members = extract.category_members(
        pages, [*page_keys, "label"], selector, accept_prefix="", limit=2_000_000_000, min_len_exclusive=min_len)
    titles = search_feed_titles(search_feeds, [*feed_keys, "label"])
    key = lambda keys, no: F.struct(*keys, no).alias("_key")
    parts = []
    for i, (rows, keys, no, text, source) in enumerate((
        (members, page_keys, "member_no", "title", category_source), (titles, feed_keys, "item_no", "text", search_source),
    )):
        one = rows.select(F.lit(i).alias("part_no"), key(keys, no), F.col(text).alias("text"), "label", F.lit(source).alias("source"))
        parts.append(dedupe.keep_first(one, [F.sha2("text", 256)], ("_key",)).drop("_key"))  # each part's keys are its own
    return dedupe.keep_first(parts[0].unionByName(parts[1]), [F.sha2("text", 256)], ("part_no",))


def balance_job(df: DataFrame, target: int, seed: int = B.DEFAULT_SEED, dedupe_text_label: bool = False) -> DataFrame:
    """Clean, down-/over-sample every label to ``target``, seeded
    shuffle key; optionally drop repeated ``(text, label)`` afterwards (D6)."""
    out = B.balance(clean.clean_corpus(df), target, seed)
    return dedupe.dedupe_text_label(out, order_cols=("row_id", "draw")) if dedupe_text_label else out


def merge_job(
    parts: Sequence[DataFrame],
    dedupe_by: str | None = "text",
    title_case_labels: bool = False,
    seed: int = B.DEFAULT_SEED,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """K6-K9: union the parts (optionally projected), keep-first by ``text``
    / ``norm`` / ``text_url`` or keep every row (``None``), optionally
    title-case the labels, and add the seeded shuffle key."""
    ps = [p.select(*columns, *(["row_id"] if "row_id" in p.columns and "row_id" not in columns else []))
          for p in parts] if columns else list(parts)
    u = merge.union_parts(ps)
    if dedupe_by == "text":
        u = dedupe.dedupe_text(u)
    elif dedupe_by == "norm":
        u = dedupe.dedupe_norm(u)
    elif dedupe_by == "text_url":
        u = dedupe.dedupe_text_url(u)
    elif dedupe_by is not None:
        raise ValueError(f"Unknown dedupe_by: {dedupe_by}")
    if title_case_labels:
        u = u.withColumn("label", title_case("label"))
    return B.shuffle(u, seed, ("part_no", "row_id"))


def profile_job(df: DataFrame, sample_labels: Sequence[str] = tuple(schema.DEFAULT_LABELS), n: int = 5) -> DataFrame:
    """The profile as one long ``(metric, key, value)`` table."""
    return profile.profile_report(df, sample_labels=sample_labels, n_samples=n)


def label_report(df: DataFrame) -> DataFrame:
    """A1 sorted as the reference prints it (count desc, then label)."""
    return profile.value_counts(df, "label", "count").orderBy(F.desc("count"), "label")
