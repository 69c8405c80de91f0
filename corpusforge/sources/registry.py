"""Source and keyword registries (S10, S11) as small dimension frames.

A registry is a list of plain dicts (one per source, list order =
priority), turned into a DataFrame with a fixed schema.  It is a dimension
of tens of rows, so joining it to items as a broadcast is bounded by
construction (``len(rows)``), not by the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge import schema

# Default CSS selectors when a source lists none.
DEFAULT_SELECTORS = ["h1 a", "h2 a", "h3 a", ".entry-title a", ".post-title a"]
DEFAULT_MAX_PAGES = 100000

# Economy keyword set of the modular job (71 entries).
ECONOMY_KEYWORDS = [
    "dhaqaale", "dhaqaalaha", "dhaqaaleed",
    "ganacsi", "ganacsiga", "ganacsato",
    "sicir", "sicir-barar", "sicirbarar",
    "qiime", "qiimaha",
    "kharash", "miisaaniyad",
    "dakhli", "khasaaro",
    "faa'iido", "faaido",
    "deyn", "dayn",
    "maalgashi", "maalgelin",
    "shirkad", "shirkadaha",
    "saami", "saamiga", "saamiyo",
    "suq", "suuq", "suqyada", "suuqyada",
    "deked", "dhoof", "dhoofin",
    "soo dejin", "soodejin", "soodajin",
    "xawaalad",
    "lacag", "shilin", "doolar",
    "sarif", "sarrif",
    "bangiga", "bangiyada", "bank",
    "shaqo", "shaqo abuur", "mushahar",
    "cashuur", "canshuur", "canshuuraha",
    "shidaal", "batrool", "gaas",
    "koronto", "biil",
    "business", "economy", "economic",
    "finance", "financial",
    "investment", "market",
    "import", "export", "trade",
    "tax", "budget", "revenue",
    "profit", "loss",
]

# Sports and health keyword sets of the feed classifier.
SPORTS_KEYWORDS = [
    "ciyaar", "ciyaaraha", "kubad", "kubbad", "k/cag", "cagta", "football",
    "soccer", "premier", "la liga", "serie a", "bundesliga", "champions",
    "olympic", "olombik", "final", "goal", "gool", "tartan", "koob", "cup",
    "nba", "fifa", "caf", "uefa", "man city", "manchester", "arsenal",
    "barcelona", "real madrid", "liverpool", "milan", "inter",
]
HEALTH_KEYWORDS = [
    "caafimaad", "caafimaadka", "cudur", "xanuun", "dhakhtar", "isbitaal",
    "tallaal", "vaccin", "vaccine", "covid", "malaria", "cholera", "dengue",
    "hargab", "daawo", "WHO", "unicef", "nafaqo", "nutrition", "hooyo",
    "uur", "caruur", "bukaan", "epidemic", "virus", "infection",
]

# Navigation words and namespace prefixes of category pages.
NAV_REJECT_WORDS = ["Bogga", "xiga", "hore"]
WIKI_ACCEPT_PREFIX = "/wiki/"
WIKI_REJECT_PREFIXES = ["/wiki/Category:", "/wiki/Help:", "/wiki/Special:", "/wiki/Template:"]


def source_row(priority: int, src: Mapping) -> tuple:
    """Registry dict -> row of ``schema.SOURCES`` with the reference defaults
    (``pagination='wp'``, ``start_page=1``, ``max_pages=100000``)."""
    return (
        int(priority),
        src["name"],
        src["label"],
        src.get("type", "wp_category"),
        src.get("pagination", "wp"),
        src["base_url"],
        int(src.get("start_page", 1)),
        int(src.get("max_pages", DEFAULT_MAX_PAGES)),
        list(src.get("selectors") or []),
        list(src.get("keywords") or []),
        bool(src.get("use_keyword_filter", False)),
    )


def sources_frame(spark: SparkSession, sources: Sequence[Mapping]) -> DataFrame:
    """Registry as a dimension frame, ``priority`` = list position (1-based)."""
    return spark.createDataFrame([source_row(i + 1, s) for i, s in enumerate(sources)], schema.SOURCES)


def apply_keywords(reg: DataFrame | None = None) -> Column:
    """The keyword filter applies to ``keyword_archive`` sources or
    when ``use_keyword_filter`` is set."""
    return (F.col("type") == "keyword_archive") | F.coalesce(F.col("use_keyword_filter"), F.lit(False))


def keywords_frame(spark: SparkSession, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(set_name, keyword)`` dimension."""
    return spark.createDataFrame([(k, w) for k, ws in sets.items() for w in ws], schema.KEYWORDS)


def labels_without_sources(spark: SparkSession, labels: Sequence[str], reg: DataFrame) -> DataFrame:
    """J2 report: ``(label, n_sources)`` for every requested label (0 = none)."""
    req = spark.createDataFrame([(i, l) for i, l in enumerate(labels)], "label_pos long, label string")
    n = reg.filter(F.col("label").isin(list(labels))).groupBy("label").agg(F.count(F.lit(1)).alias("n_sources"))
    return req.join(F.broadcast(n), "label", "left").select(
        "label_pos", "label", F.coalesce("n_sources", F.lit(0)).cast("long").alias("n_sources")
    )


def frontier(reg: DataFrame) -> DataFrame:
    """One row per (source, page) for ``start_page..max_pages``;
    none where the range is empty.

    Generated from the registry dimension (tens of rows) with
    ``sequence``; a job that reads captured pages should instead filter the
    captured page table by the same range (see ``collect``)."""
    from corpusforge.functions.urls import page_url

    return reg.filter("start_page <= max_pages").select(
        "priority", "name", "label", "pagination", "base_url",
        F.explode(F.sequence(F.col("start_page").cast("long"), F.col("max_pages").cast("long"))).alias("page_no"),
    ).withColumn("url", page_url("pagination", "base_url", "page_no"))
