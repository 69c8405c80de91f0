"""Shared input views over the supplied tables, as DataFrames and as SQL.

The supplied ``documents`` table stands in for corpus rows and for the
archive of listing pages:

* ``headlines(row_id, text, label, source, url)``: the whole document text,
  label from its language, ``url`` null for every tenth row;
* ``base``: even ``row_id`` (the existing corpus); base and archive together
  hold every row of the table;
* ``listing(source, page_no, pos, title, href, label, item_id)``: every row as
  a captured listing-page item; page ``row_id div 100 + 1``, position
  ``(row_id mod 100) div 20`` (five items per source and page);
* ``archive``: the ``listing`` items of odd ``row_id``;
* ``page_status(source, page_no, http_status)`` of the archive's pages,
  ``listing_status`` of all pages: null (request error) when
  ``(page_no*7 + src) mod 11 = 0``, 404 on the last page of every third
  source, else 200.

All are narrow projections with no window over items, so they scale with
the table.  The same definitions exist as SQL text for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Language -> label mapping of the driver views.
LANG_LABELS = {"en": "Politics", "fr": "World", "de": "Sports", "es": "Economy"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a supplied table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _label_of(lang: Column) -> Column:
    e = None
    for k, v in LANG_LABELS.items():
        e = F.when(lang == k, F.lit(v)) if e is None else e.when(lang == k, F.lit(v))
    return e


def _doc_url(source: Column, rid: Column) -> Column:
    return F.concat(F.lit("https://"), source, F.lit(".example.org/n/"), rid.cast("string"))


def headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("long").alias("row_id"),
        F.col("text"),
        _label_of(F.col("lang")).alias("label"),
        F.col("source"),
        F.when(F.col("doc_id") % 10 == 0, F.lit(None).cast("string"))
        .otherwise(_doc_url(F.col("source"), F.col("doc_id")))
        .alias("url"),
    )


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headlines(spark, sf_dir).filter(F.col("row_id") % 2 == 0)


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headlines(spark, sf_dir).select(
        "source",
        (F.floor(F.col("row_id") / 100) + 1).cast("long").alias("page_no"),
        F.floor((F.col("row_id") % 100) / 20).cast("long").alias("pos"),
        F.col("text").alias("title"),
        _doc_url(F.col("source"), F.col("row_id")).alias("href"),
        "label",
        F.col("row_id").alias("item_id"),
    )


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing(spark, sf_dir).filter(F.col("item_id") % 2 == 1)


def page_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status_of(archive(spark, sf_dir))


def listing_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status_of(listing(spark, sf_dir))


def _status_of(items: DataFrame) -> DataFrame:
    # Page-level table (one row per captured page): the window runs over
    # pages, never over items.
    p = items.select("source", "page_no").distinct()
    # Last page per source as an aggregate joined back (no window holding a
    # whole source's pages in one task).
    last = p.groupBy("source").agg(F.max("page_no").alias("_last"))
    src = F.substring("source", 4, 10).cast("long")
    return p.join(last, "source").select(
        "source",
        "page_no",
        F.when((F.col("page_no") * 7 + src) % 11 == 0, F.lit(None).cast("int"))
        .when((src % 3 == 0) & (F.col("page_no") == F.col("_last")), F.lit(404))
        .otherwise(F.lit(200))
        .alias("http_status"),
    )


# --- the same views as SQL (DuckDB dialect; tables are pre-registered) -----

SQL_HEADLINES = """headlines AS (
  SELECT CAST(doc_id AS BIGINT) AS row_id,
         text,
         CASE lang WHEN 'en' THEN 'Politics' WHEN 'fr' THEN 'World'
                   WHEN 'de' THEN 'Sports' WHEN 'es' THEN 'Economy' END AS label,
         source,
         CASE WHEN doc_id % 10 = 0 THEN NULL
              ELSE 'https://' || source || '.example.org/n/' || CAST(doc_id AS VARCHAR) END AS url
  FROM documents)"""

SQL_BASE = """base AS (SELECT * FROM headlines WHERE row_id % 2 = 0)"""

SQL_LISTING = """listing AS (
  SELECT source, CAST(row_id // 100 + 1 AS BIGINT) AS page_no,
         CAST((row_id % 100) // 20 AS BIGINT) AS pos, text AS title,
         'https://' || source || '.example.org/n/' || CAST(row_id AS VARCHAR) AS href, label,
         row_id AS item_id
  FROM headlines)"""

SQL_ARCHIVE = """archive AS (SELECT * FROM listing WHERE item_id % 2 = 1)"""

SQL_PAGE_STATUS = """page_status AS (
  SELECT source, page_no,
         CASE WHEN (page_no * 7 + CAST(substring(source, 4, 10) AS BIGINT)) % 11 = 0 THEN NULL
              WHEN CAST(substring(source, 4, 10) AS BIGINT) % 3 = 0
                   AND page_no = max(page_no) OVER (PARTITION BY source) THEN 404
              ELSE 200 END AS http_status
  FROM (SELECT DISTINCT source, page_no FROM archive))"""

SQL_VIEWS = {
    "headlines": SQL_HEADLINES,
    "base": SQL_BASE,
    "listing": SQL_LISTING,
    "archive": SQL_ARCHIVE,
    "page_status": SQL_PAGE_STATUS,
    "listing_status": SQL_PAGE_STATUS.replace("page_status", "listing_status").replace("FROM archive", "FROM listing"),
}
_DEPS = {"headlines": [], "base": ["headlines"], "listing": ["headlines"], "archive": ["listing"],
         "page_status": ["archive"], "listing_status": ["listing"]}


def with_views(*names: str) -> str:
    """``WITH`` prefix defining the named views (and their dependencies)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS[n]:
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(SQL_VIEWS[n] for n in order)
