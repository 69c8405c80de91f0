"""Driver queries: each runs a library operator over the supplied tables and
has a DuckDB SQL twin used as the correctness oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions import text as TX
from corpusforge.functions.text import norm_text
from corpusforge.operators import clean, profile
from corpusforge.plans import sqltext as S
from corpusforge.plans import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_corpus(V.headlines(spark, sf_dir))


# --------------------------------------------------------------- cleaning --

@register(
    "clean_corpus",
    V.with_views("headlines") + ",\n" + S.clean_cte() + "\nSELECT row_id, text, label, source, url FROM cleaned",
)
def q_clean_corpus(spark, sf_dir):
    return cleaned(spark, sf_dir).select("row_id", "text", "label", "source", "url")


@register(
    "normalize_text",
    f"SELECT CAST(doc_id AS BIGINT) AS doc_id, {S.norm('text')} AS norm FROM documents",
)
def q_normalize_text(spark, sf_dir):
    d = V.read_table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("long"), norm_text("text").alias("norm"))


@register(
    "label_distribution",
    V.with_views("headlines") + ",\n" + S.clean_cte()
    + "\nSELECT label, count(*) AS n_rows FROM cleaned WHERE label IS NOT NULL GROUP BY label",
)
def q_label_distribution(spark, sf_dir):
    return profile.value_counts(cleaned(spark, sf_dir), "label", "n_rows")


# ---------------------------------------------------------------- profile --

def _wv(*names: str) -> str:
    return V.with_views(*names)


_CLEAN = S.clean_cte()
HEADLINE_COLS = ["row_id", "text", "label", "source", "url"]


@register(
    "distinct_labels",
    _wv("headlines") + "\nSELECT label, min(row_id) AS first_row FROM headlines GROUP BY label",
)
def q_distinct_labels(spark, sf_dir):
    return profile.distinct_values(V.headlines(spark, sf_dir), "label")


@register(
    "distinct_sources",
    _wv("headlines") + "\nSELECT source AS value, min(row_id) AS first_row, "
    "'source' AS column_name FROM headlines GROUP BY source",
)
def q_distinct_sources(spark, sf_dir):
    df = V.headlines(spark, sf_dir)
    col = clean.pick_column(df, ("source", "website"))
    return (
        profile.distinct_values(df, col)
        .withColumnRenamed(col, "value")
        .withColumn("column_name", F.lit(col))
    )


@register(
    "distinct_counts",
    _wv("headlines") + "\nSELECT count(DISTINCT label) AS n_labels, count(DISTINCT source) AS n_sources, "
    "count(*) AS n_rows FROM headlines",
)
def q_distinct_counts(spark, sf_dir):
    df = V.headlines(spark, sf_dir)
    return df.agg(
        F.count_distinct("label").alias("n_labels"),
        F.count_distinct("source").alias("n_sources"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def _sql_null_profile(src: str, cols: list[str]) -> str:
    parts = [
        f"SELECT {S.q(c)} AS column_name, CAST({i} AS BIGINT) AS col_pos, "
        f"CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM {src}"
        for i, c in enumerate(cols)
    ]
    return "\nUNION ALL\n".join(parts)


@register("null_profile", _wv("headlines") + "\n" + _sql_null_profile("headlines", HEADLINE_COLS))
def q_null_profile(spark, sf_dir):
    return profile.null_profile(V.headlines(spark, sf_dir))


@register(
    "null_columns",
    _wv("headlines") + ",\nnp AS (" + _sql_null_profile("headlines", HEADLINE_COLS) + ")\n"
    "SELECT column_name, col_pos, nulls FROM np WHERE nulls > 0",
)
def q_null_columns(spark, sf_dir):
    return profile.null_columns(V.headlines(spark, sf_dir))


@register(
    "null_summary",
    _wv("headlines") + ",\nnp AS (" + _sql_null_profile("headlines", HEADLINE_COLS) + ")\n"
    "SELECT CAST(sum(nulls) AS BIGINT) AS total_nulls, sum(nulls) = 0 AS no_nulls FROM np",
)
def q_null_summary(spark, sf_dir):
    return profile.null_summary(V.headlines(spark, sf_dir))


@register(
    "frame_summary",
    _wv("headlines") + "\n" + "\nUNION ALL\n".join(
        f"SELECT {S.q(c)} AS column_name, CAST({i} AS BIGINT) AS col_pos, {S.q(t)} AS dtype, "
        f"count({c}) AS non_null, count(*) AS rows FROM headlines"
        for i, (c, t) in enumerate(zip(HEADLINE_COLS, ["bigint", "string", "string", "string", "string"]))
    ),
)
def q_frame_summary(spark, sf_dir):
    return profile.frame_summary(V.headlines(spark, sf_dir))


@register(
    "samples_per_label",
    _wv("headlines") + ",\n" + _CLEAN + "\nSELECT row_id, text, label, source, url FROM ("
    "SELECT *, row_number() OVER (PARTITION BY label ORDER BY row_id) AS rn FROM cleaned "
    "WHERE label IN ('Politics', 'World', 'Sports', 'Economy')) WHERE rn <= 5",
)
def q_samples_per_label(spark, sf_dir):
    df = clean.filter_labels(cleaned(spark, sf_dir), ["Politics", "World", "Sports", "Economy"])
    return profile.head_per_group(df.select(*HEADLINE_COLS), 5)


@register(
    "head_rows",
    _wv("headlines") + "\nSELECT row_id, text, label, source, url FROM headlines ORDER BY row_id LIMIT 5",
)
def q_head_rows(spark, sf_dir):
    return profile.head(V.headlines(spark, sf_dir), 5)


@register(
    "drop_url",
    _wv("headlines") + ",\n" + _CLEAN + "\nSELECT row_id, text, label, source FROM cleaned",
)
def q_drop_url(spark, sf_dir):
    return clean.drop_columns(cleaned(spark, sf_dir).select(*HEADLINE_COLS), ["url"])


@register(
    "project_text_label",
    _wv("headlines") + ",\n" + _CLEAN + "\nSELECT text, label FROM cleaned",
)
def q_project_text_label(spark, sf_dir):
    return clean.project(cleaned(spark, sf_dir), ["text", "label"])


@register(
    "count_label",
    _wv("headlines") + "\nSELECT CAST(count_if(label = 'Sports') AS BIGINT) AS n FROM headlines",
)
def q_count_label(spark, sf_dir):
    return profile.count_if_label(V.headlines(spark, sf_dir), "Sports")


@register(
    "row_counts",
    _wv("headlines") + "\nSELECT 'headlines' AS table_name, count(*) AS n_rows FROM headlines "
    "UNION ALL SELECT 'pages' AS table_name, count(*) AS n_rows FROM pages",
)
def q_row_counts(spark, sf_dir):
    h = profile.row_count(V.headlines(spark, sf_dir), "n_rows").withColumn("table_name", F.lit("headlines"))
    p = profile.row_count(V.read_table(spark, sf_dir, "pages"), "n_rows").withColumn("table_name", F.lit("pages"))
    return h.unionByName(p)


# ----------------------------------------------------------------- dedupe --

from corpusforge.operators import balance as B  # noqa: E402
from corpusforge.operators import dedupe as D  # noqa: E402
from corpusforge.operators import merge as M  # noqa: E402
from corpusforge.plans import fixtures as FX  # noqa: E402


def _keep_first_sql(src: str, key: str, cols: list[str], order: str = "row_id") -> str:
    return (
        f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS _rn "
        f"FROM {src}) WHERE _rn = 1"
    )


@register(
    "dedupe_norm",
    _wv("headlines") + ",\n" + _CLEAN + "\n" + _keep_first_sql("cleaned", S.norm("text"), HEADLINE_COLS),
)
def q_dedupe_norm(spark, sf_dir):
    return D.dedupe_norm(cleaned(spark, sf_dir).select(*HEADLINE_COLS), order_cols=("row_id",))


@register(
    "dedupe_text",
    _wv("headlines") + "\n" + _keep_first_sql("headlines", "text", HEADLINE_COLS),
)
def q_dedupe_text(spark, sf_dir):
    return D.dedupe_text(V.headlines(spark, sf_dir), order_cols=("row_id",))


@register(
    "dedupe_text_url",
    _wv("headlines") + "\n" + _keep_first_sql("headlines", "text, url", HEADLINE_COLS),
)
def q_dedupe_text_url(spark, sf_dir):
    return D.dedupe_text_url(V.headlines(spark, sf_dir), order_cols=("row_id",))


def _target_rows_div(n: int) -> str:
    return f"tgt AS (SELECT count(*) // {n} AS target FROM cbase)"


def clean_base(spark, sf_dir):
    return clean.clean_corpus(V.base(spark, sf_dir))


def base_target(cb) -> int:
    """Per-label target of the growth jobs: a fifth of the cleaned base."""
    return cb.count() // 5


@register(
    "label_needs",
    _wv("headlines") + ",\n" + S.clean_cte("headlines", "cbase") + ",\n" + FX.sql_labels() + ",\n" + _target_rows_div(5)
    + "\nSELECT req.label_pos, req.label, CAST(coalesce(c.have, 0) AS BIGINT) AS have, "
    "CAST(greatest(0, tgt.target - coalesce(c.have, 0)) AS BIGINT) AS need "
    "FROM req LEFT JOIN (SELECT label, count(*) AS have FROM cbase GROUP BY label) c ON req.label = c.label, tgt",
)
def q_label_needs(spark, sf_dir):
    cb = clean.clean_corpus(V.headlines(spark, sf_dir))
    return profile.label_needs(cb, FX.LABELS, base_target(cb))


@register(
    "unseen_items",
    _wv("base", "archive") + ",\n" + S.clean_cte("base", "cbase")
    + f",\nseen AS (SELECT DISTINCT {S.norm('text')} AS norm FROM cbase)\n"
    f"SELECT source, page_no, pos, title FROM archive WHERE NOT EXISTS "
    f"(SELECT 1 FROM seen WHERE seen.norm = {S.norm('archive.title')})",
)
def q_unseen_items(spark, sf_dir):
    seen = D.seen_set(clean_base(spark, sf_dir))
    items = V.archive(spark, sf_dir).withColumn("nkey", TX.norm_key("title"))
    return D.unseen(items, seen).select("source", "page_no", "pos", "title")


# ------------------------------------------------------------------ merge --

def archive_as_corpus(spark, sf_dir):
    """Archive items in corpus form (no url column: U1 fills it with null)."""
    return V.archive(spark, sf_dir).select(
        F.col("item_id").alias("row_id"), F.col("title").alias("text"), "label", "source"
    )


_SQL_ARCH_CORPUS = "arch AS (SELECT item_id AS row_id, title AS text, label, source FROM archive)"
_SQL_UNION = (
    "parts AS (SELECT CAST(0 AS INTEGER) AS part_no, row_id, text, label, source, url FROM base "
    "UNION ALL SELECT CAST(1 AS INTEGER) AS part_no, row_id, text, label, source, CAST(NULL AS VARCHAR) AS url FROM arch)"
)
PART_COLS = ["part_no", "row_id", "text", "label", "source", "url"]


@register(
    "union_parts",
    _wv("base", "archive") + ",\n" + _SQL_ARCH_CORPUS + ",\n" + _SQL_UNION + "\nSELECT * FROM parts",
)
def q_union_parts(spark, sf_dir):
    return M.union_parts([V.base(spark, sf_dir), archive_as_corpus(spark, sf_dir)]).select(*PART_COLS)


def _title_case_sql(x: str) -> str:
    return S.strip(f"upper(substring({x}, 1, 1)) || lower(substring({x}, 2))")


@register(
    "merge_dedupe_shuffle",
    _wv("base", "archive") + ",\n" + _SQL_ARCH_CORPUS + ",\n" + _SQL_UNION
    + ",\nkept AS (" + _keep_first_sql("parts", "text", PART_COLS, "part_no, row_id") + ")\n"
    f"SELECT part_no, row_id, text, {_title_case_sql('label')} AS label, source, url, "
    f"{S.md5_key(FX.SEED, 'part_no', 'row_id')} AS shuffle_key FROM kept",
)
def q_merge_dedupe_shuffle(spark, sf_dir):
    from corpusforge.functions.text import title_case

    u = M.union_parts([V.base(spark, sf_dir), archive_as_corpus(spark, sf_dir)]).select(*PART_COLS)
    d = D.dedupe_text(u).withColumn("label", title_case("label"))
    return B.shuffle(d, FX.SEED, ("part_no", "row_id"))


# ---------------------------------------------------------------- balance --

def balance_target(df) -> int:
    """Per-label balance target: a fifth of all rows."""
    return df.count() // 5


_SQL_BAL_TGT = "tgt AS (SELECT count(*) // 5 AS target FROM cleaned)"
_SQL_COUNTS = "cnt AS (SELECT label, count(*) AS n FROM cleaned GROUP BY label)"
_SQL_DOWN = (
    "down AS (SELECT row_id, text, label, source, url, CAST(0 AS BIGINT) AS draw FROM ("
    f"SELECT c.*, row_number() OVER (PARTITION BY c.label ORDER BY {S.md5_key(FX.SEED, 'c.row_id')}, c.row_id) AS rk, "
    "tgt.target FROM cleaned c JOIN cnt ON c.label = cnt.label, tgt WHERE cnt.n >= tgt.target) WHERE rk <= target)"
)
_SQL_OVER = (
    "small AS (SELECT cnt.label, cnt.n, tgt.target FROM cnt, tgt WHERE cnt.n < tgt.target AND cnt.n > 0),\n"
    "draws AS (SELECT small.label, CAST(d.draw AS BIGINT) AS draw, "
    f"({S.hex_to_long(S.md5_key(FX.SEED, 'small.label', 'd.draw'))} % small.n) + 1 AS rn "
    "FROM small, generate_series(1, small.target) AS d(draw)),\n"
    "numbered AS (SELECT c.*, row_number() OVER (PARTITION BY c.label ORDER BY c.row_id) AS rn "
    "FROM cleaned c WHERE c.label IN (SELECT label FROM small)),\n"
    "over AS (SELECT numbered.row_id, numbered.text, numbered.label, numbered.source, numbered.url, draws.draw "
    "FROM numbered JOIN draws ON numbered.label = draws.label AND numbered.rn = draws.rn)"
)
BAL_COLS = HEADLINE_COLS + ["draw"]


@register(
    "balance_down",
    _wv("headlines") + ",\n" + _CLEAN + ",\n" + _SQL_BAL_TGT + ",\n" + _SQL_COUNTS + ",\n" + _SQL_DOWN
    + "\nSELECT * FROM down",
)
def q_balance_down(spark, sf_dir):
    c = cleaned(spark, sf_dir).select(*HEADLINE_COLS)
    return B.down_sample(c, balance_target(c), FX.SEED).select(*BAL_COLS)


@register(
    "balance_over",
    _wv("headlines") + ",\n" + _CLEAN + ",\n" + _SQL_BAL_TGT + ",\n" + _SQL_COUNTS + ",\n" + _SQL_OVER
    + "\nSELECT * FROM over",
)
def q_balance_over(spark, sf_dir):
    c = cleaned(spark, sf_dir).select(*HEADLINE_COLS)
    return B.over_sample(c, balance_target(c), FX.SEED).select(*BAL_COLS)


_SQL_FULL = (
    _wv("headlines") + ",\n" + _CLEAN + ",\n" + _SQL_BAL_TGT + ",\n" + _SQL_COUNTS + ",\n" + _SQL_DOWN + ",\n"
    + _SQL_OVER + ",\nbal AS (SELECT * FROM down UNION ALL SELECT * FROM over)\n"
)


@register(
    "balance_full",
    _SQL_FULL + f"SELECT *, {S.md5_key(FX.SEED, 'row_id', 'draw')} AS shuffle_key FROM bal",
)
def q_balance_full(spark, sf_dir):
    c = cleaned(spark, sf_dir).select(*HEADLINE_COLS)
    return B.balance(c, balance_target(c), FX.SEED).select(*BAL_COLS, "shuffle_key")


@register(
    "job_balance",
    _SQL_FULL + "SELECT row_id, text, label, source, url, draw, "
    f"{S.md5_key(FX.SEED, 'row_id', 'draw')} AS shuffle_key FROM ("
    "SELECT *, row_number() OVER (PARTITION BY text, label ORDER BY row_id, draw) AS _k FROM bal) WHERE _k = 1",
)
def q_job_balance(spark, sf_dir):
    """K10 with the D6 option: balance, then keep-first by (text, label)."""
    c = cleaned(spark, sf_dir).select(*HEADLINE_COLS)
    bal = B.balance(c, balance_target(c), FX.SEED).select(*BAL_COLS, "shuffle_key")
    return D.dedupe_text_label(bal, order_cols=("row_id", "draw"))


def _strict_sql(labels) -> str:
    inl = ", ".join(S.q(l) for l in labels)
    return (
        _wv("headlines") + ",\n" + _CLEAN.replace("cleaned AS", "cleaned0 AS")
        + f",\ncleaned AS (SELECT * FROM cleaned0 WHERE label IN ({inl})),\n"
        + _SQL_COUNTS + ",\ntgt AS (SELECT min(n) AS target FROM cnt),\n" + _SQL_DOWN
        + f"\nSELECT *, {S.md5_key(FX.SEED, 'row_id', 'draw')} AS shuffle_key FROM down"
    )


def _strict(spark, sf_dir, labels):
    c = clean.filter_labels(cleaned(spark, sf_dir).select(*HEADLINE_COLS), labels)
    # Largest strict target the requested labels allow (tiny aggregate).
    target = c.groupBy("label").count().agg(F.min("count")).collect()[0][0]
    return B.balance_strict(c, int(target), labels, FX.SEED).select(*BAL_COLS, "shuffle_key")


@register("balance_strict", _strict_sql(["World", "Sports"]))
def q_balance_strict(spark, sf_dir):
    return _strict(spark, sf_dir, ["World", "Sports"])


@register("job_strict", _strict_sql(FX.LABELS))
def q_job_strict(spark, sf_dir):
    """P14 label filter, then strict assembly of the four labels."""
    return _strict(spark, sf_dir, FX.LABELS)


@register(
    "shuffle_seeded",
    _wv("headlines") + ",\n" + _CLEAN
    + f"\nSELECT row_id, text, label, source, url, {S.md5_key(FX.SEED, 'row_id')} AS shuffle_key FROM cleaned",
)
def q_shuffle_seeded(spark, sf_dir):
    return B.shuffle(cleaned(spark, sf_dir).select(*HEADLINE_COLS), FX.SEED)


@register(
    "shuffle_reindexed",
    _wv("headlines") + ",\n" + _CLEAN
    + ",\nkeyed AS (SELECT row_id, text, label, source, url, " + S.md5_key(FX.SEED, "row_id") + " AS shuffle_key FROM cleaned)"
    + "\nSELECT *, row_number() OVER (ORDER BY shuffle_key, row_id) - 1 AS row_no FROM keyed",
)
def q_shuffle_reindexed(spark, sf_dir):
    """The shuffled rows, numbered anew."""
    return B.reindex(B.shuffle(cleaned(spark, sf_dir).select(*HEADLINE_COLS), FX.SEED))


# ---------------------------------------------------------------- collect --

from corpusforge.operators import collect as C  # noqa: E402
from corpusforge.plans import fold_sql as FS  # noqa: E402
from corpusforge.plans import jobs  # noqa: E402
from corpusforge.sources.registry import sources_frame  # noqa: E402

# Streak thresholds scaled to the data size (80 / 25 / 10 in the reference).
FOLD_CFG = C.CollectConfig(zero_streak=3)
NO_STREAK_CFG = C.CollectConfig(zero_streak=None)
STREAKS_CFG = C.CollectConfig(zero_streak=3, zero_streak_by_source={"src11": 1, "src13": 2, "src17": 3, "src5": 1})
HARVEST_CFG = C.CollectConfig(zero_streak=None, stop_on_http=False, stop_on_empty=False)


def run_fold(spark, sf_dir, labels=FX.LABELS, registry=FX.REGISTRY, cfg=FOLD_CFG, quota=True) -> C.FoldResult:
    """K1 core on the driver views: needs from the cleaned base (target =
    a fifth of its rows), archive items, captured page statuses."""
    cb = clean_base(spark, sf_dir)
    reg = sources_frame(spark, registry)
    if quota:
        # One small job: per-label counts (tiny) give both the target (a
        # fifth of all rows) and the needs of the requested labels.
        have = {r[0]: int(r[1]) for r in cb.groupBy("label").count().collect()}
        target = sum(have.values()) // 5
        needs = {l: max(0, target - have.get(l, 0)) for l in labels}
    else:
        needs = {l: None for l in labels}
    items = V.archive(spark, sf_dir).select("source", "page_no", "pos", "title", "href")
    return C.collect_fold(spark, V.page_status(spark, sf_dir), items, reg, cb, needs, labels, cfg)


ACC_COLS = ["step", "source", "label", "page_no", "pos", "text", "url"]
CORPUS_COLS = ["part_no", "row_id", "step", "page_no", "pos", "text", "label", "source", "url"]


def run_extend(spark, sf_dir, labels=FX.LABELS, cfg=FOLD_CFG):
    """K1 through the job API: target = a fifth of the cleaned base rows."""
    target = base_target(clean_base(spark, sf_dir))
    items = V.archive(spark, sf_dir).select("source", "page_no", "pos", "title", "href")
    return jobs.extend_to_target(spark, V.base(spark, sf_dir), V.page_status(spark, sf_dir), items,
                                 FX.REGISTRY, labels, target, cfg)


@register("collect_fold", FS.fold_sql(FX.LABELS, cfg=FOLD_CFG, tail="corpus"))
def q_collect_fold(spark, sf_dir):
    """Flagship K1: extend the base corpus to the per-label target from the
    prioritised sources, then keep-first by normalised text."""
    return run_extend(spark, sf_dir).corpus.select(*CORPUS_COLS)


@register("shortfall_report", FS.fold_sql(FX.LABELS, cfg=FOLD_CFG, tail="shortfall"))
def q_shortfall_report(spark, sf_dir):
    """Labels still short of the target after K1 (needs are computed
    before the final dedupe, so base duplicates can leave a shortfall)."""
    return run_extend(spark, sf_dir).shortfall


@register("collect_page_metrics", FS.fold_sql(FX.LABELS, cfg=FOLD_CFG, tail="page_metrics"))
def q_collect_page_metrics(spark, sf_dir):
    """Per visited page, rows added and the running total of its step."""
    return run_fold(spark, sf_dir).pages


@register("collect_accepted", FS.fold_sql(FX.LABELS, cfg=FOLD_CFG, tail="accepted"))
def q_collect_accepted(spark, sf_dir):
    return run_fold(spark, sf_dir).accepted.select(*ACC_COLS)


@register("collect_metrics", FS.fold_sql(FX.LABELS, cfg=FOLD_CFG, tail="metrics"))
def q_collect_metrics(spark, sf_dir):
    return run_fold(spark, sf_dir).metrics


_ONE = [s for s in FX.REGISTRY if s["name"] == "src11"]
_ONE_CFG = C.CollectConfig(zero_streak=2)


@register("collect_one_source", FS.fold_sql(["Economy"], registry=_ONE, cfg=_ONE_CFG, tail="accepted"))
def q_collect_one_source(spark, sf_dir):
    return run_fold(spark, sf_dir, ["Economy"], _ONE, _ONE_CFG).accepted.select(*ACC_COLS)


_HTTP = [s for s in FX.REGISTRY if s["name"] in ("src3", "src9")]


@register("collect_http_continue", FS.fold_sql(["World", "Sports"], registry=_HTTP, cfg=HARVEST_CFG, quota=False))
def q_collect_http_continue(spark, sf_dir):
    """Non-200 pages are logged and skipped, no quota (harvest)."""
    return run_fold(spark, sf_dir, ["World", "Sports"], _HTTP, HARVEST_CFG, quota=False).accepted.select(*ACC_COLS)


@register("grow_two_labels", FS.fold_sql(["Sports", "Economy"], cfg=FOLD_CFG, tail="corpus"))
def q_grow_two_labels(spark, sf_dir):
    """K2: only Sports then Economy; other deficits are ignored."""
    res = run_fold(spark, sf_dir, ["Sports", "Economy"])
    return C.extend_corpus(clean_base(spark, sf_dir), res.accepted).select(*CORPUS_COLS)


@register("topup_no_streak", FS.fold_sql(FX.LABELS, cfg=NO_STREAK_CFG, tail="accepted"))
def q_topup_no_streak(spark, sf_dir):
    """Top-up cascades without the zero-streak rule."""
    return run_fold(spark, sf_dir, cfg=NO_STREAK_CFG).accepted.select(*ACC_COLS)


@register("topup_streaks", FS.fold_sql(FX.LABELS, cfg=STREAKS_CFG, tail="accepted"))
def q_topup_streaks(spark, sf_dir):
    """Per-source zero-streak thresholds."""
    return run_fold(spark, sf_dir, cfg=STREAKS_CFG).accepted.select(*ACC_COLS)


# ------------------------------------------------------------- extraction --

from corpusforge.operators import extract as X  # noqa: E402
from corpusforge.sources import feeds as FD  # noqa: E402

PAGE_KEY = ["page_id"]


def pages_tbl(spark, sf_dir):
    return V.read_table(spark, sf_dir, "pages")


# SQL: the well-formed ``<nav><ul><li><a href="…">text</a></li>…`` links of
# the supplied pages (no entities occur inside them at any scale factor).
_SQL_NAV = (
    "navl AS (SELECT page_id, url AS page_url, regexp_extract_all(html, '<li><a href=\"[^\"]*\">[^<]*</a></li>') AS l "
    "FROM pages),\n"
    "nav AS (SELECT page_id, page_url, i, regexp_extract(l[i], '<a href=\"([^\"]*)\">', 1) AS raw_href, "
    "regexp_extract(l[i], '\">([^<]*)</a>', 1) AS raw_text "
    "FROM (SELECT page_id, page_url, l, generate_subscripts(l, 1) AS i FROM navl)),\n"
    f"navt AS (SELECT page_id, page_url, i, raw_href, {S.strip('raw_href')} AS href, {S.strip('raw_text')} AS title "
    "FROM nav)"
)


def _sql_links(min_len: int, dedupe: bool = True, strict: bool = False, variant: str | None = None) -> str:
    op = ">" if strict else ">="
    k = f"SELECT * FROM navt WHERE length(title) {op} {min_len} AND length(title) > 0"
    if dedupe:
        k = (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id, title, href ORDER BY i) AS _d "
             f"FROM ({k})) WHERE _d = 1")
    v = f"{S.q(variant)} AS variant, " if variant else ""
    return (f"SELECT {v}page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) AS item_no, title, href "
            f"FROM ({k})")


@register("page_links", "WITH " + _SQL_NAV + "\n" + _sql_links(12))
def q_page_links(spark, sf_dir):
    """E1 + D4 with ``li a``: (title, href) items of each captured page."""
    items = X.extract_links(pages_tbl(spark, sf_dir), PAGE_KEY, ["li a"], min_len=12)
    return X.number_items(items, PAGE_KEY).select("page_id", "item_no", "title", "href")


_VARIANTS = [
    X.LinkRule("joined_min5", ["nav li a"], 5, "joined"),
    X.LinkRule("selector_major_min3", ["nav a", "li a"], 3, order_mode="selector"),
    X.LinkRule("no_dedupe_gt8", ["h2 a", "h3 a", "li a"], 8, dedupe=False, strict_len=True),
]


@register(
    "page_links_variants",
    "WITH " + _SQL_NAV + "\n" + "\nUNION ALL\n".join(
        _sql_links(r.min_len, r.dedupe, r.strict_len, r.name) for r in _VARIANTS
    ),
)
def q_page_links_variants(spark, sf_dir):
    """Text modes, selector-major order, dedupe off, other
    minimum lengths; each page is parsed once."""
    items = X.extract_variants(pages_tbl(spark, sf_dir), PAGE_KEY, _VARIANTS)
    return X.number_items(items, ["variant", *PAGE_KEY]).select("variant", "page_id", "item_no", "title", "href")


def _unescape_sql(x: str) -> str:
    """html.parser unescapes entities; the supplied articles use these five.
    A text cut inside an entity ends in its legacy form without ``;``
    (``...&amp``), which HTML5 also decodes: handled first, at the end only."""
    out = x
    for ent, ch in (("&amp", "&"), ("&lt", "<"), ("&gt", ">"), ("&quot", '"'), ("&#39", "'")):
        out = f"regexp_replace({out}, {S.q(ent + '$')}, {S.q(ch)})"
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = f"replace({out}, {S.q(ent)}, {S.q(ch)})"
    return out


def _sql_h1(min_len_exclusive: int, tier: int) -> str:
    txt = S.strip(_unescape_sql("regexp_extract(html, '<h1>(.*?)</h1>', 1)"))
    return (f"SELECT page_id, CAST({tier} AS INTEGER) AS tier, text FROM (SELECT page_id, {txt} AS text FROM pages) "
            f"WHERE length(text) > {min_len_exclusive}")


@register("page_headings", _sql_h1(15, 1))
def q_page_headings(spark, sf_dir):
    """``h2.post-title``, else the fallback tier (``h1`` here); whole
    text stripped; ``len > 15``."""
    h = X.headings_with_fallback(pages_tbl(spark, sf_dir), PAGE_KEY, ("h2.post-title", "h1"), 1, 15)
    return h.select("page_id", "tier", "text")


@register("heading_cascade", _sql_h1(20, 2))
def q_heading_cascade(spark, sf_dir):
    """``h2``; fewer than 3 -> ``h3``; fewer than 3 -> ``h1``; ``len > 20``."""
    h = X.headings_with_fallback(pages_tbl(spark, sf_dir), PAGE_KEY, ("h2", "h3", "h1"), 3, 20)
    return h.select("page_id", "tier", "text")


def retagged(spark, sf_dir):
    """The pages with other heading tags: of three pages the first has its
    title as ``h2.post-title``, the second as ``h3``, the third keeps ``h1``;
    of two pages the first has its menu entries as ``h2``."""
    html = F.col("html")
    title = lambda tag: F.regexp_replace(F.regexp_replace(html, "<h1>", f"<{tag}>"), "</h1>", f"</{tag.split()[0]}>")
    p = pages_tbl(spark, sf_dir)
    third = F.col("page_id") % 3
    p = p.withColumn("html", F.when(third == 0, title('h2 class="post-title"')).when(third == 1, title("h3")).otherwise(html))
    menu = F.replace(F.replace(html, F.lit("<li>"), F.lit("<h2>")), F.lit("</li>"), F.lit("</h2>"))
    return p.withColumn("html", F.when(F.col("page_id") % 2 == 0, menu).otherwise(html))


_SQL_H1_ALL = "hd AS (" + _sql_h1(0, 0) + ")"


@register(
    "heading_tiers",
    "WITH " + _SQL_H1_ALL + "\nSELECT page_id, CAST(page_id % 3 AS INTEGER) AS tier, text FROM hd WHERE length(text) > 15",
)
def q_heading_tiers(spark, sf_dir):
    """E7 where each of the three tiers has its pages."""
    h = X.headings_with_fallback(retagged(spark, sf_dir), PAGE_KEY, ("h2.post-title", "h3", "h1"), 1, 15)
    return h.select("page_id", "tier", "text")


@register(
    "heading_counts",
    "WITH " + _SQL_NAV + ",\n" + _SQL_H1_ALL + ",\n"
    "u AS (SELECT page_id, 0 AS tier, title AS text FROM navt WHERE page_id % 2 = 0 UNION ALL "
    "SELECT page_id, 0, text FROM hd WHERE page_id % 2 = 0 AND page_id % 3 = 0 UNION ALL "
    "SELECT page_id, 2, text FROM hd WHERE page_id % 2 = 1 AND page_id % 3 = 2)\n"
    "SELECT page_id, CAST(tier AS INTEGER) AS tier, text FROM u WHERE length(text) > 4",
)
def q_heading_counts(spark, sf_dir):
    """E7b where a tier needs three elements: menu entries make the first one
    of every second page, the rest fall through to the last."""
    h = X.headings_with_fallback(retagged(spark, sf_dir), PAGE_KEY, ("h2", "h3", "h1"), 3, 4)
    return h.select("page_id", "tier", "text")


_SQL_PAGE_TAGS = (
    "CASE regexp_extract(url, '\\.example\\.[a-z]+/([a-z]+)/', 1) WHEN 'en' THEN 'Politics' WHEN 'fr' THEN 'World' "
    "WHEN 'de' THEN 'Sports' WHEN 'es' THEN 'Economy' END AS label, regexp_extract(url, '://([^/]+)', 1) AS source"
)


PAGE_URL_KEY = ["page_id", "url"]  # the url goes through the parse with its page


def _with_tags(rows):
    """P20: label and source of each row from its page's url."""
    lang = F.regexp_extract("url", r"\.example\.[a-z]+/([a-z]+)/", 1)
    return rows.withColumns({"label": V._label_of(lang), "source": F.regexp_extract("url", "://([^/]+)", 1)})


@register(
    "harvest_all",
    "WITH h AS (" + _sql_h1(15, 1) + "),\ntags AS (SELECT page_id, " + _SQL_PAGE_TAGS + " FROM pages)\n"
    "SELECT h.page_id, h.text, tags.label, tags.source FROM h JOIN tags ON h.page_id = tags.page_id",
)
def q_harvest_all(spark, sf_dir):
    """K3: headings of every page, tagged with the page's label and source
    (P20), all kept (no dedupe)."""
    p = pages_tbl(spark, sf_dir)
    h = X.headings_with_fallback(p, PAGE_URL_KEY, ("h2.post-title", "h1"), 1, 15)
    return _with_tags(h).select("page_id", "text", "label", "source")


# Captured listing pages: the source is the page's domain, a page is a page of
# its own, and one in 37 could not be fetched.
PAGE_CFG = C.CollectConfig(min_title_len=5, empty_test="raw")
_SQL_CAP = (
    "cap AS (SELECT page_id, 'example.' || regexp_extract(url, '\\.example\\.([a-z]+)/', 1) AS source, "
    "CAST(page_id + 1 AS BIGINT) AS page_no, CASE WHEN page_id % 37 = 36 THEN NULL ELSE 200 END AS http_status, html FROM pages),\n"
    + _SQL_NAV + ",\nheadings AS (" + _sql_h1(0, 1) + "),\n"
)


def _sql_captured(sources) -> str:
    """Items and pages of the captures for each registry row (its id as the
    source): menu links, headings, or the headings before the links."""
    rows = []
    for i, r in enumerate(sources):
        heads, links = "article h1" in r["selectors"], any(x.endswith(" a") for x in r["selectors"])
        rows.append(f"('{i + 1}', {S.q(r['name'])}, {heads}, {links})")
    return (
        _SQL_CAP + f"ids(id, name, heads, links) AS (VALUES {', '.join(rows)}),\n"
        "archive AS (SELECT ids.id AS source, cap.page_no, CAST(nav.i AS BIGINT) AS pos, nav.title, nav.href FROM cap "
        "JOIN ids ON ids.name = cap.source AND ids.links JOIN navt nav ON nav.page_id = cap.page_id "
        "WHERE cap.http_status = 200 AND nav.title <> '' UNION ALL "
        "SELECT ids.id, cap.page_no, 0, headings.text, '' FROM cap JOIN ids ON ids.name = cap.source AND ids.heads "
        "JOIN headings ON headings.page_id = cap.page_id WHERE cap.http_status = 200),\n"
        "page_status AS (SELECT ids.id AS source, cap.page_no, cap.http_status FROM cap JOIN ids ON ids.name = cap.source)"
    )


def _sql_from_pages(columns: str, sources, labels, cfg, tail: str) -> str:
    """Twin of a fold over the captures; ids become names again."""
    own = {str(i + 1): cfg.k_for(r["name"]) for i, r in enumerate(sources)}
    fold = FS.fold_sql(labels, [{**r, "name": str(i + 1)} for i, r in enumerate(sources)],
                       replace(cfg, zero_streak_by_source=own), tail=tail, captured=_sql_captured(sources), corpus="headlines")
    names = ", ".join(f"('{i + 1}', {S.q(r['name'])})" for i, r in enumerate(sources))
    return f"SELECT {columns} FROM ({fold}) f LEFT JOIN (VALUES {names}) n(id, name) ON f.source = n.id"


def captured(spark, sf_dir):
    """The ``pages`` table as captured listing pages (``schema.PAGES``)."""
    return pages_tbl(spark, sf_dir).select(
        F.concat(F.lit("example."), F.regexp_extract("url", r"\.example\.([a-z]+)/", 1)).alias("source"),
        (F.col("page_id") + 1).cast("long").alias("page_no"), "url",
        F.when(F.col("page_id") % 37 != 36, F.lit(200)).alias("http_status"), "html",
    )


@register(
    "corpus_from_pages",
    _sql_from_pages(
        "f.part_no, f.row_id, f.step, f.page_no, f.text, f.label, CASE WHEN f.part_no = 1 THEN n.name ELSE f.source END AS source, f.url",
        FX.PAGE_SOURCES, FX.LABELS, PAGE_CFG, "corpus"),
)
def q_corpus_from_pages(spark, sf_dir):
    """K1 from captured pages: each source's own selectors, sites that serve
    two labels, quotas and stop rules, then keep-first with the base."""
    target = base_target(clean.clean_corpus(V.headlines(spark, sf_dir)))
    res = jobs.extend_from_pages(spark, V.headlines(spark, sf_dir), captured(spark, sf_dir), FX.PAGE_SOURCES, FX.LABELS, target, PAGE_CFG)
    return res.corpus.select(*[c for c in CORPUS_COLS if c != "pos"])


_NO_STREAK = replace(PAGE_CFG, zero_streak=None)
TOPUPS = {
    "topup_one_site": jobs.TopUp(FX.TOPUP_SOURCES["topup_one_site"], _NO_STREAK),  # K11
    "topup_three_sites": jobs.TopUp(FX.TOPUP_SOURCES["topup_three_sites"], _NO_STREAK, order_mode="selector"),  # K12
    "topup_keyword_site": jobs.TopUp(FX.TOPUP_SOURCES["topup_keyword_site"], _NO_STREAK),  # K13
    "topup_backup_site": jobs.TopUp(FX.TOPUP_SOURCES["topup_backup_site"], _NO_STREAK),  # K14
    "topup_categories_then_archive": jobs.TopUp(  # K15: 10 empty pages for categories, 25 for the archive
        FX.TOPUP_SOURCES["topup_categories_then_archive"],
        replace(PAGE_CFG, zero_streak=10, zero_streak_by_source={"example.org": 25})),
    "topup_archives": jobs.TopUp(FX.TOPUP_SOURCES["topup_archives"], replace(PAGE_CFG, zero_streak=80), "spaced"),  # K17
    "topup_two_archives": jobs.TopUp(FX.TOPUP_SOURCES["topup_two_archives"], _NO_STREAK),  # K18
}


def _register_top_up(name: str, job: jobs.TopUp) -> None:
    def q(spark, sf_dir):
        target = base_target(clean.clean_corpus(V.headlines(spark, sf_dir)))
        res = jobs.top_up(spark, V.headlines(spark, sf_dir), captured(spark, sf_dir), job, target)
        return res.accepted.select("step", "source", "label", "page_no", "text", "url")

    q.__name__ = f"q_{name}"
    columns = "f.step, n.name AS source, f.label, f.page_no, f.text, f.url"
    register(name, _sql_from_pages(columns, job.sources, job.labels, job.cfg, "accepted"))(q)


for _name, _job in TOPUPS.items():
    _register_top_up(_name, _job)

# Whole sites: an item may repeat within a page; a page without one ends its site.
HARVEST_PAGES_CFG = C.CollectConfig(min_title_len=3, dedupe_in_page=False)


@register(
    "harvest_sites",
    "WITH " + _sql_captured(FX.PAGE_SOURCES) + ",\nlong AS (SELECT * FROM archive WHERE length(title) >= 3),\n"
    "n AS (SELECT source, page_no, count(*) AS n FROM long GROUP BY ALL),\n"
    "stop AS (SELECT p.source, min(p.page_no) AS page_no FROM page_status p LEFT JOIN n USING (source, page_no) "
    "WHERE p.http_status <> 200 OR (p.http_status = 200 AND n.n IS NULL) GROUP BY p.source),\n"
    "lab(id, label) AS (VALUES " + ", ".join(f"('{i + 1}', {S.q(r['label'])})" for i, r in enumerate(FX.PAGE_SOURCES)) + "),\n"
    "read AS (SELECT CAST(i.source AS INTEGER) AS priority, ids.name AS source, lab.label, i.page_no, i.title AS text, "
    "CASE WHEN ids.heads THEN NULL ELSE i.href END AS url, i.pos FROM long i JOIN ids ON ids.id = i.source JOIN lab ON lab.id = i.source "
    "LEFT JOIN stop ON stop.source = i.source WHERE stop.page_no IS NULL OR i.page_no < stop.page_no)\n"
    "SELECT priority, source, label, page_no, text, url FROM read "
    "QUALIFY row_number() OVER (PARTITION BY text, url ORDER BY priority, page_no, pos) = 1",
)
def q_harvest_sites(spark, sf_dir):
    """K4: several sites page by page until their stop rule, keep-first by text
    and link."""
    rows = jobs.harvest_pages(spark, captured(spark, sf_dir), FX.PAGE_SOURCES, HARVEST_PAGES_CFG)
    return rows.drop("pos")


_CAT = dict(reject_words=["the", "ing", "and"], accept_prefix="/", reject_prefixes=["/a", "/b", "/c"],
            host="https://cat.example.org", limit=3)


@register(
    "category_members",
    "WITH " + _SQL_NAV + ",\nmem AS (SELECT page_id, i, title, raw_href FROM navt WHERE "
    + " AND ".join(f"NOT contains(title, {S.q(w)})" for w in _CAT["reject_words"])
    + f" AND starts_with(raw_href, {S.q(_CAT['accept_prefix'])})"
    + "".join(f" AND NOT starts_with(raw_href, {S.q(r)})" for r in _CAT["reject_prefixes"]) + ")\n"
    "SELECT page_id, member_no, title, url FROM (SELECT page_id, title, "
    f"{S.q(_CAT['host'])} || raw_href AS url, row_number() OVER (PARTITION BY page_id ORDER BY i) AS member_no "
    f"FROM mem) WHERE member_no <= {_CAT['limit']}",
)
def q_category_members(spark, sf_dir):
    """E10/E11, P11, P12, E13, W9 with ``nav li a`` standing in for the
    category-member list (reject words/prefixes chosen for the data)."""
    m = X.category_members(pages_tbl(spark, sf_dir), PAGE_KEY, "nav li a", **_CAT)
    return m.select("page_id", "member_no", "title", "url")


@register(
    "feed_discovery",
    "WITH " + _SQL_NAV + "\nSELECT p.page_id, f.feed_url FROM pages p LEFT JOIN (SELECT page_id, "
    "arg_min(raw_href, i) AS feed_url FROM navt WHERE contains(lower(title), 'the') AND contains(raw_href, '/t') "
    "GROUP BY page_id) f ON p.page_id = f.page_id",
)
def q_feed_discovery(spark, sf_dir):
    """First ``/t`` link inside an ``li`` mentioning ``the``."""
    return X.discover_feed(pages_tbl(spark, sf_dir), PAGE_KEY, "the", "/t").select("page_id", "feed_url")


# SQL twin of E12 for the supplied pages: every article is ``<h1>T</h1>``
# followed by ``<p><b>`` that is never closed, so (html.parser nesting) the
# first ``article > p`` holds every later text node of the article; its text
# is those nodes, unescaped and stripped, joined by one space.
_H1_RAW = "regexp_extract(a, " + S.q("^<h1>([^<]*)</h1>") + ", 1)"
_REST = "regexp_replace(a, " + S.q("^<h1>[^<]*</h1>") + ", '')"
_SQL_INTRO = (
    "art AS (SELECT page_id, url, regexp_extract(html, '<article>(.*?)</article>', 1) AS a FROM pages),\n"
    f"ti AS (SELECT page_id, url, {S.strip(_unescape_sql(_H1_RAW))} AS title, "
    f"array_to_string(list_filter(list_transform(string_split_regex({_REST}, '<[^>]*>'), "
    f"lambda x: {S.strip(_unescape_sql('x'))}), lambda x: x <> ''), ' ') AS intro FROM art),\n"
    "tix AS (SELECT page_id, url, title, intro, title || '. ' || intro AS text FROM ti WHERE length(intro) >= 15)"
)


@register("page_title_intro", "WITH " + _SQL_INTRO + "\nSELECT page_id, title, intro, text FROM tix")
def q_page_title_intro(spark, sf_dir):
    """E12 + P21: title and first long-enough intro paragraph of each page."""
    t = X.title_and_intro(pages_tbl(spark, sf_dir), PAGE_KEY, "h1", ["article > p", "article p"])
    return t.select("page_id", "title", "intro", "text")


@register(
    "topup_no_quota",
    _wv("headlines") + ",\n" + S.clean_cte("headlines", "cbase") + ",\n" + _SQL_INTRO + ",\n"
    "tags AS (SELECT page_id, " + _SQL_PAGE_TAGS + " FROM pages),\n"
    f"seen AS (SELECT DISTINCT {S.norm('text')} AS norm FROM cbase),\n"
    "new AS (SELECT tix.page_id AS row_id, tix.text, tags.label, tags.source, tix.url FROM tix "
    f"JOIN tags ON tix.page_id = tags.page_id WHERE {S.norm('tix.text')} NOT IN (SELECT norm FROM seen) "
    f"QUALIFY row_number() OVER (PARTITION BY {S.norm('tix.text')} ORDER BY tix.page_id) = 1)\n"
    "SELECT CAST(0 AS INTEGER) AS part_no, row_id, text, label, source, url FROM cbase UNION ALL "
    "SELECT CAST(1 AS INTEGER) AS part_no, row_id, text, label, source, url FROM new",
)
def q_topup_no_quota(spark, sf_dir):
    """Encyclopedia-style top-up: title + intro texts, minus everything
    already in the base (J1) or met on an earlier page (D5), appended (U1)
    with the page's url; no length filter, no quota."""
    t = X.title_and_intro(pages_tbl(spark, sf_dir), PAGE_URL_KEY, "h1", ["article > p", "article p"])
    new = _with_tags(t).select(F.col("page_id").alias("row_id"), "text", "label", "source", "url")
    base = clean.clean_corpus(V.headlines(spark, sf_dir))
    new = D.unseen(new.withColumn("nkey", TX.norm_key("text")), D.seen_set(base))
    new = D.keep_first(new, ["nkey"], order_cols=("row_id",)).drop("nkey")
    return M.union_parts([base.select(*HEADLINE_COLS), new]).select(*PART_COLS)


# ------------------------------------------------------------------ feeds --

_XML_BAD = r"[\x00-\x08\x0b\x0c\x0d\x0e-\x1f]"


def feeds_tbl(spark, sf_dir):
    """Captured feeds built from the listing: one feed per (source, page);
    odd pages RSS, even pages Atom, one page in 25 not XML.  Each feed holds the five
    items of its page, so grouping is bounded."""
    a = V.listing(spark, sf_dir)
    t = F.regexp_replace("title", _XML_BAD, "")
    esc = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    pub = F.concat(F.lit("2024-01-"), F.lpad((F.col("pos") + 1).cast("string"), 2, "0"))
    kind = F.when(F.col("page_no") % 25 == 10, 0).when(F.col("page_no") % 2 == 1, 1).otherwise(2)
    item = (
        F.when(kind == 1, F.concat(F.lit("<item><title>"), esc, F.lit("</title><link>"), F.col("href"),
                                   F.lit("</link><pubDate>"), pub, F.lit("</pubDate></item>")))
        .when(kind == 2, F.concat(F.lit("<entry><title>"), esc, F.lit("</title><updated>"), pub,
                                  F.lit("</updated></entry>")))
        .otherwise(F.concat(F.lit("<div>"), esc, F.lit("</div>")))
    )
    g = a.select("source", "page_no", "pos", item.alias("x")).groupBy("source", "page_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]), "").alias("body")
    )
    kind = F.when(F.col("page_no") % 25 == 10, 0).when(F.col("page_no") % 2 == 1, 1).otherwise(2)
    xml = (
        F.when(kind == 1, F.concat(F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>f</title>'),
                                   F.col("body"), F.lit("</channel></rss>")))
        .when(kind == 2, F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title>'),
                                  F.col("body"), F.lit("</feed>")))
        .otherwise(F.concat(F.lit("<html><body>"), F.col("body"), F.lit("</body></html>")))
    )
    return g.select("source", "page_no", xml.alias("xml"))


_FEED_MAX = 4
_SQL_FEED_BASE = (
    "fi AS (SELECT source, page_no, pos, "
    f"regexp_replace(title, {S.q(_XML_BAD)}, '', 'g') AS t, href, CASE WHEN page_no % 2 = 1 THEN 1 ELSE 2 END AS kind, "
    "'2024-01-' || lpad(CAST(pos + 1 AS VARCHAR), 2, '0') AS pub, "
    "row_number() OVER (PARTITION BY source, page_no ORDER BY pos) AS item_no FROM listing WHERE page_no % 25 <> 10)"
)


def _sql_classify(x: str) -> str:
    s = S.count_contains(f"lower({x})", FX.FIRST_KW)
    h = S.count_contains(f"lower({x})", [k.lower() for k in FX.SECOND_KW])
    return f"CASE WHEN {s} = 0 AND {h} = 0 THEN 'Other' WHEN {s} >= {h} THEN 'Sports' ELSE 'Health' END"


@register(
    "feed_items",
    _wv("listing") + ",\n" + _SQL_FEED_BASE + ",\n"
    f"f2 AS (SELECT source, page_no, item_no, {S.strip('t')} AS text, "
    f"CASE WHEN kind = 1 THEN {S.strip('href')} ELSE '' END AS url, pub AS published FROM fi WHERE item_no <= {_FEED_MAX})\n"
    f"SELECT source, page_no, item_no, text, label, url, published FROM (SELECT *, {_sql_classify('text')} AS label "
    "FROM f2 WHERE length(text) >= 12) WHERE label <> 'Other'",
)
def q_feed_items(spark, sf_dir):
    """RSS and Atom items (first 4 per feed), labelled by
    keyword vote, 'Other' dropped."""
    f = feeds_tbl(spark, sf_dir)
    return FD.feed_items(f, ["source", "page_no"], None, FX.FIRST_KW, FX.SECOND_KW, max_items=_FEED_MAX).select(
        "source", "page_no", "item_no", "text", "label", "url", "published"
    )


@register(
    "search_feed_titles",
    _wv("listing") + ",\n" + _SQL_FEED_BASE + "\n"
    f"SELECT source, page_no, item_no, text FROM (SELECT source, page_no, item_no, "
    f"{S.strip("split_part(t, '-', 1)")} AS text FROM fi) WHERE length(text) > 15",
)
def q_search_feed_titles(spark, sf_dir):
    """Every item of every feed, title cut at the first hyphen."""
    return FD.search_feed_titles(feeds_tbl(spark, sf_dir), ["source", "page_no"]).select(
        "source", "page_no", "item_no", "text"
    )


# ------------------------------------------------------ labels, registry --

from corpusforge.functions import text as TX  # noqa: E402
from corpusforge.functions import urls as U  # noqa: E402
from corpusforge.sources import csv as CSV  # noqa: E402
from corpusforge.operators.keywords import keyword_sets  # noqa: E402
from corpusforge.sources import registry as R  # noqa: E402
from corpusforge.sources.corpus import CorpusStore  # noqa: E402
from corpusforge.sources.registry import apply_keywords, frontier, labels_without_sources  # noqa: E402


def _sql_kw_case(col: str) -> str:
    parts = []
    for s in FX.ALL_SOURCES:
        apply = s.get("type") == "keyword_archive" or s.get("use_keyword_filter", False)
        kws = list(s.get("keywords") or [])
        cond = S.any_contains(col, kws) if (apply and kws) else "TRUE"
        parts.append(f"WHEN {S.q(s['name'])} THEN {cond}")
    return "CASE source " + " ".join(parts) + " END"


@register(
    "keyword_filter",
    _wv("listing") + ",\n" + FX.sql_registry(FX.ALL_SOURCES) + "\n"
    f"SELECT a.source, a.page_no, a.pos, a.title, r.label FROM listing a JOIN registry r ON a.source = r.name "
    f"WHERE {_sql_kw_case(S.norm('a.title')).replace('CASE source', 'CASE a.source')}",
)
def q_keyword_filter(spark, sf_dir):
    """P6 + P6a: keyword filter only where the source type asks for it."""
    reg = F.broadcast(sources_frame(spark, FX.ALL_SOURCES).select(
        F.col("name").alias("source"), "label", apply_keywords().alias("_apply"), "keywords"))
    a = V.listing(spark, sf_dir).select("source", "page_no", "pos", "title").join(reg, "source")
    keep = ~F.col("_apply") | TX.keyword_any_array(norm_text("title"), F.col("keywords"))
    return a.filter(keep).select("source", "page_no", "pos", "title", "label")


def _sql_classify_q() -> str:
    return (_wv("listing") + f"\nSELECT source, page_no, pos, title, {_sql_classify('title')} AS predicted "
            "FROM listing")


@register("classify_label", _sql_classify_q())
def q_classify_label(spark, sf_dir):
    """Keyword vote (tie -> first label, no hit -> Other)."""
    a = V.listing(spark, sf_dir)
    return a.select("source", "page_no", "pos", "title",
                    TX.classify_label("title", FX.FIRST_KW, FX.SECOND_KW).alias("predicted"))


@register(
    "registry_join",
    _wv("listing") + ",\n" + FX.sql_registry(FX.ALL_SOURCES) + "\n"
    "SELECT r.priority, r.name, r.label, a.page_no, a.pos, a.title, "
    "(r.type = 'keyword_archive' OR r.use_keyword_filter) AS apply_keywords "
    "FROM listing a JOIN registry r ON a.source = r.name",
)
def q_registry_join(spark, sf_dir):
    """Items tagged with their source's registry row."""
    reg = sources_frame(spark, FX.ALL_SOURCES)
    r = F.broadcast(reg.select("priority", "name", "label", apply_keywords().alias("apply_keywords")))
    a = V.listing(spark, sf_dir).select("source", "page_no", "pos", "title")
    return a.join(r, a["source"] == r["name"]).select(
        "priority", "name", "label", "page_no", "pos", "title", "apply_keywords"
    )


_LABELS_PLUS = FX.LABELS + ["Health"]


@register(
    "label_sources",
    _wv("listing") + ",\n" + FX.sql_registry(FX.ALL_SOURCES) + ",\n" + FX.sql_labels("req", _LABELS_PLUS) + "\n"
    "SELECT req.label_pos, req.label, CAST(count(r.name) AS BIGINT) AS n_sources FROM req LEFT JOIN "
    "(SELECT * FROM registry WHERE name IN (SELECT source FROM listing)) r ON r.label = req.label "
    "GROUP BY req.label_pos, req.label",
)
def q_label_sources(spark, sf_dir):
    """J2 report: how many captured sources each requested label has
    (``Health`` has none)."""
    captured = V.listing(spark, sf_dir).select(F.col("source").alias("name")).distinct()
    reg = sources_frame(spark, FX.ALL_SOURCES).join(captured, "name", "left_semi")
    return labels_without_sources(spark, _LABELS_PLUS, reg)


def _sql_page_url() -> str:
    wp = ("regexp_replace(r.base_url, '/+$', '') || '/' || CASE WHEN ps.page_no = 1 THEN '' "
          "ELSE 'page/' || CAST(ps.page_no AS VARCHAR) || '/' END")
    return f"CASE r.pagination WHEN 'wp' THEN {wp} WHEN 'param' THEN r.base_url || CAST(ps.page_no AS VARCHAR) END"


_SQL_FRONTIER_JOIN = (
    "FROM listing_status ps JOIN registry r ON ps.source = r.name "
    "AND ps.page_no BETWEEN r.start_page AND r.max_pages"
)


def _frontier_df(spark, sf_dir):
    reg = F.broadcast(sources_frame(spark, FX.ALL_SOURCES))
    ps = V.listing_status(spark, sf_dir)
    return ps.join(reg, ps["source"] == reg["name"]).filter(
        F.col("page_no").between(F.col("start_page"), F.col("max_pages"))
    )


@register(
    "frontier_urls",
    _wv("listing_status") + ",\n" + FX.sql_registry(FX.ALL_SOURCES) + f"\nSELECT r.name, ps.page_no, {_sql_page_url()} AS url "
    + _SQL_FRONTIER_JOIN,
)
def q_frontier_urls(spark, sf_dir):
    """The URL of every captured page inside each source's
    ``start_page..max_pages`` range."""
    f = _frontier_df(spark, sf_dir)
    return f.select("name", "page_no", U.page_url("pagination", "base_url", "page_no").alias("url"))


@register(
    "always_suffixed_urls",
    _wv("listing_status") + ",\n" + FX.sql_registry(FX.ALL_SOURCES)
    + "\nSELECT r.name, ps.page_no, regexp_replace(r.base_url, '/+$', '') || '/page/' || CAST(ps.page_no AS VARCHAR) "
    "|| '/' AS url, r.label || '_' || r.name AS label_key " + _SQL_FRONTIER_JOIN,
)
def q_always_suffixed_urls(spark, sf_dir):
    """``base/page/`` + N + ``/`` also for page 1."""
    f = _frontier_df(spark, sf_dir)
    base = F.concat(F.regexp_replace("base_url", "/+$", ""), F.lit("/page/"))
    return f.select("name", "page_no", U.suffixed_page_url(base, "page_no").alias("url"),
                    F.concat("label", F.lit("_"), "name").alias("label_key"))


@register(
    "label_from_key",
    _wv("listing") + "\nSELECT source, page_no, pos, label || '_' || source AS label_key, "
    "CASE WHEN contains(label || '_' || source, 'Sports') THEN 'Sports' ELSE label || '_' || source END AS label "
    "FROM listing",
)
def q_label_from_key(spark, sf_dir):
    """Label from a registry key (``'Sports' if 'Sports' in key``)."""
    a = V.listing(spark, sf_dir).withColumn("label_key", F.concat("label", F.lit("_"), "source"))
    return a.select("source", "page_no", "pos", "label_key", U.label_from_key("label_key").alias("label"))


# ------------------------------------------------------------- CSV, merge --

_NA_IN = ", ".join(S.q(t) for t in __import__("corpusforge.schema", fromlist=["NA_TOKENS"]).NA_TOKENS)


def _na(c: str) -> str:
    return f"CASE WHEN {c} IN ({_NA_IN}) THEN NULL ELSE {c} END"


@register(
    "csv_roundtrip",
    _wv("headlines") + f"\nSELECT row_id, {_na('text')} AS text, {_na('label')} AS label, {_na('source')} AS source, "
    f"{_na('url')} AS url FROM headlines",
)
def q_csv_roundtrip(spark, sf_dir):
    """Write the raw headlines as CSV to a fresh path under the
    shared checkpoint folder, read them back with the fixed schema."""
    h = V.headlines(spark, sf_dir)
    path = CSV.write_corpus_csv(h, spark=spark)
    return CSV.read_corpus_csv(spark, path, "row_id long, text string, label string, source string, url string")


@register("tolerant_load", _wv("headlines") + "\nSELECT CAST(1 AS INTEGER) AS part_no, row_id, text, label, source, url "
          "FROM headlines")
def q_tolerant_load(spark, sf_dir):
    """A missing first part reads as empty (part 0); the union with
    the corpus (part 1) carries on."""
    from corpusforge.session import scratch_path

    missing = CSV.read_tolerant(spark, scratch_path(spark, "does-not-exist") + "/x.csv",
                                "row_id long, text string, label string, source string, url string")
    return M.union_parts([missing, V.headlines(spark, sf_dir)]).select(*PART_COLS)


_TORN = "(row_id % 17 = 3 OR row_id % 23 = 5 OR row_id % 29 = 7)"


@register(
    "tolerant_rows",
    _wv("headlines") + ", line AS (SELECT row_id, replace(replace(translate(text, chr(10) || chr(13), '  '), chr(92), '/'), "
    "chr(34), chr(39)) AS text, label, source, url FROM headlines)\n"
    f"SELECT row_id, {_na('text')} AS text, label, source, {_na('url')} AS url FROM line WHERE NOT {_TORN}",
)
def q_tolerant_rows(spark, sf_dir):
    """CSV lines of which some lack fields, have one too many or a number
    that is none: the rest is read, those are rejects."""
    from corpusforge.session import scratch_path

    text = F.replace(F.replace(F.translate("text", "\n\r", "  "), F.lit("\\"), F.lit("/")), F.lit('"'), F.lit("'"))
    q = lambda c: F.concat(F.lit('"'), F.coalesce(c, F.lit("")), F.lit('"'))
    rid, tail = F.col("row_id"), F.concat(F.lit(","), q(F.col("url")))
    line = F.concat(
        F.when(rid % 29 == 7, F.concat(F.lit("no"), rid.cast("string"))).otherwise(rid.cast("string")), F.lit(","), q(text), F.lit(","),
        F.col("label"), F.lit(","), F.col("source"),
        F.when(rid % 17 == 3, "").when(rid % 23 == 5, F.concat(tail, F.lit(",more"))).otherwise(tail),
    )
    path = scratch_path(spark, "torn-csv")
    head = "row_id,text,label,source,url"
    plain = {"header": "true", "quote": "", "escape": "", "quoteAll": "false", "sep": "\u0001", "escapeQuotes": "false"}
    V.headlines(spark, sf_dir).select(line.alias(head)).write.options(**plain).csv(path)
    good, _ = CSV.read_rows_tolerant(spark, path, "row_id long, text string, label string, source string, url string")
    return good


@register(
    "corpus_versions",
    _wv("base", "archive") + ",\n" + _SQL_ARCH_CORPUS + ",\n" + _SQL_UNION + ",\n"
    f"kept AS (SELECT *, {S.md5_key(FX.SEED, 'part_no', 'row_id')} AS shuffle_key FROM parts "
    f"QUALIFY row_number() OVER (PARTITION BY {S.norm('text')} ORDER BY part_no, row_id) = 1)\n"
    "SELECT row_number() OVER (ORDER BY shuffle_key, part_no, row_id) - 1 AS row_no, part_no, row_id, text, label, shuffle_key FROM kept",
)
def q_corpus_versions(spark, sf_dir):
    """A corpus version is written, a second run reads it back,
    adds the archive's unseen titles and writes the next one in shuffled order;
    the newest version's rows with their places."""
    from corpusforge.session import scratch_path

    store = CorpusStore(spark, scratch_path(spark, "corpus"))
    order = ["shuffle_key", "part_no", "row_id"]
    cols = ["part_no", "row_id", "text", "label"]
    store.write(M.union_parts([V.base(spark, sf_dir)]).select(*cols))
    old = store.read()
    new = archive_as_corpus(spark, sf_dir).withColumn("nkey", TX.norm_key("text"))
    new = D.unseen(new, D.seen_set(old)).withColumn("part_no", F.lit(1))
    both = D.dedupe_norm(old.unionByName(new.select(*cols)))
    store.write(B.shuffle(both, FX.SEED, ("part_no", "row_id")), order)
    return store.read_numbered().select("row_no", "part_no", "row_id", "text", "label", "shuffle_key")


@register(
    "merge_parts",
    _wv("base", "archive") + ",\n" + _SQL_ARCH_CORPUS + ",\n" + _SQL_UNION + "\n"
    f"SELECT part_no, row_id, text, label, {S.md5_key(FX.SEED, 'part_no', 'row_id')} AS shuffle_key FROM parts",
)
def q_merge_parts(spark, sf_dir):
    """K6: project (text, label) of each part, union, seeded shuffle."""
    parts = [V.base(spark, sf_dir).select("row_id", "text", "label"),
             archive_as_corpus(spark, sf_dir).select("row_id", "text", "label")]
    return B.shuffle(M.union_parts(parts), FX.SEED, ("part_no", "row_id")).select(
        "part_no", "row_id", "text", "label", "shuffle_key")


@register(
    "merge_tolerant",
    _wv("base", "archive") + ",\n" + _SQL_ARCH_CORPUS + ",\n" + _SQL_UNION
    + ",\nkept AS (" + _keep_first_sql("parts", "text", PART_COLS, "part_no, row_id") + ")\n"
    f"SELECT part_no + 1 AS part_no, row_id, text, {_title_case_sql('label')} AS label, source, url, "
    f"{S.md5_key(FX.SEED, 'part_no + 1', 'row_id')} AS shuffle_key FROM kept",
)
def q_merge_tolerant(spark, sf_dir):
    """K7: tolerant load (a missing first part), union, keep-first by text,
    title-case labels, seeded shuffle."""
    from corpusforge.session import scratch_path

    missing = CSV.read_tolerant(spark, scratch_path(spark, "missing") + "/part.csv",
                                "row_id long, text string, label string, source string, url string")
    u = M.union_parts([missing, V.base(spark, sf_dir), archive_as_corpus(spark, sf_dir)]).select(*PART_COLS)
    d = D.dedupe_text(u).withColumn("label", TX.title_case("label"))
    return B.shuffle(d, FX.SEED, ("part_no", "row_id"))


@register(
    "concat_parts",
    _wv("base", "archive") + ",\n" + _SQL_ARCH_CORPUS + ",\n" + _SQL_UNION + "\n"
    "SELECT CAST(0 AS INTEGER) AS part_no, row_id, text, label, source, CAST(NULL AS VARCHAR) AS url FROM arch "
    "UNION ALL SELECT CAST(1 AS INTEGER) AS part_no, row_id, text, label, source, url FROM parts",
)
def q_concat_parts(spark, sf_dir):
    """Concat a part with a file that already contains it (bag
    semantics: the self-inclusion is kept, not silently fixed)."""
    arch = archive_as_corpus(spark, sf_dir)
    combined = M.union_parts([V.base(spark, sf_dir), arch]).select(*PART_COLS)
    a = M.with_order(arch, 0).select(*[c for c in PART_COLS if c != "url"]).withColumn("url", F.lit(None).cast("string"))
    return a.select(*PART_COLS).unionByName(combined.withColumn("part_no", F.lit(1))).select(*PART_COLS)


@register(
    "harvest_dedupe",
    "WITH " + _SQL_NAV + ",\nlinks AS (" + _sql_links(12) + "),\n"
    + _wv("listing")[len("WITH "):] + ",\n" + _SQL_FEED_BASE + ",\n"
    f"f2 AS (SELECT source, page_no, item_no, {S.strip('t')} AS text, "
    f"CASE WHEN kind = 1 THEN {S.strip('href')} ELSE '' END AS url FROM fi WHERE item_no <= {_FEED_MAX}),\n"
    f"feeds AS (SELECT * FROM (SELECT *, {_sql_classify('text')} AS label FROM f2 WHERE length(text) >= 12) "
    "WHERE label <> 'Other'),\n"
    "tags AS (SELECT page_id, " + _SQL_PAGE_TAGS + " FROM pages),\n"
    "u AS (SELECT CAST(0 AS INTEGER) AS part_no, CAST(l.page_id AS BIGINT) AS k1, l.item_no AS k2, '' AS k3, "
    "l.title AS text, t.label, t.source, l.href AS url FROM links l JOIN tags t ON l.page_id = t.page_id "
    "UNION ALL SELECT CAST(1 AS INTEGER), page_no, item_no, source, text, label, source, url FROM feeds)\n"
    "SELECT part_no, k1, k2, k3, text, label, source, url FROM (SELECT *, row_number() OVER (PARTITION BY text "
    "ORDER BY part_no, k1, k2, k3) AS _k FROM u) WHERE _k = 1",
)
def q_harvest_dedupe(spark, sf_dir):
    """K4/K5: page links and feed items unioned, then keep-first by text."""
    p = pages_tbl(spark, sf_dir)
    links = _with_tags(X.number_items(X.extract_links(p, PAGE_URL_KEY, ["li a"], min_len=12), PAGE_URL_KEY))
    l = links.select(F.lit(0).alias("part_no"), F.col("page_id").cast("long").alias("k1"), F.col("item_no").alias("k2"),
                     F.lit("").alias("k3"), F.col("title").alias("text"), "label", "source", F.col("href").alias("url"))
    f = FD.feed_items(feeds_tbl(spark, sf_dir), ["source", "page_no"], None, FX.FIRST_KW, FX.SECOND_KW,
                      max_items=_FEED_MAX)
    fi = f.select(F.lit(1).alias("part_no"), F.col("page_no").alias("k1"), F.col("item_no").alias("k2"),
                  F.col("source").alias("k3"), "text", "label", "source", "url")
    return D.keep_first(l.unionByName(fi), [F.sha2(F.col("text"), 256)], order_cols=("part_no", "k1", "k2", "k3"))


_SQL_FEED_LABEL = "CASE page_no % 3 WHEN 0 THEN 'Sports' WHEN 1 THEN 'Health' ELSE 'Economy' END"


@register(
    "harvest_categories_and_search",
    "WITH " + _SQL_NAV + ",\n" + _wv("listing")[len("WITH "):] + ",\n" + _SQL_FEED_BASE + ",\n"
    "tags AS (SELECT page_id, " + _SQL_PAGE_TAGS + " FROM pages),\n"
    "u AS (SELECT CAST(0 AS INTEGER) AS part_no, CAST(n.page_id AS BIGINT) AS k1, CAST(n.i AS BIGINT) AS k2, '' AS k0, n.title AS text, t.label, "
    "'Wikipedia' AS source FROM navt n JOIN tags t ON n.page_id = t.page_id WHERE length(n.title) > 5 "
    f"UNION ALL SELECT 1, page_no, item_no, source, {S.strip("split_part(t, '-', 1)")}, {_SQL_FEED_LABEL}, 'Google News RSS' FROM fi "
    f"WHERE length({S.strip("split_part(t, '-', 1)")}) > 15)\n"
    "SELECT part_no, text, label, source FROM u QUALIFY row_number() OVER (PARTITION BY text ORDER BY part_no, k0, k1, k2) = 1",
)
def q_harvest_categories_and_search(spark, sf_dir):
    """K5: category members and search-feed titles; ``nav li a`` stands in for
    the member list, a feed's label follows from its page."""
    feeds = feeds_tbl(spark, sf_dir).withColumn(
        "label", F.when(F.col("page_no") % 3 == 0, "Sports").when(F.col("page_no") % 3 == 1, "Health").otherwise("Economy"))
    pages = _with_tags(pages_tbl(spark, sf_dir))
    return jobs.harvest_categories_and_search(pages, feeds, ["page_id"], ["source", "page_no"], "nav li a")


_KEYWORD_SETS = {
    "economy": R.ECONOMY_KEYWORDS, "sports": R.SPORTS_KEYWORDS, "health": R.HEALTH_KEYWORDS, "text": FX.TEXT_KEYWORDS, "short": ["a", "ß", "qu", "ññ"],
}


@register(
    "keyword_sets",
    _wv("headlines") + f", n AS (SELECT row_id, {S.norm('text')} AS norm FROM headlines)\n" + " UNION ALL ".join(
        f"SELECT row_id, '{name}' AS set_name, CAST({S.count_contains('norm', sorted(set(words)))} AS BIGINT) AS n_keywords FROM n "
        f"WHERE {S.any_contains('norm', words)}" for name, words in _KEYWORD_SETS.items()),
)
def q_keyword_sets(spark, sf_dir):
    """Which keyword sets each headline hits and with how many keywords,
    all sets in one pass."""
    rows = V.headlines(spark, sf_dir)
    return keyword_sets(rows, ["row_id"], TX.norm_text("text"), R.keywords_frame(spark, _KEYWORD_SETS))


def _sql_profile() -> str:
    np_ = _sql_null_profile("headlines", HEADLINE_COLS)
    return (
        _wv("headlines") + ",\nnp AS (" + np_ + ")\n"
        "SELECT 'rows' AS metric, '' AS key, count(*) AS value FROM headlines\n"
        "UNION ALL SELECT 'n_labels', '', count(DISTINCT label) FROM headlines\n"
        "UNION ALL SELECT 'n_sources', '', count(DISTINCT source) FROM headlines\n"
        "UNION ALL SELECT 'label_first_row', label, min(row_id) FROM headlines GROUP BY label\n"
        "UNION ALL SELECT 'source_first_row', source, min(row_id) FROM headlines GROUP BY source\n"
        "UNION ALL SELECT 'sample', label || ':' || CAST(rn AS VARCHAR), row_id FROM (SELECT label, row_id, "
        "row_number() OVER (PARTITION BY label ORDER BY row_id) AS rn FROM headlines "
        "WHERE label IN ('Politics', 'World', 'Sports', 'Economy')) WHERE rn <= 5\n"
        "UNION ALL SELECT 'nulls', column_name, nulls FROM np\n"
        "UNION ALL SELECT 'total_nulls', '', CAST(sum(nulls) AS BIGINT) FROM np\n"
        "UNION ALL SELECT 'columns_with_nulls', '', CAST(count_if(nulls > 0) AS BIGINT) FROM np"
    )


@register("profile_report", _sql_profile())
def q_profile_report(spark, sf_dir):
    """K19 as one long table ``(metric, key, value)`` (one grouping-sets pass
    plus the per-label samples)."""
    return profile.profile_report(V.headlines(spark, sf_dir), sample_labels=FX.LABELS)


# -------------------------------------------------------------- streaming --

from corpusforge.streaming import growth as G  # noqa: E402


def _sql_growth(head: str, corpus: str, sources, names: str = "source") -> str:
    """Two batches, each folded label by label and source by source (``it`` has
    the items, with their batch and the registry row that reads them)."""
    ctes, taken, by_label = [], "SELECT norm FROM seen0", {}
    for b in (0, 1):
        for n, label, src in FS.steps(sources, FX.LABELS):
            priority = sources.index(src) + 1
            used = "".join(f" - (SELECT count(*) FROM {x})" for x in by_label.get(label, []))
            ctes.append(
                f"b{b}s{n} AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY page_no, pos) AS rk FROM (SELECT *, row_number() "
                f"OVER (PARTITION BY norm ORDER BY page_no, pos) AS _f FROM it WHERE batch = {b} AND priority = {priority} "
                f"AND norm NOT IN ({taken})) WHERE _f = 1) WHERE rk <= (SELECT need FROM need0 WHERE label = {S.q(label)}){used})"
            )
            taken += f" UNION ALL SELECT norm FROM b{b}s{n}"
            by_label.setdefault(label, []).append(f"b{b}s{n}")
    all_ = " UNION ALL ".join(f"SELECT CAST({x[1]} AS BIGINT) AS batch_id, {names}, label, page_no, pos, text, url FROM {x}"
                              for xs in by_label.values() for x in xs)
    return (
        head + ",\n" + S.clean_cte(corpus, "cbase") + ",\ntgt AS (SELECT count(*) // 5 AS target FROM cbase),\n"
        f"seen0 AS (SELECT DISTINCT {S.norm('text')} AS norm FROM cbase),\n"
        "need0 AS (SELECT req.label, greatest(0, tgt.target - coalesce(h.n, 0)) AS need FROM req LEFT JOIN "
        "(SELECT label, count(*) AS n FROM cbase GROUP BY label) h ON h.label = req.label, tgt),\n" + ",\n".join(ctes) + "\n" + all_
    )


def _sql_growth_items() -> str:
    kw = _sql_kw_case(S.norm("a.title")).replace("CASE source", "CASE a.source")
    head = (
        _wv("base", "archive") + ",\n" + FX.sql_labels() + ",\n" + FX.sql_registry() + ",\n"
        "it AS (SELECT a.source, a.page_no, a.pos, a.title AS text, a.href AS url, r.label, r.priority, "
        f"{S.norm('a.title')} AS norm, CASE WHEN a.page_no % 2 = 1 THEN 0 ELSE 1 END AS batch "
        f"FROM archive a JOIN registry r ON a.source = r.name JOIN req ON req.label = r.label WHERE length(a.title) >= 12 AND {kw})"
    )
    return _sql_growth(head, "base", list(FX.REGISTRY))


def _sql_growth_pages() -> str:
    kw = " ".join(
        f"WHEN {i + 1} THEN {S.any_contains(S.norm('a.title'), list(r['keywords']))}"
        for i, r in enumerate(FX.PAGE_SOURCES) if r.get("type") == "keyword_archive"
    )
    head = (
        _wv("headlines") + ",\n" + FX.sql_labels() + ",\n" + FX.sql_registry(FX.PAGE_SOURCES) + ",\n" + _sql_captured(FX.PAGE_SOURCES) + ",\n"
        "it AS (SELECT r.name AS source, a.page_no, a.pos, a.title AS text, a.href AS url, r.label, r.priority, "
        f"{S.norm('a.title')} AS norm, CASE WHEN a.page_no % 2 = 1 THEN 0 ELSE 1 END AS batch "
        "FROM archive a JOIN registry r ON a.source = CAST(r.priority AS VARCHAR) "
        f"WHERE length(a.title) >= 5 AND CASE r.priority {kw} ELSE TRUE END)"
    )
    sql = _sql_growth(head, "headlines", list(FX.PAGE_SOURCES))
    return f"SELECT batch_id, source, label, page_no, text, url FROM ({sql})"


def _grown(spark, base, batches, reg, target, pages):
    """Output of a stream that is stopped and started again after each batch of files."""
    from corpusforge.session import scratch_path

    root = scratch_path(spark, "growth")
    gbase = G.prepare_base(spark, base, f"{root}/base")
    for rows in batches:
        rows.write.mode("append").parquet(f"{root}/in")
        q = G.start_growth(spark, f"{root}/in", gbase, reg, FX.LABELS, target, f"{root}/out", f"{root}/checkpoint",
                           min_title_len=5 if pages else 12, pages=pages)
        q.awaitTermination()
    # batch_id also names the output folders; read it back as the long it is.
    return spark.read.parquet(f"{root}/out").withColumn("batch_id", F.col("batch_id").cast("long"))


@register("growth_from_pages", _sql_growth_pages())
def q_growth_from_pages(spark, sf_dir):
    """T1 from captured pages: odd pages, then even ones; each source's own
    selectors give the items, keyed state what has been seen."""
    base = clean.clean_corpus(V.headlines(spark, sf_dir))
    cap = captured(spark, sf_dir).select("source", "page_no", "url", F.col("http_status").cast("int").alias("http_status"), "html")
    reg = sources_frame(spark, FX.PAGE_SOURCES)
    batches = [cap.filter(F.col("page_no") % 2 == parity) for parity in (1, 0)]
    out = _grown(spark, base, batches, reg, base_target(base), pages=True)
    return out.select("batch_id", "source", "label", "page_no", "text", "url")


@register("incremental_growth", _sql_growth_items())
def q_incremental_growth(spark, sf_dir):
    """Archive items arrive in two file batches (odd pages, then even
    pages); an ``availableNow`` stream appends unseen titles up to each
    label's remaining need.  Returns the appended rows (end state)."""
    items = V.archive(spark, sf_dir).select("source", "page_no", "pos", "title", "href")
    cb = clean_base(spark, sf_dir)
    batches = [items.filter(F.col("page_no") % 2 == parity) for parity in (1, 0)]
    out = _grown(spark, cb, batches, sources_frame(spark, FX.REGISTRY), base_target(cb), pages=False)
    return out.select("batch_id", "source", "label", "page_no", "pos", "text", "url")
