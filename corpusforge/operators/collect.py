"""Ordered collect-until-quota over prioritised sources (W1-W10, A9, A11-A13,
D5, J1, J2, J5, P6, P6a, P20).

The sequential crawl loop of one source is restated as prefix cuts over the
page order:

* W1  request error (null status): page skipped, streak untouched;
* W2  first non-200 page ends the source (``stop_on_http``; W2b continues);
* W3  first 200-page with no items ends the source (``stop_on_empty``);
* D5/J1 an item is a candidate if its normalised title is not in the seen
  set and is the first of its norm in the source (``min`` over
  ``(page, pos)``); P6 keyword filter where P6a says so;
* W5  pages after the first one at which ``K`` visited pages in a row have added
  nothing are cut;
* W4  quota: ``before`` (accepted on earlier pages) + rank inside the page
  ``<= need``.

Both cut-offs and the quota select a *prefix* in ``(page, pos)`` order, so
this equals the loop.  Across sources the fold is sequential (W6/W7): rows
behind one source's cut stay unseen and can be claimed by the next source;
``rounds`` finds its outcome for all sources at once.

A source is a registry row: its id is its ``priority``, and one site may
serve several labels under the same name.  Pages and items that carry a
``priority`` column belong to that row alone, others to every row of their
source name.

Scale: titles become keys in the map stage; in-page dedupe, stop rules, anti join
with the base's seen set and keep-first work on keys and positions alone, in
one pass that is written once.  Page tables are scanned in segments, rounds read
them and the titles that several sources hold, and the titles of the accepted
rows are looked up at the end.  Whatever is written goes under the shared
checkpoint folder, which cuts lineage and lets a rerun skip finished parts (W8).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusforge.functions.text import keyword_any_array, norm_text
from corpusforge.operators import rounds
from corpusforge.operators.dedupe import dedupe_in_page, keep_first, seen_set
from corpusforge.session import local_rows, path_exists, scratch_path
from corpusforge.sources.registry import apply_keywords


@dataclass(frozen=True)
class CollectConfig:
    """Knobs of one collection run (defaults = the modular job)."""

    min_title_len: int = 12
    zero_streak: int | None = 80
    # Per-source override of ``zero_streak`` (name -> K, None = no rule).
    zero_streak_by_source: Mapping[str, int | None] = field(default_factory=dict)
    stop_on_http: bool = True
    stop_on_empty: bool = True
    # What "empty page" means: items after length filter and in-page dedupe
    # ("long_enough"), raw links ("raw"), or after dedupe only ("deduped").
    empty_test: str = "long_enough"
    dedupe_in_page: bool = True
    apply_keyword_filter: bool = True

    def k_for(self, name: str) -> int | None:
        return self.zero_streak_by_source.get(name, self.zero_streak)


ACCEPTED_SCHEMA = "step int, source string, label string, page_no long, pos long, text string, url string, nkey string"

def prepare_items(items: DataFrame, cfg: CollectConfig) -> tuple[DataFrame, DataFrame]:
    """E1 post-filters and the per-page item count used by the empty test.

    Returns ``(kept_items, page_counts(source, page_no, n_items))``.
    """
    long = items.filter(F.length("title") >= cfg.min_title_len)
    kept = dedupe_in_page(long) if cfg.dedupe_in_page else long
    if cfg.empty_test == "raw":
        counted = items
    elif cfg.empty_test == "deduped":
        counted = dedupe_in_page(items)
    elif cfg.empty_test == "long_enough":
        counted = kept
    else:
        raise ValueError(f"Unknown empty_test: {cfg.empty_test}")
    counts = counted.groupBy("source", "page_no").agg(F.count(F.lit(1)).alias("n_items"))
    return kept, counts


def visible_pages(pages: DataFrame, counts: DataFrame, reg: DataFrame, cfg: CollectConfig) -> DataFrame:
    """(source, page_no) that each source actually reads before a hard stop
    (W1-W3).  Page-level table only; a source's first stop is an aggregate."""
    r = reg.select(F.col("name").alias("source"), "start_page", "max_pages")
    p = (
        pages.select("source", "page_no", "http_status")
        .join(F.broadcast(r), "source")
        .filter(F.col("page_no").between(F.col("start_page"), F.col("max_pages")))
        .join(counts, ["source", "page_no"], "left")
        .withColumn("n_items", F.coalesce("n_items", F.lit(0)))
    )
    st = F.col("http_status")
    stop = F.lit(False)
    if cfg.stop_on_http:
        stop = stop | (st.isNotNull() & (st != 200))
    if cfg.stop_on_empty:
        stop = stop | ((st == 200) & (F.col("n_items") == 0))
    if cfg.stop_on_http or cfg.stop_on_empty:
        ends = p.filter(stop).groupBy("source").agg(F.min("page_no").alias("_end"))
        p = p.join(F.broadcast(ends), "source", "left").filter(F.col("_end").isNull() | (F.col("page_no") < F.col("_end")))
    return p.filter(st == 200).select("source", "page_no")


def item_keys(items: DataFrame, reg: DataFrame, cfg: CollectConfig) -> DataFrame:
    """What collection needs of an item: its place, keys of title, link and
    normalised title, whether the title is long enough and has a keyword that
    its source asks for."""
    r = reg.select(F.col("name").alias("source"), apply_keywords().alias("_apply"), "keywords")
    rows = items.join(F.broadcast(r), "source").withColumn("norm", norm_text("title"))  # the caller has the registry on the driver
    fits = ~F.col("_apply") | keyword_any_array("norm", F.col("keywords")) if cfg.apply_keyword_filter else F.lit(True)
    return rows.select(
        "source", "page_no", "pos", (F.length("title") >= cfg.min_title_len).alias("long"), F.sha2("title", 256).alias("tkey"),
        F.sha2("href", 256).alias("hkey"), F.sha2("norm", 256).alias("nkey"), fits.alias("fits"),
    )


def candidates(items: DataFrame, pages: DataFrame, reg: DataFrame, seen: DataFrame | None, cfg: CollectConfig) -> tuple[DataFrame, DataFrame]:
    """(visible pages, candidates): candidates are the items on visible pages
    that pass the filters, are not in the seen set and are the first of their
    norm in their source, as (source, nkey, page_no, pos)."""
    # a page's items in one place: in-page repeats, item counts and the page's status meet without another shuffle
    keys = item_keys(items, reg, cfg).repartition("source", "page_no")
    in_page = ["source", "page_no", "tkey", "hkey"]
    kept = keys.filter("long")
    if cfg.dedupe_in_page:
        kept = kept.groupBy(*in_page, "nkey", "fits").agg(F.min("pos").alias("pos"))
    if cfg.empty_test == "raw":
        counted = keys
    elif cfg.empty_test == "deduped":
        counted = keys.select(*in_page).distinct()
    elif cfg.empty_test == "long_enough":
        counted = kept
    else:
        raise ValueError(f"Unknown empty_test: {cfg.empty_test}")
    vis = visible_pages(pages, counted.groupBy("source", "page_no").agg(F.count(F.lit(1)).alias("n_items")), reg, cfg)
    c = kept.filter("fits").join(vis, ["source", "page_no"], "left_semi")
    c = c.groupBy("source", "nkey").agg(F.min(F.struct("page_no", "pos")).alias("at"))
    if seen is not None:
        c = c.join(seen.select("nkey"), "nkey", "left_anti")
    return vis, c.select("source", "nkey", "at.page_no", "at.pos")


def _prepare(spark: SparkSession, run_dir: str, pages: DataFrame, items: DataFrame, reg: DataFrame, seen: DataFrame | None,
             plan: Sequence[rounds.Step], cfg: CollectConfig) -> tuple[DataFrame, DataFrame]:
    """Candidates of all steps, and their page tables, written once."""
    path = f"{run_dir}/prepared"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        steps = F.broadcast(local_rows(spark, [(s.step, s.source) for s in plan], "step int, source string"))
        reg = reg.filter(F.col("name").isin([s.source for s in plan]))
        vis, c = candidates(items, pages, reg, seen, cfg)
        rows = rounds.prepared(c.join(steps, "source").select("step", "page_no", "pos", "nkey"), vis.join(steps, "source"))
        rows.write.mode("overwrite").parquet(path)
    return rounds.cand_and_pages(spark.read.schema(rounds.PREP_SCHEMA).parquet(path))


def _accepted(spark: SparkSession, resolved: rounds.Resolved, cand: DataFrame, items: DataFrame, plan: Sequence[rounds.Step]) -> DataFrame:
    """Accepted rows, with the titles and links that candidates go without."""
    names = local_rows(spark, [(s.step, s.source, s.name, s.label) for s in plan], "step int, source string, name string, label string")
    rows = rounds.accepted(spark, resolved, cand).join(F.broadcast(names), "step")
    if resolved.n_rows() <= rounds.BROADCAST_ROWS:  # else the items are shuffled to them
        rows = F.broadcast(rows)
    found = items.select("source", "page_no", "pos", "title", "href").join(rows, ["source", "page_no", "pos"])
    found = found.filter(F.sha2(norm_text("title"), 256) == F.col("nkey")).select(
        "step", F.col("name").alias("source"), "label", *(F.col(c).cast("long").alias(c) for c in ("page_no", "pos")),
        F.col("title").alias("text"), F.col("href").alias("url"), "nkey",
    )
    return keep_first(found, ["step", "nkey"], ("text", "url"))  # items that share a place and a title are one


@dataclass
class FoldResult:
    accepted: DataFrame  # ACCEPTED_SCHEMA
    metrics: DataFrame  # step, source, label, pages_visited, added
    page_counters: Callable[[], DataFrame]
    needs: dict[str, int]
    rounds: int  # that ran before nothing changed any more

    @property
    def pages(self) -> DataFrame:
        """Step, source, label, page_no, added, running_total (planned only if asked for)."""
        return self.page_counters()


def by_id(df: DataFrame, reg: DataFrame) -> DataFrame:
    """``df`` with ``source`` = the registry row's id."""
    if "priority" in df.columns:
        return df.withColumn("source", F.col("priority").cast("string")).drop("priority")
    ids = reg.select(F.col("name").alias("source"), F.col("priority").cast("string").alias("_id"))
    return df.join(F.broadcast(ids), "source").withColumn("source", F.col("_id")).drop("_id")


def _step_plan(reg_rows: Sequence, labels: Sequence[str]) -> list[tuple[str, list]]:
    """W6/W7 order: labels in the given order, each label's sources in
    registry priority order (J2)."""
    by_label: dict[str, list] = {}
    for r in sorted(reg_rows, key=lambda r: r["priority"]):
        by_label.setdefault(r["label"], []).append(r)
    return [(l, by_label.get(l, [])) for l in labels]


def collect_fold(
    spark: SparkSession,
    pages: DataFrame,
    items: DataFrame,
    reg: DataFrame,
    base: DataFrame | None,
    needs: Mapping[str, int | None],
    labels: Sequence[str],
    cfg: CollectConfig = CollectConfig(),
    run_dir: str | None = None,
    input_version: str | None = None,
) -> FoldResult:
    """K1/K2 core: fold over labels and their sources with one shared seen
    set (base norms plus everything accepted so far).

    ``needs[label] = None`` means no quota for that label.  ``run_dir`` (a
    folder on the shared file system) makes the run restartable: finished
    parts (candidates, page tables, rounds, accepted rows) are read back instead
    of recomputed, provided that parameters and inputs are the same.  ``input_version`` names the inputs' state; without
    it, a restartable run reads them once more for a digest of their rows.
    """
    reuse = run_dir is not None
    reg_rows = [r.asDict() for r in reg.select("priority", "name", "label").collect()]  # tens of rows
    if len({r["priority"] for r in reg_rows}) < len(reg_rows):
        raise ValueError("registry rows must have different priorities: they are the ids of the sources")
    run_dir = run_dir or scratch_path(spark, "collect")
    if reuse:
        if input_version is None:
            input_version = "/".join(content_digest(d) for d in (pages, items, base) if d is not None)
        _check_fingerprint(spark, run_dir, needs, labels, cfg, reg, input_version)
    pages, items = by_id(pages, reg), by_id(items, reg)
    reg = reg.withColumn("name", F.col("priority").cast("string"))
    # Static step numbers (label order x priority): a skipped step keeps its
    # number, so reruns and reports line up.
    plan = [
        rounds.Step(i + 1, str(src["priority"]), src["name"], label, cfg.k_for(src["name"]))
        for i, (label, src) in enumerate((l, x) for l, srcs in _step_plan(reg_rows, labels) for x in srcs)
    ]
    needs = {label: needs.get(label, 0) for label in labels}
    active = [s for s in plan if needs[s.label] is None or needs[s.label] > 0]
    seen = seen_set(base) if base is not None else None
    accepted_path = f"{run_dir}/accepted"
    if active:
        cand, table = _prepare(spark, run_dir, pages, items, reg, seen, active, cfg)
        shared = cand.filter("shared").drop("shared")
        resolved = rounds.resolve(spark, table, shared, active, needs, f"{run_dir}/rounds")
        if not path_exists(spark, f"{accepted_path}/_SUCCESS"):
            _accepted(spark, resolved, cand, items, active).write.mode("overwrite").parquet(accepted_path)
    else:
        table = local_rows(spark, [], "step int, page_no long, own long, n_shared long")
        resolved = rounds.Resolved(f"{run_dir}/rounds", {}, {}, 0)
        local_rows(spark, [], ACCEPTED_SCHEMA).write.mode("overwrite").parquet(accepted_path)
    accepted = spark.read.schema(ACCEPTED_SCHEMA).parquet(accepted_path)
    none = rounds.End(0, 0, 0, None)
    left = {label: need for label, need in needs.items() if need is not None}
    ran = []
    for s in active:  # a step runs while its label still needs rows, even on no page at all
        if left.get(s.label, 1) > 0:
            ran.append((s, resolved.ends.get(s.step, none)))
            if s.label in left:
                left[s.label] -= ran[-1][1].rows
    metrics = local_rows(
        spark, [(s.step, s.name, s.label, e.pages, e.rows) for s, e in ran], "step int, source string, label string, pages_visited long, added long"
    )
    return FoldResult(accepted, metrics, lambda: _page_counters(spark, resolved, table, accepted, metrics), needs, resolved.jobs)


def _page_counters(spark: SparkSession, resolved: rounds.Resolved, table: DataFrame, accepted: DataFrame, metrics: DataFrame) -> DataFrame:
    """Rows accepted on each visited page and the running total after it."""
    read = table.join(F.broadcast(resolved.ends_frame(spark)), "step").filter(F.col("page_no") <= F.col("last_page"))
    rows = read.select("step", "page_no", F.lit(0).cast("long").alias("added")).unionByName(
        accepted.select("step", "page_no", F.lit(1).cast("long").alias("added"))
    )
    return rounds.running_totals(rows).join(F.broadcast(metrics.select("step", "source", "label")), "step").select(
        "step", "source", "label", "page_no", "added", "running_total"
    )


class RunMismatchError(ValueError):
    """A run folder holds steps of a run with other parameters or inputs."""


def content_digest(df: DataFrame) -> str:
    """Digest of the rows of ``df`` in any order: their number and the sums
    of two hashes, from one scan with partial aggregates."""
    cols = [F.col(f"`{c}`") for c in sorted(df.columns)]
    low = F.shiftrightunsigned(F.xxhash64(*cols), 2).cast("decimal(38,0)")
    r = df.agg(F.count(F.lit(1)), F.sum(low), F.sum(F.hash(*cols).cast("long"))).first()
    return ":".join(str(x) for x in r)


def _check_fingerprint(spark: SparkSession, run_dir: str, needs, labels, cfg, reg: DataFrame, inputs: str) -> None:
    """A restart may only reuse finished steps of the *same* run: the needs,
    labels, configuration, registry and state of the inputs are recorded in
    the run folder on first use and compared on every later use."""
    import json

    reg_rows = sorted(json.dumps(r.asDict(), sort_keys=True, default=str) for r in reg.collect())  # tens of rows
    doc = json.dumps({"needs": dict(needs), "labels": list(labels), "cfg": repr(cfg), "registry": reg_rows, "inputs": inputs},
                     sort_keys=True, default=str)
    check_run(spark, run_dir, doc)


def check_run(spark: SparkSession, run_dir: str, doc: str) -> None:
    """Record ``doc`` in the run folder on first use, compare it later."""
    import hashlib

    digest = hashlib.sha256(doc.encode()).hexdigest()
    path = f"{run_dir}/_fingerprint"
    if path_exists(spark, f"{path}/_SUCCESS"):
        old = spark.read.schema("digest string").json(path).first()
        if old is None or old["digest"] != digest:
            raise RunMismatchError(f"{run_dir} holds a run with other parameters or inputs; use a new run folder")
    else:
        spark.createDataFrame([(digest,)], "digest string").coalesce(1).write.mode("overwrite").json(path)


def extend_corpus(base: DataFrame, accepted: DataFrame, dedupe: bool = True) -> DataFrame:
    """K1 tail: U1 base (part 0) with accepted rows (part 1, in step/page/pos
    order), then D1 keep-first by normalised text (base rows win)."""
    from corpusforge.operators.dedupe import dedupe_norm

    b = base.select(
        F.lit(0).alias("part_no"), "row_id", F.lit(None).cast("int").alias("step"),
        F.lit(None).cast("long").alias("page_no"), F.lit(None).cast("long").alias("pos"),
        "text", "label", "source", "url",
    )
    a = accepted.select(
        F.lit(1).alias("part_no"), F.lit(None).cast("long").alias("row_id"), "step", "page_no", "pos",
        "text", "label", "source", "url",
    )
    u = b.unionByName(a)
    if not dedupe:
        return u
    return dedupe_norm(u, order_cols=("part_no", "row_id", "step", "page_no", "pos"))
