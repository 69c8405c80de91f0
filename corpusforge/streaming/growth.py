"""Incremental corpus growth with Structured Streaming.

Captured pages (or their items) arrive as files; a micro-batch appends titles
that are not yet in the corpus, label by label and source by source as the fold
does, up to each label's remaining need.  Stop rules (W2/W3/W5) do not apply:
arrival order is not page order.

What has been seen is keyed state: one streaming aggregate holds, for every
normalised title, whether the base has it and when it first arrived under each
label, with the row that came first then.  The base's keys are a second source
of the stream and enter the state once.  A micro-batch reads its own files and
the state of its own titles; no earlier output or base row is read again.

Acceptance follows from arrival: a title that arrived while its label was open
has been accepted (then, or before), one that arrived when the label was already
full has not, and for the one batch in which a label filled up the batch's own
output tells.  So the state never has to be told what was accepted, and the
labels' counts and fill times, a row per label, are handed from batch to batch.

Exactly-once output: a batch writes ``out_dir/batch_id=<id>`` and its row of the
log with overwrite, so a replayed batch (after a lost executor or driver
restart) rewrites the same folders from the same state version; progress and
state live in the streaming checkpoint on the shared file system.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusforge import schema
from corpusforge.functions.text import keyword_any_array, norm_key, norm_text
from corpusforge.operators import rounds
from corpusforge.operators.collect import check_run, content_digest
from corpusforge.operators.extract import links_by_source
from corpusforge.session import local_rows, path_exists, scratch_path
from corpusforge.sources.registry import apply_keywords

OUT_SCHEMA = "batch_id long, source string, label string, page_no long, pos long, text string, url string, nkey string"
OUT_COLS = ["batch_id", "source", "label", "page_no", "pos", "text", "url", "nkey"]
LOG_SCHEMA = "label string, have long, filled_at long, filled_batch long, upto long"
#: State on the executors' disks, with changes written per batch.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class GrowthBase:
    """The corpus as the stream needs it, computed once before it starts:
    the normalised-text keys (written under the checkpoint folder) and the
    per-label row counts (one small number per label)."""

    keys_path: str
    counts: dict


def prepare_base(spark: SparkSession, base: DataFrame, path: str | None = None,
                 version: str | None = None) -> GrowthBase:
    """Materialise ``(nkey, label)`` of the base corpus once, so micro-batches
    never rescan or re-normalise it.  A given ``path`` is reused by a restart
    if the base is the same: ``version`` names its state (without it, a digest
    of its rows does); for another base it must be another path."""
    if path is not None:
        check_run(spark, path, version or content_digest(base))
    path = f"{path or scratch_path(spark, 'growth-base')}/keys"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        base.select(norm_key("text").alias("nkey"), "label").write.mode("overwrite").parquet(path)
    keys = spark.read.schema("nkey string, label string").parquet(path)
    counts = {r[0]: int(r[1]) for r in keys.groupBy("label").count().collect()}  # one row per label
    return GrowthBase(path, counts)


@dataclass(frozen=True)
class LabelState:
    """A label after a batch: its rows, and the arrival time and batch in which
    it became full (None: still open; 0 and -1: full from the start)."""

    have: int
    filled_at: int | None
    filled_batch: int | None


def _log(spark: SparkSession, out_dir: str, batch_id: int, gbase: GrowthBase, labels: Sequence[str], target: int) -> tuple[dict[str, LabelState], int]:
    """The labels before a batch, and the last arrival time so far."""
    if batch_id == 0:
        have = {l: gbase.counts.get(l, 0) for l in labels}
        return {l: LabelState(n, *((None, None) if n < target else (0, -1))) for l, n in have.items()}, 0
    rows = spark.read.schema(LOG_SCHEMA).parquet(f"{out_dir}/_log/batch_id={batch_id - 1}").collect()  # one row per label
    return {r["label"]: LabelState(r["have"], r["filled_at"], r["filled_batch"]) for r in rows}, max(r["upto"] for r in rows)


def arrivals(items: DataFrame, reg: DataFrame, labels: Sequence[str], min_title_len: int = 12) -> DataFrame:
    """Rows (nkey, label, arrived, ...) of the items that pass the filters."""
    r = reg.select(F.col("name").alias("source"), "label", "priority", apply_keywords().alias("_apply"), "keywords")
    on = "priority" if "priority" in items.columns else "source"  # items of one registry row, or of a site
    r = r.drop("source") if on == "priority" else r
    return (
        items.filter(F.length("title") >= min_title_len)
        .withColumn("norm", norm_text("title"))
        .join(F.broadcast(r.filter(F.col("label").isin(list(labels)))), on)  # the registry: a row per source
        .filter(~F.col("_apply") | keyword_any_array("norm", F.col("keywords")))
        .select(
            F.sha2("norm", 256).alias("nkey"), "label", F.unix_micros(F.current_timestamp()).alias("arrived"),
            F.col("priority").cast("int").alias("priority"), "page_no", "pos", "source", F.col("title").alias("text"), F.col("href").alias("url"),
        )
    )


FIRST = ["arrived", "priority", "page_no", "pos", "source", "text", "url"]


def titles(rows: DataFrame, base_keys: DataFrame, labels: Sequence[str]) -> DataFrame:
    """The state, a row for each title: whether the base has it, and its first
    arrival under each label (``a0``, ``a1``, ... in label order)."""
    base = base_keys.select("nkey", F.lit(True).alias("in_base"))
    both = rows.withColumn("in_base", F.lit(False)).unionByName(base, allowMissingColumns=True)
    first = [F.min(F.when(F.col("label") == l, F.struct(*FIRST))).alias(f"a{i}") for i, l in enumerate(labels)]
    return both.groupBy("nkey").agg(F.max("in_base").alias("in_base"), *first)


def admit(state: DataFrame, batch_id: int, gbase: GrowthBase, reg: DataFrame, labels: Sequence[str], target: int, out_dir: str) -> None:
    """Append what is new in the titles that a micro-batch has touched."""
    spark = state.sparkSession
    before, upto = _log(spark, out_dir, batch_id, gbase, labels, target)
    at = lambda i: F.col(f"a{i}.arrived")
    seen: Column = F.lit(False)
    ask: Column = F.lit(False)  # arrived in a batch in which the label filled up: accepted if its output says so
    for i, l in enumerate(labels):
        filled = before[l].filled_at
        seen = seen | ((at(i) <= upto) & (at(i) < filled if filled is not None else F.lit(True)))
        ask = ask | (at(i) == filled if filled else F.lit(False))
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("label_pos"), f"a{i}.*") for i in range(len(labels)))))
    new = state.filter(~F.col("in_base")).select(
        "nkey", F.coalesce(seen, F.lit(False)).alias("seen"), F.coalesce(ask, F.lit(False)).alias("ask"), each.alias("a")
    ).select("nkey", "seen", "ask", "a.*").filter(F.col("arrived") > upto)
    path = scratch_path(spark, f"growth-{batch_id}")
    new.write.parquet(f"{path}/new")
    new = spark.read.schema(new.schema).parquet(f"{path}/new")
    upto = max(upto, new.agg(F.max("arrived")).first()[0] or 0)
    needs = {l: max(0, target - before[l].have) for l in labels}
    plan = _plan(reg, labels, needs)
    after = before
    target_dir = f"{out_dir}/batch_id={batch_id}"
    if plan:
        steps = local_rows(spark, [(int(s.source), s.step, labels.index(s.label), s.label) for s in plan], "priority int, step int, label_pos int, label string")
        c = new.filter(~F.col("seen")).join(F.broadcast(steps), ["priority", "label_pos"])
        batches = sorted({before[l].filled_batch for l in labels if before[l].filled_batch not in (None, -1)})
        if batches:  # no more than labels
            done = spark.read.schema("nkey string").parquet(*(f"{out_dir}/batch_id={b}" for b in batches))
            c = c.filter(~F.col("ask")).unionByName(c.filter("ask").join(done, "nkey", "left_anti").select(*c.columns))
        rounds.prepared(c.select("step", "page_no", "pos", "nkey"), c.select("step", "page_no").distinct()).write.parquet(f"{path}/prepared")
        cand, pages = rounds.cand_and_pages(spark.read.schema(rounds.PREP_SCHEMA).parquet(f"{path}/prepared"))
        resolved = rounds.resolve(spark, pages, cand.filter("shared").drop("shared"), plan, needs, f"{path}/rounds")
        places = rounds.accepted(spark, resolved, cand).select("step", "nkey")
        if resolved.n_rows() <= rounds.BROADCAST_ROWS:
            places = F.broadcast(places)
        acc = c.join(places, ["step", "nkey"]).withColumn("batch_id", F.lit(batch_id).cast("long"))
        acc.select(*OUT_COLS).write.mode("overwrite").parquet(target_dir)
        after = {}
        for l in labels:
            have = before[l].have + sum(resolved.ends[s.step].rows for s in plan if s.label == l and s.step in resolved.ends)
            fills = before[l].filled_at is None and have >= target
            after[l] = LabelState(have, *((upto, batch_id) if fills else (before[l].filled_at, before[l].filled_batch)))
    else:  # nothing to add: an empty batch, so the output can always be read
        local_rows(spark, [], OUT_SCHEMA).write.mode("overwrite").parquet(target_dir)
    log = [(l, after[l].have, after[l].filled_at, after[l].filled_batch, upto) for l in labels]
    local_rows(spark, log, LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/_log/batch_id={batch_id}")


def _plan(reg: DataFrame, labels: Sequence[str], needs: dict[str, int]) -> list[rounds.Step]:
    """Sources of the labels that still need rows: labels in order, each label's
    sources by priority."""
    rows = reg.select("priority", "name", "label").collect()  # a row per source
    mine = sorted((labels.index(r["label"]), r["priority"], r["name"]) for r in rows if needs.get(r["label"], 0) > 0)
    return [rounds.Step(i + 1, str(p), name, labels[n], None) for i, (n, p, name) in enumerate(mine)]


def start_growth(
    spark: SparkSession,
    items_dir: str,
    gbase: GrowthBase,
    reg: DataFrame,
    labels: Sequence[str],
    target: int,
    out_dir: str,
    checkpoint: str,
    available_now: bool = True,
    min_title_len: int = 12,
    pages: bool = False,
    files_per_batch: int | None = None,
    state_provider: str | None = ROCKSDB,
) -> StreamingQuery:
    """Start the stream over ``items_dir`` (files of ``schema.ITEMS``; with
    ``pages`` files of ``schema.PAGES``, whose items are taken by each source's
    selectors).  Started again with the same folders it goes on where it was."""
    labels = list(labels)
    if state_provider:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", state_provider)
    reader = spark.readStream.schema(schema.PAGES if pages else schema.ITEMS)
    stream = (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(items_dir)
    items = links_by_source(stream, reg) if pages else stream
    base = spark.readStream.schema("nkey string, label string").parquet(gbase.keys_path)
    state = titles(arrivals(items, reg, labels, min_title_len), base, labels)

    def batch(df: DataFrame, bid: int) -> None:
        admit(df, bid, gbase, reg, labels, target, out_dir)

    w = state.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
