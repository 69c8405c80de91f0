"""Ordered collection in rounds (W4-W7): all sources at once, page scans in
segments.

**Scan.**  What the loop of one source keeps while it reads its pages (rows so
far, pages since the last one that added any) is a prefix scan over the page
table.  Pages fall into segments of ``SEGMENT`` page numbers; a segment's
summary (pages, rows added, first and last page that added any, first gap inside
that stops the loop) combines with the next one's by an associative rule, so only
summaries, one row for thousands of pages, are ever windowed by source.

**Rounds.**  One after the other, sources depend on each other in two ways
only: a title that an earlier source has accepted is blocked, and the label's
quota shrinks by what earlier sources added.  A round cuts every source at once
as if the blocked titles and quotas of the round before were right; the next
one runs only sources whose quota changed, or that lie behind a source whose
accepted titles changed and hold titles that other sources have too.  After n
rounds at least the first n sources are right, and when nothing changes all
are: the loop's result is the only fixpoint.  The number of jobs follows the
depth of the conflicts, not the number of sources.

Only *shared* titles (candidates of several sources) can be blocked, so a round
reads these and the page table; other candidates are counted per page once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusforge.session import local_rows, path_exists

SEGMENT = 4096
#: Rows (some 100 bytes each) up to which a table whose count is known goes to the other side's tasks.
BROADCAST_ROWS = 200_000
PREP_SCHEMA = (
    "kind string, step int, page_no long, pos long, nkey string, shared boolean, first int, own_before long, own long, n_shared long"
)
ROUND_SCHEMA = "kind string, step int, page_no long, pos long, nkey string, rows long, pages long, room long"


@dataclass(frozen=True)
class Step:
    """One source of one label, in the order in which the loop takes them."""

    step: int
    source: str
    name: str
    label: str
    k: int | None  # pages without additions that stop it (None: no such rule)


@dataclass(frozen=True)
class End:
    """Where a step ended: rows it added, pages it read, the last of them and
    how many rows it took there (None: all)."""

    rows: int
    pages: int
    last_page: int
    room: int | None


#: Common table expressions from ``rows`` (step, page_no, added, need, k) to
#: ``visited`` (step, page_no, added, before, need).  One statement: a round is
#: planned once, not after each of its many operators.
_SCAN = """
placed AS (SELECT /*+ REPARTITION(step, seg) */ *, floor(page_no / {segment}) AS seg FROM {rows}),
page AS (SELECT step, seg, page_no, need, k, sum(added) AS added FROM placed GROUP BY step, seg, page_no, need, k),
numbered AS (SELECT *, row_number() OVER (PARTITION BY step, seg ORDER BY page_no) AS ord FROM page),
scanned AS (
  SELECT *, coalesce(sum(added) OVER earlier, 0) AS sum, max(if(added > 0, ord, NULL)) OVER earlier AS last FROM numbered
  WINDOW earlier AS (PARTITION BY step, seg ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
-- a gap of more than k pages between two that add rows ends the loop k pages after the first
segment AS (
  SELECT step, seg, k, sum(added) AS n, count(*) AS pages, min(if(added > 0, ord, NULL)) AS first, max(if(added > 0, ord, NULL)) AS end,
         min(if(added > 0 AND ord - last > k, last + k, NULL)) AS gap
  FROM scanned GROUP BY step, seg, k),
based AS (
  SELECT *, coalesce(sum(n) OVER earlier, 0) AS base, coalesce(sum(pages) OVER earlier, 0) AS read FROM segment
  WINDOW earlier AS (PARTITION BY step ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
carried AS (
  SELECT *, coalesce(max(read + end) OVER (PARTITION BY step ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS carry
  FROM based),
ends AS (
  SELECT step, seg, base, read, if(k IS NULL, NULL, greatest(1, least(
           min(least(read + gap, if(read + first - carry > k, carry + k, NULL))) OVER (PARTITION BY step),
           coalesce(max(read + end) OVER (PARTITION BY step), 0) + k))) AS cut
  FROM carried),
visited AS (
  SELECT s.step, s.page_no, s.added, e.base + s.sum AS before, s.need FROM scanned s JOIN ends e ON s.step = e.step AND s.seg = e.seg
  WHERE (e.cut IS NULL OR e.read + s.ord <= e.cut) AND (s.need IS NULL OR e.base + s.sum < s.need))
"""


def scan_pages(pages: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Pages that the loop visits, with ``added`` and ``before``, the rows added
    on earlier pages.

    ``pages``: step, page_no, added (several rows of a page add up), need (null:
    no quota), k (null: no streak rule).  A source stops after the page at which
    ``k`` pages in a row have added nothing, and when it has ``need`` rows.
    """
    return pages.sparkSession.sql(f"WITH {_SCAN.format(segment=segment, rows='{pages}')} SELECT * FROM visited", pages=pages)


@dataclass
class Resolved:
    """Outcome of the rounds: how each step ended, and in which round that was
    found; steps without any quota left, or without pages, are missing."""

    path: str
    ends: dict[int, End]
    rounds: dict[int, int]
    jobs: int

    def n_rows(self) -> int:
        return sum(e.rows for e in self.ends.values())

    def ends_frame(self, spark: SparkSession) -> DataFrame:
        return local_rows(spark, [(s, e.last_page, e.room) for s, e in sorted(self.ends.items())], "step int, last_page long, room long")

    def keys(self, spark: SparkSession) -> DataFrame:
        """(step, page_no, pos, nkey) of the accepted shared titles."""
        return _keys(spark, self.path, self.rounds)


def _keys(spark: SparkSession, path: str, rounds: Mapping[int, int]) -> DataFrame:
    by_round: dict[int, list[int]] = {}
    for step, r in rounds.items():
        by_round.setdefault(r, []).append(step)
    out = None
    for r, steps in sorted(by_round.items()):
        part = spark.read.schema(ROUND_SCHEMA).parquet(f"{path}/round={r:04d}").filter((F.col("kind") == "key") & F.col("step").isin(sorted(steps)))
        out = part if out is None else out.unionByName(part)
    out = local_rows(spark, [], ROUND_SCHEMA) if out is None else out
    return out.select("step", "page_no", "pos", "nkey")


#: Titles that no earlier step has taken, pages as scanned, where each step
#: ends, and the titles before that.  Only the last page of a step can be cut
#: inside: its titles are ranked in one place.
_FREE = """
WITH firsts AS (SELECT nkey, min(step) AS first FROM {taken} GROUP BY nkey),
free AS (
  SELECT /*+ BROADCAST(t)BROADCAST_FIRSTS */ s.step, s.page_no, s.pos, s.nkey, s.own_before, t.need, t.k
  FROM {shared} s JOIN {todo} t ON s.step = t.step LEFT JOIN firsts f ON s.nkey = f.nkey WHERE f.first IS NULL OR f.first >= s.step),
"""
_FREE_AT_FIRST = """
WITH free AS (
  SELECT /*+ BROADCAST(t) */ s.step, s.page_no, s.pos, s.nkey, s.own_before, t.need, t.k
  FROM {shared} s JOIN {todo} t ON s.step = t.step WHERE s.first = s.step),
"""
_ROUND = """
counts AS (
  SELECT /*+ BROADCAST(t) */ p.step, p.page_no, p.own AS added, t.need, t.k FROM {pages} p JOIN {todo} t ON p.step = t.step
  UNION ALL SELECT step, page_no, 1L, need, k FROM free),
""" + _SCAN + """,
fitting AS (SELECT *, least(added, coalesce(need - before, added)) AS fits FROM visited),
last AS (
  SELECT step, sum(fits) AS rows, count(*) AS pages, max(struct(page_no, if(fits < added, fits, NULL) AS room)) AS at FROM fitting GROUP BY step),
inside AS (
  SELECT /*+ BROADCAST(l) */ f.step, f.page_no, f.pos, f.nkey, f.own_before, if(f.page_no = l.at.page_no, l.at.room, NULL) AS room
  FROM free f JOIN last l ON f.step = l.step WHERE f.page_no <= l.at.page_no),
cut AS (
  SELECT *, own_before + row_number() OVER (PARTITION BY step ORDER BY pos, nkey) AS rank FROM inside WHERE room IS NOT NULL)
SELECT 'key' AS kind, step, page_no, pos, nkey, CAST(NULL AS BIGINT) AS rows, CAST(NULL AS BIGINT) AS pages, CAST(NULL AS BIGINT) AS room
FROM inside WHERE room IS NULL
UNION ALL SELECT 'key', step, page_no, pos, nkey, NULL, NULL, NULL FROM cut WHERE rank <= room
UNION ALL SELECT 'end', step, at.page_no, NULL, NULL, rows, pages, at.room FROM last
"""


def _round(spark: SparkSession, path: str, pages: DataFrame, shared: DataFrame, todo: Sequence[tuple], taken: DataFrame | None, n_taken: int, segment: int) -> None:
    """One round over the steps of ``todo`` (step, need, k; a row per source of
    the registry), written to ``path``; ``taken``: the ``n_taken`` shared titles
    taken so far (None: by the first source that holds them)."""
    frames = {"pages": pages, "shared": shared, "todo": local_rows(spark, todo, "step int, need long, k int")}
    free = _FREE_AT_FIRST if taken is None else _FREE.replace("BROADCAST_FIRSTS", ", BROADCAST(f)" if n_taken <= BROADCAST_ROWS else "")
    if taken is not None:
        frames["taken"] = taken
    rows = (free + _ROUND).replace("{segment}", str(segment)).replace("{rows}", "counts")
    spark.sql(rows, **frames).write.mode("overwrite").parquet(path)


def resolve(
    spark: SparkSession,
    pages: DataFrame,
    shared: DataFrame,
    plan: Sequence[Step],
    needs: Mapping[str, int | None],
    path: str,
    segment: int = SEGMENT,
    on_round: Callable[[int, list[int]], None] | None = None,
) -> Resolved:
    """Run rounds until nothing changes.

    ``pages``: step, page_no, own and n_shared, the candidates of this step
    alone and of several on the page.  ``shared``: step, page_no, pos, nkey,
    first (step that holds it), own_before (candidates of this step alone before
    it on its page).  The first round supposes that a source adds all that it
    has, as far as the quota goes, and that a shared title goes to the first
    source that holds it.  Finished
    rounds under ``path`` are used again, so a restart goes on where it was.
    """
    order = sorted(plan, key=lambda s: s.step)
    held = {  # a row per source: candidates, shared ones among them, last page
        r["step"]: r for r in pages.groupBy("step").agg(
            F.sum(F.col("own") + F.col("n_shared")).alias("all"), F.sum("n_shared").alias("shared"), F.max("page_no").alias("last_page")
        ).collect()
    }
    pages = pages.select("step", "page_no", "own")
    ends: dict[int, End] = {}
    titles: dict[int, tuple[int, int]] = {}  # step -> number and digest of its accepted shared titles
    used: dict[int, int | None] = {}
    rounds: dict[int, int] = {}
    changed, r = None, 0  # first step whose accepted titles changed in the last round

    def quotas() -> dict[int, int | None]:
        left, out = dict(needs), {}
        for s in order:
            need = left.get(s.label, 0)
            if (need is None or need > 0) and s.step in held:
                out[s.step] = need
                if need is not None:
                    left[s.label] = need - (ends[s.step].rows if s.step in ends else 0 if s.step in used else min(need, held[s.step]["all"]))
        return out

    while True:
        quota = quotas()
        for s in [s for s in used if s not in quota]:
            if titles.pop(s)[0]:
                changed = s if changed is None else min(changed, s)
            ends.pop(s, None), used.pop(s), rounds.pop(s)
        again = {s for s in quota if s not in used or used[s] != quota[s]}
        if changed is not None:
            again |= {s for s in quota if s > changed and held[s]["shared"]}
        if not again:
            return Resolved(path, ends, rounds, r)
        if on_round:
            on_round(r, sorted(again))
        out = f"{path}/round={r:04d}"
        if not path_exists(spark, f"{out}/_SUCCESS"):
            ks = {s.step: s.k for s in order}
            todo = [(s, quota[s], ks[s]) for s in sorted(again)]
            if r:
                taken, n_taken = _keys(spark, path, {s: q for s, q in rounds.items() if titles[s][0]}), sum(n for n, _ in titles.values())
            else:  # by the first source that holds it, of those that are to run
                idle = any(h["shared"] for s, h in held.items() if s not in again)
                taken, n_taken = shared.filter(F.col("step").isin(sorted(again))) if idle else None, sum(held[s]["shared"] for s in again)
            _round(spark, out, pages, shared, todo, taken, n_taken, segment)
        key = F.col("kind") == "key"
        found = spark.read.schema(ROUND_SCHEMA).parquet(out).groupBy("step").agg(
            F.max("rows").alias("rows"), F.max("pages").alias("pages"), F.max(F.when(~key, F.col("page_no"))).alias("last_page"),
            F.max("room").alias("room"), F.count_if(key).alias("n"), F.sum(F.when(key, F.hash("nkey").cast("long"))).alias("digest"),
        )
        stats = {row["step"]: row for row in found.collect()}  # a row per source
        changed = None
        for s in sorted(again):
            row = stats.get(s)  # none: no page was read
            now = (row["n"], row["digest"] or 0) if row else (0, 0)
            if r == 0:  # as supposed, if the step read all it has
                same = not held[s]["shared"] or row is not None and row["room"] is None and row["last_page"] == held[s]["last_page"]
            else:
                same = titles.get(s, (0, 0)) == now
            if not same and changed is None:
                changed = s
            titles[s], used[s], rounds[s] = now, quota[s], r
            ends.pop(s, None)
            if row:
                ends[s] = End(row["rows"], row["pages"], row["last_page"], row["room"])
        r += 1


def prepared(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """What ``resolve`` reads, to be written once: rows of kind "cand" (see
    ``cand_and_pages``) and "page".  ``candidates``: step, page_no, pos, nkey, a
    title once in a step; ``pages``: step, page_no."""
    # a title has a row for each source that holds it: no more than the registry
    holders = Window.partitionBy("nkey")
    c = candidates.withColumn("shared", F.count(F.lit(1)).over(holders) > 1).withColumn("first", F.min("step").over(holders))
    page = ["step", "page_no"]
    earlier = Window.partitionBy(*page).orderBy("pos", "nkey").rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("shared"), 0).otherwise(1).cast("long")
    each = pages.select(*page, *(F.lit(0).cast("long").alias(x) for x in ("own", "n_shared"))).unionByName(
        c.select(*page, own.alias("own"), (1 - own).alias("n_shared"))
    )
    table = each.groupBy(*page).agg(F.sum("own").alias("own"), F.sum("n_shared").alias("n_shared"))
    c = c.withColumn("own_before", F.coalesce(F.sum(own).over(earlier), F.lit(0)))
    rows = table.withColumn("kind", F.lit("page")).unionByName(c.withColumn("kind", F.lit("cand")), allowMissingColumns=True)
    return rows.select(*(F.col(c).cast(t).alias(c) for c, t in (x.split() for x in PREP_SCHEMA.split(", "))))


def cand_and_pages(prep: DataFrame) -> tuple[DataFrame, DataFrame]:
    cand = prep.filter(F.col("kind") == "cand").select("step", "page_no", "pos", "nkey", "shared", "first", "own_before")
    return cand, prep.filter(F.col("kind") == "page").select("step", "page_no", "own", "n_shared")


def accepted(spark: SparkSession, resolved: Resolved, cand: DataFrame) -> DataFrame:
    """(step, page_no, pos, nkey) of all accepted candidates."""
    keys = resolved.keys(spark)
    place = ["step", "page_no", "pos", "nkey"]
    own = cand.filter(~F.col("shared")).join(F.broadcast(resolved.ends_frame(spark)), "step").filter(F.col("page_no") <= F.col("last_page"))
    # A step's last page may be cut inside: a title's own rank there counts the accepted shared titles before it
    cut = (F.col("page_no") == F.col("last_page")) & F.col("room").isNotNull()
    ends = F.broadcast(resolved.ends_frame(spark).filter("room is not null"))
    there = keys.join(ends, "step").filter(cut).select(*place, "room", F.lit(False).alias("own"))
    last = own.filter(cut).select(*place, "room", F.lit(True).alias("own")).unionByName(there)
    rank = F.row_number().over(Window.partitionBy("step").orderBy("pos", "nkey"))
    last = last.withColumn("_rk", rank).filter("own").filter(F.col("_rk") <= F.col("room"))
    return own.filter(~cut).select(*place).unionByName(last.select(*place)).unionByName(keys.select(*place))


def running_totals(pages: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``pages(step, page_no, added, ...)`` with ``running_total``."""
    free = pages.withColumn("need", F.lit(None).cast("long")).withColumn("k", F.lit(None).cast("int"))
    return scan_pages(free, segment).select("step", "page_no", "added", (F.col("before") + F.col("added")).alias("running_total"))
