"""The segmented page scan and the rounds against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.operators import rounds
from corpusforge.operators.collect import CollectConfig, collect_fold
from corpusforge.sources.registry import sources_frame


def loop(added, need, k):
    """Pages read and rows before each, as one source's loop has it."""
    out, rows, streak = [], 0, 0
    for page, n in enumerate(added, 1):
        if need is not None and rows >= need:
            break
        out.append((page, rows))
        rows += n
        streak = 0 if n else streak + 1
        if k is not None and streak >= k:
            break
    return out


@pytest.mark.parametrize("segment", [1, 3, 7, 4096])
def test_scan_equals_the_loop_whatever_the_segments(spark, segment):
    rng = random.Random(segment)
    cases = []
    for step in range(60):
        added = [rng.choice([0, 0, 0, 1, 4]) for _ in range(rng.randint(1, 40))]
        cases.append((step, added, rng.choice([None, 1, 5, 30, 1000]), rng.choice([None, 0, 1, 2, 5])))
    rows = [(s, p, n, need, k) for s, added, need, k in cases for p, n in enumerate(added, 1)]
    pages = spark.createDataFrame(rows, "step int, page_no long, added long, need long, k int").repartition(5)
    got = {}
    for r in rounds.scan_pages(pages, segment).collect():
        got.setdefault(r["step"], []).append((r["page_no"], r["before"]))
    assert {s: sorted(v) for s, v in got.items()} == {s: loop(added, need, k) for s, added, need, k in cases}


def test_millions_of_pages_of_one_source_run_in_many_tasks(spark, tmp_path):
    n, k, need = 4_000_000, 9000, 250_000
    added = F.when(F.pmod(F.xxhash64("id"), F.lit(50)) == 0, F.pmod(F.hash("id"), F.lit(9))).otherwise(0)
    added = F.when(F.col("id").between(3_000_000, 3_012_000), F.lit(0)).otherwise(added)
    pages = spark.range(1, n + 1).select(F.lit(1).alias("step"), (3 * F.col("id")).alias("page_no"), added.cast("long").alias("added"))
    pages.write.parquet(str(tmp_path / "pages"))
    pages = spark.read.parquet(str(tmp_path / "pages"))
    counts = pages.orderBy("page_no").select("added").toPandas()["added"].to_numpy()
    for need_, k_ in ((None, k), (need, None)):
        scanned = rounds.scan_pages(pages.withColumn("need", F.lit(need_).cast("long")).withColumn("k", F.lit(k_).cast("int")))
        plan = scanned._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
        got = scanned.agg(F.count("*"), F.max("page_no"), F.sum("before")).first()
        before = np.concatenate([[0], np.cumsum(counts)[:-1]])
        if k_:
            hit = np.concatenate([[0], np.nonzero(counts)[0] + 1])
            gap = np.nonzero(np.diff(hit) > k_)[0]
            end = int(hit[gap[0]]) + k_
            assert 3_008_000 < end < 3_012_000  # over two segments without any addition
        else:
            end = int(np.searchsorted(before, need_))
        assert tuple(got) == (end, 3 * end, int(before[:end].sum()))


def fold(spark, sources, needs, **cfg):
    """sources: (name, label, pages of titles) in priority order."""
    reg = sources_frame(spark, [{"name": n, "label": l, "base_url": "https://x/"} for n, l, _ in sources])
    pages = spark.createDataFrame([(n, p, 200) for n, _, ps in sources for p, _ in enumerate(ps, 1)], "source string, page_no long, http_status int")
    items = spark.createDataFrame(
        [(n, p, i, f"the headline {t}", f"/{n}") for n, _, ps in sources for p, ts in enumerate(ps, 1) for i, t in enumerate(ts)],
        "source string, page_no long, pos long, title string, href string")
    return collect_fold(spark, pages, items, reg, None, needs, [*needs], CollectConfig(**cfg))


def by_loop(sources, needs, k):
    seen, left, out = set(), dict(needs), []
    for label in needs:
        for name, own, pages in sources:
            if own != label or left[label] <= 0:
                continue
            rows, streak = [], 0
            for p, titles in enumerate(pages, 1):
                if len(rows) >= left[label]:
                    break
                added = 0
                for t in titles:
                    if t in seen or len(rows) >= left[label]:
                        continue
                    seen.add(t)
                    rows.append((name, p, f"the headline {t}"))
                    added += 1
                streak = 0 if added else streak + 1
                if streak >= k:
                    break
            left[label] -= len(rows)
            out += rows
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sources_that_share_titles_equal_the_loop(spark, seed):
    rng = random.Random(seed)
    sources = [
        (f"s{j}", f"L{j % 3}", [[f"t{rng.randint(0, 60)}" for _ in range(rng.randint(1, 6))] for _ in range(rng.randint(1, 12))])
        for j in range(14)
    ]
    sources = [(n, l, [list(dict.fromkeys(ts)) for ts in ps]) for n, l, ps in sources]
    needs = {"L0": rng.randint(5, 40), "L1": rng.randint(5, 40), "L2": rng.randint(5, 40)}
    res = fold(spark, sources, needs, zero_streak=2)
    assert sorted((r["source"], r["page_no"], r["text"]) for r in res.accepted.collect()) == by_loop(sources, needs, 2)


def test_rounds_follow_conflicts_and_not_the_number_of_sources(spark):
    apart = [(f"s{j}", "A", [[f"s{j} p{p} {i}" for i in range(3)] for p in range(4)]) for j in range(40)]
    res = fold(spark, apart, {"A": 10_000}, zero_streak=None)
    assert (res.rounds, res.accepted.count()) == (1, 480)
    # a chain: each source's title is taken by the one before unless that one's was taken
    chain = [(f"c{j}", f"L{j}", [[f"x{j}"], [f"x{j + 1}"]]) for j in range(5)]
    res = fold(spark, chain, {f"L{j}": 5 for j in range(5)}, zero_streak=1)
    got = sorted((r["source"], r["text"][-2:]) for r in res.accepted.collect())
    assert got == [("c0", "x0"), ("c0", "x1"), ("c2", "x2"), ("c2", "x3"), ("c4", "x4"), ("c4", "x5")]
    assert 2 <= res.rounds <= 6
