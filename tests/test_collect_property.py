"""The Spark fold against a plain sequential simulation of the crawl loop
(the loop restated in a few lines of Python as the test oracle), on many
random cases run through one fold."""

import random

from pyspark.sql import functions as F

from corpusforge.operators.collect import CollectConfig, collect_fold
from corpusforge.sources.registry import sources_frame

WORDS = ["alpha", "beta", "gamma", "delta", "market", "trade", "goal", "cup", "x"]


def norm(t):
    return " ".join(t.lower().split())


def simulate(case, min_len=12, empty_test="long_enough", stop_on_http=True):
    seen = set(case["base"])
    out = []
    remaining = case["need"]
    for s in case["sources"]:
        if remaining <= 0:
            break
        rows, streak = [], 0
        for page_no, status, items in s["pages"]:
            if len(rows) >= remaining:
                break
            if status is None:
                continue
            if status != 200:
                if stop_on_http:
                    break
                continue
            kept, loc = [], set()
            for t, h in items:
                if len(t) < min_len or (t, h) in loc:
                    continue
                loc.add((t, h))
                kept.append((t, h))
            if empty_test == "raw":
                empty = not items
            elif empty_test == "deduped":
                empty = not set(items)
            else:
                empty = not kept
            if empty:
                break
            added = 0
            for t, h in kept:
                n = norm(t)
                if n in seen:
                    continue
                if s["kw"] and not any(k in n for k in s["kw"]):
                    continue
                seen.add(n)
                rows.append((s["name"], page_no, t))
                added += 1
                if len(rows) >= remaining:
                    break
            streak = 0 if added else streak + 1
            if s["k"] is not None and streak >= s["k"]:
                break
        out += rows
        remaining -= len(rows)
    return out


def make_case(rng, c):
    def title():
        n = rng.randint(0, 3)
        return f"c{c} " + " ".join(rng.choice(WORDS) for _ in range(n))

    sources = []
    for j in range(2):
        pages = []
        for p in range(1, rng.randint(1, 6) + 1):
            st = rng.choices([200, None, 404], [0.75, 0.15, 0.10])[0]
            items = [(title(), f"/h{rng.randint(0, 3)}") for _ in range(rng.randint(0, 4))]
            pages.append((p, st, items))
        kw = rng.choice([[], [], ["market"], ["goal", "trade"]])
        sources.append({"name": f"c{c}s{j}", "pages": pages, "kw": kw, "k": rng.choice([None, 1, 2, 3])})
    base = [norm(title()) for _ in range(rng.randint(0, 3))]
    return {"label": f"L{c:03d}", "sources": sources, "need": rng.randint(0, 8), "base": base}


import pytest


@pytest.mark.parametrize("empty_test,stop_on_http,seed", [
    ("long_enough", True, 7), ("raw", True, 11), ("deduped", False, 13),
])
def test_fold_equals_sequential_loop(spark, empty_test, stop_on_http, seed):
    rng = random.Random(seed)
    cases = [make_case(rng, c) for c in range(24)]
    reg_rows, page_rows, item_rows, base_rows, k_map = [], [], [], [], {}
    for case in cases:
        for s in case["sources"]:
            reg_rows.append({"name": s["name"], "label": case["label"], "base_url": "https://x/",
                             "type": "keyword_archive" if s["kw"] else "wp_category", "keywords": s["kw"]})
            k_map[s["name"]] = s["k"]
            for p, st, items in s["pages"]:
                page_rows.append((s["name"], p, st))
                for i, (t, h) in enumerate(items):
                    item_rows.append((s["name"], p, i, t, h))
        base_rows += [(b, case["label"]) for b in case["base"]]
    reg = sources_frame(spark, reg_rows)
    pages = spark.createDataFrame(page_rows, "source string, page_no long, http_status int")
    items = spark.createDataFrame(item_rows, "source string, page_no long, pos long, title string, href string")
    base = spark.createDataFrame(base_rows, "text string, label string")
    labels = [c["label"] for c in cases]
    needs = {c["label"]: c["need"] for c in cases}
    cfg = CollectConfig(zero_streak=None, zero_streak_by_source=k_map, empty_test=empty_test,
                        stop_on_http=stop_on_http)
    res = collect_fold(spark, pages, items, reg, base, needs, labels, cfg)
    got = sorted((r.source, r.page_no, r.text) for r in res.accepted.collect())
    want = sorted(x for c in cases for x in simulate(c, empty_test=empty_test, stop_on_http=stop_on_http))
    assert got == want
    # metrics: one row per executed step, added == rows per step
    per = {}
    for r in res.accepted.groupBy("step").count().collect():
        per[r["step"]] = r["count"]
    for m in res.metrics.collect():
        assert m["added"] == per.get(m["step"], 0)


def test_rerun_skips_finished_parts(spark, tmp_path):
    """A rerun with the same run folder reads finished parts back."""
    reg = sources_frame(spark, [{"name": "a", "label": "L", "base_url": "https://a/"},
                                {"name": "b", "label": "L", "base_url": "https://b/"}])
    pages = spark.createDataFrame([("a", 1, 200), ("a", 2, 200), ("b", 1, 200)],
                                  "source string, page_no long, http_status int")
    items = spark.createDataFrame(
        [("a", 1, 0, "first headline here", "/1"), ("a", 2, 0, "second headline here", "/2"),
         ("b", 1, 0, "first headline here", "/3"), ("b", 1, 1, "third headline here", "/4")],
        "source string, page_no long, pos long, title string, href string")
    run = str(tmp_path / "run")
    r1 = collect_fold(spark, pages, items, reg, None, {"L": 3}, ["L"], CollectConfig(), run_dir=run)
    first = sorted((r.source, r.text) for r in r1.accepted.collect())
    assert first == [("a", "first headline here"), ("a", "second headline here"), ("b", "third headline here")]
    import os
    markers = [os.path.join(run, p, "_SUCCESS") for p in ("prepared", "rounds/round=0000", "accepted")]
    mtimes = [os.path.getmtime(m) for m in markers]
    r2 = collect_fold(spark, pages, items, reg, None, {"L": 3}, ["L"], CollectConfig(), run_dir=run)
    assert sorted((r.source, r.text) for r in r2.accepted.collect()) == first
    assert [os.path.getmtime(m) for m in markers] == mtimes
    assert [tuple(m)[3:] for m in r2.metrics.orderBy("step").collect()] == [(2, 2), (1, 1)]


def test_rerun_with_other_parameters_is_refused(spark, tmp_path):
    import pytest as _pytest

    from corpusforge.operators.collect import RunMismatchError

    reg = sources_frame(spark, [{"name": "a", "label": "L", "base_url": "https://a/"}])
    pages = spark.createDataFrame([("a", 1, 200)], "source string, page_no long, http_status int")
    items = spark.createDataFrame([("a", 1, 0, "first headline here", "/1")],
                                  "source string, page_no long, pos long, title string, href string")
    run = str(tmp_path / "run")
    collect_fold(spark, pages, items, reg, None, {"L": 1}, ["L"], CollectConfig(), run_dir=run)
    with _pytest.raises(RunMismatchError):
        collect_fold(spark, pages, items, reg, None, {"L": 2}, ["L"], CollectConfig(), run_dir=run)


@pytest.mark.parametrize("own_pages", [False, True])
def test_one_name_under_two_labels_equals_sequential_loop(spark, own_pages):
    """A registry row is a source of its own: the same site name may serve
    several labels, on the same captured pages or on its own (``priority``)."""
    rng = random.Random(17)
    cases, reg_rows, page_rows, item_rows, base_rows, needs = [], [], [], [], [], {}
    for c in range(12):
        case = make_case(rng, c)
        site = f"site{c}"
        rows = []
        for j, s in enumerate(case["sources"]):
            s = dict(s, name=site, k=4)
            if not own_pages and j:
                s["pages"] = rows[0]["pages"]
            rows.append(s)
            reg_rows.append({"name": site, "label": f"{case['label']}-{j}", "base_url": "https://x/",
                             "type": "keyword_archive" if s["kw"] else "wp_category", "keywords": s["kw"]})
            if own_pages or not j:
                for p, st, items in s["pages"]:
                    page_rows.append((len(reg_rows), site, p, st))
                    item_rows += [(len(reg_rows), site, p, i, t, h) for i, (t, h) in enumerate(items)]
        base_rows += [(b, case["label"]) for b in case["base"]]
        seen = list(case["base"])
        for j, s in enumerate(rows):
            label = f"{case['label']}-{j}"
            needs[label] = rng.randint(1, 5)
            got = simulate({"base": seen, "need": needs[label], "sources": [s]})
            cases += [(label, *x) for x in got]
            seen += [norm(t) for _, _, t in got]
    pages = spark.createDataFrame(page_rows, "priority int, source string, page_no long, http_status int")
    items = spark.createDataFrame(item_rows, "priority int, source string, page_no long, pos long, title string, href string")
    if not own_pages:
        pages, items = pages.drop("priority"), items.drop("priority")
    base = spark.createDataFrame(base_rows, "text string, label string")
    res = collect_fold(spark, pages, items, sources_frame(spark, reg_rows), base, needs, list(needs),
                       CollectConfig(zero_streak=4))
    assert sorted((r.label, r.source, r.page_no, r.text) for r in res.accepted.collect()) == sorted(cases)


def test_rerun_on_other_items_is_refused(spark, tmp_path):
    from corpusforge.operators.collect import RunMismatchError

    reg = sources_frame(spark, [{"name": "a", "label": "L", "base_url": "https://a/"}])
    pages = spark.createDataFrame([("a", 1, 200)], "source string, page_no long, http_status int")

    def run(title, **kw):
        items = spark.createDataFrame([("a", 1, 0, title, "/1")],
                                      "source string, page_no long, pos long, title string, href string")
        res = collect_fold(spark, pages, items, reg, None, {"L": 1}, ["L"], run_dir=str(tmp_path / "run"), **kw)
        return [r.text for r in res.accepted.collect()]

    assert run("first headline here") == run("first headline here") == ["first headline here"]
    with pytest.raises(RunMismatchError):
        run("second headline here")


def test_ids_of_sources_are_unique(spark):
    reg = sources_frame(spark, [{"name": "a", "label": "L", "base_url": "https://a/"}])
    none = spark.createDataFrame([], "source string, page_no long, http_status int")
    items = spark.createDataFrame([], "source string, page_no long, pos long, title string, href string")
    with pytest.raises(ValueError):
        collect_fold(spark, none, items, reg.union(reg), None, {"L": 1}, ["L"])
