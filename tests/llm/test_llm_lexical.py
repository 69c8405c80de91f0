"""Operator 13 against a brute-force version."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.llm import lexical, queries

from .test_llm_text import prose, table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    merged = {}
    for item, text in items:
        merged.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in merged.items():
        scores = []
        for doc, bag in bags:
            m = 50 + 50 * sum(bag.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 20 * m))
                for t in own if bag[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, r, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **args):
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, score string")
    rows = lexical.search(table(spark, docs), asked, **args)
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in rows.collect()), key=str)


@pytest.fixture(scope="module")
def docs():
    rng = np.random.default_rng(5)
    rows = [(i, prose(i, int(rng.integers(1, 120)))) for i in range(150)]
    rows += [(i, prose(7, 40)) for i in range(200, 260)]  # copies: equal scores
    long_ = prose(9, 400_000)  # over a part of a text
    return [*rows, (300, None), (301, ""), (302, "  ,;"), (None, prose(8, 30)), (3, prose(8, 30)), (303, long_), (304, "É É é ß the"), (305, "THE the The")]


def test_as_brute_force(spark, docs):
    items = [(0, prose(7, 40)), (1, prose(1, 300)), (2, "É the"), (3, None), (4, ""), (5, "absent"), (1, prose(2, 20)), (None, prose(8, 30))]
    expected = brute(docs, items, 20)
    assert found(spark, docs, items, k=20) == expected
    assert found(spark, docs, items, k=20, block=60) == expected  # several blocks of items


def test_more_wanted_than_there_are(spark):
    docs = [(1, "one two"), (2, "two"), (2, "two")]
    assert found(spark, docs, [(9, "two one")], k=10) == brute(docs, [(9, "two one")], 10)
    assert found(spark, [], [(9, "two")]) == [] and found(spark, docs, []) == []


def test_small_tables_in_a_task(spark, docs, monkeypatch):
    monkeypatch.setattr(lexical, "CELLS", 2000)
    items = [(0, prose(7, 40)), (1, prose(1, 30))]
    assert found(spark, docs, items, k=5) == brute(docs, items, 5)


def test_groups_of_low_maximum_are_not_scored():
    rng = np.random.default_rng(1)
    counts = (rng.random((60, 4000)) < 0.2) * rng.integers(1, 4, (60, 4000))
    lengths = rng.integers(20, 400, 4000)
    t = lexical.Table(counts, lengths, np.arange(4000), np.zeros(4000, bool), 4000, int(lengths.sum()))
    best, weights = lexical.Best(50), rng.integers(500, 9000, 60)
    scored = t.search(np.arange(60), weights, best)
    assert scored < 0.5 * 4000
    exact = weights @ t.share
    top = np.lexsort((t.ids, -exact))[:50]
    assert best.ids.tolist() == t.ids[top].tolist() and best.score.tolist() == exact[top].tolist()


def test_registered_query_covers_every_item(spark):
    rows = queries.op13_ranked_search(spark, "/root/testdata/sf0.001")
    assert rows.agg(F.countDistinct("item_id")).first()[0] == spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").count()
