"""Keyword sets in one pass against ``in``."""

import random

from pyspark.sql import functions as F

from corpusforge.operators.keywords import keyword_index, keyword_sets
from corpusforge.sources.registry import keywords_frame


def test_as_many_tests_of_contains(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcé ßx") for _ in range(n))
    texts = [(i, word(rng.randint(0, 60)) if i % 9 else [None, "", "a", "é"][i // 9 % 4]) for i in range(120)]
    sets = {f"s{j}": [word(rng.randint(1, 6)) for _ in range(40)] for j in range(4)} | {"none": ["zzz", ""], "long": ["a" * 50]}
    df = spark.createDataFrame(texts, "id long, text string").repartition(3)
    got = {(r["id"], r["set_name"]): r["n_keywords"] for r in keyword_sets(df, ["id"], F.col("text"), keywords_frame(spark, sets)).collect()}
    want = {
        (i, s): n for i, t in texts for s, ws in sets.items() if (n := sum(w in t for w in set(ws) if w) if t is not None else 0)
    }
    assert got == want


def test_no_keywords(spark):
    df = spark.createDataFrame([(1, "text")], "id long, text string")
    empty = keywords_frame(spark, {"s": [""]})
    assert keyword_sets(df, ["id"], F.col("text"), empty).collect() == []


def test_keywords_lie_under_a_gram_of_their_own_where_there_is_one(spark):
    kw = keywords_frame(spark, {"s": ["market", "markets", "marker", "super"]})
    grams = {r["keyword"]: r["gram"] for r in keyword_index(kw).collect()}
    assert grams == {"market": "ket", "markets": "ets", "marker": "ker", "super": "per"}


def test_texts_are_read_once_whatever_the_number_of_keywords(spark):
    df = spark.createDataFrame([(i, f"text number {i}") for i in range(50)], "id long, text string")
    kw = keywords_frame(spark, {"s": [f"word{i}" for i in range(4000)] + ["number 7"]})
    out = keyword_sets(df, ["id"], F.col("text"), kw)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 4 and "exists(" not in plan
    assert out.collect() == [(7, "s", 1)]


def test_spaces_short_words_and_keywords_over_words(spark):
    df = spark.createDataFrame([(1, "a a"), (2, "of the a b of"), (3, "  "), (4, "ab\ncd"), (5, ""), (6, None), (7, "xof them")], "id int, text string")
    words = [" ", "  ", "of the", "a b", "b\nc", "\n", " a", "e m"]
    got = {r["id"]: r["n_keywords"] for r in keyword_sets(df, ["id"], F.col("text"), keywords_frame(spark, {"s": words})).collect()}
    want = {r["id"]: sum(w in (r["text"] or "") for w in words) for r in df.collect()}
    assert got == {k: n for k, n in want.items() if n}
