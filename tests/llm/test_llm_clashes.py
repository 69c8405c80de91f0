"""Columns named like the operators' own come back; few labels train too."""

import numpy as np
from pyspark.sql import functions as F

from corpusforge.llm import pii, quality, simhash

from .test_llm_text import prose

OWN = "_row _copies row fp node _text _blocks _match _spans _source doc email start end".split()


def clashing(spark, texts):
    df = spark.createDataFrame(list(texts), "doc_id long, text string").repartition(2)
    return df.withColumns({c: F.concat(F.lit(f"{c}="), F.col("doc_id").cast("string")) for c in OWN})


def test_all_columns_come_back(spark):
    df = clashing(spark, [(1, "write to a.b@example.org now"), (2, None), (3, "one two three four five"), (4, "one two three four five")])
    out = pii.redact(df)
    assert out.columns == df.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[1]["text"] == "write to [EMAIL] now" and rows[2]["text"] is None
    assert all(r[c] == f"{c}={i}" for i, r in rows.items() for c in OWN)
    kept = simhash.keep_one(df)
    assert set(kept.columns) == set(df.columns)
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert sorted(rows) == [1, 2, 3] and all(r[c] == f"{c}={i}" for i, r in rows.items() for c in OWN)
    assert pii.redact(df.limit(0)).count() == 0 and simhash.keep_one(df.limit(0)).count() == 0


def test_a_classifier_is_trained_from_one_positive_on(spark):
    good = [(i, prose(i, 60)) for i in range(60)]
    bad = [(100 + i, "".join(np.random.default_rng(i).choice(list("#$%&!~ 0123"), 300))) for i in range(60)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    ids = [r[0] for r in docs.filter(~quality.held_out()).filter("doc_id < 100").select("doc_id").collect()]
    assert len(ids) > 8
    for n in (1, 2, 5):
        labels = spark.createDataFrame([(i, 1) for i in sorted(ids)[:n]], "doc_id long, quality int")
        model = quality.train(docs, labels)
        assert model is not None
        scores = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
        assert len(set(scores.values())) > 2
        assert np.mean([scores[i] for i, _ in good]) > np.mean([scores[i] for i, _ in bad])
