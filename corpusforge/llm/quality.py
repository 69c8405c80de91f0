"""Quality classifier (operator 8): positive-unlabelled learning.

A small network on features of the text alone is trained to minimise the
non-negative unbiased risk from trusted positives (label 1) and unlabelled web
text: ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``.  The class prior is
estimated from scores of a first classifier of positives against unlabelled
text, as the least ratio of the tails ``P_u(score >= c) / P_p(score >= c)`` on
held-back rows.  Labels of 0 are never used.

Training takes a sample of at most about ``sample`` positives and ``sample``
unlabelled documents, chosen by a hash of doc_id (documented parameter); every
document is scored, from its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import texts_of

PRIOR = 0.5  # share of positives, with a single row to tell from
SAMPLE = 12_000
_SLICE = 1 << 20
_KINDS = np.zeros(256, np.int64)  # classes of bytes
_KINDS[[9, 10, 11, 12, 13, 32]] = 1
_KINDS[48:58] = 2
_KINDS[65:91] = 3
_KINDS[97:123] = 4
_KINDS[[33, 44, 46, 59, 58, 63, 39, 34, 40, 41, 45]] = 5
_KINDS[128:] = 6
N_FEATURES = 24


def features_of(text: bytes) -> np.ndarray:
    """Features of a whole text; all are ratios or logarithms."""
    out = np.zeros(N_FEATURES)
    out[0] = 1.0
    if not text:
        return out
    counts = np.zeros(256, np.int64)
    raw = np.frombuffer(text, np.uint8)
    for lo in range(0, len(raw), _SLICE):
        counts += np.bincount(raw[lo : lo + _SLICE], minlength=256)
    kinds = np.bincount(_KINDS, weights=counts, minlength=7)
    n = len(raw)
    out[1] = np.log1p(n) / 10
    out[2:9] = kinds / n
    out[9] = np.sqrt(counts[33] / n)  # exclamation marks
    out[10] = np.sqrt((counts[[35, 36, 37, 38, 42]]).sum() / n)  # symbols
    out[11] = np.sqrt((counts[[124, 60, 62, 123, 125, 91, 93, 95, 92, 94, 126, 61, 43]]).sum() / n)  # marks of tables and code
    share = counts[counts > 0] / n
    out[12] = -(share * np.log2(share)).sum() / 8
    words = text.split()
    w = len(words)
    if not w:
        return out
    size = np.fromiter(map(len, words), np.int64, w)
    out[13] = np.log1p(w) / 10
    out[14] = size.mean() / 20
    out[15] = size.std() / 20
    out[16] = min(size.max(), 200) / 200
    out[17] = len(set(words)) / w
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    out[18] = np.sqrt(repeats / w)
    out[19] = np.sqrt(np.mean(np.fromiter(map(bytes.isupper, words), bool, w) & (size > 1)))
    ends = [x[-1] for x in words]
    out[20] = np.sqrt(sum(c in b"!#$%&*|~^=+@<>" for c in ends) / w)
    out[21] = sum(c in b".,;:?" for c in ends) / w
    out[22] = np.sqrt(sum(x in (b"|", b"-", b"*", b"/") for x in words) / w)
    lines = text.split(b"\n")
    out[23] = len(set(lines)) / len(lines)
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    raw = data.tobytes()
    return np.array([features_of(raw[offsets[i] : offsets[i + 1]]) for i in range(len(offsets) - 1)]).reshape(-1, N_FEATURES)


@dataclass
class Model:
    """Weights of the network, and the estimated share of positives."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(x @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _train(pos: np.ndarray, unl: np.ndarray, prior: float | None, seed: int, hidden: int = 24, epochs: int = 60) -> Model:
    """Adam on the non-negative risk with the sigmoid loss; without a prior, on
    the logistic loss of positives against unlabelled."""
    rng = np.random.default_rng(seed)
    every = np.concatenate((pos, unl))
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-6
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (pos, unl))
    k = p.shape[1]
    theta = [rng.normal(0, 1 / np.sqrt(k), (k, hidden)), np.zeros(hidden), rng.normal(0, 0.1, hidden), np.zeros(1)]
    m, v = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    batches = max(1, min(len(p), len(u)) // 256)
    step = 0
    for epoch in range(epochs):
        rate = 0.01 * 0.5 ** (epoch / 20)
        ps, us = np.array_split(rng.permutation(len(p)), batches), np.array_split(rng.permutation(len(u)), batches)
        for ip, iu in zip(ps, us, strict=True):
            x = np.concatenate((p[ip], u[iu]))
            hid = np.tanh(x @ theta[0] + theta[1])
            z = np.clip(hid @ theta[2] + theta[3][0], -30, 30)
            s = 1 / (1 + np.exp(-z))
            n = len(ip)
            grad = np.empty(len(z))
            if prior is None:
                grad[:n], grad[n:] = (s[:n] - 1) / n, s[n:] / (len(z) - n)
            else:
                slope = s * (1 - s)  # of the sigmoid loss: s for label 0, 1 - s for label 1
                negative = s[n:].mean() - prior * s[:n].mean()
                if negative >= 0:
                    grad[:n], grad[n:] = -2 * prior * slope[:n] / n, slope[n:] / (len(z) - n)
                else:  # step back from what is over-fitted
                    grad[:n], grad[n:] = prior * slope[:n] / n, -slope[n:] / (len(z) - n)
            back = grad[:, None] * theta[2][None, :] * (1 - hid**2)
            g = [x.T @ back, back.sum(axis=0), hid.T @ grad, np.array([grad.sum()])]
            step += 1
            for t, gt, mt, vt in zip(theta, g, m, v, strict=True):
                gt = gt + 1e-5 * t
                mt += 0.1 * (gt - mt)
                vt += 0.001 * (gt**2 - vt)
                t -= rate * (mt / (1 - 0.9**step)) / (np.sqrt(vt / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, theta[0], theta[1], theta[2], float(theta[3][0]), prior or 0.0)


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Share of positives in unlabelled text: the least (upper bound of the)
    ratio of the tails over all thresholds, on rows held back from training."""
    half = lambda x: (x[::2], x[1::2])
    (p0, p1), (u0, u1) = half(pos), half(unl)
    model = _train(p0, u0, None, seed=1, epochs=30)
    sp, su = np.sort(model.logits(p1)), np.sort(model.logits(u1))
    c = np.quantile(sp, np.linspace(0, 0.9, 91))
    tail_p = 1 - np.searchsorted(sp, c, "left") / len(sp)
    tail_u = 1 - np.searchsorted(su, c, "left") / len(su)
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(sp)) + 1 / np.sqrt(len(su)))
    at = int(np.argmin((tail_u + slack) / np.maximum(tail_p, 1e-9)))
    return float(np.clip(tail_u[at] / tail_p[at], 0.05, 0.99))


def held_out() -> Column:
    """Whether a row's labels are never learnt: crc32(doc_id as text) mod 3 = 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _share(part: float) -> Column:
    """Rows whose hash of doc_id is among the first ``part`` of all hashes."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, part) * (1 << 30))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Model from the positives of ``labels`` (doc_id, quality) that aren't held
    out and from documents that aren't either, from one positive on; None without
    positives (or without documents): then no classifier is applied."""
    trusted = labels.filter("doc_id is not null and quality = 1").filter(~held_out()).select("doc_id").distinct()
    n_trusted = trusted.count()
    n_docs = docs.count()
    if not n_trusted or not n_docs:
        return None
    ids = trusted.filter(_share(sample / n_trusted)).limit(2 * sample).withColumn("positive", F.lit(True))
    texts = docs.filter("doc_id is not null").filter(~held_out()).select("doc_id", "text")
    unlabelled = _share(1.5 * sample / n_docs)
    picked = (
        texts.join(F.broadcast(ids), "doc_id", "left")  # at most 2 * sample ids
        .filter(F.col("positive") | unlabelled)
        .select("doc_id", F.coalesce("positive", F.lit(False)).alias("positive"), unlabelled.alias("unlabelled"), "text")
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(*texts_of(batch.column("text")))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "positive": batch.column("positive"), "unlabelled": batch.column("unlabelled"),
                "x": pa.array(list(x), pa.list_(pa.float64())),
            })

    got = picked.mapInArrow(rows, "doc_id long, positive boolean, unlabelled boolean, x array<double>").toPandas()
    got = got.sort_values("doc_id", kind="stable")  # the same model whatever the order of rows
    x = np.array(got["x"].tolist()).reshape(-1, N_FEATURES)
    pos, unl = x[got["positive"].to_numpy(bool)], x[got["unlabelled"].to_numpy(bool)]
    if not len(pos) or not len(unl):
        return None
    # a half of each is held back to estimate the prior; where nothing can be, it is supposed
    prior = estimate_prior(pos, unl) if min(len(pos), len(unl)) > 1 else PRIOR
    return _train(pos, unl, prior, seed=2)


def _scores(model: Model | None, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.full(len(offsets) - 1, 0.5) if model is None else model.score(features(data, offsets))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    A null or empty text is scored by the features of an empty text; without a
    model (no trusted positives) every score is 0.5.  A null doc_id is not held
    out.  Repeated rows get equal scores; other columns are ignored; an empty
    table gives no rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _scores(model, *texts_of(batch.column("text")))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": s, "predicted": (s >= 0.5).astype(np.int32),
            })

    texts = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    return texts.mapInArrow(rows, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that are predicted 1, with all columns; without a
    model (no trusted positives) all rows.  A null text is judged as an empty one;
    an empty table gives no rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, *texts_of(batch.column("text"))) >= 0.5))

    return docs.mapInArrow(rows, docs.schema)
