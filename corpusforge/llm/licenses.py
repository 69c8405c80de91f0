"""License scans (operator 3), with DataFrame functions only.

Templates and texts become lower-case words, and shingles of ``SHINGLE`` (5)
words, each hashed once.

* Texts are cut into **overlapping windows** sized for the templates: for
  templates of ``w`` shingles the windows hold ``w + s - 1`` shingles and start
  every ``s = max(1, w // 2)``, so one window holds any such passage whole.
  Templates of similar size share a width.
* **MinHash bands** of one row each retrieve templates: with ``b`` bands a
  window is missed with a probability of ``(1 - J) ** b`` at most; ``b`` is
  chosen so that this is under ``MISS`` for a window that holds just the
  ``CONTAINMENT`` of the template.
* **Exact containment** verifies: the share of the template's shingles that the
  window holds must be at least ``CONTAINMENT``.

A band can only collide in a window that holds the template's least shingle of
that band, so only windows with some template shingle are sketched.

The templates are taken in blocks of at most ``TEMPLATE_SHINGLES`` shingles,
each of which goes to every task; more templates mean more passes over the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm.common import splitmix, staged

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-4
TEMPLATE_SHINGLES = 200_000  # of a block of templates

#: License notices to look for; a parameter of ``scan``.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "MIT": "Released under the MIT License",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(ws: Column) -> Column:
    """Hashes of the shingles in order; none for fewer words than a shingle.

    The words are zipped with themselves instead of being looked up by place:
    the optimiser may put the expression of ``ws`` in its place, and inside a
    lambda that would be computed anew for each shingle."""
    n = F.size(ws)
    zipped = F.arrays_zip(*[F.slice(ws, k + 1, n).alias(f"w{k}") for k in range(SHINGLE)])
    every = F.transform(zipped, lambda x: F.xxhash64(*[x[f"w{k}"] for k in range(SHINGLE)]))
    return F.slice(every, 1, F.greatest(F.lit(0), n - SHINGLE + 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _sketch(hashes: Column, bands: int) -> Column:
    """MinHash: of each band the least hash under that band's mask."""

    def least(mask: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(mask))))

    return F.array(*[least(_signed(int(m))) for m in splitmix(bands, 11)])


def templates_of(spark: SparkSession, notices: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(list(notices.items()), "license_id string, text string")


def widths(sizes: list[int]) -> list[tuple[int, int, int, int]]:
    """(least w, greatest w, window, stride) of classes of template sizes."""
    out: list[list[int]] = []
    for w in sorted(set(sizes)):
        if out and w <= 1.25 * out[-1][0]:
            out[-1][1] = w
        else:
            out.append([w, w])
    return [(lo, hi, hi + max(1, hi // 2) - 1, max(1, hi // 2)) for lo, hi in out]


def bands(low: int, width: int, containment: float) -> int:
    """Bands for templates of ``low`` shingles or more in windows of ``width``:
    of a window that holds ``containment`` of such a template the Jaccard
    similarity is ``held / (low + width - held)`` at least."""
    held = max(1, math.ceil(containment * low - 1e-9))
    similar = held / (low + width - held)
    return max(1, math.ceil(math.log(MISS) / math.log(1 - similar))) if similar < 1 else 1


def _blocks(known: DataFrame) -> Iterator[list[tuple[str, list[int], int]]]:
    block, size = [], 0
    for r in known.toLocalIterator(prefetchPartitions=False):
        if size + r["w"] > TEMPLATE_SHINGLES and block:
            yield block
            block, size = [], 0
        block.append((r["license_id"], list(r["own"]), r["w"]))
        size += r["w"]
    if block:
        yield block


def scan(docs: DataFrame, templates: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, license_id, containment, start_word, n_words): for every row of
    ``docs`` (doc_id, text) and every template (license_id, text) that one of
    its windows contains by at least ``containment``, the first of the best
    windows.

    Null and empty texts, and templates of fewer words than a shingle, match
    nothing.  Null and repeated ids are returned as they are: rows that agree in
    doc_id and text are one.  Other columns are ignored; without documents or
    templates there are no rows."""
    spark = docs.sparkSession
    known = (
        templates.select("license_id", words(F.col("text")).alias("words"))
        .select("license_id", F.array_distinct(shingles(F.col("words"))).alias("own"))
        .filter(F.size("own") > 0).select("license_id", "own", F.size("own").alias("w"))
    )
    classes = widths([r["w"] for r in known.select("w").distinct().collect()])  # of all blocks, so that these don't matter
    found = None
    for block in _blocks(known):
        if found is not None:  # earlier blocks are done before the next is held
            found = staged(found, "licenses")
        more = _found(docs, block, classes, containment)
        found = more if found is None else found.unionByName(more)
    if found is None:
        return spark.createDataFrame([], "doc_id long, license_id string, containment double, start_word int, n_words int")
    best = F.max_by(F.struct("containment", "start_word", "n_words"), F.struct("containment", -F.col("start_word"), -F.col("n_words")))
    return (
        found.groupBy("doc_id", "row", "license_id").agg(best.alias("best"))
        .select("doc_id", "license_id", "best.containment", "best.start_word", "best.n_words")
    )


def _found(
    docs: DataFrame, rows: list[tuple[str, list[int], int]], classes: list[tuple[int, int, int, int]], containment: float
) -> DataFrame:
    """The windows of ``docs`` that contain one of ``rows`` (license_id, its
    shingles, their number), with the hash of their text as ``row``."""
    spark = docs.sparkSession
    wanted = sorted({h for _, own, _ in rows for h in own})
    classes = [c for c in classes if any(c[0] <= w <= c[1] for _, _, w in rows)]

    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("row"), words(F.col("text")).alias("words"))
    hashed = texts.select("doc_id", "row", shingles(F.col("words")).alias("hashes"))
    some = F.transform("hashes", lambda h, i: F.when(h.isin(wanted), i))
    hashed = hashed.withColumn("places", F.filter(some, lambda i: i.isNotNull()))
    counts = [bands(low, width, containment) for low, _, width, _ in classes]
    bank, windows = [], []
    for c, ((low, high, width, stride), n) in enumerate(zip(classes, counts, strict=True)):
        for i, own, w in rows:
            if low <= w <= high:
                bank += [(c, i, own, b, v) for b, v in enumerate(_sketch_of(own, n))]
        at = F.array_distinct(F.flatten(F.transform("places", _windows_of(width, stride))))
        windows.append(F.transform(at, _struct_of(c)))
    bank = spark.createDataFrame(bank, "class int, license_id string, own array<long>, band int, least long")
    width, stride = (F.get(F.array(*[F.lit(x[k]) for x in classes]), F.col("at.class")) for k in (2, 3))
    last = F.greatest(F.lit(0), F.ceil((F.size("hashes") - F.col("width")) / F.col("stride"))).cast("int")  # it ends with the text
    cut = (
        hashed.select("doc_id", "row", "hashes", F.explode(F.concat(*windows)).alias("at"))
        .select("doc_id", "row", "hashes", "at.class", "at.window", width.alias("width"), stride.alias("stride"))
        .select("doc_id", "row", "hashes", "class", "width", (F.least("window", last) * F.col("stride")).alias("start_word"))
        .select("doc_id", "row", "class", "start_word", F.slice("hashes", F.col("start_word") + 1, F.col("width")).alias("part"))
    )
    banded = cut.select("*", F.posexplode(_sketch(F.col("part"), max(counts))).alias("band", "least"))
    share = F.size(F.array_intersect("own", "part")) / F.size("own")
    return (
        banded.join(F.broadcast(bank), ["class", "band", "least"])  # at most a block's shingles per band
        .select("doc_id", "row", "license_id", share.alias("containment"), "start_word", (F.size("part") + SHINGLE - 1).alias("n_words"))
        .filter(F.col("containment") >= containment)
    )


def _windows_of(width: int, stride: int):
    """Numbers of the windows that hold a shingle, by its place."""

    def of(i: Column) -> Column:
        first = F.greatest(F.lit(0), F.ceil((i - width + 1) / stride).cast("int"))
        return F.sequence(F.least(first, F.floor(i / stride).cast("int")), F.floor(i / stride).cast("int"))

    return of


def _struct_of(c: int):
    return lambda w: F.struct(F.lit(c).alias("class"), w.alias("window"))


def _sketch_of(own: list[int], bands: int) -> list[int]:
    return [min(h ^ _signed(int(m)) for h in own) for m in splitmix(bands, 11)]
