"""SimHash near-dedup (operator 7) with pivot distance tables.

Fingerprints are linked when at most ``bits`` (2) of their 64 bits differ.

* Equal fingerprints are merged first, so copies cost one row.
* The distinct fingerprints are dealt out by the pigeonhole principle: of four
  blocks of 16 bits at most two can differ, so two linked fingerprints agree in
  two whole blocks, that is in one of 6 choices.  This only brings together what
  could be linked.  A group of more than ``GROUP`` is dealt out once more by the
  four bytes it doesn't share, of which linked ones agree in two: such a part
  differs in two bytes only and holds 65,536 at most, whatever the input.
* In a group the **pivot table** has the Hamming distance of each fingerprint
  to every reference fingerprint.  By the triangle inequality a pair whose
  distances to some pivot differ by more than ``bits`` can't be linked.  The
  group is sorted by the first distance, so only a band of the sorted group is
  looked at, the other coordinates discard nearly all of that, and the
  survivors are verified by XOR and population count.
* Each group yields a spanning forest of its links, never its pairs; the
  components of all of them come from alternating large-star and small-star
  passes, each written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import splitmix, staged, texts_of, unused

PIVOTS = 16
#: Fingerprints up to which a group is one task's work as it is.
GROUP = 65_536
#: Larger groups up to which their names go to every task (some 30 bytes each); beyond, the join is shuffled.
BROADCAST_GROUPS = 200_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority of the bits of XXH64 (seed 42) over all word shingles."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    begin = end - size
    n = max(1, len(words) - shingle + 1)
    spans = zip(begin[:n].tolist(), end[len(words) - n :].tolist(), strict=True)
    hash_ = xxhash.xxh64_intdigest
    h = np.array([hash_(line[a:b], 42) for a, b in spans], dtype=">u8")
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 16):
        ones += np.unpackbits(h[lo : lo + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _fingerprints(shingle: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch.column("text"))
            raw = data.tobytes()
            out = [fingerprint(raw[offsets[i] : offsets[i + 1]], shingle) for i in range(len(offsets) - 1)]
            rest = {n: batch.column(n) for n in batch.schema.names if n != "text"}
            yield pa.RecordBatch.from_pydict(rest | {"fp": np.array(out, np.uint64).view(np.int64)})

    return rows


def fingerprints(docs: DataFrame, shingle: int = 3, *more: Column) -> DataFrame:
    """(doc_id, fp) of every row, with the long columns ``more`` between; a null
    text is empty."""
    texts = docs.select(F.col("doc_id").cast("long"), *more, "text")
    schema = ", ".join(f"{n} long" for n in (*texts.columns[:-1], "fp"))
    return texts.mapInArrow(_fingerprints(shingle), schema)


def distances(fp: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivot table: Hamming distances of every fingerprint to every pivot."""
    return np.bitwise_count(fp[:, None] ^ pivots[None, :]).astype(np.int8)


def possible(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """Which pairs of rows of the pivot table can be within ``bits``: the largest
    difference of their coordinates says no for the others."""
    return np.abs(left - right).max(axis=1, initial=0) <= bits


def _forest(key: np.ndarray, fp: np.ndarray, pivots: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smaller fingerprint of its tree) of groups of equal
    ``key``: a spanning forest of all links within the groups."""
    table = distances(fp, pivots)
    by = np.lexsort((table[:, 0], key))
    key, fp, table = key[by], fp[by], table[by]
    left, right = [], []
    at, step = np.arange(len(fp) - 1), 1
    while len(at):
        far = at + step
        near = (key[at] == key[far]) & (table[far, 0] - table[at, 0] <= bits)
        at, far = at[near], far[near]
        close = possible(table[at], table[far], bits)
        a, b = at[close], far[close]
        linked = np.bitwise_count(fp[a] ^ fp[b]) <= bits
        left.append(a[linked])
        right.append(b[linked])
        step += 1
        at = at[at + step < len(fp)]
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    root = fp.copy()
    while True:
        before = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        if np.array_equal(before, root):
            break
    moved = root != fp
    return fp[moved], root[moved]


def _links(bits: int):
    pivots = splitmix(PIVOTS, 7)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros((0, 2), np.int64), np.zeros(0, np.uint64)

        def forest(upto: int) -> pa.RecordBatch:
            names = np.unique(key[:upto], axis=0, return_inverse=True)[1].reshape(-1)
            size = np.bincount(names)
            own = size[names] > 1
            u, v = _forest(names[own], fp[:upto][own], pivots, bits)
            return pa.RecordBatch.from_pydict({"u": u.view(np.int64), "v": v.view(np.int64)})

        for batch in batches:  # sorted by group; the last group of a batch may go on
            mine = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("choice", "part")], axis=1)
            key = np.concatenate((key, mine))
            fp = np.concatenate((fp, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)))
            done = np.flatnonzero((key != key[-1]).any(axis=1))
            upto = done[-1] + 1 if len(done) else 0
            if upto:
                yield forest(upto)
                key, fp = key[upto:], fp[upto:]
        if len(fp):
            yield forest(len(fp))

    return rows


def links(distinct: DataFrame, bits: int = 2) -> DataFrame:
    """Links (u, v) between the distinct fingerprints ``fp`` that connect the
    same ones as all pairs within ``bits`` bits."""
    if not 0 <= bits <= 2:
        raise ValueError("bits must be 0, 1 or 2")
    coarse = [(i, 0xFFFF << 16 * a | 0xFFFF << 16 * b) for i, (a, b) in enumerate(combinations(range(4), 2))]
    group = ["choice", "part"]
    dealt = distinct.select("fp", F.explode(_keys(coarse)).alias("key")).select("key.*", "fp")
    large = staged(dealt.groupBy(*group).count().filter(F.col("count") > GROUP).select(*group, F.lit(True).alias("large")), "large-groups")
    n_large = large.count()
    if n_large:
        dealt = dealt.join(F.broadcast(large) if n_large <= BROADCAST_GROUPS else large, group, "left")
        finer = F.lit(None)
        for i, mask in coarse:
            free = [8 * k for k in range(8) if not mask >> 8 * k & 1]
            parts = [(6 + 6 * i + j, mask | 0xFF << a | 0xFF << b) for j, (a, b) in enumerate(combinations(free, 2))]
            finer = F.when(F.col("choice") == i, _keys(parts)).otherwise(finer)
        own = F.array(F.struct("choice", "part"))
        dealt = dealt.select("fp", F.explode(F.when(F.col("large"), finer).otherwise(own)).alias("key")).select("key.*", "fp")
    return dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(_links(bits), "u long, v long")


def _keys(masks: list[tuple[int, int]]) -> Column:
    """(choice, part) of ``fp`` for each choice and the bits it keeps."""
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("part")) for i, m in masks])


def components(edges: DataFrame, limit: int = 100) -> DataFrame:
    """(node, root): the least node reachable, for every node of ``edges``
    (u, v).  Large-star and small-star passes until nothing changes."""
    ends = lambda a, b: F.struct(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    at = staged(edges.select(ends("u", "v").alias("e")).select("e.*").filter("u != v").distinct(), "links")
    digest = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    seen = at.select(digest).first()[0]
    for _ in range(limit):
        both = at.unionByName(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(ends("v", "m").alias("e")).select("e.*").filter("u != v")
        at = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = at.select(digest).first()[0]
        if now == seen:
            return at.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
    raise RuntimeError(f"components didn't settle in {limit} passes")


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hex digits)
    and component_id, the smallest doc_id reachable by links.

    A null or wordless text has fingerprint zero and is linked like any other.
    A null doc_id takes part, but names a component only if no other can (the
    component_id is then null).  Rows that share a doc_id are documents of their
    own.  Other columns are ignored; an empty table gives no rows.
    """
    found = staged(fingerprints(docs, shingle), "fingerprints")
    distinct = staged(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), bits))
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.select("fp", "root").join(least, "root").select("fp", "component_id")
    return found.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that with the
    smallest doc_id (a null one last); of rows that share the doc_id, the one
    with the least hash of all its columns.  All columns are returned, whatever
    their names; null and empty texts are one group; an empty table gives no
    rows."""
    row = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    found = staged(fingerprints(docs, shingle, row.alias("row")), "row-fingerprints")
    distinct = staged(found.select("fp").distinct(), "distinct-fingerprints")
    roots = components(links(distinct, bits))
    root = F.coalesce("root", "fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row"))
    of = found.groupBy("fp").agg(first.alias("first")).join(roots, F.col("fp") == F.col("node"), "left")
    winners = of.groupBy(root.alias("root")).agg(F.min("first").alias("first")).select("first.row")
    number, name = unused("_copies", docs.columns), unused("_row", docs.columns)
    copies = found.groupBy("row").agg(F.count("*").alias(number))
    win = staged(winners.join(copies, "row").withColumnRenamed("row", name), "winners")
    kept = docs.withColumn(name, row).join(win.hint("shuffle_hash"), name).drop(name)
    single = kept.filter(F.col(number) == 1).drop(number)
    if win.filter(F.col(number) > 1).isEmpty():
        return single
    return single.unionByName(kept.filter(F.col(number) > 1).drop(number).dropDuplicates())

