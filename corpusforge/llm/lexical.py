"""Ranked lexical search (operator 13): for every item the documents of highest
score, by presence masks.

The items are a stated query set, looked for in all documents in blocks of items
of a bounded number of terms.  A task takes some documents at a time as a table
of terms by documents, sorted by length.  For an item, a bitmap of which of its
terms a document holds is the document's mask; documents of equal mask and
similar length are one group, whose highest possible score follows from the
greatest contribution of each term at that length.  Groups are scored by
descending maximum until no further one can reach the item's k-th best so far.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.llm.common import staged

TOP = 50
TERMS = 20_000  # terms of the items of a block, together, about
CELLS = 4_000_000  # of a table of terms by documents
LENGTHS = 16  # groups of similar length in a table
TOGETHER = 256  # documents that are scored between two looks at the k-th best
SALTS = 64
PART = 1 << 20  # bytes of a text that are split at a time
#: UTF-8 bytes: 0-9, a-z and all bytes of other characters beyond ASCII stay, A-Z become small, the rest part terms.
_TERM_BYTES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: str | None) -> Iterator[list[bytes]]:
    """All terms of a text, some at a time."""
    data = (text or "").encode().translate(_TERM_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PART)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _statistics(known: dict[bytes, int]):
    """Rows (term, n): the documents that hold a term; at -1 the documents with
    any term, at -2 all terms."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding = np.zeros(len(known), np.int64)
        documents = total = 0
        for batch in batches:
            for text in batch.column("text"):
                n, own = 0, set()
                for some in terms(text.as_py()):
                    n += len(some)
                    own |= known.keys() & set(some)
                documents += n > 0
                total += n
                holding[[known[t] for t in own]] += 1
        at = np.nonzero(holding)[0]
        yield pa.RecordBatch.from_pydict({
            "term": pa.array(np.concatenate([at, [-1, -2]]), pa.int64()), "n": pa.array(np.concatenate([holding[at], [documents, total]]), pa.int64()),
        })

    return rows


class Table:
    """Contributions of the terms to the scores of some documents."""

    def __init__(self, counts: np.ndarray, lengths: np.ndarray, ids: np.ndarray, nulls: np.ndarray, n_docs: int, n_terms: int):
        order = np.argsort(lengths, kind="stable")
        counts, m = counts[:, order], 50 + 50 * lengths[order] * n_docs // n_terms
        self.ids, self.nulls = ids[order], nulls[order]
        self.present = counts > 0
        self.share = np.zeros(counts.shape, np.int64)
        term, doc = np.nonzero(self.present)
        tf = counts[term, doc].astype(np.int64)
        self.share[term, doc] = 1_000_000_000 * tf // (1000 * tf + 20 * m[doc])
        starts = np.unique(np.arange(LENGTHS) * len(order) // LENGTHS)
        self.most = np.maximum.reduceat(self.share, starts, axis=1)
        self.similar = np.searchsorted(starts, np.arange(len(order)), side="right") - 1

    def groups(self, wanted: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents sorted by group, where each group begins, highest possible
        score of each group) for an item's terms, groups by descending score."""
        bits = self.present[wanted]
        packed = np.packbits(bits, axis=0)
        some = np.nonzero(packed.any(axis=0))[0]
        code = self.similar[some]
        for k in range(0, len(packed), 7):  # masks of any width: 56 terms at a time
            word = np.zeros(len(some), np.int64)
            for row in packed[k : k + 7]:
                word = word << 8 | row[some]
            _, word = np.unique(word, return_inverse=True)
            _, code = np.unique(code * (len(some) + 1) + word, return_inverse=True)
        order = np.argsort(code, kind="stable")
        starts = np.nonzero(np.diff(code[order], prepend=-1))[0]
        one = some[order[starts]]  # stands for its group
        limit = (bits[:, one] * (weights[:, None] * self.most[wanted][:, self.similar[one]])).sum(axis=0)
        by_limit = np.argsort(-limit, kind="stable")
        sizes = np.diff(starts, append=len(order))[by_limit]
        ends = np.cumsum(sizes)
        inside = np.arange(len(order)) - np.repeat(ends - sizes, sizes)
        docs = some[order[np.repeat(starts[by_limit], sizes) + inside]]
        return docs, ends - sizes, limit[by_limit]

    def search(self, wanted: np.ndarray, weights: np.ndarray, best: Best) -> int:
        """Put the documents that may be among the best into ``best``; the
        number of documents scored."""
        docs, starts, limit = self.groups(wanted, weights)
        ends, scored, group = np.append(starts[1:], len(docs)), 0, 0
        while group < len(starts) and limit[group] >= best.floor:  # equal scores may win by their id
            upto = max(group + 1, int(np.searchsorted(ends, starts[group] + TOGETHER, side="right")))
            upto = min(upto, int(np.searchsorted(-limit, -best.floor, side="right")))
            some = docs[starts[group] : ends[upto - 1]]
            score = weights @ self.share[np.ix_(wanted, some)]
            best.take(score, self.ids[some], self.nulls[some])
            scored, group = scored + len(some), upto
        return scored


class Best:
    """The k best (score above 0, then smaller id, null last) of those taken."""

    def __init__(self, k: int):
        self.k, self.floor = k, 1
        self.score, self.ids, self.nulls = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def take(self, score: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        fits = score >= self.floor
        score, ids, nulls = (np.concatenate([a, b[fits]]) for a, b in ((self.score, score), (self.ids, ids), (self.nulls, nulls)))
        top = np.lexsort((ids, nulls, -score))[: self.k]
        self.score, self.ids, self.nulls = score[top], ids[top], nulls[top]
        if len(top) == self.k:
            self.floor = int(self.score[-1])


def _search(known: dict[bytes, int], items: list[tuple[int | None, np.ndarray, np.ndarray]], n_docs: int, n_terms: int, k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        width = max(1, CELLS // max(1, len(known)))

        def table(docs: list[tuple[int | None, np.ndarray, int]]) -> None:
            doc = np.repeat(np.arange(len(docs)), [len(places) for _, places, _ in docs])
            term = np.concatenate([places for _, places, _ in docs])
            counts = np.bincount(term * len(docs) + doc, minlength=len(known) * len(docs)).reshape(len(known), len(docs))
            ids = np.array([0 if i is None else i for i, _, _ in docs], np.int64)
            nulls = np.array([i is None for i, _, _ in docs])
            t = Table(counts, np.array([n for _, _, n in docs], np.int64), ids, nulls, n_docs, n_terms)
            for (_, wanted, weights), top in zip(items, best, strict=True):
                t.search(wanted, weights, top)

        held: list[tuple[int | None, np.ndarray, int]] = []
        for batch in batches:
            for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                n, places = 0, []
                for some in terms(text.as_py()):
                    n += len(some)
                    places.append(np.array([p for p in map(known.get, some) if p is not None], np.int64))
                places = np.concatenate(places) if places else np.zeros(0, np.int64)
                if len(places):
                    held.append((doc.as_py(), places, n))
                    if len(held) == width:
                        table(held)
                        held = []
        if held:
            table(held)
        for (item, _, _), top in zip(items, best, strict=True):
            yield pa.RecordBatch.from_pydict({
                "item_id": pa.array([item] * len(top.ids), pa.int64()), "doc_id": pa.array(top.ids, pa.int64(), mask=top.nulls),
                "score": pa.array(top.score, pa.int64()),
            })

    return rows


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block: int = TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item of ``items`` (item_id,
    text) the ``k`` rows of ``docs`` (doc_id, text) of highest score above 0
    (all, if fewer), equal scores by ascending doc_id.

    Null or empty texts have no terms.  Rows of ``items`` that share an item_id
    (null for one) are one item with the terms of all.  Rows of ``docs`` that
    share a doc_id are ranked each; a null doc_id comes last among equal scores.
    Other columns are ignored; an empty table gives no rows.  Items go to the
    tasks in blocks of about ``block`` terms, with two passes over ``docs`` each.
    """
    lower = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    words = F.explode(F.array_distinct(F.regexp_extract_all(lower, F.lit(_TERM), F.lit(0))))
    asked = staged(items.select(F.col("item_id").cast("long"), words.alias("term")).distinct(), "item-terms")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    n_blocks = max(1, -(-asked.count() // block))
    found, schema = None, "item_id long, doc_id long, score long"
    for b in range(n_blocks):
        mine = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == b).groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))
        rows = mine.sort("item_id").collect()  # a block
        known = {t.encode(): i for i, t in enumerate(sorted({t for r in rows for t in r["terms"]}))}
        n = {r["term"]: r["n"] for r in docs.mapInArrow(_statistics(known), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
        n_docs, n_terms = n.get(-1, 0), n.get(-2, 0)
        block_items = []
        for r in rows:
            wanted = np.array([p for p in (known[t.encode()] for t in r["terms"]) if p in n], np.int64)
            weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n[p] + 1))) for p in wanted.tolist()], np.int64)
            if len(wanted):
                block_items.append((r["item_id"], wanted, weights))
        hits = docs.mapInArrow(_search(known, block_items, n_docs, n_terms, k), schema)
        hits = staged(hits, "hits") if n_blocks > 1 else hits
        found = hits if found is None else found.unionByName(hits)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    first = F.row_number().over(Window.partitionBy("item_id", salt).orderBy(*order))
    best = found.withColumn("rank", first).filter(F.col("rank") <= k)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
