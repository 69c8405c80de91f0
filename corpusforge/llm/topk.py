"""Exact top-k search (operator 6): aggregation without random access.

Vectors lie in blocks.  In a block there is one list for each component, sorted
by that component.  For a query each list is read from its better end (the
sign of the query's component says which), so contributions come in falling
order.  After reading all lists down to some depth, a vector's score is at
least what has been seen plus the worst the unread lists can hold, and at most
what has been seen plus what stands at the reading points.  Vectors whose upper
bound lies below the k-th best lower bound can't qualify and are dropped;
reading stops when nothing else can, and the scores of those left are resolved.
The k-th best score of earlier blocks of a task is a lower bound from the
start.

Equal vectors are merged first (only the ``k + 1`` smallest ids of equal
vectors can appear), and so are equal queries, unless their id has several
vectors: none of these may appear, so such a query is searched by itself and
passes over the rows of its id.  The query set grows with the
table, so it is taken in chunks of ``QUERIES`` vectors; each chunk goes to all
tasks and meets all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusforge.llm.common import staged

BLOCK = 4096
QUERIES = 4096
DEPTHS = (1 / 2, 3 / 4, 7 / 8)  # of a block: where reading pauses and bounds are compared
RESOLVED = 64  # so few vectors left are resolved without reading on
TOGETHER = 512  # queries whose bounds are held at a time


class Block:
    """Vectors of one length with their sorted lists."""

    def __init__(self, vectors: np.ndarray, ids: list[np.ndarray]):
        self.vectors, self.ids = vectors, ids
        self.least, self.sole = np.array([i[0] for i in ids], np.int64), np.array([len(i) == 1 for i in ids], bool)
        n = len(vectors)
        order = np.argsort(vectors, axis=0, kind="stable")
        self.lists = np.take_along_axis(vectors, order, axis=0)  # ascending
        self.place = np.empty_like(order, dtype=np.int32)
        np.put_along_axis(self.place, order, np.arange(n, dtype=np.int32)[:, None], axis=0)

    def _read(self, depth: int) -> np.ndarray:
        """What has been seen of each vector after reading ``depth`` entries from
        the upper ends and from the lower ends, and which are unread."""
        up, down = self.place >= len(self.place) - depth, self.place < depth
        return np.hstack((self.vectors * up, self.vectors * down, ~up, ~down)).astype(np.float64)

    def search(
        self, queries: np.ndarray, k: int, floors: np.ndarray, owns: list[int | None]
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the rows (and scores) that may be among its ``k`` best:
        every row that scores at least its k-th best, and at least its floor.
        Rows that have no id but the query's own (null for none) are passed over."""
        n = len(self.vectors)
        up, down = np.maximum(queries, 0.0), np.minimum(queries, 0.0)
        floors = floors.copy()
        alive = np.ones((n, len(queries)), bool)
        for j, own in enumerate(owns):
            if own is not None:
                alive[:, j] = ~self.sole | (self.least != own)
        others = alive.copy()
        open_ = np.arange(len(queries))  # queries that read on
        for part in DEPTHS:
            depth = int(part * n)
            if not depth or not len(open_):
                break
            seen = self._read(depth)
            u, d = up[open_], down[open_]
            if n > k:
                lower = seen @ np.hstack((u, d, u * self.lists[0], d * self.lists[-1])).T
                lower[~others[:, open_]] = -np.inf
                floors[open_] = np.maximum(floors[open_], np.partition(lower, n - k, axis=0)[n - k])
            upper = seen @ np.hstack((u, d, u * self.lists[n - depth], d * self.lists[depth - 1])).T
            alive[:, open_] &= upper >= floors[open_]
            open_ = open_[alive[:, open_].sum(axis=0) > RESOLVED]
        for j, query in enumerate(queries):
            rows = np.flatnonzero(alive[:, j])
            scores = self.vectors[rows] @ query
            keep = scores >= floors[j]
            yield rows[keep], scores[keep]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _search_rows(keys: list[int], queries: list[np.ndarray], owns: list[int | None], k: int):
    """For each query the ``k`` best (vec_id, score) of a task's vectors, those
    of its own id (null for none) left out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        held: dict[int, list] = {}  # rows that wait for a whole block, by length

        def block(dims: int, rows_: list) -> None:
            b = Block(np.array([v for v, _ in rows_], np.float64).reshape(len(rows_), dims), [i for _, i in rows_])
            mine = [j for j, q in enumerate(queries) if len(q) == dims]
            for lo in range(0, len(mine), TOGETHER):
                part = mine[lo : lo + TOGETHER]
                tops = [best.get(keys[j], (np.zeros(0), np.zeros(0, np.int64))) for j in part]
                floors = np.array([scores[-1] if len(scores) == k else -np.inf for scores, _ in tops])
                hits = b.search(np.array([queries[j] for j in part]), k, floors, [owns[j] for j in part])
                for j, (scores, ids), (row, score) in zip(part, tops, hits, strict=True):
                    ids = np.concatenate([ids, *[b.ids[r] for r in row]])
                    scores = np.concatenate([scores, np.repeat(score, [len(b.ids[r]) for r in row])])
                    if owns[j] is not None:
                        ids, scores = ids[ids != owns[j]], scores[ids != owns[j]]
                    top = _best(scores, ids, k)
                    best[keys[j]] = scores[top], ids[top]

        for batch in batches:
            for vector, ids in zip(batch.column("vector"), batch.column("ids"), strict=True):
                v = vector.values.to_numpy(zero_copy_only=False)
                mine = held.setdefault(len(v), [])
                mine.append((v, np.sort(ids.values.to_numpy(zero_copy_only=False))))
                if len(mine) == BLOCK:
                    block(len(v), held.pop(len(v)))
        for dims, rows_ in held.items():
            block(dims, rows_)
        for key, (scores, ids) in best.items():
            yield pa.RecordBatch.from_pydict({
                "query": pa.array([key] * len(ids), pa.int64()), "vec_id": pa.array(ids, pa.int64()),
                "score": pa.array(scores.astype(np.int64)),
            })

    return rows


def quantized(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, vector) with floor(scale * x) components; rows whose vector is
    null or holds a null or non-finite component are left out."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter("vec_id is not null and embedding is not null").filter(whole).select(
        F.col("vec_id").cast("long"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("vector")
    )


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``vectors`` (vec_id,
    vector) for which ``is_query`` holds, the ``k`` rows of greatest inner
    product among the others (all, if fewer), ties to the smaller vec_id.

    Components should be integers (scores are returned as such).  Vectors of
    another length than the query's are no candidates.  Rows that share a vec_id
    are one row if they are equal, else rows of their own, none of which is a
    candidate of the others; if several of them ask, the ``k`` best of all their
    pairs are returned under the one query_id.  Other columns are ignored; an empty table gives
    no rows.
    """
    rows = vectors.select("vec_id", "vector", is_query.alias("is_query")).dropDuplicates()
    first = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    least = rows.select("vec_id", "vector").withColumn("n", first).filter(F.col("n") <= k + 1)
    merged = staged(least.groupBy("vector").agg(F.collect_list("vec_id").alias("ids")), "vectors")
    several = rows.groupBy("vec_id").count().filter("count > 1").select("vec_id", F.col("vec_id").alias("own"))
    asked = rows.filter("is_query").select("vec_id", "vector").join(several, "vec_id", "left")
    # a key for each query: an id is none, since it may have several vectors
    queries = staged(asked.select("vector", "own").distinct().withColumn("query", F.monotonically_increasing_id()), "query-vectors")
    found, schema = None, "query long, vec_id long, score long"
    n = queries.count()
    chunks = max(1, -(-n // QUERIES))
    for c in range(chunks):
        mine = queries.filter(F.pmod(F.xxhash64("query"), F.lit(chunks)) == c).sort("query").collect()  # a chunk
        search_rows = _search_rows([r["query"] for r in mine], [np.array(r["vector"]) for r in mine], [r["own"] for r in mine], k + 1)
        hits = merged.mapInArrow(search_rows, schema)
        top = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
        hits = hits.withColumn("n", top).filter(F.col("n") <= k + 1).drop("n")
        hits = staged(hits, "hits") if chunks > 1 else hits
        found = hits if found is None else found.unionByName(hits)
    same = (F.col("a.vector") == F.col("q.vector")) & F.col("a.own").eqNullSafe(F.col("q.own"))
    named = asked.alias("a").join(queries.alias("q"), same).select(F.col("a.vec_id").alias("query_id"), "q.query")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        named.join(found, "query").filter("vec_id != query_id")
        .withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
