"""Exact-substring dedup (operator 2): depth-limited radix sort of suffixes.

Every suffix of at least ``depth`` bytes is a key of ``depth`` bytes; two equal
keys are a repeated window.  The keys are never sorted to the end and never
written out one by one.  Most-significant-digit passes split them, and a
bucket with one key is finished and dropped:

* **Digit 1** of a key is its least ``gram``-byte string (by hash, the leftmost
  of equals).  It depends on the key alone, so equal keys share it; and
  neighbouring suffixes share the same occurrence of it, so a *run* of up to
  ``depth - gram + 1`` suffixes (a start and a count) is one row.
* **Digit 2** is the run's whole text.  Runs equal in it hold pairwise equal
  keys: all but the earliest are repeats, as intervals.  The earliest run goes
  on only if its digit-1 bucket has a run of another text.
* **Digit 3** serves the runs that go on, cut at every eighth place as counted
  from digit 1: the ``depth - 7`` bytes that all keys of such a cell share.
  Again equal cells are repeats of the earliest, and a cell goes on only if a
  cell of another text shares the digit.
* **Digit 4** is the rest of the key (up to seven bytes on either side, carried
  with the cell), for the suffixes of those cells alone.  Equal groups are
  exactly the repeated windows; all but the earliest are repeats.

Digits travel as 64-bit fingerprints (128 bits together in either pass).
Skew: equal rows of an Arrow batch are merged before the shuffle (the later
ones become finished intervals at once), and a digit-1 bucket with many texts
in a batch is dealt by both digits, with one marker row left in the bucket.
A bucket therefore gets a bounded number of rows from each batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusforge.llm.common import GOLDEN, mix64, release, splitmix, staged, texts_of

SEGMENT = 1 << 20  # bytes hashed at a time; longer texts go in overlapping segments
CROWD = 16  # texts of one digit-1 bucket in a batch from which the bucket is dealt by both digits
RUN, CROWDED, MARKER, REPEAT = 0, 1, 2, 3
_NO_DOC = -(1 << 63)


class _Hasher:
    """Polynomial hashes modulo 2^64 over random byte values."""

    def __init__(self, size: int, seed: int):
        self.values = splitmix(256, seed)
        base = np.uint64(0xD6E8FEB86659FD93 + 2 * seed)
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.full(size, base, np.uint64))
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            self.inverse = np.cumprod(np.full(size, inverse, np.uint64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.power[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.inverse[start]


def _pieces(offsets: np.ndarray, depth: int) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """Segments (from, to, [(text, piece start, piece end)]) of whole texts, or
    of one part of a long text; parts overlap by ``depth - 1`` bytes."""
    lo, part = 0, []
    for i in range(len(offsets) - 1):
        s, e = int(offsets[i]), int(offsets[i + 1])
        if e - s < depth:
            continue
        if part and e - lo > SEGMENT:
            yield lo, part[-1][2], part
            part = []
        while e - s > SEGMENT:
            yield s, s + SEGMENT, [(i, s, s + SEGMENT)]
            s += SEGMENT - depth + 1
        if e - s >= depth:
            if not part:
                lo = s
            part.append((i, s, e))
    if part:
        yield lo, part[-1][2], part


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def runs_of(data: np.ndarray, offsets: np.ndarray, depth: int, gram: int, hasher: _Hasher) -> dict[str, np.ndarray]:
    """The runs of all texts: text index, start, place of digit 1 from the
    start on, count, digits 1 and 2."""
    found: list[tuple[np.ndarray, ...]] = []
    for lo, hi, part in _pieces(offsets, depth):
        text = data[lo:hi]
        sums = hasher.sums(text)
        at = np.arange(len(text) - gram + 1)
        digit = mix64((sums[gram:] - sums[: len(text) - gram + 1]) * hasher.inverse[: len(at)])
        least = _sliding_min((digit & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), depth - gram + 1)
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        valid = np.zeros(len(place), bool)
        for _, s, e in part:
            valid[s - lo : e - lo - depth + 1] = True
        change = place[1:] != place[:-1]
        first = np.flatnonzero(valid & np.concatenate(([True], change | ~valid[:-1])))
        last = np.flatnonzero(valid & np.concatenate((change | ~valid[1:], [True])))
        count = last - first + 1
        key1 = digit[place[first]]
        key2 = mix64(hasher.of(sums, first, last + depth) + count.astype(np.uint64) * np.uint64(GOLDEN))
        starts = np.array([s - lo for _, s, _ in part])
        which = np.searchsorted(starts, first, side="right") - 1
        index = np.array([i for i, _, _ in part])[which]
        found.append((index, first + lo - offsets[index], place[first] - first, count, key1, key2))
    names = ("text", "start", "offset", "count", "key1", "key2")
    if not found:
        return {n: np.zeros(0, np.uint64 if n.startswith("key") else np.int64) for n in names}
    return {n: np.concatenate([f[k] for f in found]) for k, n in enumerate(names)}


def _earliest(key: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of equal ``key``: (sorting of the rows, whether each is the
    earliest of its group, in that sorting)."""
    by = np.argsort(key, kind="stable")
    k = key[by]
    begins = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    size = np.diff(np.append(begins, len(k)))
    least = np.repeat(np.minimum.reduceat(order[by], begins), size)
    return by, order[by] == least


def _order(doc: np.ndarray, text: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rank of (doc, start); equal for equal pairs."""
    rank = np.unique(doc, return_inverse=True)[1]
    return (rank[text].astype(np.int64) << 40) | start


def _place(start: np.ndarray, offset: np.ndarray, count: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """One long: start (32 bits), offset (7), count (7), tag of the text (17);
    sorts by start."""
    return (start.astype(np.int64) << 31) | (offset.astype(np.int64) << 24) | (count.astype(np.int64) << 17) | tag.astype(np.int64)


def _spread(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Buckets for rows that are finished and need no others."""
    return mix64(doc.astype(np.uint64) * np.uint64(GOLDEN) + start.astype(np.uint64))


def _crowds(key1: np.ndarray, key2: np.ndarray, early: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, bucket, buckets that need a marker) of rows merged in a batch."""
    kind = np.where(early, RUN, REPEAT).astype(np.int8)
    own = np.flatnonzero(early)
    names, inverse, size = np.unique(key1[own], return_inverse=True, return_counts=True)
    crowd = size >= CROWD
    kind[own[crowd[inverse]]] = CROWDED
    bucket = np.where(kind == CROWDED, mix64(key1 ^ (key2 * np.uint64(GOLDEN))), key1)
    return kind, np.where(kind == REPEAT, spread, bucket), names[crowd]


def _batch(bucket: np.ndarray, marked: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """The rows, and one marker row for each bucket of ``marked``."""
    n = len(marked)
    out = {"bucket": np.concatenate((bucket, marked)).view(np.int64)}
    for name, x in columns.items():
        x = x.view(np.int64) if x.dtype == np.uint64 else x
        out[name] = np.concatenate((x, np.full(n, MARKER if name == "kind" else 0, x.dtype)))
    return pa.RecordBatch.from_pydict(out)


def _run_rows(depth: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher(SEGMENT + depth, 1)
        np.seterr(over="ignore")
        for batch in batches:
            data, offsets = texts_of(batch.column("text"))
            doc = batch.column("doc").to_numpy(zero_copy_only=False)
            tag = batch.column("tag").to_numpy(zero_copy_only=False)
            r = runs_of(data, offsets, depth, gram, hasher)
            if not len(r["start"]):
                continue
            by, early = _earliest(mix64(r["key1"]) ^ r["key2"], _order(doc, r["text"], r["start"]))
            text, start, offset, count, key1, key2 = (r[n][by] for n in ("text", "start", "offset", "count", "key1", "key2"))
            kind, bucket, marked = _crowds(key1, key2, early, _spread(doc[text], start))
            yield _batch(bucket, marked, key2=key2, doc=doc[text], place=_place(start, offset, count, tag[text]), kind=kind)

    return rows


def _bytes(body: np.ndarray, at: np.ndarray, step: int, keep: np.ndarray) -> np.ndarray:
    """Up to seven bytes from ``at`` on in steps of ``step``, in one long each,
    the nearest lowest; only the first ``keep`` of them count."""
    out = np.zeros(len(at), np.uint64)
    for i in range(7):
        byte = body[np.clip(at + i * step, 0, len(body) - 1)].astype(np.uint64)
        out |= np.where(i < keep, byte, np.uint64(0)) << np.uint64(8 * i)
    return out


def _cell_rows(depth: int):
    """Cells of the runs that go on: the bytes their keys share, and the rest."""
    core = depth - 7

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h1, h2 = _Hasher(SEGMENT + depth, 2), _Hasher(SEGMENT + depth, 3)
        np.seterr(over="ignore")
        for batch in batches:
            data, offsets = texts_of(batch.column("text"))
            doc = batch.column("doc").to_numpy(zero_copy_only=False)
            tag = batch.column("tag").to_numpy(zero_copy_only=False)
            places = batch.column("places")
            ends = np.asarray(places.offsets) - places.offsets[0].as_py()
            place = places.flatten().to_numpy(zero_copy_only=False)
            got = []
            for i in range(len(doc)):
                mine = place[ends[i] : ends[i + 1]]
                start, offset, count = mine >> 31, (mine >> 24) & 127, (mine >> 17) & 127
                anchor, most, least = start + offset, offset, offset - count + 1
                cells = most // 8 - least // 8 + 1
                run = np.repeat(np.arange(len(mine)), cells)
                cell = least[run] // 8 + np.arange(len(run)) - np.repeat(np.cumsum(cells) - cells, cells)
                base = anchor[run] - 8 * cell
                high = np.minimum(most[run] - 8 * cell, 7)
                low = np.maximum(least[run] - 8 * cell, 0)
                body = data[offsets[i] : offsets[i + 1]]
                k1, k2 = np.zeros(len(base), np.uint64), np.zeros(len(base), np.uint64)
                for lo in range(0, len(body), SEGMENT - core + 1):
                    here = np.flatnonzero((base >= lo) & (base < lo + SEGMENT - core + 1))
                    if len(here):
                        part = body[lo : lo + SEGMENT]
                        s1, s2, at = h1.sums(part), h2.sums(part), base[here] - lo
                        k1[here], k2[here] = h1.of(s1, at, at + core), h2.of(s2, at, at + core)
                got.append((np.full(len(base), i), base - high, high, low, k1, k2, _bytes(body, base - 1, -1, high), _bytes(body, base + core, 1, 7 - low)))
            if not got:
                continue
            text, start, high, low, k1, k2, left, right = (np.concatenate(x) for x in zip(*got, strict=True))
            core1, core2 = mix64(k1), mix64(k2)
            key2 = mix64(core2 ^ mix64(left ^ mix64(right ^ mix64((8 * high + low + 1).astype(np.uint64)))))
            by, early = _earliest(mix64(core1) ^ key2, _order(doc, text, start))
            text, start, high, low, core1, core2, key2, left, right = (x[by] for x in (text, start, high, low, core1, core2, key2, left, right))
            kind, bucket, marked = _crowds(core1, key2, early, _spread(doc[text], start))
            place = _place(start, high, high - low + 1, tag[text])
            yield _batch(bucket, marked, key2=key2, doc=doc[text], place=place, kind=kind, core1=core1, core2=core2, left=left, right=right)

    return rows


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes of the cells that go on, by their whole key; cells that are
    repeats pass through."""
    np.seterr(over="ignore")
    for batch in batches:
        columns = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("doc", "place", "core1", "core2", "left", "right", "repeat")}
        over = columns.pop("repeat").astype(bool)
        doc, place = columns["doc"][over], columns["place"][over]
        if len(doc):
            bucket = _spread(doc, place)
            yield _batch(bucket, bucket[:0], key2=np.zeros(len(doc), np.int64), doc=doc, place=place, kind=np.full(len(doc), REPEAT, np.int8))
        if over.all():
            continue
        columns = {n: x[~over] for n, x in columns.items()}
        doc, place = columns["doc"], columns["place"]
        core1, core2, left, right = (columns[n].view(np.uint64) for n in ("core1", "core2", "left", "right"))
        start, high, count = place >> 31, (place >> 24) & 127, (place >> 17) & 127
        got = []
        for t in range(8):
            here = np.flatnonzero((t <= high) & (t > high - count))
            low = [np.uint64((1 << 8 * n) - 1) for n in (t, 7 - t)]
            rest = mix64((left[here] & low[0]) ^ mix64((right[here] & low[1]) ^ np.uint64(mix64(np.array([t + 1], np.uint64))[0])))
            got.append((here, start[here] + high[here] - t, mix64(core1[here] ^ rest), mix64(core2[here] + rest)))
        row, start, bucket, key2 = (np.concatenate(x) for x in zip(*got, strict=True))
        by, early = _earliest(mix64(bucket) ^ key2, _order(doc, row, start))
        row, start, bucket, key2 = row[by], start[by], bucket[by], key2[by]
        one = np.ones(len(row), np.int64)
        bucket = np.where(early, bucket, _spread(doc[row], start))
        yield _batch(bucket, bucket[:0], key2=key2, doc=doc[row], place=_place(start, 0 * one, one, place[row] & _TAGS), kind=np.where(early, RUN, REPEAT).astype(np.int8))


_TAGS = (1 << 17) - 1
_ROWS = "bucket long, key2 long, doc long, place long, kind byte"
_CELLS = ", core1 long, core2 long, left long, right long"


def _digest_rows(depth: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch.column("text"))
            places = batch.column("places").fill_null([])
            out: dict[str, list] = {"n_removed": [], "n_spans": [], "kept": []}
            for i, row in enumerate(places):
                body = data[offsets[i] : offsets[i + 1]]
                removed = spans = 0
                mine = np.sort(row.values.to_numpy(zero_copy_only=False)) if len(row) else np.zeros(0, np.int64)
                kept = []
                if len(mine):
                    start = mine >> 31
                    end = np.maximum.accumulate(start + ((mine >> 17) & 127) - 1 + depth)
                    new = np.concatenate(([True], start[1:] > end[:-1]))
                    lo, hi = start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]
                    removed, spans = int((hi - lo).sum()), len(lo)
                    for a, b in zip(np.append(0, hi), np.append(lo, len(body)), strict=True):
                        if b > a:
                            kept.append(body[a:b].tobytes())
                else:
                    kept.append(body.tobytes())
                out["n_removed"].append(removed)
                out["n_spans"].append(spans)
                out["kept"].append(b"".join(kept))
            columns = {"doc_id": batch.column("doc_id"), "n_bytes": pa.array(np.diff(offsets))}
            yield pa.RecordBatch.from_pydict(columns | {
                "n_removed": pa.array(out["n_removed"], pa.int64()),
                "n_spans": pa.array(out["n_spans"], pa.int64()),
                "kept_sha256": [hashlib.sha256(x).hexdigest() for x in out["kept"]],
            })

    return rows


def _start() -> Column:
    return F.struct("doc", F.shiftright("place", 31).alias("start"))


def _tag() -> Column:
    return F.col("place").bitwiseAND(F.lit(_TAGS)).alias("tag")


def _sift(rows: DataFrame) -> DataFrame:
    """One pass: the rows that are repeats, and those that go on (``repeat``
    says which).  Either window deals the rows by ``bucket``."""
    bucket, group = Window.partitionBy("bucket"), Window.partitionBy("bucket", "key2")
    return (
        rows.withColumn("n", F.count("*").over(bucket))
        .withColumn("mixed", (F.min("key2").over(bucket) != F.max("key2").over(bucket)) | (F.col("kind") == CROWDED))
        .filter((F.col("n") > 1) | (F.col("kind") != RUN))
        .filter(F.col("kind") != MARKER)
        .withColumn("first", F.min(_start()).over(group))
        .withColumn("repeat", (F.col("kind") == REPEAT) | (_start() > F.col("first")))
        .filter(F.col("repeat") | F.col("mixed"))
        .drop("bucket", "key2", "kind", "n", "mixed", "first")
    )


def repeated_places(texts: DataFrame, depth: int, gram: int) -> DataFrame:
    """(doc, place) of every repeat, as runs of suffixes; ``texts`` has
    doc, tag, text."""
    runs = staged(_sift(texts.mapInArrow(_run_rows(depth, gram), _ROWS)), "suffix-runs")
    release(texts.sparkSession)
    on = runs.filter(~F.col("repeat")).groupBy("doc", _tag()).agg(F.collect_list("place").alias("places"))
    cells = _sift(texts.join(on.hint("shuffle_hash"), ["doc", "tag"]).mapInArrow(_cell_rows(depth), _ROWS + _CELLS))
    keys = cells.mapInArrow(_key_rows, _ROWS)
    late = (
        keys.withColumn("first", F.min(_start()).over(Window.partitionBy("bucket", "key2")))
        .filter((F.col("kind") == REPEAT) | (_start() > F.col("first")))
    )
    return runs.filter("repeat").select("doc", "place").unionByName(late.select("doc", "place"))


def dedup_substrings(docs: DataFrame, depth: int = 100, gram: int = 24) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_bytes, n_removed, n_spans,
    kept_sha256, after removing every byte covered by a ``depth``-byte string
    that also starts earlier (smaller doc_id, or earlier in the same document).

    A null text is empty; a null doc_id counts as the smallest.  Rows that share
    a doc_id are one place in the order: equal strings at the same start of such
    rows are no repeat of each other.  Other columns are ignored.  An empty
    table gives no rows.
    """
    if not 7 < gram < depth < gram + 127:
        raise ValueError("gram must be over 7, depth from gram + 1 to gram + 126")
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_DOC)).alias("doc"),
        F.xxhash64("text").bitwiseAND(F.lit(_TAGS)).alias("tag"),  # never null, so that both joins share one exchange
        F.coalesce("text", F.lit("")).alias("text"),
    )
    places = repeated_places(texts, depth, gram).groupBy("doc", _tag()).agg(F.collect_list("place").alias("places"))
    return (
        texts.join(places.hint("shuffle_hash"), ["doc", "tag"], "left")
        .select(F.nullif("doc", F.lit(_NO_DOC)).alias("doc_id"), "text", "places")
        .mapInArrow(_digest_rows(depth), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )
