"""Benchmark decontamination (operator 9): greedy string tiling with running
Karp-Rabin matching.

* Texts become lower-case words.  White space and punctuation of all scripts
  separate them; a character of a script that is written without spaces, and a
  symbol beyond ASCII, is a word of its own.
* **Seeds**: the Karp-Rabin hash of every ``tile`` (5) words of a document is
  looked up among those of the benchmark items; equal words confirm it.
* **Tiling** of each document and item that share a seed: of the matches made
  of neighbouring seeds, the longest are marked, then the longest of what is
  still unmarked on either side, and so on down to ``tile`` words.  No word of
  the item counts twice and the order of the tiles doesn't matter, so shuffled
  passages are caught.  An item of fewer words has one tile: all of it.
* A document is contaminated by an item when the tiles cover at least
  ``coverage`` of the item's words.

The items are taken in blocks of at most ``BLOCK`` words.  A block's index goes
to every task, so that the documents stay where they are; more items mean more
passes over the documents, not a larger index.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import mix64, splitmix, staged

TILE = 5
COVERAGE = 0.6
BLOCK = 1_000_000
#: Blocks of scripts written without spaces (first and last code point).
UNSPACED = (
    (0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x2FDF),
    (0x3000, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F), (0x12000, 0x1345F), (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF),
)


class _Written(dict):
    """What stands for a character (by code point) before the text is split."""

    def __missing__(self, c: int) -> str:
        x = chr(c)
        kind = unicodedata.category(x)
        if c < 128:
            out = x if x.isalnum() else " "
        elif kind[0] in "ZP" or kind == "Cc" or c in (0x200B, 0xFEFF):  # the last two: spaces without width
            out = " "
        elif kind[0] == "S" or any(a <= c <= b for a, b in UNSPACED):
            out = f" {x} "
        else:
            out = x
        self[c] = out
        return out


_WRITTEN = _Written()


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().translate(_WRITTEN).split()


class Index:
    """Seeds of a block of items."""

    def __init__(self, items: list[tuple[int | None, list[str]]], tile: int):
        self.ids = [i for i, _ in items]
        self.number: dict[str, int] = {}
        self.words = [np.array([self.number.setdefault(w, len(self.number) + 1) for w in ws], np.int64) for _, ws in items]
        self.values = splitmix(len(self.number) + 1, 9)
        self.tile = [min(tile, len(ws)) for ws in self.words]  # of each item
        self.flat = np.concatenate([*self.words, np.zeros(0, np.int64)])
        self.begin = np.cumsum([0, *[len(ws) for ws in self.words]])
        self.seeds = [self._seeds(n, 22 if n == tile else 16) for n in sorted({*self.tile} - {0})]

    def _seeds(self, tile: int, bits: int) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the items with tiles of ``tile`` words: (tile, bits, sieve of the
        upper bits, sorted seeds, their items, their places)."""
        mine = [k for k, n in enumerate(self.tile) if n == tile]
        size = [len(self.words[k]) - tile + 1 for k in mine]
        seeds = np.concatenate([self.hashes(self.words[k], tile) for k in mine])
        item, at = np.repeat(mine, size), np.concatenate([np.arange(n) for n in size])
        by = np.argsort(seeds, kind="stable")
        sieve = np.zeros(1 << bits, bool)
        sieve[seeds >> np.uint64(64 - bits)] = True
        return tile, bits, sieve, seeds[by], item[by], at[by]

    def hashes(self, words: np.ndarray, tile: int) -> np.ndarray:
        """Karp-Rabin hash of every ``tile`` neighbouring words."""
        v, n = self.values[words], len(words) - tile + 1
        h = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(tile):
                h = h * np.uint64(0x9E3779B97F4A7C15) + v[k : n + k]
            return mix64(h)

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``words``, item, place in the item) of all shared seeds;
        0 is a word that no item has."""
        out = [(np.zeros(0, np.int64),) * 3]
        for tile, bits, sieve, seeds, items, places in self.seeds:
            if len(words) < tile:
                continue
            h = self.hashes(words, tile)
            place = np.flatnonzero(sieve[h >> np.uint64(64 - bits)])
            lo = np.searchsorted(seeds, h[place], "left")
            n = np.searchsorted(seeds, h[place], "right") - lo
            place, k = np.repeat(place, n), np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            item, at = items[k], places[k]
            same = np.ones(len(place), bool)
            for k in range(tile):
                same &= words[place + k] == self.flat[self.begin[item] + at + k]
            out.append((place[same], item[same], at[same]))
        place, item, at = (np.concatenate(x) for x in zip(*out, strict=True))
        return place, item, at


def tiles(place: np.ndarray, at: np.ndarray, tile: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from the shared seeds of a document (``place``) and
    an item (``at``): (place, at, words), longest first."""
    by = np.lexsort((place, place - at))
    place, at = place[by], at[by]
    marked_d: set[int] = set()
    marked_i: set[int] = set()
    out = []
    while len(place):
        joined = (place[1:] == place[:-1] + 1) & (at[1:] == at[:-1] + 1)
        first = np.flatnonzero(np.concatenate(([True], ~joined)))
        size = np.diff(np.append(first, len(place))) + tile - 1
        longest = int(size.max())
        for k in first[size == longest]:
            p, a = int(place[k]), int(at[k])
            d, i = range(p, p + longest), range(a, a + longest)
            if marked_d.isdisjoint(d) and marked_i.isdisjoint(i):
                marked_d.update(d)
                marked_i.update(i)
                out.append((p, a, longest))
        taken_d, taken_i = np.fromiter(marked_d, np.int64), np.fromiter(marked_i, np.int64)
        free = np.ones(len(place), bool)
        for k in range(tile):
            free &= ~np.isin(place + k, taken_d) & ~np.isin(at + k, taken_i)
        place, at = place[free], at[free]
    return out


def _tiled(index: Index, coverage: float, texts: list[str | None]) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, words covered, tiles) of every contaminated text."""
    lists = [words_of(t) for t in texts]
    size = np.array([len(x) + 1 for x in lists], np.int64)
    words = np.zeros(int(size.sum()), np.int64)  # a 0 between texts
    begin = np.cumsum(size) - size
    number = index.number.get
    for b, x in zip(begin, lists, strict=True):
        words[b : b + len(x)] = [number(w, 0) for w in x]
    place, item, at = index.hits(words)
    text = np.searchsorted(begin, place, side="right") - 1
    if not len(text):
        return
    by = np.lexsort((item, text))
    text, item, place, at = text[by], item[by], place[by], at[by]
    first = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (item[1:] != item[:-1]))))
    for lo, hi in zip(first, [*first[1:], len(text)], strict=True):
        found = tiles(place[lo:hi], at[lo:hi], index.tile[item[lo]])
        covered = sum(n for _, _, n in found)
        if covered >= coverage * len(index.words[item[lo]]):
            yield int(text[lo]), int(item[lo]), covered, len(found)


def _pair_rows(index: Index, coverage: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_tiled(index, coverage, batch.column("text").to_pylist()))
            if found:
                text, item, covered, count = (list(x) for x in zip(*found, strict=True))
                words = [len(index.words[i]) for i in item]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").take(pa.array(text)),
                    "item_id": pa.array([index.ids[i] for i in item], pa.int64()),
                    "item_words": pa.array(words, pa.int32()),
                    "covered_words": pa.array(covered, pa.int32()),
                    "tiles": pa.array(count, pa.int32()),
                    "coverage": pa.array([c / w for c, w in zip(covered, words, strict=True)], pa.float64()),
                })

    return rows


def _clean_rows(index: Index, coverage: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = {f[0] for f in _tiled(index, coverage, batch.column("text").to_pylist())}
            yield batch.filter(pa.array([i not in hit for i in range(batch.num_rows)], pa.bool_()))

    return rows


def _blocks(items: DataFrame, tile: int) -> Iterator[Index]:
    block, size = [], 0
    for r in items.select(F.col("item_id").cast("long"), "text").toLocalIterator(prefetchPartitions=False):
        words = words_of(r[1])
        if size + len(words) > BLOCK and block:
            yield Index(block, tile)
            block, size = [], 0
        block.append((r[0], words))
        size += len(words)
    if block:
        yield Index(block, tile)


def contaminated(docs: DataFrame, items: DataFrame, tile: int = TILE, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, item_words, covered_words, tiles, coverage) of every
    document (doc_id, text) that holds at least ``coverage`` of an item
    (item_id, text).

    Null and empty texts match nothing; an item of fewer than ``tile`` words
    matches where all of it stands.  Null ids are returned as
    they are; repeated documents or items give repeated rows.  Other columns
    are ignored; without documents or items there are no rows.
    """
    schema = "doc_id long, item_id long, item_words int, covered_words int, tiles int, coverage double"
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    out = None
    for index in _blocks(items, tile):
        if out is not None:  # earlier blocks are done before the next is held
            out = staged(out, "tiles")
        found = texts.mapInArrow(_pair_rows(index, coverage), schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, items: DataFrame, tile: int = TILE, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all columns."""
    out, blocks = docs, 0
    for index in _blocks(items, tile):
        if blocks:
            out = staged(out, "clean")
        out, blocks = out.mapInArrow(_clean_rows(index, coverage), docs.schema), blocks + 1
    return out
