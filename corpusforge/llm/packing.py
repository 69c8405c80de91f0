"""Best-fit packing (operator 4) with large-item matching.

Items of one length are interchangeable, so the packing is decided on the
number of items of each length (at most ``capacity`` numbers, whatever the
input) and then dealt out to the items by their rank within their length.

* Items of over a third of the capacity ("large") fit at most twice into a bin:
  from the longest down, each is matched with the longest other large item that
  still fits.
* The rest, from the longest down, go into the bin with the least gap that
  still takes them; a new bin is opened when none does.

Ranks come from counts of (length, salt) and their running sums, so a length
that a third of all items share is numbered by many tasks.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusforge.llm.common import staged, texts_of, worker_cache

CAPACITY = 2048
CACHED_WORDS = 500_000  # (about 90 MB) words whose ids a worker keeps; it starts afresh beyond that
SALTS = 4096
SLICE = 8 << 20  # bytes of text whose words are held at a time
TOGETHER = 256  # words of letters that are encoded as one text

#: Letters, single digits and runs of other signs are encoded apart, in lower case.
_SPLIT = {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}
#: Where such a word ends for sure: ASCII signs after a letter or digit (ASCII or Latin-1).
_END = re.compile(rb"(?:(?<=[a-z0-9])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))(?=[!-/:-@\[-`{-~])")


class _Encoder:
    """Ids of words, kept for the words to come."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(tokenizer)
        self.known: dict[bytes, bytes] = {}
        parts = json.loads(self.encoder.to_str())
        normalizer = parts["normalizer"] or {}
        types = [n["type"] for n in normalizer.get("normalizers", [normalizer]) if n]
        before = parts["pre_tokenizer"] or {}
        split = before.get("pretokenizers", [before])[0]
        #: The words of the split above, told apart by their last ids' suffix; other tokenizers get whole chunks, one by one.
        suffix = parts["model"].get("end_of_word_suffix")
        self.words = "Lowercase" in types and split.get("pattern") == _SPLIT and split.get("invert") is True and bool(suffix)
        if self.words:
            self.added = [t["content"].lower().encode() for t in parts["added_tokens"]]  # found before all else
            vocabulary = self.encoder.get_vocab()
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for w, i in vocabulary.items() if w.endswith(suffix)]] = True

    def encode(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        codes = self.encoder.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return ((w, np.array(c.ids, "<u4").tobytes()) for w, c in zip(words, codes, strict=True))

    def split(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        """The words of each chunk, with spaces between them."""
        lines = b"\n".join(chunks)
        return dict(zip(chunks, (_END.sub(b" ", lines) if self.words else lines).split(b"\n"), strict=True)) if chunks else {}

    def learn(self, words: set[bytes]) -> bool:
        """False if all words were forgotten instead, as there would be too many."""
        new = words.difference(self.known)
        if self.known and len(self.known) + len(new) > CACHED_WORDS:
            self.known.clear()
            return False
        letters = [w for w in new if w.decode().isalpha()] if self.words else []
        rest = list(new.difference(letters))
        groups = [letters[k : k + TOGETHER] for k in range(0, len(letters), TOGETHER)]
        for k in range(0, len(groups), TOGETHER):
            some = groups[k : k + TOGETHER]
            codes = self.encoder.encode_batch_fast([b" ".join(g).decode() for g in some], add_special_tokens=False)
            for group, code in zip(some, codes, strict=True):
                ids = np.array(code.ids, "<u4")
                ends = (4 * np.flatnonzero(self.last[ids]) + 4).tolist()
                if len(ends) != len(group):  # a letter whose lower case isn't only letters
                    rest += group
                    continue
                ids = ids.tobytes()
                self.known.update((w, ids[a:b]) for w, a, b in zip(group, [0, *ends], ends))
        for k in range(0, len(rest), TOGETHER * TOGETHER):
            self.known.update(self.encode(rest[k : k + TOGETHER * TOGETHER]))
        return True

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Token ids of each text, as little-endian unsigned 32-bit numbers.

        The tokenizer drops white space and never joins what it separates, so
        ids are looked up by white-space separated chunk, and a chunk's by word."""
        apart: dict[int, bytes] = {}
        if self.words:
            small = [t.lower() for t in texts]
            for k, t in enumerate(small):
                if any(a in t for a in self.added):
                    apart[k], small[k] = b"".join(i for _, i in self.encode(texts[k].split())), b""
                elif b"\xcc" in t or b"\xcd" in t:  # a mark may combine with a small letter and not with its capital
                    small[k] = texts[k]
            texts = small
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        coded = lists.flatten().dictionary_encode()
        chunks = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        new = self.split(list(set(chunks).difference(self.known)))
        if not self.learn(set(b" ".join(new.values()).split())):
            new = self.split(chunks)
            self.learn(set(b" ".join(new.values()).split()))
        known = self.known
        found = [b"".join(map(known.__getitem__, new[c].split())) if c in new else known[c] for c in chunks]
        flat = np.frombuffer(b"".join(found), "<u4")
        sizes = np.array([len(f) // 4 for f in found], np.int64)
        starts = np.cumsum(sizes) - sizes
        index = coded.indices.to_numpy()
        sizes = sizes[index]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = flat[np.repeat(starts[index] - ends[:-1], sizes) + np.arange(ends[-1])]
        bounds = ends[lists.offsets.to_numpy()]
        return [apart[k] if k in apart else ids[a:b].tobytes() for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]


def _ids(tokenizer: str, cache: dict, texts: list[bytes]) -> list[bytes]:
    if tokenizer not in cache:
        cache[tokenizer] = _Encoder(tokenizer)
    return cache[tokenizer].ids(texts)


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SLICE`` bytes together."""
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE, "right")) - 1)
        yield lo, hi
        lo = hi


def _piece_rows(tokenizer: str, capacity: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        for batch in batches:
            data, offsets = texts_of(batch.column("text"))
            row, piece, start, length, crc = [], [], [], [], []
            for lo, hi in _slices(offsets):
                texts = [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(lo, hi)]
                for i, ids in enumerate(_ids(tokenizer, worker_cache(), texts), lo):
                    ids += bytes(4)
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        row.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            })

    return rows


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every row (its ids, then id 0)."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _piece_rows(tokenizer, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Kinds of bins: (number of such bins, [(length, items of it in a bin)])."""
    left = {s: n for s, n in counts.items() if n > 0}
    large = sorted(s for s in left if 3 * s > capacity)
    bins: dict[int, list[list]] = {}  # gap: [[number, items]]
    gaps: list[int] = []

    def put(gap: int, number: int, items: list[tuple[int, int]]) -> None:
        if number:
            if gap not in bins:
                bins[gap] = []
                insort(gaps, gap)
            bins[gap].append([number, items])

    while large:
        s = large[-1]
        k = bisect_left(large, capacity - s + 1) - 1
        if k >= 0 and large[k] == s and left[s] == 1:
            k -= 1
        if k < 0:
            put(capacity - s, left[s], [(s, 1)])
            left[s] = 0
        elif large[k] == s:
            put(capacity - 2 * s, left[s] // 2, [(s, 2)])
            left[s] %= 2
        else:
            t = large[k]
            pairs = min(left[s], left[t])
            put(capacity - s - t, pairs, [(s, 1), (t, 1)])
            left[s] -= pairs
            left[t] -= pairs
            if not left[t]:
                large.remove(t)
        if not left[s]:
            large.remove(s)

    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        n = left[s]
        while n:
            k = bisect_left(gaps, s)
            if k < len(gaps):
                gap = gaps[k]
                number, items = bins[gap].pop()
                if not bins[gap]:
                    del bins[gap], gaps[k]
            else:
                gap, items = capacity, []
                number = -(-n // (capacity // s))
            each = gap // s
            full, rest = divmod(min(n, number * each), each)
            n -= full * each + rest
            put(gap - each * s, full, [*items, (s, each)])
            put(gap - rest * s, 1 if rest else 0, [*items, (s, rest)])
            put(gap, number - full - (1 if rest else 0), items)
    return [(number, items) for kinds in bins.values() for number, items in kinds]


def _slots(kinds: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """Where the items of each length go, by rank: from ``rank`` on, ``each``
    items to a bin, the first bin being ``sequence``, from ``offset`` on."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for number, items in kinds:
        offset = 0
        for s, each in items:
            rank = ranks.get(s, 0)
            rows.append((s, rank, each, sequence, offset))
            ranks[s] = rank + number * each
            offset += s * each
        sequence += number
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {"key": table[:, 0] << 44 | table[:, 1]} | {n: table[:, k] for k, n in enumerate(("length", "rank", "each", "sequence", "offset"))}


def _placed(slots: dict[str, np.ndarray]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            k = np.searchsorted(slots["key"], length << 44 | rank, side="right") - 1
            nth = rank - slots["rank"][k]
            out = {n: batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
            out["sequence_id"] = slots["sequence"][k] + nth // slots["each"][k]
            out["offset"] = slots["offset"][k] + nth % slots["each"][k] * length
            yield pa.RecordBatch.from_pydict(out)

    return rows


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Per piece of every row of ``docs`` (doc_id, text): doc_id, piece, start,
    length, ids_crc32, sequence_id, offset.

    A null or empty text is the single id 0.  A null doc_id and rows that share
    a doc_id are packed like any other.  Other columns are ignored; an empty
    table gives no rows.  Only the counts by length (``capacity`` numbers at
    most) reach the driver.
    """
    items = staged(pieces(docs, tokenizer, capacity), "pieces")
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).alias("salt")
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = _slots(plan(counts, capacity))
    salted = items.withColumn("salt", salt)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
        .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.join(bases, ["length", "salt"])
        .withColumn("rank", F.col("base") + F.row_number().over(within) - 1)
        .select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    )
    return ranked.mapInArrow(
        _placed(slots), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
