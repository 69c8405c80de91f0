"""Spelling variants (operator 12): the minimised acceptor of the vocabulary,
composed with a one-edit transducer and the acceptor again.

Two words with one edit between them agree on everything but the segment in
which they first differ.  Words are therefore filed by the two halves of the
shorter word's positions: words with equal text outside the half ``[lo, hi)``
are the composition's paths from one initial state, and a file is enumerated on
its own.  A file of more than ``LIMIT`` words is filed again by half segments,
until a segment is one code point wide, where the alphabet bounds the file.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import staged

LEAST, TWICE, FACTOR = 7, 2, 10  # code points and occurrences of a word, times its count that a form has
MODULUS = 31
LIMIT = 4096
ENTRIES = 400_000  # distinct words that a task holds before it passes their counts on
#: Latin-1 bytes: letters stay, A-Z become small, all others part words.
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 0xC0 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def _counts(least: int, modulus: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def passed() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in found]
            out = pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "n": pa.array(found.values(), pa.int64())})
            found.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                # code points beyond Latin-1 are no letters here and become "?", which parts words too
                runs = (text.as_py() or "").encode("latin-1", "replace").translate(_LETTERS).split()
                own = doc.as_py()
                seed = zlib.crc32(b":" if own is None else b"%d:" % own)
                for run, n in Counter(r for r in runs if len(r) >= least).items():
                    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
                    if h % modulus == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least:
                            continue
                    found[run] += n
                if len(found) >= ENTRIES:
                    yield passed()
        yield passed()

    return rows


def vocabulary(docs: DataFrame, least: int = LEAST, twice: int = TWICE, modulus: int = MODULUS) -> DataFrame:
    """(word, n): the distinct words of all texts, with their occurrences."""
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_counts(least, modulus), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= twice)


class Acceptors:
    """Minimised acceptors of sorted words of one length.  A state is a dict
    from a symbol to (next state, words accepted by way of smaller symbols); so
    a path's sum is the place of its word.  Equal states are one, in all
    acceptors made here."""

    def __init__(self) -> None:
        self.states: list[dict[str, tuple[int, int]]] = [{}]  # the first accepts the empty word
        self.sizes = [1]
        self.known: dict[tuple, int] = {(): 0}
        self.meets: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def _state(self, edges: dict[str, int]) -> int:
        key = tuple(edges.items())
        if key not in self.known:
            self.known[key] = len(self.states)
            state, n = {}, 0
            for symbol, to in key:
                state[symbol] = (to, n)
                n += self.sizes[to]
            self.states.append(state)
            self.sizes.append(n)
        return self.known[key]

    def add(self, words: list[str]) -> int:
        """Initial state of the acceptor of ``words``, at least one."""
        path: list[dict[str, int]] = [{}]
        last = ""
        for word in [*words, ""]:
            same = 0
            for a, b in zip(last, word, strict=False):
                if a != b:
                    break
                same += 1
            for k in range(len(last), same, -1):
                done = self._state(path.pop())
                path[-1][last[k - 1]] = done
            path.extend({} for _ in word[same:])
            last = word
        return self._state(path[0])

    def both(self, a: int, b: int) -> list[tuple[int, int]]:
        """Places, below ``a`` and below ``b``, of the words that both accept."""
        if a == b:
            return [(k, k) for k in range(self.sizes[a])]
        if (a, b) not in self.meets:
            out, todo = [], [(a, b, 0, 0)]
            while todo:
                p, q, i, j = todo.pop()
                if p == q:
                    out += [(i + k, j + k) for k in range(self.sizes[p])]
                    continue
                right = self.states[q]
                for symbol, (to, n) in self.states[p].items():
                    if symbol in right:
                        other, m = right[symbol]
                        todo.append((to, other, i + n, j + m))
            self.meets[a, b] = out
        return self.meets[a, b]

    def replaced(self, start: int) -> Iterator[tuple[int, int]]:
        """Places of the words with one symbol replaced by another."""
        here: dict[int, list[tuple[int, int]]] = {}
        todo = [(start, 0)]
        while todo:
            p, base = todo.pop()
            if p not in here:
                edges = [*self.states[p].values()]
                here[p] = [(n + i, m + j) for k, (a, n) in enumerate(edges) for b, m in edges[:k] for i, j in self.both(a, b)]
            yield from ((base + i, base + j) for i, j in here[p])
            todo += [(to, base + n) for to, n in self.states[p].values()]

    def inserted(self, short: int, long: int, at_end: bool) -> Iterator[tuple[int, int]]:
        """Places of words of the first acceptor and of the second that have one
        symbol more.  The edit stands where the words first differ, so each
        pair comes once; ``at_end``: also after the last symbol."""
        here: dict[tuple[int, int], list[tuple[int, int]]] = {}
        todo = [(short, long, 0, 0)]
        while todo:
            p, q, i, j = todo.pop()
            if (p, q) not in here:
                left, found = self.states[p], []
                for x, (to, m) in self.states[q].items():
                    if not left and at_end and not self.states[to]:
                        found.append((0, m))
                    for y, (after, more) in self.states[to].items():
                        if y != x and y in left:
                            a, n = left[y]
                            found += [(n + k, m + more + l) for k, l in self.both(a, after)]
                here[p, q] = found
            yield from ((i + k, j + l) for k, l in here[p, q])
            right = self.states[q]
            todo += [(to, right[x][0], i + n, j + right[x][1]) for x, (to, n) in self.states[p].items() if x in right]


def near_in_file(short: list[str], long: list[str], at_end: bool) -> Iterator[tuple[int, int]]:
    """Pairs one edit apart of sorted words of one length and of those that are
    one longer, by place (the longer ones after the others); replacements
    between two longer ones are another file's."""
    if not short:
        return
    machine = Acceptors()
    start = machine.add(short)
    yield from machine.replaced(start)
    if long:
        yield from ((i, len(short) + j) for i, j in machine.inserted(start, machine.add(long), at_end))


def _enumerated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word of a file that has near words there: their number, the largest
    count among them and the first word that has it.  Rows come sorted by file."""
    out: dict[str, list] = {"word": [], "n_near": [], "form_n": [], "form": []}
    held: list[tuple[bool, str, int]] = []
    now = None

    def close() -> None:
        if len(held) < 2:
            return
        bounds, prefix, suffix = now.split(" ")
        whole = [prefix + inner + suffix for _, inner, _ in held]
        n_short = sum(not longer for longer, _, _ in held)
        number, best = [0] * len(held), [None] * len(held)
        for i, j in near_in_file([x for _, x, _ in held[:n_short]], [x for _, x, _ in held[n_short:]], bounds.endswith("$")):
            for a, b in ((i, j), (j, i)):
                number[a] += 1
                said = (-held[b][2], whole[b])
                if best[a] is None or said < best[a]:
                    best[a] = said
        for word, k, said in zip(whole, number, best, strict=True):
            if k:
                for name, value in zip(out, (word, k, -said[0], said[1]), strict=True):
                    out[name].append(value)

    def passed() -> pa.RecordBatch:
        done = pa.RecordBatch.from_pydict({n: pa.array(out[n], pa.int64() if n in ("n_near", "form_n") else pa.string()) for n in out})
        for values in out.values():
            values.clear()
        return done

    for batch in batches:
        for file, longer, inner, n in zip(*(batch.column(c).to_pylist() for c in ("file", "longer", "inner", "n")), strict=True):
            if file != now:
                close()
                held.clear()
                now = file
            held.append((longer, inner, n))
        yield passed()
    close()
    yield passed()


def _filed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, longer, a, parts, part) with their file: bounds, text
    before and text after the segment; ``a`` is the shorter length."""
    edge = lambda part: F.floor(F.col("a") * part / F.col("parts")).cast("int")
    rows = rows.withColumn("lo", edge(F.col("part"))).withColumn("hi", edge(F.col("part") + 1))
    width = F.col("hi") - F.col("lo") + F.col("longer").cast("int")
    last = F.when(F.col("part") == F.col("parts") - 1, "$").otherwise("")
    piece = lambda start, n: F.substring("word", start, n)
    before, inner = piece(F.lit(1), F.col("lo")), piece(F.col("lo") + 1, width)
    after = piece(F.col("lo") + 1 + width, F.length("word"))
    bounds = F.concat(F.concat_ws(",", "a", "lo", "hi"), last)
    # an empty segment holds no first difference, but for the end of the word
    return rows.withColumn("file", F.concat_ws(" ", bounds, before, after)).withColumn("inner", inner).filter((F.col("hi") > F.col("lo")) | (last == "$"))


def _halved(first: Column) -> Column:
    return F.explode(F.array(first, first + 1))


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(word, n_near, form_n, form) of the words of ``words`` (word, n; distinct)
    that have near words: how many, the largest count among them, and the first
    word in code-point order that has it."""
    length = F.length("word")
    both = F.explode(F.array(F.struct(F.lit(False).alias("longer"), length.alias("a")), F.struct(F.lit(True).alias("longer"), (length - 1).alias("a"))))
    rows = words.select("word", "n", both.alias("as")).select("word", "n", "as.longer", "as.a", F.lit(2).alias("parts"))
    todo, ready = _filed(rows.withColumn("part", _halved(F.lit(0)))), None
    while True:
        wide = F.col("hi") - F.col("lo") > 1
        hot = staged(todo.filter(wide).groupBy("file").agg(F.count("*").alias("n")).filter(F.col("n") > limit).select("file"), "files")
        if hot.isEmpty():
            ready = todo if ready is None else ready.unionByName(todo)
            break
        cold = todo.join(hot, "file", "left_anti")
        ready = cold if ready is None else ready.unionByName(cold)
        again = todo.join(hot, "file", "left_semi").select("word", "n", "longer", "a", (F.col("parts") * 2).alias("parts"), _halved(F.col("part") * 2).alias("part"))
        todo = _filed(again)
    files = ready.select("file", "longer", "inner", "n").repartition("file").sortWithinPartitions("file", "longer", "inner")
    found = files.mapInArrow(_enumerated, "word string, n_near long, form_n long, form string")
    # each pair is in one file, so the files' numbers add up
    first = F.min(F.struct((-F.col("form_n")).alias("minus"), "form"))
    return (
        found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
        .select("word", "n_near", (-F.col("first.minus")).alias("form_n"), "first.form")
    )


def _roots(forms: DataFrame, largest: int) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last by doubling
    the steps.  A form has ``FACTOR`` times the count, so that the largest
    count bounds the steps."""
    steps, n = 0, TWICE * FACTOR
    while n <= largest:
        steps, n = steps + 1, n * FACTOR
    ends, reach = forms.select("word", F.col("form").alias("root")), 1
    while reach < steps:
        ahead = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ends = staged(ends.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
        reach *= 2
    return ends


def variants(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Per word of the texts of ``docs`` (doc_id, text): word, form, root, n,
    n_near, form_n (see README, operator 12).

    A null text has no words; a null doc_id counts as an empty one.  Rows that
    share a doc_id, or are equal, each count.  Other columns are ignored; an
    empty table gives no rows.  ``limit`` bounds the words of a file in a task.
    """
    words = staged(vocabulary(docs), "words")
    known = words.select("word", "n", F.lit(None).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form"))
    near = near_words(words, limit).select("word", F.lit(None).cast("long").alias("n"), "n_near", "form_n", "form")
    each = known.unionByName(near).groupBy("word").agg(*(F.max(c).alias(c) for c in ("n", "n_near", "form_n", "form")))
    fits = F.col("form_n") >= FACTOR * F.col("n")
    rows = staged(
        each.select(
            "word", F.when(fits, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(fits, F.col("form_n")).alias("form_n"),
        ),
        "variants",
    )
    forms = rows.filter("form is not null")
    largest = rows.agg(F.max("n")).first()[0] or 0
    return rows.join(_roots(forms, largest), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
