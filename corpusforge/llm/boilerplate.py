"""HTML extraction (operator 11): suffix arrays of each host's token streams find
the text that its pages repeat.

A page becomes blocks.  Elements that can't hold the article (``nav``,
``footer``, ``aside``, ``form``, a class such as ``ad`` or ``comments``) are
boilerplate by their markup; what lies neither in them nor in ``article`` or
``main`` is open.  All tokens of a page make up its stream, in stretches outside
the article and in it; the streams of a host are put in one suffix array, to a
depth of ``RUN`` tokens, in which equal neighbours are repeated substrings.

* Text in ``article`` or ``main`` stays, however often it is repeated: copies of
  an article are no boilerplate.
* Open blocks go if substrings cover them that stand outside the article on at
  least two pages; unique ones stay.
* On a page without an article of its own, such a block stays nevertheless if
  the array finds it within articles too and the repeat goes on there beyond
  the block: it is part of a copy.  A headline alone that others list doesn't.

The array is built batch by batch, sorted by its packed tokens; equal entries of
all batches then meet by an aggregate that is combined before the shuffle, so a
host or a menu on a third of all pages costs a row for each batch.  Suffixes of
articles join the array second, and those that no two pages have outside the
article, as most, can't decide about anything: a filter that holds all entries
of the first half (``_Filter``) drops them before the shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cached_property
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import mix64, splitmix, staged

RUN = 6  # tokens of a repeated substring, at least; a block's start is a token
COVERED = 0.8  # share of an open block's words from which on it goes
FILTER_BITS = 1 << 28  # of the filter, at most: 32 MB; more entries let more suffixes of articles through, never fewer

_MARKUP = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))
    |<(?P<raw>script|style|textarea|title|xmp|iframe|noembed|noframes)(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)
    |<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<attributes>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(?P<end2>/?)(?P<name2>[a-z][^\s/>]*+)(?P<attributes2>[^>]*+)(?:>|\Z)
    |<[!?/][^>]*+(?:>|\Z)""",
    re.S | re.I | re.X,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
NOISE = frozenset("aside audio button canvas dialog footer form head map menu nav noscript object select svg template video".split())
#: What may stand in ``head``; any other element ends it.
IN_HEAD = frozenset("head base link meta noscript script style template title".split())
#: A class, id or role is boilerplate's if its last word is one of these, or its first one of ``FIRST``.
LAST = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies copyright disclaimer disqus footer gdpr masthead menu modal nav navbar navigation newsletter "
    "notice notices overlay pagination popup promo promotion promotions related replies reply search share sharing sidebar signup "
    "social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
FIRST = LAST - frozenset("alert related reply search share".split())
NOT = frozenset("has no with without".split())
#: An element closes one of these that is still open, up to the nearest of the list's own element.
SIBLINGS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table")}
SIBLINGS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in SIBLINGS.items()}

OPEN, MAIN, ARTICLE, GONE = range(4)


def _marked(attributes: str, inside: bool) -> int:
    """GONE, ARTICLE, MAIN or OPEN, as an element's attributes say; ``inside``
    an article, a header is the article's own."""
    kind = OPEN
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values)
        if key.lower() == "itemprop":
            kind = ARTICLE if value == "articleBody" else kind
            continue
        if key.lower() == "role" and value == "main":
            kind = max(kind, MAIN)
        for name in value.split():
            words = [w.lower() for w in _WORD.findall(name)]
            if words and words[0] not in NOT and (words[-1] in LAST or words[0] in FIRST or words[-1] == "header" and not inside):
                return GONE
    return kind


def blocks(html: str | None) -> list[tuple[int, str, str]]:
    """(kind, element, text) of the blocks of a page, in order: text in which
    references are decoded and white space is one space, never empty."""
    html = html or ""
    out: list[tuple[int, str, str]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements, with the kind of their text
    kind, element, at = OPEN, "body", 0

    def text(upto: int) -> None:
        if upto > at:
            piece = html[at:upto]
            held.append(unescape(piece) if "&" in piece else piece)

    def close() -> None:
        words = " ".join("".join(held).split())
        if words:
            out.append((kind, element, words))
        held.clear()

    def drop(n: int) -> None:
        nonlocal kind, element
        del stack[n:]
        element, kind = stack[-1] if stack else ("body", OPEN)

    for tag in _MARKUP.finditer(html):
        text(tag.start())
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            continue  # comments, raw text, declarations: white space isn't added
        attributes = tag["attributes"] or tag["attributes2"] or ""
        inline = name in INLINE
        if tag["end"] or tag["end2"]:
            if not inline:
                close()
            for n in range(len(stack) - 1, -1, -1):
                if inline and stack[n][0] not in INLINE:
                    break
                if stack[n][0] == name:
                    if (stack[n - 1][1] if n else OPEN) != kind:
                        close()
                    drop(n)
                    break
            continue
        if name == "br":
            held.append(" ")
        own = OPEN
        if "=" in attributes and name not in ("html", "body", "article", "main"):
            own = _marked(attributes, kind in (MAIN, ARTICLE))
        if name in VOID and inline or name == "img":
            continue
        if inline and own != GONE:
            if any(s == name for s, _ in stack):  # so that its end isn't taken for the other's
                stack.append((name, kind))
            continue
        close()
        if not inline and stack and stack[-1][0] == "p":
            drop(len(stack) - 1)
        if stack and stack[-1][0] == "head" and name not in IN_HEAD:
            drop(len(stack) - 1)
        if name in SIBLINGS:
            same, upto = SIBLINGS[name]
            for n in range(len(stack) - 1, -1, -1):
                if stack[n][0] in same:
                    drop(n)
                if n >= len(stack) or stack[n][0] in upto:
                    break
        if name in ("article", "main"):
            # an article doesn't stand in a menu or a form that was never closed
            for n, (s, _) in enumerate(stack):
                if s in ("nav", "header", "form", "menu"):
                    drop(n)
                    break
            if name == "main" and kind == GONE:  # as a class says of what is around all
                kind = OPEN
            own = GONE if name == "article" and "=" in attributes and _comment(attributes) else ARTICLE if name == "article" else MAIN
        elif name in NOISE or name == "header" and kind == OPEN:
            own = GONE
        element = name
        if name not in VOID:
            kind = GONE if GONE in (kind, own) else max(kind, own)
            stack.append((name, kind))
    text(len(html))
    close()
    marked = any(k == ARTICLE for k, _, _ in out)
    return [(OPEN if k == MAIN and marked else ARTICLE if k == MAIN else k, e, t) for k, e, t in out]


def _comment(attributes: str) -> bool:
    return any(w.lower() in ("comment", "comments", "reply", "teaser", "related", "ad", "promo") for _, *v in _ATTRIBUTE.findall(attributes) for w in _WORD.findall("".join(v)))


def _host(url: str | None) -> int:
    """A number for the url's host, A-Z lower-cased (none: the empty one)."""
    _, found, rest = (url or "").partition("://")
    host = re.split("[/?#]", rest, maxsplit=1)[0].encode().lower() if found else b""
    return xxhash.xxh64_intdigest(host)


def _tokens(element: str, text: str) -> list[int]:
    return [zlib.crc32(b"<" + element.encode()), *map(zlib.crc32, text.encode().split(b" "))]


class Stream:
    """Tokens of blocks, each after its element's, and the runs they stand in: a
    substring doesn't go beyond its run."""

    def __init__(self, host: int, runs: list[list[tuple[int, str, str]]]):
        tokens: list[int] = []
        self.host = host
        self.runs: list[tuple[int, int]] = []
        self.words: dict[int, tuple[int, int]] = {}  # block -> its words in the stream
        for run in runs:
            begin = len(tokens)
            for k, element, text in run:
                first = len(tokens) + 1
                tokens += _tokens(element, text)
                self.words[k] = (first, len(tokens))
            self.runs.append((begin, len(tokens)))
        self.tokens = np.array(tokens, np.uint32)

    def starts(self, run: int) -> np.ndarray:
        """Where suffixes of at least ``run`` tokens begin."""
        return np.concatenate([np.arange(a, max(a, b - run + 1)) for a, b in self.runs]).astype(np.int64)

    def entries(self, run: int) -> np.ndarray:
        """The suffixes to their first ``run`` tokens, after the host."""
        starts = self.starts(run)
        out = np.empty((len(starts), run + 2), np.uint32)
        out[:, :2] = self.host >> 32, self.host & 0xFFFFFFFF
        out[:, 2:] = self.tokens[starts[:, None] + np.arange(run)]
        return out


class Page(Stream):
    """A page's blocks, and its stream outside the article; each stretch between
    parts of the article is a run of its own.  ``article`` is the stream in it."""

    def __init__(self, url: str | None, html: str | None):
        self.blocks = blocks(html)
        outside: list[list[tuple[int, str, str]]] = [[]]
        self._inside: list[list[tuple[int, str, str]]] = [[]]
        for k, (kind, element, text) in enumerate(self.blocks):
            here, other = (self._inside, outside) if kind == ARTICLE else (outside, self._inside)
            here[-1].append((k, element, text))
            if other[-1]:
                other.append([])
        super().__init__(_host(url), outside)
        self.open = {k: w for k, w in self.words.items() if self.blocks[k][0] == OPEN}

    @cached_property
    def article(self) -> Stream:
        return Stream(self.host, self._inside)

    def content(self) -> int:
        """Equal pages are one."""
        digest = xxhash.xxh64(seed=1)
        for kind, _, text in self.blocks:
            digest.update(f"{kind}{text}\n".encode())
        return digest.intdigest()

    def stream(self) -> bytes:
        """Names the stream: equal ones on a host are covered alike."""
        runs = np.array(self.runs, np.int64).tobytes()
        return xxhash.xxh128(self.host.to_bytes(8) + self.tokens.tobytes() + runs + str([*self.open.values()]).encode()).digest()

    def kept(self, places: np.ndarray, copied: np.ndarray, run: int, covered: float) -> list[str]:
        """Texts of the article and of open blocks, unless substrings at
        ``places`` cover these; those of ``copied`` stand in articles as well."""
        marked = any(kind == ARTICLE for kind, _, _ in self.blocks)
        seen, known = (_spread(x, len(self.tokens), run) for x in (places, copied))
        out = []
        for k, (kind, _, text) in enumerate(self.blocks):
            if kind == OPEN:
                a, b = self.open[k]
                least = covered * (b - a)
                beyond = (copied < a - 1) & (copied + run > a) | (copied < b) & (copied + run > b + 1)  # to a word of a neighbour
                if seen[a:b].sum() < least or not marked and known[a:b].sum() >= least and beyond.any():
                    out.append(text)
            elif kind == ARTICLE:
                out.append(text)
        return out


def _spread(places: np.ndarray, size: int, run: int) -> np.ndarray:
    seen = np.zeros(size + run, bool)
    for k in range(run):
        seen[places + k] = True
    return seen


class _Filter:
    """A Bloom filter of entries: two bits each in a table of 64-bit words."""

    def __init__(self, table: np.ndarray, run: int):
        self.table = table
        self.mask = np.uint64(64 * len(table) - 1)
        self.factors = splitmix(run + 2, 11) | np.uint64(1)

    def bits(self, entries: np.ndarray) -> np.ndarray:
        h = mix64(entries.astype(np.uint64) @ self.factors)
        return np.stack((h & self.mask, (h >> np.uint64(32)) & self.mask))

    def holds(self, entries: np.ndarray) -> np.ndarray:
        at = self.bits(entries)
        return ((self.table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool).all(axis=0)


def _pages(batch: pa.RecordBatch) -> Iterator[Page]:
    for url, html in zip(batch.column("url"), batch.column("html"), strict=True):
        yield Page(url.as_py(), html.as_py())


def _packed(entries: np.ndarray) -> pa.Array:
    return pa.array([e.tobytes() for e in entries.astype(">u4")], pa.binary())


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _arrays(run: int):
    """The suffix array of a batch's streams, an entry for equal suffixes: with
    the least and the greatest number of a page that holds it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries, page = [], []
            for p in _pages(batch):
                entries.append(p.entries(run))
                page.append(np.full(len(entries[-1]), p.content(), np.uint64))
            entries = np.concatenate(entries) if entries else np.empty((0, run + 2), np.uint32)
            if not len(entries):
                continue
            page = _signed(np.concatenate(page))
            order = np.lexsort(entries.T[::-1])  # digit by digit, the last first
            entries, page = entries[order], page[order]
            first = np.concatenate([[True], (entries[1:] != entries[:-1]).any(axis=1)])
            at = np.nonzero(first)[0]
            yield pa.RecordBatch.from_pydict({
                "entry": _packed(entries[at]),
                "low": pa.array(np.minimum.reduceat(page, at)), "high": pa.array(np.maximum.reduceat(page, at)),
            })

    return rows


def _article_arrays(run: int, table):
    """The suffixes of a batch's articles that the filter holds, equal ones once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Filter(table.value, run)
        for batch in batches:
            entries = [np.empty((0, run + 2), np.uint32)]
            for p in _pages(batch):
                own = p.article.entries(run)
                entries.append(own[found.holds(own)])
            yield pa.RecordBatch.from_pydict({"entry": _packed(np.unique(np.concatenate(entries), axis=0))})

    return rows


def _open_entries(run: int):
    """Rows (stream, place, entry) of the streams with open blocks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            streams = {}
            for p in _pages(batch):
                streams.setdefault(p.stream(), p)
            for name, p in streams.items():
                yield pa.RecordBatch.from_pydict({
                    "stream": pa.array([name] * len(starts := p.starts(run)), pa.binary()), "place": pa.array(starts, pa.int64()),
                    "entry": _packed(p.entries(run)),
                })

    return rows


def repeated(pages: DataFrame, run: int = RUN) -> DataFrame:
    """(entry): host and first ``run`` tokens of the suffixes that begin in
    streams of at least two distinct pages of the host."""
    arrays = pages.select("url", "html").mapInArrow(_arrays(run), "entry binary, low long, high long")
    return arrays.groupBy("entry").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high").select("entry")


def _words(bits: int, run: int):
    """Rows (word, bits) of the filter's table."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Filter(np.zeros(bits // 64, np.uint64), run)
        for batch in batches:
            entries = np.frombuffer(b"".join(batch.column("entry").to_pylist()), ">u4").reshape(-1, run + 2)
            at = np.sort(found.bits(entries).ravel())
            word, one = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
            first = np.nonzero(np.concatenate([[True], word[1:] != word[:-1]]))[0] if len(word) else np.zeros(0, np.int64)
            one = np.bitwise_or.reduceat(one, first) if len(word) else one
            yield pa.RecordBatch.from_pydict({"word": pa.array(_signed(word[first])), "bits": pa.array(_signed(one))})

    return rows


def _filter(repeats: DataFrame, run: int):
    """The table of the filter of ``repeats``, broadcast: 32 bits for an entry, up to ``FILTER_BITS``."""
    bits = min(FILTER_BITS, 1 << max(16, (32 * repeats.count() - 1).bit_length()))
    table = np.zeros(bits // 64, np.uint64)
    words = repeats.mapInArrow(_words(bits, run), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return repeats.sparkSession.sparkContext.broadcast(table)


def _array(pages: DataFrame, run: int) -> DataFrame:
    """(entry, copied): the entries of ``repeated``, and whether articles of the
    host hold them as well."""
    repeats = staged(repeated(pages, run), "repeats")
    articles = pages.select("url", "html").mapInArrow(_article_arrays(run, _filter(repeats, run)), "entry binary").distinct()
    return repeats.join(articles.withColumn("copied", F.lit(True)), "entry", "left").select("entry", F.coalesce("copied", F.lit(False)).alias("copied"))


def _texts(wants_open: bool):
    """Rows of the pages with, or without, open blocks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [(k, p) for k, p in enumerate(_pages(batch)) if bool(p.open) == wants_open]
            own = batch.take(pa.array([k for k, _ in pages], pa.int64()))
            out = {"page_id": own.column("page_id"), "url": own.column("url")}
            if wants_open:
                out["html"] = own.column("html")
                out["stream"] = pa.array([p.stream() for _, p in pages], pa.binary())
            else:
                out["text"] = pa.array(["\n\n".join(t for k, _, t in p.blocks if k == ARTICLE) for _, p in pages], pa.string())
            yield pa.RecordBatch.from_pydict(out)

    return rows


def _kept(run: int, covered: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for p, *places in zip(_pages(batch), batch.column("places"), batch.column("copied"), strict=True):
                places, copied = (np.array(x.as_py() or (), np.int64) for x in places)
                texts.append("\n\n".join(p.kept(places, copied, run, covered)))
            yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string())})

    return rows


def extract(pages: DataFrame, run: int = RUN, covered: float = COVERED) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url,
    html): the blocks of the main text, joined by an empty line.

    A null or empty html gives an empty text.  Pages without a host count as
    one host's.  Equal pages are one page of their host; rows that share a
    page_id are extracted each.  Of a page without ``article`` or ``main`` all
    text is open, so blocks that near copies of it share go too, unless an
    article of the host has them.  Other columns are ignored; an empty table
    gives no rows.
    """
    pages = pages.select(F.col("page_id").cast("long"), "url", "html")
    array = staged(_array(pages, run), "array")
    open_ = staged(pages.mapInArrow(_texts(True), "page_id long, url string, html string, stream binary"), "open")
    places = open_.mapInArrow(_open_entries(run), "stream binary, place long, entry binary").join(array, "entry")
    places = places.groupBy("stream").agg(F.collect_set("place").alias("places"), F.collect_set(F.when(F.col("copied"), F.col("place"))).alias("copied"))
    places = staged(places, "places")
    open_ = open_.join(places, "stream", "left").select("page_id", "url", "html", "places", "copied")
    open_ = open_.mapInArrow(_kept(run, covered), "page_id long, url string, text string")
    rows = pages.mapInArrow(_texts(False), "page_id long, url string, text string").unionByName(open_)
    return rows.withColumn("n_chars", F.length("text").cast("long"))
