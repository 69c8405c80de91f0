"""Per-page HTML helper used inside ``mapInPandas`` (the only Python stage).

It parses one page with the standard library's ``html.parser`` into a flat
element list and matches a small CSS subset: type selectors, ``.class``,
``#id``, their compounds (``h2.post-title``), descendant and child (``>``)
combinators and comma unions.  Tree building is lenient the way browsers'
simplest builders are: void elements never open, an end tag closes the
nearest open element of that name (and everything opened inside it), a
stray end tag is ignored, unclosed elements close at the end.  A repeated
attribute keeps its last value.  Comments and text inside ``script``,
``style``, ``template``, ``rt`` and ``rp`` are not text.  Entities are
unescaped by the parser.

Everything after matching (length filters, tiers, first-of, dedupe) is
done by Spark built-ins on the emitted rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

# HTML void elements (never have content or an end tag).
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Elements whose text is not part of a page's text.
NO_TEXT = frozenset(("script", "style", "template", "rt", "rp"))


@dataclass
class Element:
    tag: str
    attrs: dict
    parent: int  # index of the parent element, -1 for the root
    hidden: bool = False  # inside (or itself) an element without text
    children: list = field(default_factory=list)  # ints (elements) or str (text)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.els: list[Element] = [Element("#root", {}, -1)]
        self.stack: list[int] = [0]

    def handle_starttag(self, tag, attrs):
        d = {k: "" if v is None else v for k, v in attrs}
        idx = len(self.els)
        hidden = tag in NO_TEXT or self.els[self.stack[-1]].hidden
        self.els.append(Element(tag, d, self.stack[-1], hidden))
        self.els[self.stack[-1]].children.append(idx)
        if tag not in VOID:
            self.stack.append(idx)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.stack.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.els[self.stack[i]].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        top = self.els[self.stack[-1]]
        if top.hidden:
            return
        top.children.append(data)


def parse(html: str) -> list[Element]:
    b = _Builder()
    try:
        b.feed(html or "")
        b.close()
    except Exception:  # noqa: BLE001 - malformed markup: keep what was built
        pass
    return b.els


def strings(els: list[Element], i: int) -> list[str]:
    """Text nodes below element ``i`` in document order."""
    out: list[str] = []
    todo = [i]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            out.append(node)
            continue
        todo.extend(reversed(els[node].children))
    return out


def text_spaced(parts: list[str]) -> str:
    """``get_text(" ", strip=True)``."""
    return " ".join(s.strip() for s in parts if s.strip())


def text_joined(parts: list[str]) -> str:
    """``get_text(strip=True)``."""
    return "".join(s.strip() for s in parts if s.strip())


def text_whole(parts: list[str]) -> str:
    """``get_text().strip()``."""
    return "".join(parts).strip()


# --- selectors ---------------------------------------------------------------

_COMPOUND = re.compile(r"([a-zA-Z][a-zA-Z0-9-]*|\*)?((?:[.#][A-Za-z0-9_-]+)*)")


@dataclass(frozen=True)
class Compound:
    tag: str | None
    ids: tuple
    classes: tuple

    def matches(self, el: Element) -> bool:
        if self.tag and self.tag != "*" and el.tag != self.tag:
            return False
        if self.ids and el.attrs.get("id") not in self.ids:
            return False
        if self.classes:
            have = set(el.attrs.get("class", "").split())
            if not all(c in have for c in self.classes):
                return False
        return True


def _compound(tok: str) -> Compound:
    m = _COMPOUND.fullmatch(tok)
    if not m:
        raise ValueError(f"Unsupported selector part: {tok!r}")
    rest = re.findall(r"([.#])([A-Za-z0-9_-]+)", m.group(2) or "")
    return Compound(
        (m.group(1) or "").lower() or None,
        tuple(v for k, v in rest if k == "#"),
        tuple(v for k, v in rest if k == "."),
    )


def compile_selector(sel: str) -> list[tuple]:
    """``"div.a > p, h2 a"`` -> list of chains ``[(combinator, Compound), ...]``
    (right-most last; combinator of the first part is ``None``)."""
    chains = []
    for part in sel.split(","):
        toks = part.replace(">", " > ").split()
        if not toks:
            continue
        chain, comb = [], None
        for t in toks:
            if t == ">":
                comb = ">"
                continue
            chain.append((comb, _compound(t)))
            comb = " "
        chains.append(chain)
    return chains


def _match_chain(els: list[Element], i: int, chain: list[tuple]) -> bool:
    comb, last = chain[-1]
    if not last.matches(els[i]):
        return False
    if len(chain) == 1:
        return True
    rest = chain[:-1]
    p = els[i].parent
    if comb == ">":
        return p > 0 and _match_chain(els, p, rest)
    while p > 0:
        if _match_chain(els, p, rest):
            return True
        p = els[p].parent
    return False


def select(els: list[Element], chains: list[tuple]) -> list[int]:
    """Indices of elements matching any chain, in document order."""
    return [i for i in range(1, len(els)) if any(_match_chain(els, i, c) for c in chains)]


def subtree_ends(els: list[Element]) -> list[int]:
    """Index of the last element inside each element (itself if none): the
    elements below ``i`` are exactly ``i + 1 .. ends[i]``."""
    ends = list(range(len(els)))
    for i in range(len(els) - 1, 0, -1):
        p = els[i].parent
        ends[p] = max(ends[p], ends[i])
    return ends


TEXTS = {"spaced": text_spaced, "joined": text_joined, "whole": text_whole}


def matches(html: str, selectors: list[str], union: bool, modes: list | None = None):
    """Yield ``(sel_idx, doc_pos, spaced, joined, whole, href, end_pos)``;
    the elements inside a hit have positions ``doc_pos + 1 .. end_pos``.

    ``union=True``: the comma union of all selectors, one row per element
    (``sel_idx`` = first selector it matches), document order.
    ``union=False``: one row per (selector, element), selector-major.
    ``modes``: the text modes wanted of each selector (none: all); the other
    texts are None.
    """
    els = parse(html)
    compiled = [compile_selector(s) for s in selectors]
    hits: list[tuple[int, int]] = []
    if union:
        for i in range(1, len(els)):
            for k, chains in enumerate(compiled):
                if any(_match_chain(els, i, c) for c in chains):
                    hits.append((k, i))
                    break
    else:
        for k, chains in enumerate(compiled):
            hits.extend((k, i) for i in select(els, chains))
    ends = subtree_ends(els) if hits else []
    for k, i in hits:
        parts = strings(els, i)
        href = els[i].attrs.get("href")
        yield (
            k,
            i,
            *(text(parts) if modes is None or mode in modes[k] else None for mode, text in TEXTS.items()),
            href,
            ends[i],
        )
