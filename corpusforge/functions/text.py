"""Scalar text expressions (all JVM-side built-ins, inside whole-stage codegen).

The whitespace class reproduces Python's ``str.split()`` / ``str.strip()``
notion of white space: ASCII controls TAB..CR, the four information
separators U+001C..U+001F, NEL U+0085 and every Unicode separator
(``\\p{Z}``: NBSP, U+1680, U+2000..U+200A, U+2028, U+2029, U+202F, U+205F,
U+3000).  Spark's ``trim`` strips only U+0020 and Java's ``\\s`` misses
NBSP, so the class is spelled out.  The same text works in Java regex and
RE2, so the SQL oracles use it verbatim.  Stripping uses the same set as
explicit characters with ``btrim`` (ends only, no scan of the text).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Regex character class of Python white space (works in Java regex and RE2).
WS_CLASS = r"[\t\n\x0b\f\r \x1c-\x1f\x85\p{Z}]"
_RUNS_RE = WS_CLASS + "+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The same white-space set as explicit characters (Python's str.isspace()).
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()`` on both ends (null stays null).

    ``btrim`` with the explicit character set only looks at the two ends of
    the string (a regex would scan every character of long texts)."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def norm_text(c: Column | str) -> Column:
    """Lower-case, split on Unicode white space, join with one space."""
    return F.trim(F.regexp_replace(F.lower(_c(c)), _RUNS_RE, " "))


def norm_key(c: Column | str) -> Column:
    """Fixed-width key of the normalised text (``sha2``, 64 hex chars): what
    seen sets, anti joins and keep-first shuffle instead of whole texts."""
    return F.sha2(norm_text(c), 256)


def text_len(c: Column | str) -> Column:
    """Length in code points (equals Python ``len``)."""
    return F.length(_c(c))


def _kw_array(keywords: Sequence[str]) -> Column:
    return F.array(*[F.lit(k) for k in keywords]) if keywords else F.array().cast("array<string>")


def keyword_any(norm: Column | str, keywords: Sequence[str]) -> Column:
    """True when any keyword is a substring of ``norm``; an empty list
    keeps everything.  Substring, not word boundary (``tax`` hits ``taxi``)."""
    if not keywords:
        return F.lit(True)
    # Subsumed keywords ("ganacsiga" contains "ganacsi") cannot change an
    # any-match, so drop them: fewer `contains` per row.
    kws = sorted(set(keywords), key=len)
    kept: list[str] = []
    for k in kws:
        if not any(s in k for s in kept):
            kept.append(k)
    n = _c(norm)
    out = None
    for k in kept:
        e = n.contains(k)
        out = e if out is None else (out | e)
    return out


def keyword_any_array(norm: Column | str, keywords: Column) -> Column:
    """P6 with a per-row keyword array (from the source registry): empty or
    null array keeps the row."""
    n = _c(norm)
    return F.coalesce(F.size(keywords) <= 0, F.lit(True)) | F.exists(keywords, lambda k: n.contains(k))


def keyword_hits(text: Column | str, keywords: Sequence[str], lower_keywords: bool = False) -> Column:
    """Number of keywords contained in ``lower(text)``; overlapping keywords
    all count."""
    t = F.lower(_c(text))
    kws = [k.lower() if lower_keywords else k for k in keywords]
    if not kws:
        return F.lit(0)
    return F.size(F.filter(_kw_array(kws), lambda k: t.contains(k)))


def classify_label(
    title: Column | str,
    first_kw: Sequence[str],
    second_kw: Sequence[str],
    first_label: str = "Sports",
    second_label: str = "Health",
    other: str = "Other",
) -> Column:
    """Keyword vote between two labels; no hit -> ``other``; a tie goes
    to the first label.  The first list is matched as written, the second
    one lower-cased (as the reference does)."""
    s = keyword_hits(title, first_kw, lower_keywords=False)
    h = keyword_hits(title, second_kw, lower_keywords=True)
    return (
        F.when((s == 0) & (h == 0), F.lit(other))
        .when(s >= h, F.lit(first_label))
        .otherwise(F.lit(second_label))
    )


_CASED = r"[\p{Lu}\p{Ll}\p{Lt}]"


def title_case(c: Column | str) -> Column:
    """Python ``str.title()`` then strip.

    A character is upper-cased when the one before it is not a cased
    letter (start, space, apostrophe, hyphen, digit...), else lower-cased --
    Python's rule, which Spark's ``initcap`` (words split on spaces only)
    does not follow.  Native: a ``transform`` over the characters."""
    chars = F.split(_c(c), "")
    prev_cased = lambda i: (i > 0) & F.element_at(chars, i).rlike(_CASED)  # noqa: E731 (element_at is 1-based)
    titled = F.transform(chars, lambda ch, i: F.when(prev_cased(i), F.lower(ch)).otherwise(F.upper(ch)))
    return strip_ws(F.array_join(titled, ""))


def cut_first_hyphen(c: Column | str) -> Column:
    """Keep the part before the first ``-`` and strip it."""
    return strip_ws(F.substring_index(_c(c), "-", 1))


def looks_like_xml(c: Column | str) -> Column:
    """P10: after strip, starts with ``<?xml`` or contains ``<rss``/``<feed``."""
    t = strip_ws(_c(c))
    return t.startswith("<?xml") | t.contains("<rss") | t.contains("<feed")


def contains_none(c: Column | str, words: Sequence[str]) -> Column:
    """True when none of ``words`` occurs (case-sensitive, anywhere)."""
    x = _c(c)
    out = F.lit(True)
    for w in words:
        out = out & ~x.contains(w)
    return out


def path_accepted(href: Column | str, accept_prefix: str, reject_prefixes: Sequence[str]) -> Column:
    """Starts with ``accept_prefix`` and with none of ``reject_prefixes``."""
    h = _c(href)
    out = h.startswith(accept_prefix)
    for r in reject_prefixes:
        out = out & ~h.startswith(r)
    return out


def clamp_need(target: Column | int, have: Column | str) -> Column:
    """``max(0, target - have)``."""
    t = target if isinstance(target, Column) else F.lit(target)
    return F.greatest(F.lit(0).cast("long"), (t - F.coalesce(_c(have), F.lit(0))).cast("long"))
