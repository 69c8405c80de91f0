"""SQL spellings (DuckDB dialect) of the library expressions, used only to
build the oracle queries that check the Spark plans."""

from __future__ import annotations

from corpusforge.functions.text import WS_CLASS

STRIP_RE = r"\A" + WS_CLASS + r"+|" + WS_CLASS + r"+\z"
RUNS_RE = WS_CLASS + "+"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(STRIP_RE)}, '', 'g')"


def norm(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), {q(RUNS_RE)}, ' ', 'g'))"


def any_contains(x: str, words) -> str:
    if not words:
        return "TRUE"
    return "(" + " OR ".join(f"contains({x}, {q(w)})" for w in words) + ")"


def count_contains(x: str, words) -> str:
    if not words:
        return "0"
    return "(" + " + ".join(f"CAST(contains({x}, {q(w)}) AS BIGINT)" for w in words) + ")"


def md5_key(seed: int, *parts: str) -> str:
    inner = " || ':' || ".join([q(str(seed))] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"md5({inner})"


def hex_to_long(h: str) -> str:
    return f"CAST(('0x' || substring({h}, 1, 15)) AS BIGINT)"


def clean_cte(src: str = "headlines", name: str = "cleaned", min_len: int | None = 5) -> str:
    where = f"WHERE length(text) > {min_len}" if min_len is not None else ""
    return f"""{name} AS (
  SELECT * FROM (
    SELECT row_id, {strip('text')} AS text, {strip('label')} AS label, source, url
    FROM {src} WHERE text IS NOT NULL AND label IS NOT NULL) {where})"""
