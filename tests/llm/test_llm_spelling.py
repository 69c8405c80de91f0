"""Operator 12 against a brute-force version."""

import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from .test_llm_text import table

from corpusforge.llm import spelling


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 7 and k >= 2}
    links = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if near(a, b):
            links[a].append(b)
            links[b].append(a)
    form = {}
    for w in n:
        best = min(links[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(links[w]), n.get(form[w])))
    return sorted(out)


def found(spark, rows, **args):
    out = spelling.variants(table(spark, rows), **args).collect()
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in out)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    syllables = ["th", "er", "on", "an", "é", "tion", "ß", "a", "÷", "Ou"]
    stems = ["".join(rng.choice(syllables, 5)) for _ in range(25)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa"]
    rows = []
    for i in range(60):
        words = []
        for _ in range(80):
            w = stems[min(int(rng.exponential(4)), len(stems) - 1)]
            if rng.random() < 0.3:
                k = int(rng.integers(0, len(w)))
                w = [w[:k] + w[k + 1 :], w[:k] + "x" + w[k:], w[:k] + "é" + w[k + 1 :], w + w[-1]][int(rng.integers(0, 4))]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, " ".join(words) + ("," if i % 2 else "中文€")))
    long_ = "ab" * 2000
    return [*rows, (5, rows[5][1]), (None, rows[7][1]), (70, None), (71, ""), (72, f"{long_} {long_}c {long_}"), (73, f"{long_}c")]


@pytest.mark.parametrize("limit", [4096, 6])
def test_as_brute_force_also_where_files_are_split(spark, texts, limit):
    out = found(spark, texts, limit=limit)
    assert out == brute(texts)
    assert any(r[1] for r in out) and any(r[2] != (r[1] or r[0]) for r in out)


def test_forms_are_followed_to_the_last(spark):
    chain = [("windows", 2), ("windowsx", 20), ("windowsxy", 200), ("windowsxyz", 2000), ("unrelated", 3)]
    # doc ids under which no run is altered
    safe = next(i for i in range(1, 99999) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w, _ in chain))
    out = found(spark, [(safe, " ".join(f"{w} " * k for w, k in chain))])
    assert {r[0]: r[2] for r in out} == {w: "windowsxyz" for w, _ in chain[:4]} | {"unrelated": "unrelated"}
    assert {r[0]: r[5] for r in out}["windows"] == 20


def test_empty_table(spark):
    assert found(spark, []) == []


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abc", min_size=3, max_size=3), min_size=1), st.sets(st.text("abc", min_size=4, max_size=4)))
def test_composition_gives_each_pair_once(short, long):
    short, long = sorted(short), sorted(long)
    words = short + long
    pairs = [tuple(sorted((words[i], words[j]), key=lambda w: (len(w), w))) for i, j in spelling.near_in_file(short, long, True)]
    expected = [(a, b) for a, b in combinations(words, 2) if near(a, b) and len(a) == 3]
    assert sorted(pairs) == sorted(expected) and len(set(pairs)) == len(pairs)


def test_acceptor_is_minimal():
    machine = spelling.Acceptors()
    machine.add(["aab", "abb", "bab", "bbb"])
    assert len(machine.states) == 4  # both first and both second symbols lead to one state
