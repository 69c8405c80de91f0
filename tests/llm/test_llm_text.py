"""Operators 2, 4, 5, 7, 8, 9 against brute-force versions on small tables."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusforge.llm import decontam, packing, pii, quality, queries, simhash, suffix_dedup
from corpusforge.llm.common import splitmix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kind string, _row string"


def table(spark, rows):
    """Rows (doc_id, text) with further columns, some named as the operators' own."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y") for i, t in rows], SCHEMA).repartition(3)


WORDS = "the quick brown fox jumps over lazy dogs while seven bright stars shine above quiet hills and rivers flow".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[k] + str(rng.integers(0, 50)) for k in rng.integers(0, len(WORDS), n))


@pytest.fixture(scope="module")
def texts():
    passage, long_ = prose(1, 60), prose(2, 3000)
    return [
        (1, passage), (2, passage), (3, prose(3, 30) + " " + passage + " " + prose(4, 30)), (4, None), (5, ""),
        (6, "ab " * 200), (7, "x" * 500), (8, long_), (9, long_[:9000] + "!" + long_[9000:]), (10, "é" * 150 + passage[50:300]),
        (11, "word"), (12, "Word"), (None, prose(5, 40)), (13, prose(5, 40)), (14, " \n\t"), (15, passage[::-1]),
    ]


# 2. suffix-array dedup


def brute_dedup(rows, depth):
    seen, out = {}, {}
    order = sorted(((-1 << 63 if i is None else i), (t or "").encode()) for i, t in rows)
    for i, b in order:
        for k in range(len(b) - depth + 1):
            w = b[k : k + depth]
            seen[w] = min(seen.get(w, (i, k)), (i, k))
    for i, b in order:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - depth + 1):
            if seen[b[k : k + depth]] < (i, k):
                gone[k : k + depth] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[i if i != -1 << 63 else None] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("segment", [1 << 20, 512])
def test_op2_equals_brute_force(spark, texts, segment, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)  # long texts in overlapping parts
    monkeypatch.setattr(suffix_dedup, "CROWD", 2 if segment == 512 else 16)
    got = {r[0]: tuple(r[1:]) for r in suffix_dedup.dedup_substrings(table(spark, texts)).collect()}
    assert got == brute_dedup(texts, 100)


def test_op2_repeated_ids_and_empty_table(spark):
    t = prose(7, 60)
    rows = suffix_dedup.dedup_substrings(table(spark, [(1, t), (1, t), (2, t)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(1, 0), (1, 0), (2, len(t))]
    assert suffix_dedup.dedup_substrings(table(spark, [])).count() == 0


# 4. packing


def test_op4_pieces_equal_the_tokenizer(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer())
    rows = [r for r in texts if r[0]] + [(20, "<|endoftext|>. it's DON'T é, İ ß 10,000.\u0085x"), (21, "hello " * 5000)]
    got = packing.pack(table(spark, rows), queries.tokenizer()).toPandas()
    want = {}
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a : a + 2048]
            want[i, k] = (a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()} == want
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        ends = g.offset + g.length
        assert g.offset.tolist() == [0, *ends.tolist()[:-1]] and ends.iloc[-1] <= 2048
    assert packing.pack(table(spark, []), queries.tokenizer()).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_op4_plan_packs_every_item_once(seed):
    rng = np.random.default_rng(seed)
    counts = {int(s): int(n) for s, n in zip(rng.integers(1, 101, 25), rng.integers(1, 60, 25), strict=True)}
    kinds = packing.plan(dict(counts), 100)
    packed: dict[int, int] = {}
    for number, items in kinds:
        assert number > 0 and sum(s * n for s, n in items) <= 100
        assert sum(n for s, n in items if 3 * s > 100) <= 2
        for s, n in items:
            packed[s] = packed.get(s, 0) + number * n
    assert packed == counts
    total = sum(s * n for s, n in counts.items())
    large = sum(n for s, n in counts.items() if 2 * s > 100)
    assert sum(n for n, _ in kinds) <= 1.25 * max(-(-total // 100), large) + 1


def test_op4_ties_and_repeated_rows(spark):
    got = packing.pack(table(spark, [(1, "a b c")] * 40 + [(None, "a b c")] * 5), queries.tokenizer()).toPandas()
    assert len(got) == 45 and got.sequence_id.nunique() == 1 and sorted(got.offset) == list(range(0, 180, 4))


# 5. PII


def base_spans(t):
    luhn = lambda x: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(x))) % 10 == 0
    out = []
    for kind, p in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if (
                kind == "ip" and any(int(x) > 255 for x in m[0].split("."))
                or kind == "card" and not (16 <= len(d) <= 19 and luhn(d))
                or kind == "phone" and not 8 <= len(d) <= 15
            ):
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


PII = [
    "a@b.c@d.e x@y.z.w_k@p.q", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4 00000000000255.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1111 41111111111111112222233333", "+1 (234) 555-6789. +49.30.12345 +1 2",
    "é@x.y éa@b.cc 😀 +12345678", "a" * 3000 + " " + "1" * 3000, "a@b" + ".c" * 3000, "x@y.z " * 700, None, "",
]


def test_op5_base_spans_equal_brute_force(spark):
    got = {r.doc_id: r for r in pii.report(table(spark, list(enumerate(PII)))).collect()}
    for i, t in enumerate(PII):
        spans = base_spans(t or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), i
        assert [s for s in got[i].spans.split(",") if s] == spans
        assert got[i].n_email == sum(s.startswith("email") for s in spans)


def test_op5_checksums_context_and_redaction(spark):
    rows = [
        (1, "GB82 WEST 1234 5698 7654 32 and DE89370400440532013000 not DE89370400440532013001"),
        (2, "my ssn is 078-05-1120"), (3, "part 078-05-1120"), (4, "mail a@b.cc, call +1 (234) 555-6789 now"), (5, None),
    ]
    df = table(spark, rows)
    spans = {r.doc_id: r.spans for r in pii.report(df).collect()}
    assert spans == {1: "iban:0:27,iban:32:54", 2: "ssn:10:21", 3: "", 4: "email:5:11,phone:18:35", 5: ""}
    out = {r.doc_id: r for r in pii.redact(df).collect()}
    assert out[4].text == "mail [EMAIL], call [PHONE] now" and out[4].n_chars == len(out[4].text)
    assert out[3].text == rows[2][1] and out[5].text is None and out[4].kind == "x"
    assert pii.redact(df).columns == df.columns and pii.report(table(spark, [])).count() == 0


def test_op5_context_goes_over_neighbours_and_blocks(spark):
    rows = [
        (1, "social security 078-05-1120, 219-09-9999"), (2, "078-05-1120 219-09-9999 ssn"),
        (3, "y" * 250 + " ssn 078-05-1120"), (4, "😀" * 244 + "078-05-1120 ssn"), (5, "078-05-1120" + " " * 40 + "ssn"),
        (6, "ssn" + " " * 37 + "078-05-1120 " + " " * 300 + "219-09-9999"),
    ]
    spans = {r.doc_id: r.spans for r in pii.report(table(spark, rows)).collect()}
    assert spans == {1: "ssn:16:27,ssn:29:40", 2: "ssn:0:11,ssn:12:23", 3: "ssn:255:266", 4: "ssn:244:255", 5: "", 6: "ssn:40:51"}


def test_op5_ibans_of_every_length_before_other_words(spark):
    def iban(country, bban):
        rest = int("".join(str(int(c, 36)) for c in bban + country + "00")) % 97
        return f"{country}{98 - rest:02d}{bban}"

    rows, want = [], {}
    for n, codes in pii.IBAN_LENGTHS.items():
        for country in codes.split():
            bare = iban(country, "12345678901234567890123456789012"[: n - 4])
            for form in (bare, " ".join(bare[k : k + 4] for k in range(0, n, 4))):
                for after in ("", " Please pay", " 2024-01-01", " BIC GEBABEBB", ", " + form, " " + form):
                    begins = [4, 4 + len(after)] if after.endswith(form) else [4]
                    want[len(rows)] = ",".join(f"iban:{b}:{b + len(form)}" for b in begins)
                    rows.append((len(rows), "pay " + form + after))
    assert len(rows) == 12 * len({c for x in pii.IBAN_LENGTHS.values() for c in x.split()})  # none twice
    texts = [
        ("ES91 2100 0418 4502 0005 1332 Please pay", "iban:0:29"), ("BE68 5390 0754 7034 BIC GEBABEBB", "iban:0:19"),
        ("AT611904300234573201 2024-01-01", "iban:0:20"), ("BE12 3456 AT61 1904 3002 3457 3201 X", "iban:10:34"),
        ("BE68 5390 0754 7034X", ""), ("BE68 5390 0754 7035", ""), (iban("ZZ", "123456789012"), "iban:0:16"),
    ]
    for text, spans in texts:
        want[len(rows)] = spans
        rows.append((len(rows), text))
    found = pii.report(table(spark, rows)).collect()
    assert {r.doc_id: ",".join(s for s in r.spans.split(",") if s.startswith("iban")) for r in found} == want
    out = {r.doc_id: r.text for r in pii.redact(table(spark, [(1, texts[0][0])])).collect()}
    assert out == {1: "[IBAN] Please pay"}


def brute_redaction(text, spans):
    """``spans``: kind:start:end, comma-joined, as ``report`` gives them."""
    found = [s.split(":") for s in spans.split(",") if s]
    parts, end = [], 0
    for start, _, kind, upto in sorted((int(a), -int(b), k, int(b)) for k, a, b in found):
        if start >= end:
            parts += [text[end:start], f"[{kind.upper()}]"]
            end = upto
    return "".join(parts) + text[end:]


def test_op5_redaction_of_overlaps_and_blocks_is_brute_force(spark):
    rng = random.Random(8)
    bits = ["+1 234 555 6789", "078-05-1120 ssn", "4111 1111 1111 1111", "10.0.0.1", "a.b@c.de", "+4111 1111 1111 1111", "10.0.0.1@x.yz", "😀", "é" * 40, "\n"]
    rows = [(i, "".join(rng.choice(bits) + rng.choice(["", " ", ", "]) for _ in range(rng.choice([0, 1, 5, 60, 400])))) for i in range(60)]
    rows += [(60, "x" * 256 + " a@b.cc"), (61, "a@b.cc " + "x" * 249), (62, "a@b.cc"), (63, " " * 512), (64, "y" * 5000 + " 10.0.0.1")]
    df = table(spark, rows)
    spans = {r.doc_id: r.spans for r in pii.report(df).collect()}
    out = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert out == {i: brute_redaction(t, spans[i]) for i, t in rows}
    assert sum(s.count(",") for s in spans.values()) > 500


def test_op5_redacts_tens_of_thousands_of_spans_in_a_text(spark):
    text = "a@b.cc 10.0.0.1 " * 16_000
    df = table(spark, [(1, text)])

    def seconds(run):
        begin = time.monotonic()
        got = run(df).collect()[0]
        return time.monotonic() - begin, got

    pii.redact(table(spark, [(1, "a@b.cc")])).collect()
    plain, _ = seconds(pii.report)
    spent, row = seconds(pii.redact)
    assert row.text == "[EMAIL] [IP] " * 16_000
    assert spent < 3 * plain + 5


# 7. SimHash


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    parent = list(range(len(fps)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                parent[find(a)] = find(b)
    return [find(a) for a in range(len(fps))]


def test_op7_equals_brute_force(spark, texts):
    base = prose(9, 400).split()
    rows = [*texts, *((100 + k, " ".join(base[:k] + ["changed"] + base[k:])) for k in range(0, 60, 2))]
    got = {r.doc_id: r for r in simhash.near_duplicates(table(spark, rows)).collect()}
    fps = [brute_fingerprint(t) for _, t in rows]
    comps = brute_components(fps)
    for (i, _), fp, c in zip(rows, fps, comps, strict=True):
        assert got[i].fingerprint == f"{fp:016x}"
        assert got[i].component_id == min(rows[k][0] for k in range(len(rows)) if comps[k] == c and rows[k][0] is not None)
    kept = [r.doc_id for r in simhash.keep_one(table(spark, rows)).collect()]
    assert sorted(kept) == sorted({r.component_id for r in got.values()})


def test_op7_links_of_dense_fingerprints(spark):
    rng = np.random.default_rng(3)
    fps = {0, 1, (1 << 64) - 1}
    for _ in range(40):
        x = int(rng.integers(0, 1 << 63))
        for _ in range(12):
            fps.add(x)
            x ^= 1 << int(rng.integers(0, 64))
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(df)).collect()}
    comps = brute_components(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    for a in range(len(fps)):
        for b in range(a):
            same = roots.get(signed[a], signed[a]) == roots.get(signed[b], signed[b])
            assert same == (comps[a] == comps[b])


def families(seed, n, size):
    """Fingerprints that agree in two blocks of 16 bits, near ones among them."""
    rng = random.Random(seed)
    out = set()
    for _ in range(n):
        base, (a, b) = rng.getrandbits(64), rng.sample(range(4), 2)
        keep = 0xFFFF << 16 * a | 0xFFFF << 16 * b
        for _ in range(size):
            fp = base & keep | rng.getrandbits(64) & ~keep
            out |= {fp, *(fp ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(rng.choice([0, 0, 0, 2])))}
    return sorted(out)


@pytest.mark.parametrize("group", [simhash.GROUP, 8])
def test_op7_groups_of_any_size_lose_no_link(spark, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)
    fps = np.array(families(3, 12, 60) + [0, 1, 3, 7, (1 << 64) - 1], np.uint64)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(4)
    roots = {r.node: r.root for r in simhash.components(simhash.links(df)).collect()}
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    root = fps.view(np.int64).copy()
    for _ in range(len(fps)):
        new = np.where(near, root[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (new == root).all():
            break
        root = new
    assert [roots.get(int(x), int(x)) for x in fps.view(np.int64)] == root.tolist()
    assert len(set(root.tolist())) < len(fps) - 100


def test_op7_pivots_discard_nearly_all_pairs_of_a_group_that_are_not_linked():
    fps = np.array(families(4, 1, 400), np.uint64)
    a, b = np.triu_indices(len(fps), 1)
    linked = np.bitwise_count(fps[a] ^ fps[b]) <= 2
    table = simhash.distances(fps, splitmix(simhash.PIVOTS, 7))
    left = simhash.possible(table[a], table[b], 2)
    assert left[linked].all() and linked.sum() > 50
    assert left[~linked].mean() < 0.01


def test_op7_repeated_rows_and_empty_table(spark):
    df = table(spark, [(3, "one two three four"), (3, "one two three four"), (None, "one two three four"), (None, "else")])
    assert sorted((r.doc_id or -1, r.text) for r in simhash.keep_one(df).collect()) == [(-1, "else"), (3, "one two three four")]
    assert simhash.near_duplicates(table(spark, [])).count() == 0 and simhash.keep_one(table(spark, [])).count() == 0


# 8. quality


def test_op8_learns_without_negatives(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(900):
        good = rng.random() < 0.7
        words = prose(1000 + i, 60).split()
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words), good))
    docs = table(spark, [(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (None, "a b")])
    labels = spark.createDataFrame([(i, int(g), 0) for i, _, g in rows if i % 3], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    assert 0.5 < model.prior < 0.9
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    assert len(got) == 903 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    out = [(got[i].predicted, g) for i, _, g in rows if got[i].held_out]
    assert np.mean([p == g for p, g in out]) > 0.95
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(900))
    assert quality.keep_good(docs, model).columns == docs.columns
    assert model.prior == quality.train(docs.repartition(7), labels).prior


def test_op8_without_labels_keeps_all(spark):
    docs = table(spark, [(1, "x"), (2, None)])
    model = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert model is None and {r.score for r in quality.score(docs, model).collect()} == {0.5}
    assert quality.keep_good(docs, model).count() == 2


# 9. decontamination


def brute_tiles(doc, item, n):
    md, mi, covered = set(), set(), 0
    while True:
        best = None
        for a in range(len(item)):
            for p in range(len(doc)):
                k = 0
                while a + k < len(item) and p + k < len(doc) and doc[p + k] == item[a + k] and p + k not in md and a + k not in mi:
                    k += 1
                if k >= n and (best is None or k > best[0]):
                    best = (k, p, a)
        if best is None:
            return covered
        k, p, a = best
        md |= set(range(p, p + k))
        mi |= set(range(a, a + k))
        covered += k


def test_op9_equals_brute_force(spark):
    a, b = prose(21, 40), prose(22, 25)
    w = a.split()
    docs = [
        (1, prose(23, 50) + " " + a + " " + prose(24, 20)), (2, " ".join(w[20:] + ["gap"] + w[:20])), (3, " ".join(w[:12])),
        (4, prose(25, 200)), (5, a.upper().replace(" ", ", ")), (6, None), (7, ""), (8, (b + " ") * 50), (9, " ".join(w[:30])), (None, b),
    ]
    items = [(1, a), (2, b), (3, "too short"), (4, None), (None, b)]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id): r.covered_words for r in decontam.contaminated(table(spark, docs), bench).collect()}
    want = {}
    for i, t in docs:
        for k, s in items:
            ws = decontam.words_of(s)
            if len(ws) >= 5 and (n := brute_tiles(decontam.words_of(t), ws, 5)) >= 0.6 * len(ws):
                want[i, k] = n
    assert got == want and (2, 1) in got and (3, 1) not in got
    kept = decontam.clean(table(spark, docs), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 6, 7]


def test_op9_blocks_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK", 10)
    items = [(k, prose(50 + k, 12)) for k in range(4)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = table(spark, [(k, "start " + t) for k, t in items] + [(9, prose(90, 30))])
    assert sorted(r[:2] for r in decontam.contaminated(docs, bench).collect()) == [(k, k) for k in range(4)]
    assert [r.doc_id for r in decontam.clean(docs, bench).collect()] == [9]
    assert decontam.contaminated(docs, bench.limit(0)).count() == 0 and decontam.clean(docs, bench.limit(0)).count() == 5
    assert decontam.contaminated(docs.filter(F.lit(False)), bench).count() == 0


def test_op9_unspaced_scripts_and_short_items(spark):
    items = [
        (1, "机器学习模型在测试集上的准确率是多少"), (2, "東京タワーの高さは、何メートルですか。"), (3, "กรุงเทพมหานครเป็นเมืองหลวงของประเทศไทย"),
        (4, "Who wrote Hamlet"), (5, "東京"), (6, "un «deux» trois—quatre… cinq\u3000six"), (7, "∀x∃y∀z"), (8, "हिन्दी भाषा कैसे लिखी जाती है"), (9, "…!"),
    ]
    docs = [
        (1, "前文。" + items[0][1] + "？后文"), (2, "あ東京タワーの高さは何メートルですか"), (3, "ก" + items[2][1]), (4, "So, who wrote 'Hamlet'?"),
        (5, "Hamlet wrote who"), (6, "un deux trois quatre cinq six"), (7, "(∀ x ∃ y ∀ z)"), (8, "x " + items[7][1] + "।"), (9, "京東、机器, x"), (10, None),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(r[:5] for r in decontam.contaminated(table(spark, docs), bench).collect())
    assert got == [
        (1, 1, 18, 18, 1), (2, 2, 17, 17, 1), (2, 5, 2, 2, 1), (3, 3, 38, 38, 1), (4, 4, 3, 3, 1), (6, 6, 6, 6, 1), (7, 7, 6, 6, 1), (8, 8, 6, 6, 1),
    ]
    assert sorted(r.doc_id for r in decontam.clean(table(spark, docs), bench).collect()) == [5, 9, 10]


def test_op4_words_are_encoded_once_without_case_and_signs():
    """Chunks share the ids of their words; ids are those of the whole text."""
    signs = "aAbJHTWYIKst019'’”\"().,;:!?- \t\ṉ̸̀́̌̇éÉñß×÷İıKΣςǅﬁ中あ②<>=|̈́ 　\x1c😀ʼ_"
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list(signs), rng.integers(0, 15))) for _ in range(5000)]
    texts += ["Word, word. WORD (word)", "it's IT'S don't", "<|endoftext|> a, B. <|EndOfText|>", "a</w> </w>", ""]
    from tokenizers import Tokenizer

    encoder = packing._Encoder(queries.tokenizer())
    tok = Tokenizer.from_file(queries.tokenizer())
    want = [np.array(c.ids, "<u4").tobytes() for c in tok.encode_batch_fast(texts, add_special_tokens=False)]
    assert encoder.ids([t.encode() for t in texts]) == want
    encoder.known.clear()
    encoder.ids([b"Word, word. WORD; word", b"wOrd"])
    assert set(encoder.known) == {b"word", b",", b".", b";"}


def test_op4_words_are_forgotten_beyond_a_number(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 20)
    encoder = packing._Encoder(queries.tokenizer())
    texts = [" ".join(f"w{'abcdefghij'[k % 10] * (k % 7 + 1)}x{k}, Ab" for k in range(n, n + 9)).encode() for n in range(0, 900, 9)]
    parts = [x for k in range(0, 100, 3) for x in encoder.ids(texts[k : k + 3])]
    assert parts == packing._Encoder(queries.tokenizer()).ids(texts)
    encoder.known.clear()
    assert [encoder.ids([t])[0] for t in texts] == parts
