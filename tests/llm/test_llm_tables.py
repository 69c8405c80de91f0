"""Operators 1, 3, 6, 10 and the pipeline against brute-force versions."""

import json

import numpy as np
import pytest

from corpusforge.llm import licenses, queries, tools, topk, urls
from corpusforge.llm.common import splitmix
from tests.llm.test_llm_text import SCHEMA, base_spans, brute_components, brute_fingerprint, prose, table

# 1. tool calls

SCHEMAS = {"f": {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer", "minimum": 0}}, "additionalProperties": False}}


def test_op1_links_orders_validates(spark):
    calls = [
        (1, "a", None, 0, "f", '{"x": 1}'), (1, "b", "a", 5, "f", '{"x": -1}'), (1, "c", "b", 2, "f", '{"y": 1, "x": 2.0}'),
        (1, "c", "b", 9, "f", '{"x": 3}'), (1, "p", "q", 3, "f", "{bad"), (1, "q", "p", 4, "g", "{}"), (1, "r", "q", 6, "f", None),
        (2, "a", "gone", 0, "f", '{"x": "1"}'), (None, "a", None, 0, "f", '{"x": 1}'), (3, None, None, 1, "f", '{"x": 1}'),
    ]
    results = [(1, "a", 1, 'he said "é"\n'), (1, "b", 6, None), (1, "b", 7, "late"), (1, "zz", 8, "x"), (2, None, 1, "x"), (1, "c", 3, "\x01")]
    c = spark.createDataFrame([(*r, "m") for r in calls], "conv_id long, call_id string, parent_id string, turn long, name string, arguments string, message string")
    r = spark.createDataFrame(results, "conv_id long, call_id string, turn long, content string")
    rows = tools.link(c, r, SCHEMAS).collect()
    assert len(rows) == len(calls) + len(results)
    got = {(x.conv_id, x.call_id, x.kind, x.turn): x for x in rows}
    of = lambda *k: (got[k].status, got[k].depth, got[k].faults)
    assert of(1, "a", "call", 0) == ("linked", 0, "")
    assert of(1, "b", "call", 5) == ("linked", 2, "$.x:minimum")
    assert of(1, "c", "call", 2) == ("linked", 4, "$.y:additionalProperties")
    assert of(1, "c", "call", 9) == ("repeated", None, "")
    assert of(1, "p", "call", 3) == ("cycle", None, "$:json")
    assert of(1, "q", "call", 4) == ("cycle", None, "$:unknown tool")
    assert of(1, "r", "call", 6) == ("cycle", None, "$:json")
    assert of(2, "a", "call", 0) == ("unanswered", 0, "$.x:type")
    assert got[None, "a", "call", 0].status == "unanswered" and got[3, None, "call", 1].status == "unanswered"
    assert of(1, "a", "result", 1)[:2] == ("linked", 1) and of(1, "b", "result", 7)[0] == "repeated"
    assert of(1, "zz", "result", 8)[0] == "orphan" and got[2, None, "result", 1].status == "orphan"
    for x in rows:
        assert tools.canonical(json.loads(x.message)) == x.message
    assert tools.link(c.limit(0), r.limit(0), SCHEMAS).count() == 0


def test_op1_long_chain(spark):
    calls = [(7, f"c{k}", f"c{k - 1}" if k else None, k, "f", '{"x": 1}') for k in range(70)]
    c = spark.createDataFrame(calls, "conv_id long, call_id string, parent_id string, turn long, name string, arguments string")
    got = {r.call_id: r.depth for r in tools.depths(c.select("conv_id", "call_id", "parent_id")).collect()}
    assert got == {f"c{k}": k for k in range(70)}


@pytest.mark.parametrize(("schema", "value", "want"), [
    ({"exclusiveMinimum": 10, "const": 3}, 5, ["$:const", "$:exclusiveMinimum"]),
    ({"exclusiveMaximum": 5, "multipleOf": 0.1}, 0.3, []), ({"multipleOf": 0.1}, 0.35, ["$:multipleOf"]), ({"multipleOf": 2}, 1e300, []),
    ({"enum": [1]}, True, ["$:enum"]), ({"enum": [1, {"a": [1.0]}]}, {"a": [1]}, []), ({"const": None}, None, []),
    ({"pattern": "^a+$"}, "ab", ["$:pattern"]), ({"pattern": "b"}, "abc", []), ({"pattern": "b"}, 7, []),
    ({"minItems": 2, "uniqueItems": True, "items": {"type": "string"}}, ["x"], ["$:minItems"]),
    ({"uniqueItems": True}, [1, 1.0], ["$:uniqueItems"]), ({"uniqueItems": True}, [1, True, [1], {"a": 1}], []), ({"maxItems": 1}, [1, 2], ["$:maxItems"]),
    ({"additionalProperties": {"type": "integer"}, "properties": {"a": {}}}, {"a": "x", "b": "y"}, ["$.b:type"]),
    ({"minProperties": 1}, {}, ["$:minProperties"]), ({"maxProperties": 1}, {"a": 1, "b": 2}, ["$:maxProperties"]),
    ({"anyOf": [{"type": "string"}, {"minimum": 3}]}, 2, ["$:anyOf"]), ({"oneOf": [{"minimum": 1}, {"minimum": 3}]}, 4, ["$:oneOf"]),
    ({"oneOf": [{"minimum": 1}, {"minimum": 3}]}, 2, []), ({"allOf": [{"minimum": 1}, {"maximum": 0}]}, 0.5, ["$:minimum", "$:maximum"]),
    ({"not": {"type": "null"}}, None, ["$:not"]), (False, 1, ["$:false"]), (True, 1, []), ({"items": False}, [1], ["$[0]:false"]),
    ({"$defs": {"n": {"type": "integer"}}, "properties": {"a": {"$ref": "#/$defs/n"}}}, {"a": "x"}, ["$.a:type"]),
    ({"properties": {"kid": {"$ref": "#"}, "n": {"type": "integer"}}}, {"kid": {"kid": {"n": "x"}}}, ["$.kid.kid.n:type"]),
    ({"title": "t", "description": "d", "type": ["integer", "null"]}, None, []),
])
def test_op1_schema_keywords(schema, value, want):
    tools.check_schema(schema)
    assert tools.faults(value, schema) == want


@pytest.mark.parametrize("schema", [
    {"type": "text"}, {"properties": {"a": {"patternProperties": {}}}}, {"pattern": "("}, {"$ref": "#/$defs/gone"}, {"$ref": "http://x/y"},
    {"$ref": "#"}, {"$defs": {"a": {"anyOf": [{"$ref": "#/$defs/b"}]}, "b": {"$ref": "#/$defs/a"}}}, {"items": 3}, {"minimum": "1"}, {"multipleOf": 0},
    {"anyOf": [{"if": {}}]}, {"enum": 1}, [],
])
def test_op1_raises_before_the_job_for_schemas_it_cannot_check(schema):
    with pytest.raises(ValueError):
        tools.check_schema(schema)


def test_op1_other_roles_long_texts_and_ties_in_turn(spark, tmp_path):
    long_ = 'ü"\n' * 200_000
    turns = [(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", long_), (1, 3, "tool", "t"), (1, 4, None, None), (2, 0, "user", ""), (2, 0, "user", "tie"), (None, 0, "critic", "c")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    rows = queries.op1_chat_formatting(spark, str(tmp_path)).collect()
    assert len(rows) == len(turns)
    plain = sorted((r.message for r in rows if r.kind == "turn" and r.status == "plain" and r.depth is None and r.call_id is None))
    assert plain == ['{"content":"c","role":"critic","type":"turn"}', '{"content":"t","role":"tool","type":"turn"}', '{"content":null,"role":null,"type":"turn"}']
    assert next(json.loads(r.message)["content"] for r in rows if r.kind == "result") == long_
    assert sorted(r.status for r in rows if r.conv_id == 2) == ["repeated", "unanswered"]
    deep = "[" * 400 + "]" * 400
    calls = spark.createDataFrame([(1, "a", None, 0, "f", deep)], "conv_id long, call_id string, parent_id string, turn long, name string, arguments string")
    results = spark.createDataFrame([], "conv_id long, call_id string, turn long, content string")
    assert tools.link(calls, results, {"f": {"items": {"$ref": "#"}}}).first().faults in ("", "$:depth")


# 3. licenses


def test_op3_finds_notices(spark):
    apache = licenses.NOTICES["Apache-2.0"]
    long_ = prose(31, 120)
    rows = [
        (1, prose(1, 300) + " " + apache.upper() + ". " + prose(2, 300)), (2, "Released under the MIT License."), (3, prose(3, 200)),
        (4, None), (5, ""), (6, "Licensed under the Apache"), (7, prose(4, 37) + " " + long_ + " " + prose(5, 41)), (7, prose(6, 9)),
        (None, "x " * 2000 + "Released under the MIT License"), (8, " ".join(long_.split()[:60])),
        (9, " ".join(w if k != 60 else "other" for k, w in enumerate(long_.split()))),
    ]
    bank = licenses.templates_of(spark, licenses.NOTICES | {"long": long_, "tiny": "MIT"})
    got = {(r.doc_id, r.license_id): r for r in licenses.scan(table(spark, rows), bank).collect()}
    assert set(got) == {(1, "Apache-2.0"), (2, "MIT"), (7, "long"), (None, "MIT"), (9, "long")}
    assert got[2, "MIT"].containment == 1.0 and got[2, "MIT"].start_word == 0
    first = got[1, "Apache-2.0"]
    assert first.start_word <= 300 and first.start_word + first.n_words >= 309
    assert got[9, "long"].containment == pytest.approx(111 / 116)
    assert licenses.scan(table(spark, []), bank).count() == 0 and licenses.scan(table(spark, rows), bank.limit(0)).count() == 0


def test_op3_bands_hold_their_guarantee():
    for low, high, width, stride in licenses.widths([1, 3, 8, 9, 150, 170, 400]):
        assert low / width >= 0.5 and width - stride + 1 >= high
    assert len({int(x) for x in splitmix(64, 11)}) == 64


def test_op3_bands_find_windows_at_the_least_containment():
    for low, _, width, _ in licenses.widths([1, 3, 5, 8, 150, 400, 6000]):
        held = -(-low * 4 // 5)
        assert (1 - held / (low + width - held)) ** licenses.bands(low, width, 0.8) <= licenses.MISS


def test_op3_banks_of_any_size(spark, monkeypatch):
    parts = [prose(60 + k, 20 + 9 * k) for k in range(5)]
    docs = table(spark, [(k, prose(80 + k, 30) + " " + t + " " + prose(90 + k, 7)) for k, t in enumerate(parts)] + [(9, prose(99, 200))])
    bank = spark.createDataFrame([(f"l{k // 2}", t) for k, t in enumerate(parts)], "license_id string, text string")
    whole = sorted(map(tuple, licenses.scan(docs, bank).collect()))
    assert [r[:3] for r in whole] == [(k, f"l{k // 2}", 1.0) for k in range(5)]
    monkeypatch.setattr(licenses, "TEMPLATE_SHINGLES", 30)
    assert sorted(map(tuple, licenses.scan(docs, bank).collect())) == whole


# 6. top-k


def brute_topk(rows, k):
    good = {(i, tuple(np.floor(256.0 * np.array(v, np.float64)))) for i, v in rows if v is not None and i is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, q in good:
        if i % 50 == 0:
            best = sorted(((-int(np.dot(q, v)), j) for j, v in good if j != i and len(v) == len(q)))
            best = list(dict.fromkeys(best))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 37])
def test_op6_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(400)]
    rows += [(1000 + k, rows[0][1]) for k in range(60)] + [(2000, None), (2050, [None] * 8), (2100, [float("nan")] + [0.0] * 7), (2150, [float("inf")] * 8)]
    rows += [(3000, [1.0, 2.0]), (3001, [0.5, 0.5]), (None, [0.0] * 8), (3050, [0.0] * 8), (50, rows[50][1])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, vector string").repartition(3)
    got = topk.search(topk.quantized(df), topk.F.col("vec_id") % 50 == 0, 5)
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, 5)
    assert topk.search(topk.quantized(df.limit(0)), topk.F.col("vec_id") % 50 == 0, 5).count() == 0


def test_op6_query_chunks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(401)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.search(topk.quantized(df), topk.F.col("vec_id") % 50 == 0, 5)
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, 5)


@pytest.mark.parametrize("block", [4096, 37])
def test_op6_ids_with_several_vectors(spark, block, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", 7)
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(200)]
    rows += [(50, [9.0, 0.0, 0.0, 0.0]), (250, [9.0, 0.0, 0.0, 0.0]), (300, rows[50][1]), (350, [1.0] * 4), (350, [1.0] * 4)]
    rows += [(400, [5.0 + k / 4, 5.0, 5.0, 5.0]) for k in range(90)] + [(401, [6.0, 5.0, 5.0, 5.0]), (450, [5.0] * 4)]
    rows += [(403, [8.0, 1.0, 0.0, 0.0]), (403, [8.0, 0.0, 1.0, 0.0]), (500, [1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = topk.search(topk.quantized(df), topk.F.col("vec_id") % 50 == 0, 5)
    # as in the SQL: ranks over all pairs of a query_id
    good = {(i, tuple(np.floor(256.0 * np.array(v)))) for i, v in rows}
    want = []
    for i in {i for i, _ in good if i % 50 == 0}:
        pairs = sorted((-int(np.dot(q, v)), j) for a, q in good if a == i for j, v in good if j != i)
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(pairs[:5])]
    assert sorted(map(tuple, got.collect())) == sorted(want)


# 10. URLs


def test_op10_rules_and_trees(spark):
    rows = [(k, f"https://h{k % 7}.example.{'com' if k % 2 else 'org'}/{('fr', 'de')[k % 4 // 2]}/{k}?a={k}") for k in range(120)]
    rows += [
        (200, None), (201, "no scheme"), (202, "http://EXAMPLE.org/es/1"), (203, "http://a.example.org/en/12#x"), (204, "x://y.org"),
        (205, "http://example.net/?q=http://b.com/fr/"), (206, "http://myorg/"), (207, "http://org/x"), (208, "http://a.com/fr"),
        (209, "http://a.com?/fr/"), (None, "ftp://c.com/de/1"), (210, "http://z.net/" + "a" * 5000),
    ]
    df = spark.createDataFrame([(i, u, "h", "kept") for i, u in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in urls.judge(df).collect()}
    assert len(got) == len(rows) and all(r.verdict in ("allow", "block") for r in got.values())
    of = lambda i: (got[i].host, got[i].path, got[i].rule)
    assert of(200) == of(201) == ("", "", None)
    assert of(202) == ("example.org", "/es/1", "example.org/es/") and got[202].verdict == "block"
    assert of(203) == ("a.example.org", "/en/12", "example.org/en/1") and of(204) == ("y.org", "", None)
    assert of(205) == ("example.net", "/", None) and of(206) == ("myorg", "/", None) and of(207)[2] == "org/"
    assert of(208)[2] is None and of(209) == ("a.com", "", None) and got[None].verdict == "block"
    assert got[1].rule == "com/fr/" and got[3].verdict == "block"
    assert all(r.score is not None for r in got.values())


def test_op10_without_examples_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.net/"), (2, "http://a.org/")], "page_id long, url string")
    assert {(r.page_id, r.verdict, r.score) for r in urls.judge(df).collect()} == {(1, "allow", None), (2, "allow", None)}
    assert urls.judge(df.limit(0)).count() == 0


# pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    leak = prose(500, 30)
    rows = [(i, prose(i, 40 + i % 50)) for i in range(200)]
    rows += [(300 + i, " ".join(w.upper() + "!!" for w in prose(700 + i, 50).split())) for i in range(60)]
    rows += [(400, rows[3][1]), (401, prose(801, 20) + " " + leak), (402, "write to me a@b.cc " + prose(802, 30)), (403, None)]
    table(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i < 300), 0) for i, _ in rows[:260] if i % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = docs
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() <= before.count()
    ids = lambda n: {r.doc_id for r in seen[n].collect()}
    good = seen["quality_classifier"].collect()
    assert not any(300 <= r.doc_id < 360 for r in good) and len(good) >= 195
    comps = brute_components([brute_fingerprint(r.text) for r in good])
    assert len(ids("simhash_near_dedup")) == len(set(comps)) and 400 not in ids("simhash_near_dedup")
    assert ids("simhash_near_dedup") - ids("benchmark_decontamination") == {401} & ids("simhash_near_dedup")
    text = {r.doc_id: r.text for r in seen["pii"].collect()}
    assert set(text) == ids("benchmark_decontamination") and not any(base_spans(t or "") for t in text.values())
    packed = seen["best_fit_packing"]
    assert {r.doc_id for r in packed.collect()} == set(text)
    again = corpus_pipeline.run(spark, str(tmp_path))
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, again.select(key).collect())) == sorted(map(tuple, packed.select(key).collect()))


def test_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert SCHEMA
