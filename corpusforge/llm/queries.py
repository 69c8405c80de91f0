"""One query for each operator of this package, over its whole table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm import boilerplate, decontam, lexical, licenses, packing, pii, quality, simhash, spelling, suffix_dedup, tools, topk, urls
from corpusforge.llm.common import table

#: Schemas of the two calls that op1 makes of the turns.
SCHEMAS = {
    "ask": {
        "type": "object",
        "required": ["text", "turn", "words"],
        "additionalProperties": False,
        "properties": {
            "text": {"type": "string", "minLength": 1, "maxLength": 400},
            "turn": {"type": "integer", "minimum": 0},
            "words": {"type": "integer", "minimum": 1, "maximum": 60},
        },
    },
    "configure": {"type": "object", "required": ["text", "tools"], "properties": {"text": {"type": "string"}}},
}


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool calls of ``conversations``.  The table has no tool turns, so its own
    turns are read as such: a user's turn calls ``ask`` and a system turn
    ``configure``, each depending on the call two turns earlier; an assistant's
    turn is the result of the call one turn earlier.  Turns of other roles, or
    of none, come back as they are."""
    turns = table(spark, sf_dir, "conversations")
    n_words = F.size(F.filter(F.split("text", "[ \\n]+"), lambda w: w != ""))
    of = lambda back: F.concat(F.lit("c"), (F.col("turn") - back).cast("string"))
    calls = turns.filter("role in ('user', 'system')").select(
        "conv_id", of(0).alias("call_id"), of(2).alias("parent_id"), "turn",
        F.when(F.col("role") == "user", "ask").otherwise("configure").alias("name"),
        F.to_json(F.struct(n_words.alias("words"), "turn", "text")).alias("arguments"),
    )
    results = turns.filter("role = 'assistant'").select("conv_id", of(1).alias("call_id"), "turn", F.col("text").alias("content"))
    others = turns.filter("role is null or role not in ('user', 'system', 'assistant')")
    return tools.link(calls, results, SCHEMAS, others.select("conv_id", "turn", "role", F.col("text").alias("content")))


OP1_SQL = r"""
WITH t AS (SELECT conv_id, turn, role, text FROM conversations),
     c AS (SELECT *, 'c' || turn AS call_id, 'c' || (turn - 2) AS parent_id,
                  CASE role WHEN 'user' THEN 'ask' ELSE 'configure' END AS name,
                  len([w FOR w IN regexp_split_to_array(text, '[ \n]+') IF w <> '']) AS words,
                  turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island
           FROM t WHERE role IN ('user', 'system')),
     d AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) - 1 AS above FROM c),
     a AS (SELECT conv_id, turn, text, 'c' || (turn - 1) AS call_id FROM t WHERE role = 'assistant')
SELECT d.conv_id, d.call_id, d.turn, 'call' AS kind,
       CASE WHEN a.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status, 2 * above AS depth,
       CASE WHEN name = 'configure' THEN '$.tools:required' ELSE concat_ws(',',
         CASE WHEN length(d.text) < 1 THEN '$.text:minLength' WHEN length(d.text) > 400 THEN '$.text:maxLength' END,
         CASE WHEN words < 1 THEN '$.words:minimum' WHEN words > 60 THEN '$.words:maximum' END) END AS faults,
       '{"arguments":{"text":' || to_json(d.text)::VARCHAR || ',"turn":' || d.turn || ',"words":' || words || '},"depends_on":"'
         || parent_id || '","id":"' || d.call_id || '","name":"' || name || '","type":"tool_call"}' AS message
FROM d LEFT JOIN a ON a.conv_id = d.conv_id AND a.call_id = d.call_id
UNION ALL
SELECT a.conv_id, a.call_id, a.turn, 'result', CASE WHEN d.call_id IS NULL THEN 'orphan' ELSE 'linked' END, 2 * above + 1, NULL,
       '{"content":' || to_json(a.text)::VARCHAR || ',"id":"' || a.call_id || '","type":"tool_result"}'
FROM a LEFT JOIN d ON a.conv_id = d.conv_id AND a.call_id = d.call_id
UNION ALL
SELECT conv_id, NULL, turn, 'turn', 'plain', NULL, NULL,
       '{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"role":' || coalesce(to_json(role)::VARCHAR, 'null') || ',"type":"turn"}'
FROM t WHERE role IS NULL OR role NOT IN ('user', 'system', 'assistant')
"""


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"), depth=100)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.templates_of(spark, licenses.NOTICES))


def _op3_sql() -> str:
    """Containment of every template in every window, without bands."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    words = lambda x: f"list_filter(string_split_regex(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    k = licenses.SHINGLE
    shingles = f"list_transform(range(1, greatest(0, len(words) - {k - 1}) + 1), lambda i: array_to_string(words[i:i + {k - 1}], ' '))"
    sizes = [len(re.findall(r"[^\W_]+", x)) - k + 1 for x in licenses.NOTICES.values()]
    notices = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in licenses.NOTICES.items())
    classes = ", ".join(str(c) for c in licenses.widths([n for n in sizes if n > 0]))
    return f"""
WITH notice(license_id, text) AS (VALUES {notices}),
     class(low, high, width, stride) AS (VALUES {classes}),
     known AS (SELECT license_id, list_distinct({shingles}) AS own
               FROM (SELECT license_id, {words("text")} AS words FROM notice)),
     t AS (SELECT license_id, own, width, stride FROM known JOIN class ON len(own) BETWEEN low AND high),
     d AS (SELECT doc_id, {shingles} AS s FROM (SELECT DISTINCT doc_id, {words("coalesce(text, '')")} AS words FROM documents)),
     w AS (SELECT doc_id, license_id, own, width, stride, s,
                  unnest(range(0, greatest(0, CAST(ceil((len(s) - width) / stride) AS BIGINT)) + 1)) AS n
           FROM d JOIN t ON list_has_any(s, own)),
     c AS (SELECT doc_id, license_id, CAST(n * stride AS INTEGER) AS start_word, own, s[n * stride + 1 : n * stride + width] AS part FROM w),
     f AS (SELECT doc_id, license_id, len(list_intersect(own, part)) / len(own) AS containment, start_word,
                  CAST(len(part) + {k - 1} AS INTEGER) AS n_words FROM c)
SELECT doc_id, license_id, containment, start_word, n_words FROM f WHERE containment >= {licenses.CONTAINMENT}
QUALIFY row_number() OVER (PARTITION BY doc_id, license_id ORDER BY containment DESC, start_word) = 1
"""


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer(), capacity=2048)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantized(table(spark, sf_dir, "embeddings"), scale=256)
    return topk.search(vectors, F.col("vec_id") % 50 == 0, k=5)


OP6_SQL = """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
           WHERE embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
     r AS (SELECT query_id, vec_id, score,
                  row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, bits=2)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.extract(table(spark, sf_dir, "pages"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


OP13_SQL = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
     q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
     d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
     s AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM d),
     f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
     v AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY term),
     r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
           FROM q JOIN v USING (term) JOIN f USING (term) JOIN d USING (doc_id), s GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 50
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_formatting, op2_suffix_dedup, op3_license_scan, op4_best_fit_packing, op5_pii, op6_topk_search, op7_simhash,
        op8_quality, op9_decontamination, op10_url_filter, op11_html_extraction, op12_spelling_variants,
        op13_ranked_search,
    )
}
#: Those that SQL can express.
ORACLE = {"op1_chat_formatting": OP1_SQL, "op3_license_scan": _op3_sql(), "op6_topk_search": OP6_SQL, "op13_ranked_search": OP13_SQL}
