"""Fixed schemas and tokens of the corpus data model."""

from __future__ import annotations

from pyspark.sql import types as T

# The missing-value tokens pandas' read_csv turns into NaN by
# default (kept verbatim so CSV input means the same thing).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Default label vocabulary, default per-label target.
DEFAULT_LABELS = ["Politics", "World", "Sports", "Economy"]
DEFAULT_TARGET = 5255

CORPUS = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)

CORPUS_ORDERED = T.StructType(
    [T.StructField("row_id", T.LongType()), T.StructField("part_no", T.IntegerType())] + CORPUS.fields
)

PAGES = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("html", T.StringType()),
    ]
)

ITEMS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("pos", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("href", T.StringType()),
    ]
)

FEEDS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("xml", T.StringType()),
    ]
)

SOURCES = T.StructType(
    [
        T.StructField("priority", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("pagination", T.StringType()),
        T.StructField("base_url", T.StringType()),
        T.StructField("start_page", T.IntegerType()),
        T.StructField("max_pages", T.IntegerType()),
        T.StructField("selectors", T.ArrayType(T.StringType())),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("use_keyword_filter", T.BooleanType()),
    ]
)

KEYWORDS = T.StructType([T.StructField("set_name", T.StringType()), T.StructField("keyword", T.StringType())])
