"""Many keyword sets in one pass over the texts.

``contains`` for each keyword reads every text as often as there are keywords.
Here each keyword is filed under its rarest triple of characters within a word
(its words, if all are shorter); a text's distinct words give the triples that
are looked up in that index, and only the keywords that they bring are tested
with ``contains``.  So the cost of a text follows from its length, whether there
are forty keywords or forty thousand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM = 3
#: Keywords up to which the index goes to every task (some 100 bytes each); beyond, texts' triples are shuffled to it.
BROADCAST_KEYWORDS = 200_000


def _grams(text: Column, n: int) -> Column:
    """Runs of ``n`` characters without a space, from one scan of the text."""
    return F.regexp_extract_all(text, F.lit(f"(?=([^ ]{{{n}}}))"), F.lit(1))


def keyword_index(keywords: DataFrame) -> DataFrame:
    """(gram, set_name, keyword): each keyword under the gram that the fewest
    other keywords hold; one of spaces alone lies under a space.  Empty and null
    keywords match nothing."""
    kw = keywords.select("set_name", "keyword").filter(F.length("keyword") > 0).distinct()
    triples, words = _grams(F.col("keyword"), GRAM), F.array_remove(F.split("keyword", " "), "")
    grams = F.when(F.size(triples) > 0, triples).when(F.size(words) > 0, words).otherwise(F.array(F.lit(" ")))
    each = kw.select("set_name", "keyword", F.explode(F.array_distinct(grams)).alias("gram"))
    common = each.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = Window.partitionBy("set_name", "keyword").orderBy("n", "gram")
    return each.join(common, "gram").withColumn("_r", F.row_number().over(rarest)).filter("_r = 1").select("gram", "set_name", "keyword")


def keyword_sets(df: DataFrame, keys: Sequence[str], text: Column, keywords: DataFrame) -> DataFrame:
    """(keys..., set_name, n_keywords): for every row the sets of which
    ``text`` contains a keyword, and how many.  ``keys`` name a row; rows that
    share them count as one, a null text contains nothing."""
    index = keyword_index(keywords)
    sizes = index.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.length("gram")).alias("lengths")).first()  # up to three lengths
    if not sizes["n"]:
        return df.select(*keys, F.lit("").alias("set_name"), F.lit(0).cast("long").alias("n_keywords")).limit(0)
    if sizes["n"] <= BROADCAST_KEYWORDS:
        index = F.broadcast(index)
    words = F.array_join(F.array_distinct(F.split("_text", " ")), " ")
    grams = F.concat(F.array(F.lit(" ")), *(_grams(words, n) for n in sorted(sizes["lengths"])))
    rows = df.select(*keys, text.alias("_text")).select(*keys, "_text", F.explode(F.array_distinct(grams)).alias("gram"))
    hits = rows.join(index, "gram").filter(F.col("_text").contains(F.col("keyword")))
    return hits.groupBy(*keys, "set_name").agg(F.count_distinct("keyword").alias("n_keywords"))
