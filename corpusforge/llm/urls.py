"""URL filters (operator 10): rules first, then gradient-boosted trees on
lexical features, trained from the URLs that the rules label.

Features: length, depth, digit ratio, entropy of the characters, parameter
counts and statistics of the host's suffix (how common it is, and how often the
rules allow it).  Training takes at most about ``SAMPLE`` labelled URLs, chosen
by a hash of the URL; every URL is judged.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import staged

SAMPLE = 20_000
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
FEATURES = (
    "length", "host_length", "path_length", "depth", "labels", "digits", "host_digits", "hyphens", "entropy", "host_entropy",
    "parameters", "fragment", "extension", "secure", "suffix_share", "suffix_allowed",
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty without ``://``."""
    host = F.translate(F.regexp_extract(url, r"(?s)^(?:(?!://).)*+://([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(url, r"(?s)^(?:(?!://).)*+://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    rule = verdict = None
    for text, says in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    return rule, verdict


def _ratio(text: Column, pattern: str) -> Column:
    return (F.length(F.regexp_replace(text, pattern, "")) / F.greatest(F.lit(1), F.length(text))).cast("double")


def _entropy(text: Column) -> Column:
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.greatest(F.lit(1), F.length(text))
    one = lambda c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    term = lambda c: -(one(c) / n) * F.log2(F.greatest(F.lit(1), one(c)) / n)
    return F.aggregate(F.transform(F.array_distinct(chars), term), F.lit(0.0), lambda a, x: a + x)


def _features(pages: DataFrame) -> DataFrame:
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    number = lambda c: c.cast("double")
    return pages.withColumns({
        "length": number(F.length(url)),
        "host_length": number(F.length("host")),
        "path_length": number(F.length("path")),
        "depth": number(F.size(F.filter(F.split("path", "/"), lambda x: x != ""))),
        "labels": number(F.size(F.split("host", r"\."))),
        "digits": _ratio(url, "[^0-9]"),
        "host_digits": _ratio(F.col("host"), "[^0-9]"),
        "hyphens": number(F.length(F.regexp_replace("host", "[^-]", ""))),
        "entropy": _entropy(url),
        "host_entropy": _entropy(F.col("host")),
        "parameters": F.when(query != "", number(F.size(F.split(query, "&")))).otherwise(0.0),
        "fragment": number(url.contains("#")),
        "extension": number(F.rlike("path", F.lit(r"\.[A-Za-z0-9]{1,5}$"))),
        "secure": number(url.startswith("https:")),
        "suffix": F.regexp_extract("host", r"([^.]*)$", 1),
    })


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, sample: int = SAMPLE, rounds: int = 10) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict,
    and score (of the trees: how likely a rule would allow it; null where the
    rules give no examples of both kinds).

    Without a fitting rule the verdict is the trees': allow from 0.5 on; allow
    too where there are no trees.  A null URL, or one without ``://``, has an
    empty host and path.  Null and repeated ids are returned as they are; other
    columns are ignored; an empty table gives no rows."""
    host, path = parts(F.col("url"))
    split = pages.select(F.col("page_id"), "url", host.alias("host"), path.alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    base = staged(_features(split.withColumns({"rule": rule, "said": said})), "urls")
    allowed = F.col("said") == "allow"
    suffixes = base.groupBy("suffix").agg(
        F.count("*").alias("n"), F.count("said").alias("n_said"), F.count_if(allowed).alias("n_allowed")
    )
    totals = suffixes.agg(F.sum("n"), F.sum("n_said"), F.sum("n_allowed")).first()
    n, n_said, n_allowed = (int(x or 0) for x in totals)
    columns = ("page_id", "host", "path", "rule")
    if not 0 < n_allowed < n_said:
        return base.select(*columns, F.coalesce("said", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score"))
    rate = n_allowed / n_said
    stats = suffixes.select(
        "suffix", (F.col("n") / n).alias("suffix_share"), ((F.col("n_allowed") + 10 * rate) / (F.col("n_said") + 10)).alias("suffix_allowed")
    )
    whole = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(base.join(stats, "suffix"))
    part = int(min(1.0, sample / n_said) * (1 << 30))
    taken = whole.filter("said is not null").filter(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < part)
    examples = staged(taken.select("features", allowed.cast("double").alias("label")).sort("label", F.xxhash64("features")), "url-examples")
    if examples.select("label").distinct().count() < 2:
        return base.select(*columns, F.coalesce("said", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score"))
    trees = GBTClassifier(maxIter=rounds, maxDepth=4, seed=1, stepSize=0.3).fit(examples)
    score = vector_to_array("probability")[1]
    return trees.transform(whole).select(
        *columns, F.coalesce("said", F.when(score >= 0.5, "allow").otherwise("block")).alias("verdict"), score.alias("score")
    )
