"""Personal data (operator 5), with DataFrame functions only.

* **Propose**: one regular expression for each kind gives its matches and the
  text between them, and so the place of each match.
* **Confirm**: a checksum or range rule drops matches: Luhn for cards, modulo
  97 for IBANs (as long as their country code says), parts up to 255 for addresses, the number of digits for phones.
* **Score**: a kind starts with its own score, and words of its context within
  ``REACH`` characters on either side raise it, whatever else stands between
  (other matches of the kind too).  Spans under ``THRESHOLD`` are
  dropped; the base kinds (email, ip, card, phone) start above it, so context
  only ranks them, while a social-security number needs its context.

The expressions are written so that none looks at a text position more than a
fixed number of times: possessive repeats, and a look-behind that keeps a match
from being tried inside a run that has already failed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REACH = 40
THRESHOLD = 0.5
BLOCK = 256
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: Length of a country's IBANs: the registry of ISO 13616, and countries that use the form without an entry.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU",
}


def _iban() -> str:
    """Proposes an IBAN at each place where one may begin: group 1 is as long as
    the country says, or as far as it goes for other codes.  Only its first four
    characters are consumed, so that it doesn't hide one that begins inside it."""
    group = " ?[A-Z0-9]"
    ends = lambda n: f"(?:{group}{{4}}){{{n // 4 - 1}}}" + (f"{group}{{{n % 4}}}" if n % 4 else "")
    known = [f"(?:{codes.replace(' ', '|')})[0-9]{{2}}{ends(n)}" for n, codes in IBAN_LENGTHS.items()]
    codes = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
    other = f"(?!{codes})[A-Z]{{2}}[0-9]{{2}}(?:{group}{{4}}){{2,7}}+(?:{group}{{1,3}})?+"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?=({'|'.join([*known, other])})(?![A-Za-z0-9])).{{4}}"


_IBAN = _iban()
#: Kinds whose match is group 1, of which the pattern consumes so many characters.
AHEAD = {"iban": 4}
#: kind: pattern, a character or class that every match has, score, words of its context
KINDS: dict[str, tuple[str, str, float, str]] = {
    "email": (rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++", "@", 0.9, r"e-?mail|contact|write|reach|mailto"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", ".", 0.6, r"\bip\b|address|host|server|client|login|logged"),
    "card": (r"[0-9](?:[ -]?[0-9])++", "", 0.8, r"card|visa|master|amex|credit|debit|payment|cvv|expir"),
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", "+", 0.7, r"phone|call|tel\b|mobile|cell|fax|whatsapp"),
    "iban": (_IBAN, "", 0.8, r"iban|bank|account|konto|transfer|bic|swift"),
    "ssn": (r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "-", 0.3, r"\bssn\b|social security"),
}
BASE = ("email", "ip", "card", "phone")


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _chars(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""

    def add(at: Column, d: Column) -> Column:
        twice = d.cast("int") * F.when(at["odd"], 2).otherwise(1)
        return F.struct((at["sum"] + F.when(twice > 9, twice - 9).otherwise(twice)).alias("sum"), (~at["odd"]).alias("odd"))

    start = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd"))
    return F.aggregate(_chars(F.reverse(digits)), start, add, lambda at: at["sum"] % 10 == 0)


def mod97(iban: Column) -> Column:
    """Whether an IBAN (capitals and digits) leaves 1 modulo 97."""
    turned = F.concat(F.substring(iban, 5, 100), F.substring(iban, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        v = F.conv(c, 36, 10).cast("int")
        return (rest * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(_chars(turned), F.lit(0), add) == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        short = lambda p: F.length(p := F.regexp_replace(p, "^0+(?=.)", "")) <= 3
        part = lambda p: F.when(short(p), F.regexp_replace(p, "^0+(?=.)", "").cast("int") <= 255).otherwise(False)
        return F.forall(F.split(match, r"\."), part)
    if kind == "card":
        d = _digits(match)
        return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    if kind == "iban":
        bare = F.replace(match, F.lit(" "), F.lit(""))
        return F.when(F.length(bare).between(15, 34), mod97(bare)).otherwise(False)
    return F.lit(True)


def _before(sizes: Column) -> Column:
    """Sums of the elements before each element.  In blocks, since an array
    grows by being copied: the work stays near linear for long arrays."""

    def sums(xs: Column) -> Column:
        start = F.array(F.lit(0))
        return F.aggregate(xs, start, lambda at, x: F.array_append(at, F.element_at(at, -1) + x))

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")), lambda b: F.slice(sizes, b * BLOCK + 1, BLOCK)
    )
    inner = F.transform(blocks, sums)
    outer = sums(F.transform(inner, lambda x: F.element_at(x, -1)))
    shift = lambda x, o: F.transform(F.slice(x, 1, F.size(x) - 1), lambda y: y + o)
    return F.flatten(F.filter(F.zip_with(inner, outer, shift), lambda x: x.isNotNull()))


def _near(start: Column, end: Column) -> Column:
    """``REACH`` characters of the text before ``start`` and after ``end``,
    whatever is proposed there.  Taken from its block and the next one, since a
    place in a string is found by counting from the beginning."""
    block = lambda k: F.coalesce(F.get("_blocks", k.cast("int")), F.lit(""))
    a, b = F.floor(start / BLOCK), F.floor(end / BLOCK)
    left = F.concat(block(a - 1), F.left(block(a), start % BLOCK))
    right = F.concat(F.substr(block(b), end % BLOCK + 1), block(b + 1))
    return F.concat(F.right(left, F.lit(REACH)), F.lit(" "), F.left(right, F.lit(REACH)))


_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def _spans(df: DataFrame, kind: str) -> DataFrame:
    """Adds column ``kind``: its confirmed and scored spans, in order of start."""
    pattern, needs, score, words = KINDS[kind]
    match = F.regexp_extract_all("_text", F.lit(pattern), F.lit(1 if kind in AHEAD else 0))
    used = lambda m: F.lit(AHEAD[kind]) if kind in AHEAD else F.length(m)
    if needs:
        match = F.when(F.contains("_text", F.lit(needs)), match)
    df = df.withColumn("_match", match)
    some = F.size("_match") > 0
    df = df.withColumn("_gap", F.when(some, F.split("_text", pattern, -1)))
    n = F.size("_match")
    left = F.slice("_gap", 1, n)
    before = _before(F.zip_with(left, "_match", lambda g, m: F.length(g) + used(m)))
    # one array, so that nothing above is computed again for each element
    items = F.arrays_zip(F.col("_match").alias("m"), before.alias("b"), left.alias("l"))

    def span(x: Column) -> Column:
        start = x["b"] + F.length(x["l"])
        end = start + F.length(x["m"])
        bonus = F.when(F.rlike(F.lower(_near(start, end)), F.lit(words)), 0.3).otherwise(0.0)
        return F.struct(
            F.lit(kind).alias("kind"), start.cast("int").alias("start"), end.cast("int").alias("end"),
            F.least(F.lit(1.0), F.round(F.lit(score) + bonus, 2)).alias("score"), _valid(kind, x["m"]).alias("ok"),
        )

    kept = F.filter(F.transform(items, span), lambda s: s["ok"] & (s["score"] >= THRESHOLD))
    bare = F.transform(kept, lambda s: F.struct(s["kind"], s["start"], s["end"], s["score"]))
    return df.withColumn(kind, F.when(some, bare).otherwise(F.array().cast(_SPAN))).drop("_match", "_gap")


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``_spans``: spans (kind, start, end, score) of
    every whole text, by kind as listed in ``KINDS``, then by start; positions
    are code points, the end is exclusive.  A null text is empty."""
    df = docs.withColumn("_text", F.coalesce("text", F.lit("")))
    df = df.withColumn("_blocks", F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))
    names = {k: f"_{k}" for k in KINDS}
    for kind, name in names.items():
        df = _spans(df, kind).withColumnRenamed(kind, name) if kind not in docs.columns else _aside(df, kind, name)
    return df.withColumn("_spans", F.concat(*names.values())).drop("_text", "_blocks", *names.values())


def _aside(df: DataFrame, kind: str, name: str) -> DataFrame:
    """As ``_spans``, where the table has a column of the kind's name."""
    held = f"_held_{kind}"
    return _spans(df.withColumnRenamed(kind, held), kind).withColumnRenamed(kind, name).withColumnRenamed(held, kind)


def _joined(spans: Column, *more: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"], *[s[m] for m in more])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_email, n_ip, n_card,
    n_phone, base_sha256 (of the base spans), spans (all), scores (all, with
    their scores).  A null or empty text has no spans; null and repeated ids are
    returned as they are; other columns are ignored; an empty table gives no
    rows."""
    found = find(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("_spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id", *[count(k) for k in BASE], F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("_spans")).alias("spans"), _joined(F.col("_spans"), "score").alias("scores"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (of spans that
    overlap, the one that starts first, then the longer one, then by kind), and
    ``n_chars`` counted anew where the table has it.  A null text stays null;
    columns of any name stay as they are; an empty table gives no rows."""
    # the row as one column: none of its names meets one that the search uses
    found = find(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), "text")).withColumn("_source", F.col("text"))

    def sooner(a: Column, b: Column) -> Column:
        return (
            F.when(a["start"] != b["start"], a["start"] - b["start"]).when(a["end"] != b["end"], b["end"] - a["end"]).otherwise(F.lit(0))
        )

    empty = "array<struct<after:int,upto:int,tag:string>>"

    def add(at: Column, s: Column) -> Column:
        tag = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        one = F.struct(at["end"].alias("after"), s["start"].alias("upto"), tag.alias("tag"))
        more = F.struct(F.array_append(at["gaps"], one).alias("gaps"), s["end"].alias("end"))
        return F.when(s["start"] >= at["end"], more).otherwise(at)

    def add_all(at: Column, spans: Column) -> Column:
        # BLOCK spans at a time, since each step copies what it has so far
        begin = F.struct(F.array().cast(empty).alias("gaps"), at["end"].alias("end"))
        return F.aggregate(
            spans, begin, add, lambda x: F.struct(F.array_append(at["steps"], x["gaps"]).alias("steps"), x["end"].alias("end"))
        )

    def between(after: Column, upto: Column) -> Column:
        # from the blocks it lies in, as a place in a string is found by counting from the beginning
        first = F.floor(after / BLOCK).cast("int")
        part = F.array_join(F.slice("_parts", first + 1, F.floor(upto / BLOCK).cast("int") - first + 1), "")
        return F.substr(part, after % BLOCK + 1, upto - after)

    found = found.withColumn("_sorted", F.array_sort("_spans", sooner))
    last = F.floor((F.size("_sorted") - 1) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice("_sorted", k * BLOCK + 1, BLOCK))
    start = F.struct(F.array().cast(f"array<{empty}>").alias("steps"), F.lit(0).alias("end"))
    done = F.aggregate(blocks, start, add_all, lambda at: F.struct(F.flatten(at["steps"]).alias("gaps"), at["end"].alias("end")))
    found = found.withColumn("_done", F.when(F.size("_spans") > 0, done))
    found = found.withColumn("_parts", F.when(F.size("_spans") > 0, F.regexp_extract_all("_source", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))
    pieces = F.transform(F.col("_done.gaps"), lambda g: F.concat(between(g["after"], g["upto"]), g["tag"]))
    whole = F.concat(F.array_join(pieces, ""), between(F.col("_done.end"), F.length("_source")))
    out = found.withColumn("text", F.when(F.size("_spans") > 0, whole).otherwise(F.col("_source")))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])
