"""P1/P2/P3 expressions against Python's own str semantics."""

from pyspark.sql import functions as F

from corpusforge.functions.text import (
    cut_first_hyphen, keyword_any, keyword_any_array, classify_label, looks_like_xml, norm_text, strip_ws, title_case,
)

EDGE = [
    "\t Hello\nWorld \n",
    " NBSP inside ",
    "em space",
    "sep\u001cchar",
    "zero​width",          # U+200B is not white space in Python: kept
    "﻿bom start",          # BOM is not white space: kept
    "İstanbul Büyük",
    "",
    "     ",
    "a\x0bb\x0cc\x1dd\x1ee\x1ff\x85g h i　j",
    "MiXeD   CaSe\r\nline",
]


def test_norm_and_strip_match_python(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(EDGE)] + [(99, None)], "i int, s string")
    got = {r.i: (r.n, r.t) for r in df.select("i", norm_text("s").alias("n"), strip_ws("s").alias("t")).collect()}
    for i, s in enumerate(EDGE):
        assert got[i][1] == s.strip(), (i, s)
        # Python lower() then split/join; Java lower-cases the dotted capital
        # I the same way for this input.
        assert got[i][0] == " ".join(s.lower().split()), (i, s)
    assert got[99] == (None, None)


def test_length_is_code_points(spark):
    s = "ab\U0001F600c"
    assert spark.createDataFrame([(s,)], "s string").select(F.length("s")).first()[0] == len(s)


def test_keyword_any_substring_semantics(spark):
    kws = ["tax", "faa'iido", "sicir-barar", "WHO", "ganacsi", "ganacsiga"]
    rows = ["new taxi rules", "faa'iido weyn", "sicir-barar cusub", "who said", "ganacsiga", "nothing"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = [r[0] for r in df.select(keyword_any(norm_text("t"), kws)).collect()]
    # substring, not word boundary; an upper-case keyword never matches a
    # lower-cased title
    assert got == [True, True, True, False, True, False]
    assert df.select(keyword_any("t", [])).first()[0] is True


def test_keyword_any_array(spark):
    df = spark.createDataFrame([("abc", ["b"]), ("abc", []), ("abc", None), ("abc", ["x"])], "t string, k array<string>")
    assert [r[0] for r in df.select(keyword_any_array("t", F.col("k"))).collect()] == [True, True, True, False]


def test_classify_label(spark):
    first, second = ["goal", "cup", "final"], ["virus", "WHO"]
    rows = ["Cup final goal", "WHO warns virus", "goal virus", "nothing here", "Who won the cup"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = [r[0] for r in df.select(classify_label("t", first, second)).collect()]
    # overlaps count, the second list is lower-cased, ties go to the first
    assert got == ["Sports", "Health", "Sports", "Other", "Sports"]


def test_hyphen_cut_titlecase_sniff(spark):
    rows = [("Sicir-barar - BBC",), ("No hyphen here",), ("-leading",), ("a - Outlet",)]
    df = spark.createDataFrame(rows, "t string")
    assert [r[0] for r in df.select(cut_first_hyphen("t")).collect()] == ["Sicir", "No hyphen here", "", "a"]
    labels = [" sports ", "ECONOMY", "faa'iido weyn", "3rd place", "sicir-barar", "ÉTÉ chaud", ""]
    df2 = spark.createDataFrame([(x,) for x in labels], "l string")
    # Python's str.title(): a new word starts after any uncased character
    assert [r[0] for r in df2.select(title_case("l")).collect()] == [x.title().strip() for x in labels]
    x = spark.createDataFrame([("  <?xml version='1.0'?><rss/>",), ("<html><feed",), ("plain",)], "x string")
    assert [r[0] for r in x.select(looks_like_xml("x")).collect()] == [True, True, False]
