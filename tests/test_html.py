from corpusforge.functions.html import matches
from corpusforge.operators.extract import discover_feed, extract_links, headings_with_fallback, title_and_intro

PAGE = """<html><head><style>h2 a {x}</style><script>var s="<h2><a href='/s'>script link</a></h2>";</script></head>
<body>
<h2 class="entry-title post-title"><a href=" /one ">First <b>bold</b>   title here</a></h2>
<h2><a>No href title long</a></h2>
<h3><a href="/dup">Duplicate title x</a></h3>
<h3><a href="/dup">Duplicate title x</a></h3>
<h1><a href="/short">11 chars ok</a></h1>
<h1><a href="/twelve">12 chars ok!</a></h1>
<div id="mw-pages"><ul><li><a href="/wiki/Page_A">Page A</a></li><li><a href="/wiki/Category:X">Cat</a></li></ul></div>
<div class="post-title"><p>Fish &amp; chips &quot;today&quot; news</p><a href="/amp">Fish &amp; chips headline</a></div>
<article><h1>Main heading text</h1><p><b>unclosed bold intro paragraph<p>second paragraph text</article>
<ul><li>Ciyaaraha <a href="/x">x</a> <a href="/api/zz">Rukumo</a></li><li><a href="/api/other">Ciyaaraha feed</a></li></ul>
</body></html>"""


def _rows(sels, union=True):
    return list(matches(PAGE, sels, union))


def test_selectors_and_text():
    hits = _rows(["h1 a, h2 a, h3 a, .entry-title a, .post-title a"])
    titles = [h[2] for h in hits]
    assert titles[0] == "First bold title here"       # nested tags, " " separator, pieces stripped
    assert "script link" not in " ".join(titles)       # script text is not markup
    assert "Fish & chips headline" in titles           # entities unescaped, .class descendant
    assert titles.count("Duplicate title x") == 2      # dedupe happens later, natively
    h = {x[2]: x[5] for x in hits}
    assert h["No href title long"] is None and h["First bold title here"] == " /one "
    assert [x[2] for x in _rows(["#mw-pages a"])] == ["Page A", "Cat"]
    assert [x[2] for x in _rows(["ul > li > a"])][:2] == ["Page A", "Cat"]
    assert [x[3] for x in _rows(["h2.post-title a"])] == ["Firstboldtitle here"]


def test_unclosed_tags_nest():
    ps = _rows(["article p"])
    # the unclosed <p><b> swallows the following paragraph
    assert ps[0][2] == "unclosed bold intro paragraph second paragraph text"
    assert ps[1][2] == "second paragraph text"


def test_extract_links_filters(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    items = extract_links(pages, ["page_id"], None, min_len=12).orderBy("pos").collect()
    titles = [r.title for r in items]
    assert titles.count("Duplicate title x") == 1
    assert "11 chars ok" not in titles and "12 chars ok!" in titles
    assert {r.title: r.href for r in items}["No href title long"] == ""
    nulls = extract_links(pages, ["page_id"], ["h2 a"], min_len=5, dedupe=False, href_default=None)
    assert {r.title: r.href for r in nulls.collect()}["No href title long"] is None
    assert {r.title: r.href for r in items}["First bold title here"] == "/one"
    sel = extract_links(pages, ["page_id"], ["h3 a", "h1 a"], min_len=5, order_mode="selector", dedupe=False)
    assert [r.title for r in sel.orderBy("pos").collect()] == [
        "Duplicate title x", "Duplicate title x", "11 chars ok", "12 chars ok!"]


def test_heading_fallback_and_intro(spark):
    pages = spark.createDataFrame(
        [(1, "<h2 class='post-title'>A post title long enough</h2><h3>Third level heading here</h3>"),
         (2, "<h3>Only third level heading</h3><h3>short</h3>"),
         (3, "<p>nothing</p>")], "page_id long, html string")
    got = sorted((r.page_id, r.text) for r in headings_with_fallback(pages, ["page_id"]).collect())
    assert got == [(1, "A post title long enough"), (2, "Only third level heading")]
    art = spark.createDataFrame(
        [(1, "<h1>Title <i>x</i></h1><div class='mw-parser-output'><p>short</p><p>An intro of enough length.</p></div>"),
         (2, "<p>An intro but no heading at all</p>"),
         (3, "<h1>T</h1><div id='mw-content-text'><p>fourteen chars</p><p>fifteen chars!!</p></div>")],
        "page_id long, html string")
    got = {r.page_id: r.text for r in title_and_intro(art, ["page_id"]).collect()}
    assert got == {1: "Titlex. An intro of enough length.", 3: "T. fifteen chars!!"}


def test_feed_discovery(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<a href='/api/q'>Ciyaaraha</a>"), (3, "<p>none</p>")],
                                  "page_id long, html string")
    got = {r.page_id: r.feed_url for r in discover_feed(pages, ["page_id"], "ciyaaraha").collect()}
    assert got == {1: "/api/zz", 2: "/api/q", 3: None}


def test_workers_do_not_need_the_package_on_their_path(spark):
    """The parser helper is shipped by value, so executors started outside
    the repository (another working directory, a cluster) can run it."""
    import subprocess
    import sys
    import textwrap

    code = textwrap.dedent('''
        import sys
        sys.path.insert(0, "/root/repo")
        from pyspark.sql import SparkSession
        s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        from corpusforge.operators.extract import extract_links
        pages = s.createDataFrame([(1, "<h2><a href='/x'>A headline long enough</a></h2>")], "page_id long, html string")
        print("ROWS", extract_links(pages, ["page_id"]).count())
    ''')
    out = subprocess.run([sys.executable, "-c", code], cwd="/tmp", capture_output=True, text=True, timeout=300)
    assert "ROWS 1" in out.stdout, out.stderr[-2000:]


def test_repeated_attribute_keeps_the_last_value():
    assert [h[5] for h in matches("<a href='/1' href='/2'>x</a>", ["a"], True)] == ["/2"]


def test_template_and_ruby_notes_are_not_text():
    page = "<a href='/1'>t <template>x <b>y</b></template><ruby>k<rp>(</rp><rt>r</rt></ruby></a>"
    assert [h[3] for h in matches(page, ["a"], True)] == ["tk"]


def test_feed_discovery_in_nested_lists(spark):
    nested = ("<ul><li>Ciyaaraha<ul><li>other <a href='/x'>x</a> <a href='/api/in'>in</a></li></ul></li>"
              "<li>Ciyaaraha <a href='/api/later'>later</a></li></ul>")
    empty_first = "<li>Ciyaaraha</li><li>none <a href='/api/no'>n</a></li><li>ciyaaraha <a href='/api/yes'>y</a></li>"
    pages = spark.createDataFrame([(1, nested), (2, empty_first), (3, None), (4, "")], "page_id long, html string")
    got = {r.page_id: r.feed_url for r in discover_feed(pages, ["page_id"], "ciyaaraha").collect()}
    assert got == {1: "/api/in", 2: "/api/yes", 3: None, 4: None}


def test_matches_are_sent_on_in_bounded_parts():
    """Elements inside each other: a page's matches can be far larger than the page."""
    import pandas as pd

    from corpusforge.operators import extract as X

    pages = ["<article>" + f"<p>{n} words of a paragraph " * 400 + "</article>" for n in range(20)]
    batch = pd.DataFrame({"page_id": range(20), "html": pages})
    names = ["page_id", *(f.name for f in X.HIT_FIELDS)]
    parts = list(X._hit_rows(names, ["article p"], False, False, "spaced")(iter([batch])))
    held = [int(p["text_spaced"].str.len().sum()) for p in parts]
    assert sum(held) > 15 * X.HELD and max(held) < 2 * X.HELD  # a page's largest match and little else
    table = pd.concat(parts)
    want = [(n, *m[:3]) for n, page in enumerate(pages) for m in matches(page, ["article p"], False)]
    assert list(table[["page_id", "sel_idx", "doc_pos", "text_spaced"]].itertuples(index=False, name=None)) == want
    assert table["text_joined"].isna().all() and table["text_whole"].isna().all()  # not asked for
