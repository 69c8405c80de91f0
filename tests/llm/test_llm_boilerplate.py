"""Operator 11: hand-made pages, and whole tables against the article's markup."""

import re
from html import unescape

import pytest
from pyspark.sql import functions as F

from corpusforge.llm import boilerplate as b
from corpusforge.llm import queries

SCHEMA = "page_id long, url string, html string, text string, stream string, places string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z") for i, u, h in rows], SCHEMA).repartition(3)


def texts(spark, rows, **args):
    return {r["page_id"]: r["text"] for r in b.extract(pages(spark, rows), **args).collect()}


@pytest.mark.parametrize("html, article", [
    ("<article><p>One &amp; two&nbsp;&#51;<br>four<p>Five</article>", ["One & two 3 four", "Five"]),
    ("<article>a<!-- no <p> --> b<script>var t='</p><p>';</script>c</article>", ["a bc"]),
    ("<nav><ul><li>Home</nav><article><h1>T</h1>x < y</article><footer>f", ["T", "x < y"]),
    ("<article><header><h1>Title</h1></header>Body<footer>by me</footer></article>", ["Title", "Body"]),
    ("<header>Site</header><main><p>Text<div class='cookie-notice'>Cookies <div>and</div> more</div>end</main>", ["Text", "end"]),
    ("<article>Text<section id=comments><p>nice<article class=comment>me too</article></section>end</article>", ["Text", "end"]),
    ("<article>Text<form><label>Name</label><input></form><aside>also</aside>end</article>", ["Text", "end"]),
    ("<article>Te<b>x</b>t <span class='ad'>buy <span>now</span> here</span> end</article>", ["Text", "end"]),
    ("<article>Text<p class=notice>note<p>end</article>", ["Text", "end"]),
    ("<body class='has-sidebar'><div class='sidebar-layout'><main>Text</main></div>", ["Text"]),
    ("<nav>never closed <ul><li>a<article>Text</article>", ["Text"]),
    ("<article><a title='a > b' href=\"x\">link</a> &am <i>p</i>; &amp", ["link &am p; &"]),
    ("<article><ul><li>one<li class=share>no<li>two</ul></article>", ["one", "two"]),
    ("<article><textarea>typed</textarea><style>p{}</style><template>t</template>x", ["x"]),
    ("<ARTICLE>Text<DIV CLASS='Ad'>no</DIV></ARTICLE>", ["Text"]),
    (None, []), ("", []), ("<article> \n </article>", []), ("<", []),
])
def test_blocks_of_the_article(html, article):
    assert [t for k, _, t in b.blocks(html) if k == b.ARTICLE] == [t for t in article if t != "<"]


def story(n):
    return f"Story{n} was told{n} by a writer{n} of the town{n}, its people{n} and their words{n}."


def page(n, *, menu="Start News Sport Weather Contact Imprint", body=None):
    lines = "".join(f"<div>{w}</div>" for w in menu.split())
    return f"<html><body>{lines}<div>{body or story(n)}</div><div>All rights are reserved by the owner of this site</div>"


def test_repeats_of_a_host_go_and_unique_text_stays(spark):
    rows = [(n, f"http://a.example/{n}", page(n)) for n in range(6)]
    rows += [(10, "http://b.example/", page(10))]  # the same menu, once on its host
    rows += [(11, "http://A.example/x?y", page(11, body="Alone here.")), (12, None, page(12)), (13, "no host", page(13))]
    out = texts(spark, rows)
    assert [out[n] for n in range(6)] == [story(n) for n in range(6)]
    assert out[10].startswith("Start\n\nNews") and out[10].endswith("site")
    assert out[11] == "Alone here."
    assert (out[12], out[13]) == (story(12), story(13))  # pages without a host are one host's


def test_copies_of_an_article_are_no_boilerplate(spark):
    html = "<nav>Start News Sport Weather Contact Imprint</nav><article><p>The same long article is found on more than one page.</article>"
    rows = [(n, f"http://a.example/{n}", html + f"<footer>{n}</footer>") for n in range(4)]
    assert set(texts(spark, rows).values()) == {"The same long article is found on more than one page."}
    # equal pages are one page: nothing of them is repeated
    rows = [(n, "http://a.example/", page(1)) for n in range(3)]
    assert {t.count("\n\n") for t in texts(spark, rows).values()} == {7}


def test_unmarked_repeats_beside_the_article_go(spark):
    rows = [
        (n, f"http://a.example/{n}", f"<div>Read our other stories about the weather</div><article>Story {n}</article><div>Written by author number {n} on a rainy day</div>")
        for n in range(3)
    ]
    assert texts(spark, rows)[1] == "Story 1\n\nWritten by author number 1 on a rainy day"


def lines(n):
    return [f"Line{k} of text{n} tells how one{n} came{k} to town{n} and left{k} again{n}." for k in range(3)]


def test_articles_in_the_array_save_their_unmarked_copies(spark):
    """Near copies without marks share all blocks, which boilerplate does too; an article of the host tells them apart."""
    headline = "The town has a new mayor since last night"
    copy = "".join(f"<p>{x}</p>" for x in lines(1))
    menu = "<div>Start News Sport Weather Contact and more Imprint</div>"
    rows = [(n, f"http://a.example/{n}", f"{menu}<h1>{headline}</h1>{copy}<div>Printed for reader{n}</div>") for n in (1, 2)]
    rows += [(3, "http://a.example/3", f"{menu}<article><h1>{headline}</h1>{copy}</article>")]
    # the headline alone, and the copy beside another article, are no main text
    rows += [(n, f"http://a.example/{n}", f"{menu}<div>{headline}</div><div>Other things are told on page{n} here</div>") for n in (4, 5)]
    rows += [(n, f"http://a.example/{n}", f"{menu}{copy}<article><p>{lines(n)[0]}</p></article>") for n in (6, 7)]
    # a host that has the same pages without the article
    rows += [(n + 10, f"http://b.example/{n}", html) for n, _, html in rows[:2]]
    out = texts(spark, rows)
    for n in (1, 2):
        assert out[n].split("\n\n") == [headline, *lines(1), f"Printed for reader{n}"]
        assert out[n + 10] == f"Printed for reader{n}"
    assert out[3].split("\n\n") == [headline, *lines(1)]
    for n in (4, 5):
        assert out[n] == f"Other things are told on page{n} here"
    for n in (6, 7):
        assert out[n] == lines(n)[0]


def test_array_holds_the_articles(spark):
    """Every repeated substring of a host, with whether its articles have it."""
    src = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    parsed = [b.Page(r["url"], r["html"]) for r in src.collect()]
    inside = {e.as_py() for p in parsed for e in b._packed(p.article.entries(b.RUN))}
    array = {bytes(r["entry"]): r["copied"] for r in b._array(src, b.RUN).collect()}
    assert set(array) == {bytes(r[0]) for r in b.repeated(src).collect()}
    assert array == {e: e in inside for e in array} and any(array.values())


def test_filter_loses_no_entry(spark):
    rows = [(n, f"http://a.example/{n}", page(n)) for n in range(6)]
    found = b.repeated(pages(spark, rows))
    entries = b.np.frombuffer(b"".join(bytes(r[0]) for r in found.collect()), ">u4").reshape(-1, b.RUN + 2)
    bloom = b._Filter(b._filter(found, b.RUN).value, b.RUN)
    assert len(entries) and bloom.holds(entries).all()
    assert bloom.holds(entries + 1).mean() < 0.5


def brute(rows, run, covered):
    """Open blocks whose words lie in substrings that another page of the host has too."""
    parsed = [(i, b.Page(u, h)) for i, u, h in rows]
    holders = {}
    for _, p in parsed:
        for a, z in p.runs:
            for k in range(a, z - run + 1):
                holders.setdefault((p.host, *p.tokens[k : k + run]), set()).add(tuple(p.blocks))
    out = {}
    for i, p in parsed:
        seen = set()
        for a, z in p.runs:
            for k in range(a, z - run + 1):
                if len(holders[p.host, *p.tokens[k : k + run]]) > 1:
                    seen.update(range(k, k + run))
        keep = []
        for n, (kind, _, text) in enumerate(p.blocks):
            words = range(*p.open.get(n, (0, 1)))
            if kind == b.ARTICLE or kind == b.OPEN and sum(w in seen for w in words) < covered * len(words):
                keep.append(text)
        out[i] = "\n\n".join(keep)
    return out


def test_whole_table_without_its_marks_as_brute_force(spark):
    """The supplied pages with plain elements: the arrays alone must decide."""
    src = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    plain = lambda h: re.sub(r"<(/?)(article|nav|footer|header)>", r"<\1div>", h.replace(' class="ad"', ""))
    rows = [(r["page_id"], re.sub(r"://[^/]*", "://one.host" if r["page_id"] % 3 else "://two.host", r["url"]), plain(r["html"])) for r in src]
    rows += [(900, None, None), (901, "http://one.host/", ""), (902, "http://one.host/", "<div>" + "long text " * 50_000)]
    for run in (4, 6):
        assert texts(spark, rows, run=run) == brute(rows, run, b.COVERED)


def test_share_of_boilerplate_that_the_arrays_find_by_themselves(spark):
    """Of the words outside the articles (which have marks here) those that are repeated on their host."""
    src = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    found = {bytes(r[0]) for r in b.repeated(src).collect()}
    words = seen = 0
    for r in src.collect():
        p = b.Page(r["url"], r["html"])
        hits = zip(p.starts(b.RUN), b._packed(p.entries(b.RUN)), strict=True)
        words, seen = words + len(p.tokens), seen + len({k + j for k, e in hits if e.as_py() in found for j in range(b.RUN)})
    assert seen / words > 0.6  # 0.645; the rest, unique on its host, is known by its marks alone


def test_registered_query_gives_every_article(spark):
    out = queries.op11_html_extraction(spark, "/root/testdata/sf0.01")
    src = {r["page_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == len(src)
    for r in out.collect():
        article = re.search(r"<article>(.*?)</article>", src[r["page_id"]]["html"], re.S)[1]
        own = (" ".join(unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article))
        assert r["text"] == "\n\n".join(x for x in own if x)
        assert r["n_chars"] == len(r["text"]) and r["url"] == src[r["page_id"]]["url"]


def test_empty_table(spark):
    assert b.extract(pages(spark, [])).agg(F.count("*")).first()[0] == 0
