import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from webcapture.functions.html_events import scan_batch
from webcapture.operators.pages import clean_pages, page_metadata, pages_to_markdown, with_fallback
from webcapture.plans.capture import capture_pages


def events(html):
    return scan_batch(pa.array([html]), (), (), with_raw=True)[0].as_py()


@pytest.fixture(scope="module")
def markdown(spark):
    def run(html, **options):
        df = spark.createDataFrame([(1, "https://x", html)], "page_id long, url string, html string")
        return pages_to_markdown(df, **options).first().markdown

    return run


TAGS = "p b i a div ul ol li table tr td th tbody pre code blockquote script style title br img h2 span dl dt dd select option form".split()


def tag_soup(rng):
    parts = []
    for _ in range(rng.randrange(40)):
        tag = rng.choice(TAGS)
        parts.append(
            rng.choice(
                [f"<{tag}>", f"</{tag}>", f'<{tag} class="x>y" href=\'a"b\'>', f"<{tag.upper()}/>", "text & &amp; <", " ", "\n", "<!-- c -->",
                 "<!doctype html>", "<", ">", '"', "</", "<!--", "<a b=\"", "&lt;", "< p>", "</p x>"]
            )
        )
    return "".join(parts)


def test_events_hold_the_whole_source():
    rng = random.Random(11)
    for _ in range(3000):
        html = tag_soup(rng)
        assert "".join(e["raw"] for e in events(html)) == html


def test_events_are_nested():
    rng = random.Random(12)
    for _ in range(1000):
        depth = []
        for e in events(tag_soup(rng)):
            if e["kind"] == "open" and e["tag"] not in ("br", "img"):
                depth.append(e["tag"])
            elif e["kind"] == "close":
                assert depth.pop() == e["tag"]
            assert e["quote"] == depth.count("blockquote") or e["kind"] != "text"
        assert depth == []


@pytest.mark.parametrize(
    "bad",
    ["<a " * 50000 + ">", '<a "' * 50000, "<" * 100000, "<b>" * 50000 + "</i>" * 50000, "<div>" * 50000, "<!--" * 50000,
     "<a x='" * 50001, "<title>" * 5000, "<ul><li>" * 20000 + "</b>" * 20000, "<p><table><td>" * 10000],
)
def test_hostile_pages_stay_linear(bad):
    assert "".join(e["raw"] for e in events(bad)) == bad


def test_null_and_empty_pages():
    got = scan_batch(pa.array([None, "", "x"]), (), ())
    assert [len(x) for x in got.to_pylist()] == [0, 0, 1]


@pytest.mark.parametrize(
    "html,want",
    [
        ("<h1>A</h1><h6>B <i>c</i></h6>", "# A\n\n###### B *c*"),
        ("<p>a\n  b</p>c<p>d", "a b\n\nc\n\nd"),
        ("<p><b>x<br><p>y</p>", "**x**\n\ny"),
        ("a <b> b </b>c<em></em> <strong>d</strong>", "a **b** c **d**"),
        ("x<br>y<br><br>z", "x  \ny\n\nz"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n  - c"),
        ("<ol start=3><li>a</li><li><p>b</p></li></ol>", "3. a\n4. b"),
        ("<p>q</p><blockquote><p>a</p><blockquote>b</blockquote></blockquote>c", "q\n\n> a\n\n> > b\n\nc"),
        ("<pre>a\n  b  c\n</pre>", "```\na\n  b  c\n\n```"),
        ("use <code>x  y</code> now", "use `x y` now"),
        ('<a href="/u?a=1&amp;b=2">t <b>u</b></a> <a>no</a> <a href=" ">blank</a>', "[t **u**](/u?a=1&b=2) no blank"),
        ('<img src="i.png" alt="An *alt*"><img alt="none">', "![An *alt*](i.png)"),
        ("<table><tr><th>a<th>b|c</tr><tr><td>1<br>2<td><p>3</p></table>", "| a | b\\|c |\n| --- | --- |\n| 1 2 | 3 |"),
        ("a<hr>b", "a\n\n---\n\nb"),
        ("<title>t</title><script>var a='<p>';</script><style>p{}</style><textarea>x</textarea>v", "v"),
        ("&lt;b&gt; &copy; &#233; &amp;amp; A&T", "<b> © é &amp; A&T"),
        ("&nbsp;x", " x"),
        ("<dl><dt>a<dd>b<dt>c</dl>", "a\n\nb\n\nc"),
        ("<div>a</div>\n\n<div> </div><div>b</div>", "a\n\nb"),
        ("", ""),
        ("<b><i> </i></b>x<i></i>", "x"),
        ("\x0e\x1e a \x05 b", "\x0e\x1e a \x05 b"),
        ("$1 \\2 ${x}", "$1 \\2 ${x}"),
        ("<p>a<p>b<i>c<p>d</i>e", "a\n\nb*c*\n\nde"),
        ("<nav>n</nav>x<div class='my-ad'>y</div><div class='ad'>z</div>", "x\n\nz"),
    ],
)
def test_markdown(markdown, html, want):
    assert markdown(html) == want


def test_included_regions_are_separate(markdown):
    assert markdown("<span>a</span>x<span>b</span>", include=["span"]) == "a\n\nb"


def test_unsupported_selector_fails_before_the_job(spark):
    df = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    with pytest.raises(ValueError):
        clean_pages(df, exclude=["a:hover"])


def test_metadata(spark):
    html = """<html lang=" de "><head><title> A
      &amp; B </title><meta NAME=Description content="d &quot;e&quot;"><meta property="og:url" content="https://og">
      <link rel="alternate canonical" href="https://canon"></head><body><svg><title>not this</title></svg>"""
    bare = "<p>x</p>"
    og = '<meta property="og:title" content="T"><meta property="og:description" content="D"><title> </title>'
    rows = [(1, "https://u", html), (2, "https://u", bare), (3, "https://u", og), (4, "https://u", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [tuple(r) for r in page_metadata(df).orderBy("page_id").collect()]
    assert got == [
        (1, "A & B", 'd "e"', "de", "https://canon", "https://og"),
        (2, None, None, None, "https://u", None),
        (3, "T", "D", None, "https://u", None),
        (4, None, None, None, "https://u", None),
    ]


def test_capture_fallback(spark):
    rows = [
        (1, "<article><p>in</p></article><p>out</p>"),
        (2, "<p>only</p><nav>menu</nav>"),
        (3, "<script>x</script>"),
        (4, '<article><img src="data:image/png;base64,AAAA" alt="pic"></article>'),
    ]
    df = spark.createDataFrame([(i, f"https://{i}", h) for i, h in rows], "page_id long, url string, html string")
    got = {r.page_id: r for r in capture_pages(df, include=["article"]).collect()}
    assert [(got[i].markdown, got[i].used_fallback) for i in (1, 2, 3, 4)] == [
        ("in", False),
        ("only\n\nmenu", True),
        ("", True),
        ("![pic]()", False),
    ]
    assert got[1].export_text == (
        "## title: \n## description: \n## url: https://1\n## language: \n## creditsUsed: \n\n---\n\nin\n"
    )


def test_capture_partitions_keep_all_pages(spark):
    df = spark.range(300).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("<p>"), F.col("id"), F.lit("</p>")).alias("html")
    )
    got = capture_pages(df, partitions=7)
    assert {(r.page_id, r.markdown) for r in got.collect()} == {(i, str(i)) for i in range(300)}


def test_with_fallback(spark):
    first = spark.createDataFrame(
        [(1, "", True), (2, "x", True), (3, None, True), (4, "", False), (5, "", None), (6, "", True), (7, "", True), (8, "", True)],
        "k long, markdown string, success boolean",
    )
    second = spark.createDataFrame(
        [(1, "one", True, True), (2, "two", True, True), (3, "three", True, True), (4, "four", True, True), (5, "five", None, True),
         (6, "six", False, True), (7, "seven", True, False)],
        "k long, markdown string, success boolean, has_data boolean",
    )
    got = {r.k: (r.markdown, r.used_fallback) for r in with_fallback(first, second, "k").collect()}
    assert got == {
        1: ("one", True), 2: ("x", False), 3: (None, False), 4: ("", False),
        5: ("five", True), 6: ("", False), 7: ("", False), 8: ("", False),
    }


def test_pages_plan_is_one_pass(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = capture_pages(df).filter("used_fallback")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in plan


HOSTILE = [
    "<p>data:image/png" + ";a" * 200000,
    "data:image/x;" * 50000,
    "<b>" * 50000 + "x",
    "<div>" * 20000 + "<nav>MENU</nav><article>TEXT</article>",
    "<ul><li>" * 3000 + "deep",
]


@pytest.mark.parametrize("html", HOSTILE)
def test_hostile_pages_through_the_job(spark, html):
    started = time.time()
    row = capture_pages(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")).first()
    assert row.success and time.time() - started < 60
    assert "MENU" not in row.markdown
    assert "deep" not in html or "deep" in row.markdown


def test_depth_changes_nothing(spark):
    deep = "<div>" * 20000
    pages = [(1, "u", deep + "<nav>MENU</nav>end"), (2, "u", deep + "<article>TEXT</article>out")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: (r.markdown, r.used_fallback) for r in capture_pages(df, include=["article"]).collect()}
    assert got[2] == ("TEXT", False) and got[1][1]
    assert {r.page_id: r.markdown for r in capture_pages(df).collect()}[1] == "end"


def test_page_without_html(spark):
    row = capture_pages(spark.createDataFrame([(1, "u", None)], "page_id long, url string, html string")).first()
    assert (row.outcome, row.success, row.markdown, row.used_fallback) == ("empty", False, None, False)


def test_window_of_markdown(spark):
    df = spark.createDataFrame([(1, "u", "<p>abcdef</p>")], "page_id long, url string, html string")
    assert capture_pages(df, max_chars=3, start=2).first().markdown == "cde"
