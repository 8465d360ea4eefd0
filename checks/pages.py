"""Queries for page cleaning, Markdown, metadata and the capture job."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import registry, table
from webcapture.operators.pages import clean_pages, page_metadata, pages_to_markdown, with_fallback
from webcapture.plans.capture import capture_pages

QUERIES, ORACLES, query = registry()

_BUILT_IN_HITS = "(?s)<style>.*?</style>|<script>.*?</script>|<nav>.*?</nav>|<footer>.*?</footer>"


def _decoded(sql):
    for entity, char in (("&quot;?", '"'), ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&")):
        sql = f"regexp_replace({sql}, '{entity}', '{char}', 'g')"
    return sql


def _sql_text(text):
    return "'" + text.replace("\\1", "\x01").replace("\\2", "\x02").replace("\\n", "' || chr(10) || '").replace("\x01", "\\1").replace("\x02", "\\2") + "'"


def _replaced(sql, pairs):
    for pattern, text in pairs:
        sql = f"regexp_replace({sql}, {_sql_text(pattern)}, {_sql_text(text)}, 'g')"
    return sql


def _page_markdown(dropped):
    """Markdown of a driver page as SQL; its few forms of markup are known."""
    sql = rf"regexp_replace(regexp_replace(html, '(?s)<!.*?>|<title>.*?</title>|{dropped}', '', 'g'), '\s+', ' ', 'g')"
    return _decoded(
        _replaced(
            sql,
            (
                ("<p><b> *(.*?) *<br>", r"\n\n**\1**\n\n"),
                ("<h1> *(.*?) *</h1>", r"\n\n# \1\n\n"),
                ('<li><a href="([^"]*)"> *(.*?) *</a></li>', r"\n- [\2](\1)"),
                (r"</?(p|div|article|nav|ul|footer|body|html|head|meta)\b[^>]*>", r"\n\n"),
                (r" *\n *", r"\n"),
                (r"\n\n+", r"\n\n"),
                (r"^[ \n]+", ""),
                (r"[ \n]+$", ""),
            ),
        )
    )


_CLEANED = _page_markdown("<style>.*?</style>|<script>.*?</script>|<nav>.*?</nav>|<footer>.*?</footer>")
_EVERYTHING = _page_markdown("<style>.*?</style>|<script>.*?</script>")
_TITLE = _decoded(r"trim(regexp_replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '\s+', ' ', 'g'))")
_LANG = "regexp_extract(html, '<html lang=\"([^\"]*)\"', 1)"


@query("clean_pages", f"SELECT page_id, url, regexp_replace(html, '{_BUILT_IN_HITS}', '', 'g') AS clean_html FROM pages")
def _(spark, sf):
    return clean_pages(table(spark, sf, "pages"))


@query("clean_pages_include", "SELECT page_id, url, regexp_extract(html, '(?s)<article>.*</article>') AS clean_html FROM pages")
def _(spark, sf):
    return clean_pages(table(spark, sf, "pages"), include=["article", "p", "b"])


@query(
    "clean_pages_selectors",
    """SELECT page_id, url, regexp_replace(html, '(?s)<div class="ad">.*?</div>|<h1>.*?</h1>|<li>.*?</li>|<title>.*?</title>', '', 'g') AS clean_html FROM pages""",
)
def _(spark, sf):
    rules = ["div.ad", "article > h1", "nav li", 'title, [lang="xx"]', "footer > h1"]
    return clean_pages(table(spark, sf, "pages"), exclude=rules, empty_tags=True)


@query(
    "clean_pages_has",
    """SELECT page_id, url, list_reduce(list_prepend('', list_filter(regexp_extract_all(html, '<li>.*?</li>'), lambda x: contains(x, 'href="/de"'))), lambda a, b: a || b) AS clean_html FROM pages""",
)
def _(spark, sf):
    return clean_pages(table(spark, sf, "pages"), include=['li:has(a[href="/de"])'], empty_tags=True)


@query("pages_to_markdown", f"SELECT page_id, url, {_CLEANED} AS markdown FROM pages")
def _(spark, sf):
    return pages_to_markdown(table(spark, sf, "pages"))


@query(
    "page_metadata",
    f"""SELECT page_id, {_TITLE} AS title, CAST(NULL AS VARCHAR) AS description, {_LANG} AS language, url, CAST(NULL AS VARCHAR) AS "ogUrl" FROM pages""",
)
def _(spark, sf):
    return page_metadata(table(spark, sf, "pages"))


@query(
    "capture_pages",
    f"""SELECT page_id, url, title, CAST(NULL AS VARCHAR) AS description, language, markdown, false AS used_fallback, CAST(NULL AS DOUBLE) AS "creditsUsed", true AS success, 'ok' AS outcome, CAST(NULL AS VARCHAR) AS message,
        concat('## title: ', title, chr(10), '## description: ', chr(10), '## url: ', url, chr(10), '## language: ', language, chr(10), '## creditsUsed: ', chr(10), chr(10),
        '---', chr(10), chr(10), markdown, chr(10)) AS export_text FROM (SELECT page_id, url, {_TITLE} AS title, {_LANG} AS language, {_CLEANED} AS markdown FROM pages)""",
)
def _(spark, sf):
    return capture_pages(table(spark, sf, "pages"))


@query("capture_pages_balanced", ORACLES["capture_pages"])
def _(spark, sf):
    return capture_pages(table(spark, sf, "pages"), partitions=2 * spark.sparkContext.defaultParallelism, balance=True)


_RARE = ['li:has(a[href="/de"])']
_FALLBACK = f"""SELECT page_id, NOT contains(html, 'href="/de"') AS used_fallback,
    CASE WHEN contains(html, 'href="/de"') THEN array_to_string(list_transform(regexp_extract_all(html, 'href="/de"'), lambda x: '- [de](/de)'), chr(10) || chr(10)) ELSE {_EVERYTHING} END AS markdown FROM pages"""


@query("with_fallback", _FALLBACK)
def _(spark, sf):
    pages = table(spark, sf, "pages")
    done = F.lit(True)
    first = pages_to_markdown(pages, include=_RARE, empty_tags=True).select("page_id", "markdown", done.alias("success"))
    second = pages_to_markdown(pages, empty_tags=True).select("page_id", "markdown", done.alias("success"), done.alias("has_data"))
    return with_fallback(first, second, "page_id").select("page_id", "used_fallback", "markdown")


@query("capture_pages_fallback", _FALLBACK)
def _(spark, sf):
    captured = capture_pages(table(spark, sf, "pages"), include=_RARE, empty_tags=True)
    return captured.select("page_id", "used_fallback", "markdown")
