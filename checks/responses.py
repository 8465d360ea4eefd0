"""Queries for response flattening, outcomes, sources and sinks.

The driver's tables hold no API responses, so their rows are wrapped in response JSON first.
"""

from __future__ import annotations


from pyspark.sql import functions as F

from checks.common import json_text, registry, table
from webcapture.functions.variant import credits_used, error_reason, pick, resolved_url
from webcapture.functions.text import export_path, to_compact_json
from webcapture.operators.country import dictionary_aliases, dictionary_entries
from webcapture.operators.requests import limit_per_request, supported_documents
from webcapture.operators.responses import (
    av_records,
    classify,
    credit_snapshots,
    image_results,
    news_results,
    parse_records,
    scholar_results,
    scrape_records,
    search_envelope,
    search_results,
    split_outcomes,
    web_results,
)
from webcapture.plans.capture import flatten_scrapes, flatten_search, scrapes_with_fallback
from webcapture.sources.readers import parse_responses
from webcapture.shared import new_path
from webcapture.sources.writers import render_capture, render_parsed, write_exports

QUERIES, ORACLES, query = registry()


def _json(c) -> F.Column:
    """A text column as a JSON string literal."""
    return F.regexp_extract(F.to_json(F.struct(F.coalesce(c, F.lit("")).alias("x"))), r'(?s)\A\{"x":(.*)\}\z', 1)


def _search_responses(spark, sf):
    """Search response per page; every fifth page has its web list replaced or its items spoilt."""
    pages = table(spark, sf, "pages").withColumn("title", F.regexp_extract("html", "<title>(.*?)</title>", 1))
    title, url = _json(F.col("title")), _json(F.col("url"))
    m = F.col("page_id") % 5
    lit = F.lit
    item = F.concat(lit('{"title":'), title, lit(',"description":"d","url":'), url, lit(',"extra":[1]}'))
    web = (
        F.when(m == 0, lit('"none"'))
        .when(m == 1, lit('{"title":"x"}'))
        .when(m == 2, F.concat(lit("[5,null,"), item, lit("]")))
        .when(m == 3, F.concat(lit("["), item, lit(',{"title":null},'), item, lit("]")))
        .otherwise(lit("[]"))
    )
    news = F.concat(lit('[{"title":'), title, lit(',"url":'), url, lit(',"date":"4 days ago"},{"snippet":"s"}]'))
    images = F.concat(lit('[{"imageUrl":'), url, lit(',"url":7}]'))
    raw = F.concat(
        lit('{"success":true,"data":{"web":'), web, lit(',"news":'), news,
        F.when(m == 4, lit("")).otherwise(F.concat(lit(',"images":'), images)),
        lit('},"creditsUsed":'), F.col("page_id").cast("string"), lit("}"),
    )
    named = pages.select(F.col("page_id").cast("string").alias("response_id"), "page_id", F.col("url").alias("target_url"), raw.alias("raw"))
    return parse_responses(named)


_PAGES = "(SELECT page_id, CAST(page_id AS VARCHAR) AS response_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages)"
_WEB = f"""
    SELECT response_id, 0 AS pos, NULL AS title, NULL AS description, NULL AS url FROM {_PAGES} WHERE page_id % 5 = 2
    UNION ALL SELECT response_id, 1, NULL, NULL, NULL FROM {_PAGES} WHERE page_id % 5 = 2
    UNION ALL SELECT response_id, 2, title, 'd', url FROM {_PAGES} WHERE page_id % 5 = 2
    UNION ALL SELECT response_id, 0, title, 'd', url FROM {_PAGES} WHERE page_id % 5 = 3
    UNION ALL SELECT response_id, 1, NULL, NULL, NULL FROM {_PAGES} WHERE page_id % 5 = 3
    UNION ALL SELECT response_id, 2, title, 'd', url FROM {_PAGES} WHERE page_id % 5 = 3"""
_NEWS = f"""
    SELECT response_id, 0 AS pos, title, NULL AS snippet, url, '4 days ago' AS date FROM {_PAGES}
    UNION ALL SELECT response_id, 1, NULL, 's', NULL, NULL FROM {_PAGES}"""
_IMAGES = f"SELECT response_id, 0 AS pos, CAST(NULL AS VARCHAR) AS title, url AS \"imageUrl\", '7' AS url FROM {_PAGES} WHERE page_id % 5 <> 4"
_ALL = f"""
    SELECT response_id, 'web' AS kind, pos, title, description, url, NULL AS snippet, NULL AS date, NULL AS "imageUrl" FROM ({_WEB})
    UNION ALL SELECT response_id, 'news', pos, title, NULL, url, snippet, date, NULL FROM ({_NEWS})
    UNION ALL SELECT response_id, 'images', pos, title, NULL, url, NULL, NULL, "imageUrl" FROM ({_IMAGES})"""


@query("web_results", _WEB)
def _(spark, sf):
    return web_results(_search_responses(spark, sf))


@query("news_results", _NEWS)
def _(spark, sf):
    return news_results(_search_responses(spark, sf))


@query("image_results", _IMAGES)
def _(spark, sf):
    return image_results(_search_responses(spark, sf))


@query("search_results", _ALL)
def _(spark, sf):
    return search_results(_search_responses(spark, sf))


@query("limit_per_request", f"SELECT * FROM ({_ALL}) WHERE pos < CAST(response_id AS BIGINT) % 3 + 1")
def _(spark, sf):
    rows = search_results(_search_responses(spark, sf), carry=("page_id",))
    return limit_per_request(rows, F.col("page_id") % 3 + 1).drop("page_id")


@query("flatten_search", f"SELECT * FROM ({_ALL}) WHERE pos < CAST(response_id AS BIGINT) % 2 + 1")
def _(spark, sf):
    responses = _search_responses(spark, sf).withColumn("n", F.col("page_id") % 2 + 1)
    return flatten_search(responses, "n")[0]


_T, _U = json_text("title"), json_text("url")


@query(
    "search_envelope",
    f"""SELECT response_id, concat('{{"success":true,"data":{{"web":', CASE page_id % 5
        WHEN 2 THEN concat('[{{"title":null,"description":null,"url":null}},{{"title":null,"description":null,"url":null}},{{"title":', {_T}, ',"description":"d","url":', {_U}, '}}]')
        WHEN 3 THEN concat('[{{"title":', {_T}, ',"description":"d","url":', {_U}, '}},{{"title":null,"description":null,"url":null}},{{"title":', {_T}, ',"description":"d","url":', {_U}, '}}]')
        ELSE '[]' END, ',"news":[{{"title":', {_T}, ',"snippet":null,"url":', {_U}, ',"date":"4 days ago"}},{{"title":null,"snippet":"s","url":null,"date":null}}],"images":',
        CASE WHEN page_id % 5 = 4 THEN '[]' ELSE concat('[{{"title":null,"imageUrl":', {_U}, ',"url":7}}]') END, '}},"creditsUsed":', page_id, '}}') AS envelope FROM {_PAGES}""",
)
def _(spark, sf):
    enveloped = search_envelope(_search_responses(spark, sf))
    return enveloped.select("response_id", to_compact_json("envelope").alias("envelope"))


@query(
    "scholar_results",
    """SELECT CAST(doc_id AS VARCHAR) AS response_id, 0 AS pos, source AS title, text AS abstract, CAST(doc_id AS VARCHAR) AS "paperId",
         concat('arxiv:', doc_id) AS "primaryId", n_chars / 8 AS score FROM documents
       UNION ALL SELECT CAST(doc_id AS VARCHAR), 1, NULL, NULL, NULL, NULL, NULL FROM documents WHERE doc_id % 2 = 0""",
)
def _(spark, sf):
    lit = F.lit
    raw = F.concat(
        lit('{"success":true,"results":[{"title":'), _json(F.col("source")), lit(',"abstract":'), _json(F.col("text")),
        lit(',"paperId":"'), F.col("doc_id"), lit('","primaryId":"arxiv:'), F.col("doc_id"), lit('","score":'),
        (F.col("n_chars") / 8).cast("decimal(20,3)").cast("string"), lit(',"ids":{}}'),
        F.when(F.col("doc_id") % 2 == 0, lit(',"text"')).otherwise(lit("")), lit("]}"),
    )
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("response_id"), raw.alias("raw"))
    return scholar_results(parse_responses(docs))


def _scrape_responses(spark, sf):
    """Scrape response per page: percent-encoded Markdown with literal newlines, URL under varying keys."""
    pages = table(spark, sf, "pages").withColumn("title", F.regexp_extract("html", "<title>(.*?)</title>", 1))
    title, url = _json(F.col("title")), _json(F.col("url"))
    m = F.col("page_id") % 5
    lit = F.lit
    encoded = F.replace(F.replace("title", lit("%"), lit("%25")), lit(" "), lit("%20"))
    markdown = (
        F.when(m == 0, lit(',"markdown":""'))
        .when(m == 1, lit(""))
        .when(m == 2, lit(',"markdown":["x"]'))
        .otherwise(F.concat(lit(',"markdown":'), _json(F.concat(encoded, lit("\\nend%zz")))))
    )
    keys = (
        F.when(m == 0, F.concat(lit(',"url":" ","sourceURL":'), url))
        .when(m == 1, F.concat(lit(',"url":5,"ogUrl":'), url))
        .when(m == 2, F.concat(lit(',"url":'), url))
        .otherwise(lit(""))
    )
    meta = F.concat(
        lit('{"title":'), title, lit(',"language":null,"proxyUsed":"basic"'), keys,
        F.when(m < 3, F.concat(lit(',"creditsUsed":'), F.col("page_id"), F.when(m == 1, lit(".5")).otherwise(lit("")))).otherwise(lit("")), lit("}"),
    )
    raw = F.concat(lit('{"success":true,"creditsUsed":1,"data":{"metadata":'), meta, markdown, lit("}}"))
    named = pages.select(F.col("page_id").cast("string").alias("response_id"), F.concat(lit("asked:"), F.col("url")).alias("target_url"), raw.alias("raw"))
    return parse_responses(named)


_SCRAPE_CREDITS = "CAST(CASE page_id % 5 WHEN 0 THEN page_id WHEN 1 THEN page_id + 0.5 WHEN 2 THEN page_id END AS DOUBLE)"
_SCRAPE_URL = "CASE WHEN page_id % 5 < 3 THEN url ELSE concat('asked:', url) END"
_SCRAPE_MD = "CASE page_id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE concat(title, chr(10), 'end%zz') END"


@query(
    "scrape_records",
    f"""SELECT response_id, true AS success, 'basic' AS "proxyUsed", title, CAST(NULL AS VARCHAR) AS description, {_SCRAPE_URL} AS url,
        CAST(NULL AS VARCHAR) AS language, {_SCRAPE_MD} AS markdown, {_SCRAPE_CREDITS} AS "creditsUsed" FROM {_PAGES}""",
)
def _(spark, sf):
    return scrape_records(_scrape_responses(spark, sf))


@query(
    "scrape_records_strict",
    f"""SELECT response_id, CASE page_id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN NULL
        ELSE concat(replace(replace(title, '%', '%25'), ' ', '%20'), '\\nend%zz') END AS markdown FROM {_PAGES}""",
)
def _(spark, sf):
    return scrape_records(_scrape_responses(spark, sf), strict=True, repair=False).select("response_id", "markdown")


@query(
    "parse_records",
    f"""SELECT response_id, title, {_SCRAPE_URL} AS url, CAST(NULL AS VARCHAR) AS language,
        coalesce({_SCRAPE_CREDITS}, 1) AS "creditsUsed", {_SCRAPE_MD} AS markdown FROM {_PAGES}""",
)
def _(spark, sf):
    return parse_records(_scrape_responses(spark, sf))


@query("flatten_scrapes", f"""SELECT response_id, concat('## title: ', title, chr(10), '## description: ', chr(10), '## url: ', {_SCRAPE_URL}, chr(10), '## language: ', chr(10),
    '## creditsUsed: ', CASE page_id % 5 WHEN 1 THEN concat(page_id, '.5') WHEN 0 THEN CAST(page_id AS VARCHAR) WHEN 2 THEN CAST(page_id AS VARCHAR) ELSE '' END, chr(10), chr(10), '---', chr(10), chr(10), coalesce({_SCRAPE_MD}, ''), chr(10)) AS export_text FROM {_PAGES}""")
def _(spark, sf):
    return flatten_scrapes(_scrape_responses(spark, sf))[0].select("response_id", "export_text")


@query(
    "scrapes_with_fallback",
    f"""SELECT response_id, page_id % 10 = 0 AS used_fallback, CASE WHEN page_id % 10 = 0 THEN concat('again ', title) ELSE {_SCRAPE_MD} END AS markdown,
        CASE WHEN page_id % 10 = 0 THEN 'T' ELSE title END AS title FROM {_PAGES}""",
)
def _(spark, sf):
    first = _scrape_responses(spark, sf)
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    raw = F.when(
        F.col("page_id") % 10 != 5,
        F.concat(
            F.lit('{"data":{"metadata":{"title":"T"},"markdown":'),
            _json(F.concat(F.lit("again "), F.replace(title, F.lit("%"), F.lit("%25")))), F.lit("}}"),
        ),
    ).otherwise('{"success":false,"data":{"markdown":"no"}}')
    second = table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("response_id"), F.col("url").alias("target_url"), raw.alias("raw")
    )
    merged = scrapes_with_fallback(first, parse_responses(second))[0]
    return merged.select("response_id", "used_fallback", "markdown", "title")


@query("resolved_url", f"SELECT response_id, {_SCRAPE_URL} AS url FROM {_PAGES}")
def _(spark, sf):
    return _scrape_responses(spark, sf).select("response_id", resolved_url("v", "target_url").alias("url"))


@query(
    "credits_used",
    f"""SELECT response_id, CAST(1 AS DOUBLE) AS root, {_SCRAPE_CREDITS} AS meta,
        coalesce({_SCRAPE_CREDITS}, 1) AS either FROM {_PAGES}""",
)
def _(spark, sf):
    return _scrape_responses(spark, sf).select(
        "response_id",
        credits_used("v", "search").alias("root"),
        credits_used("v", "scrape").alias("meta"),
        credits_used("v", "av").alias("either"),
    )


def _av_sql(kind, rest):
    return f"""SELECT CAST(doc_id AS VARCHAR) AS response_id, CAST(n_chars AS DOUBLE) AS "creditsUsed", source AS title, lang AS description,
        CASE WHEN doc_id % 2 = {rest} THEN concat('https://media.example/', doc_id) END AS {kind}, true AS success FROM documents"""


def _av_responses(spark, sf):
    lit = F.lit
    kind = F.when(F.col("doc_id") % 2 == 0, "audio").otherwise("video")
    raw = F.concat(
        lit('{"success":true,"creditsUsed":'), F.col("n_chars"), lit(',"data":{"metadata":{"title":'), _json(F.col("source")),
        lit(',"description":'), _json(F.col("lang")), lit('},"'), kind, lit('":"https://media.example/'), F.col("doc_id"), lit('"}}'),
    )
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("response_id"), raw.alias("raw"))
    return parse_responses(docs)


@query("audio_records", _av_sql("audio", 0))
def _(spark, sf):
    return av_records(_av_responses(spark, sf), "audio")


@query("video_records", _av_sql("video", 1))
def _(spark, sf):
    return av_records(_av_responses(spark, sf), "video")


@query(
    "credit_snapshots",
    """SELECT CAST(c_custkey AS VARCHAR) AS response_id, CAST(CASE WHEN c_custkey % 4 <> 0 THEN c_custkey END AS DOUBLE) AS "remainingCredits", CAST(c_nationkey AS DOUBLE) + 0.25 AS "planCredits",
       TIMESTAMP '2025-01-01 00:00:00' + to_days(CAST(c_nationkey AS INTEGER)) AS "billingPeriodStart", CAST(NULL AS TIMESTAMP) AS "billingPeriodEnd" FROM customer""",
)
def _(spark, sf):
    lit = F.lit
    start = F.date_format(F.date_add(lit("2025-01-01").cast("date"), F.col("c_nationkey")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    remaining = F.when(F.col("c_custkey") % 4 == 0, lit('"many"')).otherwise(F.col("c_custkey").cast("string"))
    raw = F.concat(
        lit('{"success":true,"data":{"remainingCredits":'), remaining, lit(',"planCredits":'), F.col("c_nationkey"), lit(".25"),
        lit(',"billingPeriodStart":"'), start, lit('","billingPeriodEnd":"soon"}}'),
    )
    named = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("response_id"), raw.alias("raw"))
    return credit_snapshots(parse_responses(named))


@query(
    "pick",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(-1 AS BIGINT) AS missing, CAST(NULL AS BIGINT) AS through_scalar,
       CAST(NULL AS BIGINT) AS present_null FROM events""",
)
def _(spark, sf):
    props = table(spark, sf, "events").withColumn("v", F.try_parse_json("props"))
    nulled = F.try_parse_json(F.concat(F.lit('{"k":null,"id":'), F.col("event_id"), F.lit("}")))
    return props.select(
        "event_id",
        pick("v", "k", as_type="long").alias("k"),
        pick("v", "no", "such", default=-1, as_type="long").alias("missing"),
        pick("v", "k", "deeper", as_type="long").alias("through_scalar"),
        pick(nulled, "k", default=5, as_type="long").alias("present_null"),
    )


_BODIES = {
    "view": ('\'{"success":true,"data":{"k":\' || event_id || \'}}\'', "ok", None),
    "click": ('\'{"success":true,"error":"quota","data":{"k":\' || event_id || \'}}\'', "error", "'quota'"),
    "error": ("'<html>' || event_id", "unparseable", "'response is not JSON'"),
    "purchase": (
        '\'{"success":false,"upstream":{"upstream":{"upstream":{"upstream":{"upstream":{"message":"deep \' || event_id || \'"}}}}}}\'',
        "upstream_false",
        "'deep ' || event_id",
    ),
    "signup": (
        'CASE CAST(event_id % 4 AS INT) WHEN 0 THEN \'  \' WHEN 1 THEN \'[\' || event_id || \']\' WHEN 2 THEN \'null\' ELSE \'{"error":[],"success":"no","data":[]}\' END',
        None,
        None,
    ),
}
_RAW = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {b}" for k, (b, _, _) in _BODIES.items()) + " END"
_STATUS = "CASE WHEN event_id % 10 = 0 THEN 503 ELSE 200 END"
_OUTCOME = (
    f"CASE WHEN {_STATUS} = 503 THEN 'http_error' "
    + " ".join(f"WHEN event_type = '{k}' THEN '{o}'" for k, (_, o, _) in _BODIES.items() if o)
    + " ELSE CASE CAST(event_id % 4 AS INT) WHEN 1 THEN 'malformed' WHEN 3 THEN 'missing_data' ELSE 'empty' END END"
)


def _event_responses(spark, sf):
    events = table(spark, sf, "events")
    named = events.select(F.col("event_id").cast("string").alias("response_id"), F.expr(_RAW).alias("raw"), F.expr(_STATUS).alias("status"))
    return parse_responses(named)


@query("classify", f"SELECT CAST(event_id AS VARCHAR) AS response_id, {_OUTCOME} AS outcome FROM events")
def _(spark, sf):
    return classify(_event_responses(spark, sf), "search", "status").select("response_id", "outcome")


_REASON = f"""CASE event_type WHEN 'click' THEN 'quota' WHEN 'purchase' THEN concat('deep ', event_id)
    WHEN 'signup' THEN CASE WHEN event_id % 4 = 3 THEN '[]' ELSE 'unknown error' END ELSE 'unknown error' END"""


@query("error_reason", f"SELECT CAST(event_id AS VARCHAR) AS response_id, {_REASON} AS reason FROM events")
def _(spark, sf):
    return _event_responses(spark, sf).select("response_id", error_reason("v").alias("reason"))


@query(
    "quarantine",
    f"""SELECT * FROM (SELECT CAST(event_id AS VARCHAR) AS response_id, {_OUTCOME} AS outcome, CASE {_OUTCOME}
        WHEN 'unparseable' THEN 'response is not JSON' WHEN 'empty' THEN 'response is empty' WHEN 'malformed' THEN 'response is not an object'
        WHEN 'missing_data' THEN 'response is missing data object' ELSE {_REASON} END AS message FROM events) WHERE outcome <> 'ok'""",
)
def _(spark, sf):
    bad = split_outcomes(classify(_event_responses(spark, sf), "search", "status"))[1]
    return bad.select("response_id", "outcome", "message")


@query(
    "read_responses",
    """SELECT CAST(page_id AS VARCHAR) AS response_id, CASE WHEN page_id % 3 = 0 THEN url END AS url, page_id % 3 = 0 AS is_json FROM pages""",
)
def _(spark, sf):
    m = F.col("page_id") % 3
    body = F.to_json(F.struct("page_id", "url", "html"))
    raw = F.when(m == 0, body).when(m == 1, F.concat(body, F.lit("}"))).otherwise(F.lit(""))
    named = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("response_id"), raw.alias("raw"))
    return parse_responses(named).select("response_id", pick("v", "url").alias("url"), F.col("v").isNotNull().alias("is_json"))


_DICT = """CASE CAST(c_custkey % 4 AS INT) WHEN 0 THEN concat('{"n', c_nationkey, '":"', c_name, '"}')
    WHEN 1 THEN concat('{"n', c_nationkey, '":["', c_name, '", 5, null, "', c_mktsegment, '"], "x":["', c_name, '"]}')
    WHEN 2 THEN concat('{"n', c_nationkey, '":{"a":"', c_name, '"}}') ELSE c_name END"""


@query(
    "load_aliases",
    """SELECT concat('N', c_nationkey) AS code, c_name AS alias FROM customer WHERE c_custkey % 4 < 2
       UNION ALL SELECT concat('N', c_nationkey), c_mktsegment FROM customer WHERE c_custkey % 4 = 1
       UNION ALL SELECT 'X', c_name FROM customer WHERE c_custkey % 4 = 1""",
)
def _(spark, sf):
    return dictionary_aliases(dictionary_entries(table(spark, sf, "customer").select(F.expr(_DICT).alias("value"))))


def _records(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.col("source").alias("title"),
        F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("description"),
        F.concat(F.lit("https://docs.example/"), F.col("doc_id")).alias("url"),
        F.col("lang").alias("language"),
        F.when(F.col("doc_id") % 3 == 0, F.col("n_chars")).alias("creditsUsed"),
        F.when(F.col("doc_id") % 5 != 0, F.col("text")).alias("markdown"),
        F.when(F.col("doc_id") % 7 == 0, "error").otherwise("ok").alias("outcome"),
    )


_HEAD = """concat('## title: ', source, chr(10), {d}'## url: https://docs.example/', doc_id, chr(10), '## language: ', lang, chr(10),
    '## creditsUsed: ', CASE WHEN doc_id % 3 = 0 THEN CAST(n_chars AS VARCHAR) ELSE '' END, chr(10), chr(10), {rule}
    CASE WHEN doc_id % 5 <> 0 THEN text ELSE '' END, chr(10))"""
_CAPTURE = _HEAD.format(
    d="'## description: ', CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END, chr(10), ", rule="'---', chr(10), chr(10),"
)


@query("render_capture", f"SELECT doc_id, {_CAPTURE} AS export_text FROM documents")
def _(spark, sf):
    return render_capture(_records(spark, sf)).select("doc_id", "export_text")


@query("render_parsed", f"SELECT doc_id, {_HEAD.format(d='', rule='')} AS export_text FROM documents")
def _(spark, sf):
    return render_parsed(_records(spark, sf)).select("doc_id", "export_text")


@query(
    "write_exports",
    f"SELECT concat('exports/doc', doc_id, '.md') AS export_name, {_CAPTURE} AS export_text FROM documents WHERE doc_id % 7 <> 0",
)
def _(spark, sf):
    name = export_path(F.concat(F.lit("doc"), F.col("doc_id")), "exports")
    folder = new_path(spark, "exports")
    write_exports(render_capture(_records(spark, sf)).withColumn("export_name", name), folder)
    return spark.read.parquet(folder)


@query(
    "write_exports_batches",
    f"""SELECT concat('exports/doc', doc_id, '.md') AS export_name, {_CAPTURE} AS export_text, CAST(doc_id % 2 AS INTEGER) AS batch FROM documents WHERE doc_id % 7 <> 0""",
)
def _(spark, sf):
    # All rows, in two batches; the first is written again after the second.
    name = export_path(F.concat(F.lit("doc"), F.col("doc_id")), "exports")
    records = render_capture(_records(spark, sf)).withColumn("export_name", name)
    folder = new_path(spark, "exports")
    for batch in (0, 1, 0):
        write_exports(records.filter(F.col("doc_id") % 2 == batch), folder, batch=batch, compact=batch == 1)
    return spark.read.parquet(folder)


@query("supported_documents", "SELECT page_id, url FROM pages WHERE regexp_matches(lower(url), '\\.(html|htm|pdf|docx|doc|odt|rtf|xlsx|xls)$')")
def _(spark, sf):
    return supported_documents(table(spark, sf, "pages"), "url").select("page_id", "url")


@query(
    "write_exports_files",
    f"SELECT concat('exports/doc', doc_id, '.md') AS export_name, {_CAPTURE} AS export_text FROM documents WHERE doc_id % 7 <> 0",
)
def _(spark, sf):
    name = export_path(F.concat(F.lit("doc"), F.col("doc_id")), "exports")
    folder = new_path(spark, "exports")
    write_exports(render_capture(_records(spark, sf)).withColumn("export_name", name), folder, layout="files")
    # As binary files: the reader of whole texts sets up a Hadoop job for each of them.
    files = spark.read.format("binaryFile").load(f"{folder}/exports")
    return files.select(F.concat(F.lit("exports/"), F.substring_index("path", "/", -1)).alias("export_name"), F.col("content").cast("string").alias("export_text"))
