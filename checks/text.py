"""Queries for the text, name, recency, selector and header functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import registry, table
from webcapture.functions.headers import merge_headers, parse_header_block, parse_header_json, parse_headers
from webcapture.functions.names import alias_variants, normalize_name
from webcapture.functions.recency import recency_code, recency_error
from webcapture.functions.selectors import DEFAULT_EXCLUDES, parse_selectors, resolve_excludes, selectors_error
from webcapture.functions.text import (
    export_path,
    percent_decode,
    repair_newlines,
    stable_unique,
    strip_base64_images,
    text_window,
    to_compact_json,
)

QUERIES, ORACLES, query = registry()


# Every second text ends in a malformed escape, and all carry a plus sign.
_ENCODED_SQL = """
    SELECT doc_id, concat('a+b%20', replace(text, ' ', '%20'), CASE WHEN doc_id % 2 = 0 THEN '%C3%A9%zz' ELSE '%C3%A9' END) AS x
    FROM documents
"""


def _encoded(spark, sf):
    x = F.concat(
        F.lit("a+b%20"),
        F.replace("text", F.lit(" "), F.lit("%20")),
        F.when(F.col("doc_id") % 2 == 0, "%C3%A9%zz").otherwise("%C3%A9"),
    )
    return table(spark, sf, "documents").select("doc_id", x.alias("x"))


@query(
    "percent_decode_lenient",
    f"SELECT doc_id, url_decode(regexp_replace(x, '%([^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f])', '%25\\1', 'g')) AS decoded FROM "
    f"(SELECT doc_id, regexp_replace(regexp_replace(x, '%%', '%25%', 'g'), '%%', '%25%', 'g') AS x FROM ({_ENCODED_SQL}))",
)
def _(spark, sf):
    return _encoded(spark, sf).select("doc_id", percent_decode("x").alias("decoded"))


@query(
    "percent_decode_strict",
    f"SELECT doc_id, CASE WHEN regexp_matches(x, '(?s)%([^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|.?$)') THEN x ELSE url_decode(x) END AS decoded FROM ({_ENCODED_SQL})",
)
def _(spark, sf):
    return _encoded(spark, sf).select("doc_id", percent_decode("x", strict=True).alias("decoded"))


@query("repair_newlines", "SELECT doc_id, concat(text, chr(10), 'end') AS repaired FROM documents")
def _(spark, sf):
    broken = F.concat(F.replace("text", F.lit("\n"), F.lit("\\n")), F.lit("\\nend"))
    return table(spark, sf, "documents").select("doc_id", repair_newlines(broken).alias("repaired"))


@query(
    "text_window",
    """SELECT doc_id, CASE WHEN n_chars % 60 - 5 > 0
              THEN substr(text, CASE WHEN doc_id % 90 - 20 < 0 THEN 1 ELSE doc_id % 90 - 19 END, n_chars % 60 - 5)
              ELSE text END AS part FROM documents""",
)
def _(spark, sf):
    part = text_window("text", F.col("n_chars") % 60 - 5, F.col("doc_id") % 90 - 20)
    return table(spark, sf, "documents").select("doc_id", part.alias("part"))


@query(
    "strip_base64_images",
    "SELECT doc_id, concat('![pic](', ') ', text, '<img src=\"\" alt=\"x\">') AS stripped FROM documents",
)
def _(spark, sf):
    payload = F.base64(F.encode("text", "utf-8"))
    payload = F.regexp_replace(payload, r"\s", "")
    with_images = F.concat(
        F.lit("![pic](data:image/png;base64,"), payload, F.lit(") "), F.col("text"),
        F.lit('<img src="data:image/svg+xml;charset=utf-8;base64,'), payload, F.lit('" alt="x">'),
    )
    return table(spark, sf, "documents").select("doc_id", strip_base64_images(with_images).alias("stripped"))


@query(
    "normalize_name",
    r"""SELECT doc_id, trim(regexp_replace(regexp_replace(trim(lower(strip_accents(text)), chr(32) || chr(10) || chr(9) || chr(13)),
              '[^\p{L}\p{N}\s''_-]', ' ', 'g'), '[_\s]+', ' ', 'g')) AS name FROM documents""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", normalize_name("text").alias("name"))


_ALIAS = "CASE WHEN p_partkey % 3 = 0 THEN concat(p_type, ', ', p_name) WHEN p_partkey % 3 = 1 THEN concat(' ', p_name, '!') ELSE concat(p_name, ' ', p_brand) END"


@query(
    "alias_variants",
    f"""WITH a AS (SELECT p_partkey, trim({_ALIAS}) AS base FROM part),
    n AS (SELECT *, trim(regexp_replace(regexp_replace(lower(base), '[^a-z0-9''_ -]', ' ', 'g'), '[_ ]+', ' ', 'g')) AS norm,
          list_filter(list_transform(string_split(base, ','), lambda p: trim(p)), lambda p: p <> '') AS parts FROM a),
    v AS (SELECT p_partkey, [base, norm, trim(regexp_replace(norm, '[^a-z0-9 ]', '', 'g')),
          CASE WHEN len(parts) >= 2 THEN array_to_string(list_reverse(parts), ' ') END,
          CASE WHEN len(parts) >= 2 THEN trim(regexp_replace(regexp_replace(lower(array_to_string(list_reverse(parts), ' ')), '[^a-z0-9''_ -]', ' ', 'g'), '[_ ]+', ' ', 'g')) END,
          CASE WHEN len(string_split(norm, ' ')) = 2 THEN array_to_string(list_reverse(string_split(norm, ' ')), ' ') END] AS all_v FROM n)
    SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(all_v, lambda x: x <> ''))), '|') AS variants FROM v""",
)
def _(spark, sf):
    variants = F.array_join(F.array_sort(alias_variants(F.expr(_ALIAS))), "|")
    return table(spark, sf, "part").select("p_partkey", variants.alias("variants"))


# Fixed phrases around a number taken from the event.
_PHRASES = [
    "'past ' || {n} || ' days'", "'last ' || {n} || ' weeks'", "{n} || 'h'", "'24H'", "'Past  Year'", "'最近一周'",
    "'过去' || {n} || '天'", "'QDR:m'", "'qdr:x'", "'daily'", "'someday'", "'in ' || {n} || ' mo'", "{n} || '年'",
    "'pasthour ' || {n}", "'months of ' || {n} || ' days'", "'  hours '", "'last yearly'", "''", "'' || {n}", "'yr_' || {n}",
]
_N = "CAST(event_id % 37 AS STRING)"
_PHRASE = "CASE CAST(event_id % 20 AS INT) " + " ".join(
    f"WHEN {i} THEN {p.format(n=_N)}" for i, p in enumerate(_PHRASES)
) + " END"


def _unit_sql(words, unit, short, *more):
    edge_l, edge_r = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
    parts = [f"{edge_l}({words}){edge_r}", rf"(last|past)\s+{unit}", rf"\p{{Nd}}\s*{short}{edge_r}", *more]
    return "regexp_matches(t, '" + "|".join(parts) + "')"


@query(
    "recency_code",
    f"""SELECT event_id, CASE WHEN starts_with(t, 'qdr:') THEN CASE WHEN t IN ('qdr:h','qdr:d','qdr:w','qdr:m','qdr:y') THEN t END
        WHEN {_unit_sql('y|yr|yrs|year|years', 'year', 'y', '年')} THEN 'qdr:y'
        WHEN {_unit_sql('mo|mos|month|months', 'month', 'mo', '月')} THEN 'qdr:m'
        WHEN {_unit_sql('w|wk|wks|week|weeks', 'week', 'w', '周', '星期')} THEN 'qdr:w'
        WHEN {_unit_sql('d|day|days', 'day', 'd', '天', '日', 'daily')} THEN 'qdr:d'
        WHEN {_unit_sql('h|hr|hrs|hour|hours', 'hour', 'h', '小时')} THEN 'qdr:h' END AS code
        FROM (SELECT event_id, lower(trim({_PHRASE})) AS t FROM events)""",
)
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", recency_code(F.expr(_PHRASE)).alias("code"))


_STRICT = "CASE CAST(event_id % 7 AS INT) WHEN 0 THEN ' Hour ' WHEN 1 THEN 'day' WHEN 2 THEN 'WEEK' WHEN 3 THEN 'month' WHEN 4 THEN 'year' WHEN 5 THEN ' ' ELSE event_type END"


@query(
    "recency_code_strict",
    f"""SELECT event_id, CASE t WHEN 'hour' THEN 'qdr:h' WHEN 'day' THEN 'qdr:d' WHEN 'week' THEN 'qdr:w' WHEN 'month' THEN 'qdr:m' WHEN 'year' THEN 'qdr:y' END AS code,
        t NOT IN ('', 'hour', 'day', 'week', 'month', 'year') AS rejected FROM (SELECT event_id, lower(trim({_STRICT})) AS t FROM events)""",
)
def _(spark, sf):
    text = F.expr(_STRICT)
    return table(spark, sf, "events").select(
        "event_id", recency_code(text, strict=True).alias("code"), recency_error(text).isNotNull().alias("rejected")
    )


_LIST = """CASE CAST(p_partkey % 4 AS INT) WHEN 0 THEN concat(' .', replace(p_name, ' ', ' , .'), ',, .x , .x')
    WHEN 1 THEN concat('[".', replace(p_name, ' ', '", " '), '", null, "", "', p_type, '"]')
    WHEN 2 THEN concat('["', p_name, '", 5]') ELSE '  ' END"""


@query(
    "parse_selectors",
    """SELECT p_partkey, p_partkey % 4 = 2 AS rejected, CASE CAST(p_partkey % 4 AS INT)
        WHEN 0 THEN concat('.', replace(p_name, ' ', '|.'), '|.x')
        WHEN 1 THEN concat('.', replace(p_name, ' ', '|'), '|', p_type) END AS selectors FROM part""",
)
def _(spark, sf):
    text = F.expr(_LIST)
    return table(spark, sf, "part").select(
        "p_partkey",
        selectors_error(text).isNotNull().alias("rejected"),
        F.array_join(parse_selectors(text), "|").alias("selectors"),
    )


_BUILT_IN = "|".join(DEFAULT_EXCLUDES)


@query(
    "resolve_excludes",
    f"""SELECT p_partkey, concat('{_BUILT_IN}', '|', p_name, CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '|.x' END) AS resolved,
        concat('nav|', p_name, CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '|.x' END) AS user_only FROM part""",
)
def _(spark, sf):
    user = F.array(F.lit("nav"), F.concat(F.col("p_name"), F.lit(" ")), F.lit(" "), F.when(F.col("p_partkey") % 2 == 0, "nav").otherwise(".x"))
    return table(spark, sf, "part").select(
        "p_partkey",
        F.array_join(resolve_excludes(user), "|").alias("resolved"),
        F.array_join(resolve_excludes(user, empty_tags=True), "|").alias("user_only"),
    )


@query(
    "stable_unique",
    """WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents),
       f AS (SELECT doc_id, word, min(i) AS i FROM w GROUP BY doc_id, word)
       SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words FROM f GROUP BY doc_id""",
)
def _(spark, sf):
    words = F.array_join(stable_unique(F.split("text", " ")), " ")
    return table(spark, sf, "documents").select("doc_id", words.alias("words"))


@query(
    "export_path",
    r"""WITH b AS (SELECT page_id, regexp_replace(regexp_replace(url, '/+$', ''), '^.*/', '') AS base FROM pages)
       SELECT page_id, concat('out/pages/', base, CASE WHEN lower(base) LIKE '%.md' THEN '' ELSE '.md' END) AS path,
              concat('page', page_id, '.MD') AS kept FROM b""",
)
def _(spark, sf):
    named = F.concat(F.lit(" /x/page"), F.col("page_id").cast("string"), F.lit(".MD "))
    return table(spark, sf, "pages").select(
        "page_id", export_path("url", "./out//pages/").alias("path"), export_path(named).alias("kept")
    )


@query(
    "compact_json",
    """SELECT c_custkey, concat('{"c_custkey":', c_custkey, ',"c_name":"', c_name, '","segment":',
        CASE WHEN c_nationkey % 3 = 0 THEN 'null' ELSE concat('"<&>é ', c_mktsegment, '"') END, ',"nested":{"n":', c_nationkey, ',"none":null}}') AS line FROM customer""",
)
def _(spark, sf):
    row = F.struct(
        "c_custkey",
        "c_name",
        F.when(F.col("c_nationkey") % 3 != 0, F.concat(F.lit("<&>é "), F.col("c_mktsegment"))).alias("segment"),
        F.struct(F.col("c_nationkey").alias("n"), F.lit(None).cast("string").alias("none")).alias("nested"),
    )
    return table(spark, sf, "customer").select("c_custkey", to_compact_json(row).alias("line"))


_BLOCK = r"""concat('HTTP/1.1 200 OK', chr(13), chr(10), ':status: 200', chr(10), 'X-Name: ', c_name, chr(13), chr(10),
    'X-Seg:', c_mktsegment, chr(10), 'X-Seg: again', chr(10), 'X-Seg:', chr(10), ' folded  ', chr(10), chr(10), 'x-seg: lower',
    CASE WHEN c_custkey % 5 = 0 THEN concat(chr(10), 'bad line') ELSE '' END)"""


@query(
    "parse_header_block",
    """SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN concat('X-Name=', c_name, ';X-Seg=', c_mktsegment, ', again folded;x-seg=lower') END AS headers FROM customer""",
)
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", _flat(parse_header_block(F.expr(_BLOCK))).alias("headers"))


def _flat(m):
    """A map as sorted text; null stays null."""
    entries = F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(entries, ";")


_RECORDS = """CASE CAST(c_custkey % 6 AS INT)
    WHEN 0 THEN concat('{"headers":[{"name":" X-Name ","value":"', c_name, '"},{"name":"A","value":"1"},{"name":"A","value":"2"}]}')
    WHEN 1 THEN concat('[{"name":"X-Name","value":"', c_name, '"}]')
    WHEN 2 THEN concat('{"X-Name":"', c_name, '","b c":""}')
    WHEN 3 THEN concat('{"X-Name":"', c_name, '","n":1}')
    WHEN 4 THEN concat('[{"name":"bad name","value":"', c_name, '"}]')
    ELSE concat('[{"name":"X","value":"', c_name, '","domain":"d"}]') END"""


@query(
    "parse_header_json",
    """SELECT c_custkey, CASE CAST(c_custkey % 6 AS INT) WHEN 0 THEN concat('A=2;X-Name=', c_name) WHEN 1 THEN concat('X-Name=', c_name)
       WHEN 2 THEN concat('X-Name=', c_name, ';b c=') END AS headers FROM customer""",
)
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", _flat(parse_header_json(F.expr(_RECORDS))).alias("headers"))


@query(
    "merge_headers",
    """SELECT c_custkey, CASE CAST(c_custkey % 6 AS INT) WHEN 0 THEN concat('A=2;X-Name=', c_name, ';X-Seg=', c_mktsegment, ', again folded;x-seg=lower')
       WHEN 1 THEN concat('X-Name=', c_name, ';X-Seg=', c_mktsegment, ', again folded;x-seg=lower')
       WHEN 2 THEN concat('X-Name=', c_name, ';X-Seg=', c_mktsegment, ', again folded;b c=;x-seg=lower')
       ELSE concat('X-Name=', c_name, ';X-Seg=', c_mktsegment, ', again folded;x-seg=lower') END AS headers
       FROM customer WHERE c_custkey % 5 <> 0
       UNION ALL SELECT c_custkey, CASE CAST(c_custkey % 6 AS INT) WHEN 0 THEN concat('A=2;X-Name=', c_name) WHEN 1 THEN concat('X-Name=', c_name)
       WHEN 2 THEN concat('X-Name=', c_name, ';b c=') END FROM customer WHERE c_custkey % 5 = 0""",
)
def _(spark, sf):
    merged = merge_headers(parse_headers(F.expr(_BLOCK)), parse_headers(F.expr(_RECORDS)))
    return table(spark, sf, "customer").select("c_custkey", _flat(merged).alias("headers"))
