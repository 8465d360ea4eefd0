"""Queries for the search over captured text."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import registry, table
from webcapture.operators.search import grep_lines, keyword_hits, keyword_ranking, outline, read_lines, text_lines

QUERIES, ORACLES, query = registry()

_LINES = """(SELECT doc_id, unnest(list_transform(string_split(CASE WHEN text LIKE '%' || chr(10) THEN left(text, -1) ELSE text END, chr(10)), lambda l, i: {'line_no': i, 'line': l}), recursive := true)
    FROM documents WHERE text <> '')"""
_PATTERN = r"\bthe\b|Qu[a-zé]+\.$|[0-9]{3}"


@query("text_lines", f"SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM {_LINES}")
def _(spark, sf):
    return text_lines(table(spark, sf, "documents"), "doc_id")


@query("grep_lines", f"SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM {_LINES} WHERE regexp_matches(line, '{_PATTERN}')")
def _(spark, sf):
    return grep_lines(table(spark, sf, "documents"), _PATTERN, "doc_id")


@query("read_lines", f"SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM {_LINES} WHERE line_no BETWEEN 3 AND 8")
def _(spark, sf):
    return read_lines(table(spark, sf, "documents"), 3, 8, "doc_id")


_CAPTURED = "concat('# ', source, chr(10), chr(10), text, chr(10), '###   end ', lang, chr(10), '#no heading')"


@query(
    "outline",
    f"""WITH c AS (SELECT doc_id, {_CAPTURED} AS t FROM documents), l AS (SELECT doc_id, t, string_split(t, chr(10)) AS ls FROM c),
        h AS (SELECT doc_id, t, ls, list_filter(list_transform(ls, lambda x, i: {{'i': i, 'm': length(regexp_extract(x, '^(#{{1,6}})\\s', 1)), 'x': x}}), lambda s: s.m > 0) AS hs FROM l)
        SELECT doc_id, CAST(length(t) AS INTEGER) AS n_chars, CAST(len(ls) AS INTEGER) AS n_lines,
        array_to_string(list_transform(hs, lambda s: concat(s.i, ':', s.m, ':', trim(regexp_replace(s.x, '^#{{1,6}}\\s+', '')))), '|') AS headings FROM h""",
)
def _(spark, sf):
    captured = table(spark, sf, "documents").select("doc_id", F.expr(_CAPTURED).alias("text"))
    flat = F.transform("headings", lambda h: F.concat_ws(":", h["line_no"].cast("string"), h["level"].cast("string"), h["title"]))
    return outline(captured, "doc_id").withColumn("headings", F.array_join(flat, "|"))


_KEYWORDS = ("the", "ing[a-z]", "que", "[%$]{3}")
_COUNTS = [f"len(regexp_extract_all(text, '{k}'))" for k in _KEYWORDS]


@query(
    "keyword_hits",
    "SELECT doc_id, keyword, CAST(hits AS INTEGER) AS hits FROM ("
    + " UNION ALL ".join(f"SELECT doc_id, '{k}' AS keyword, {c} AS hits FROM documents" for k, c in zip(_KEYWORDS, _COUNTS))
    + ") WHERE hits > 0",
)
def _(spark, sf):
    return keyword_hits(table(spark, sf, "documents"), _KEYWORDS, "doc_id")


@query(
    "keyword_ranking",
    f"SELECT doc_id, CAST({' + '.join(_COUNTS)} AS INTEGER) AS hits, CAST({' + '.join(f'CAST({c} > 0 AS INTEGER)' for c in _COUNTS)} AS INTEGER) AS n_keywords FROM documents WHERE {' + '.join(_COUNTS)} > 0",
)
def _(spark, sf):
    return keyword_ranking(table(spark, sf, "documents"), _KEYWORDS, "doc_id")


# Some five thousand literal keywords: every pair of syllables.
_SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve ch ge ie un sc be ll ra os as ci la qu et eu ai ion ing tion and the que ung lich keit heit ver ent men ado aci ment eau eux".split()
_PAIRS = list(dict.fromkeys(a + b for a in _SYLLABLES for b in _SYLLABLES))


@query(
    "keyword_profile",
    f"""WITH s AS (SELECT unnest({_SYLLABLES}) AS x), k AS (SELECT DISTINCT a.x || b.x AS keyword FROM s a, s b)
        SELECT doc_id, keyword, CAST((length(text) - length(replace(text, keyword, ''))) // length(keyword) AS INTEGER) AS hits FROM documents, k WHERE contains(text, keyword)""",
)
def _(spark, sf):
    return keyword_hits(table(spark, sf, "documents"), _PAIRS, "doc_id")
