"""Queries for request checks, request filters, limits and freshness."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import registry, table
from webcapture.functions.recency import recency_code
from webcapture.operators.requests import (
    clamp_limit,
    fresh_captures,
    has_all,
    in_date_window,
    recent,
    top_papers,
    validate_requests,
)

QUERIES, ORACLES, query = registry()

_AS_OF = "2024-01-20 12:00:00"


@query(
    "recent_week",
    f"SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '{_AS_OF}' - INTERVAL 7 DAY AND ts <= TIMESTAMP '{_AS_OF}'",
)
def _(spark, sf):
    return recent(table(spark, sf, "events").select("event_id", "ts"), "ts", "qdr:w", _AS_OF)


@query(
    "recent_by_phrase",
    f"""SELECT event_id, event_type FROM events WHERE event_type = 'error' OR (ts <= TIMESTAMP '{_AS_OF}' AND ts > TIMESTAMP '{_AS_OF}' -
        CASE event_type WHEN 'view' THEN INTERVAL 1 HOUR WHEN 'click' THEN INTERVAL 1 DAY WHEN 'purchase' THEN INTERVAL 1 MONTH ELSE INTERVAL 1 YEAR END)""",
)
def _(spark, sf):
    phrase = F.expr(
        "CASE event_type WHEN 'view' THEN 'past hour' WHEN 'click' THEN '1 day' WHEN 'purchase' THEN '最近一月' WHEN 'error' THEN 'whenever' ELSE 'last year' END"
    )
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return recent(events, "ts", recency_code(phrase), _AS_OF).drop("ts")


@query(
    "has_all_categories",
    """SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT CASE WHEN l_returnflag IN ('A', 'N') THEN l_returnflag END) = 2""",
)
def _(spark, sf):
    flags = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("flags"))
    return flags.filter(has_all("flags", ["A", "N"])).select("l_orderkey")


@query(
    "in_date_window",
    """SELECT o_orderkey FROM orders WHERE (o_orderdate >= DATE '1996-02-01' AND o_orderdate < DATE '1997-01-01')
       OR (CAST(o_orderdate + to_days(CAST(o_custkey % 400 AS INTEGER)) AS DATE) BETWEEN DATE '1996-02-01' AND DATE '1996-12-31')""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    updated = F.date_format(F.date_add("o_orderdate", (F.col("o_custkey") % 400).cast("int")), "yyyy-MM-dd")
    orders = orders.withColumn("updated", F.when(F.col("o_orderkey") >= 0, updated).otherwise("soon"))
    return orders.filter(in_date_window(orders, ["o_orderdate", "updated"], "1996-02-01", "1996-12-31")).select("o_orderkey")


@query("created_since", "SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1998-01-01'")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.filter(in_date_window(orders, "o_orderdate", frm="1998-01-01")).select("o_orderkey")


_SEARCH = """l_orderkey, l_linenumber, CASE WHEN l_suppkey % 9 = 0 THEN '  ' ELSE l_returnflag END AS query, CAST(l_quantity * 3 AS INT) - 10 AS search_num,
    CASE WHEN l_linenumber = 3 THEN 9223372037 ELSE CAST(l_linenumber AS BIGINT) - 1 END AS timeout_s,
    CASE WHEN l_partkey % 5 = 0 THEN 'fortnight' WHEN l_partkey % 5 = 1 THEN '' ELSE ' Week' END AS search_time"""


def _reject_sql(top, last=""):
    return f"""SELECT l_orderkey, l_linenumber, CASE WHEN trim(query) = '' THEN 'query is required'
        WHEN search_num NOT BETWEEN 1 AND {top} THEN 'search_num must be an integer from 1 to {top}'
        WHEN timeout_s <= 0 THEN 'timeout must be an integer greater than 0' WHEN timeout_s > 9223372036 THEN 'timeout is too large' {last} END AS reject_reason
        FROM (SELECT {_SEARCH} FROM lineitem)"""


@query("validate_search", _reject_sql(100, "WHEN search_time = 'fortnight' THEN 'time filter must be hour, day, week, month or year'"))
def _(spark, sf):
    return validate_requests(_request_rows(spark, sf), "search").select("l_orderkey", "l_linenumber", "reject_reason")


def _request_rows(spark, sf):
    return spark.sql(f"SELECT {_SEARCH} FROM {{lines}}", lines=table(spark, sf, "lineitem"))


@query("validate_scholar", _reject_sql(500))
def _(spark, sf):
    return validate_requests(_request_rows(spark, sf), "scholar").select("l_orderkey", "l_linenumber", "reject_reason")


@query(
    "validate_parse",
    """SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'output is required' WHEN page_id % 4 = 0 THEN 'only one of url or file may be provided'
         WHEN page_id % 4 = 1 THEN 'one of url or file is required' WHEN page_id % 5 = 0 THEN 'timeout must be an integer greater than 0'
         WHEN page_id % 4 = 2 AND page_id % 3 = 0 THEN 'file extension must be one of: .html, .htm, .pdf, .docx, .doc, .odt, .rtf, .xlsx, .xls' END AS reject_reason FROM pages""",
)
def _(spark, sf):
    rows = table(spark, sf, "pages").selectExpr(
        "page_id",
        "CASE WHEN page_id % 7 = 0 THEN ' ' ELSE 'x' END AS output",
        "CASE WHEN page_id % 4 IN (0, 3) THEN url END AS url",
        "CASE WHEN page_id % 4 IN (0, 2) THEN CASE WHEN page_id % 3 = 0 THEN 'a.pdf/x' ELSE ' A.PDF ' END ELSE ' ' END AS file",
        "CASE WHEN page_id % 5 = 0 THEN 0 ELSE 30 END AS timeout_s",
    )
    return validate_requests(rows, "parse").select("page_id", "reject_reason")


@query(
    "validate_scrape",
    """SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'url is required' WHEN page_id % 3 = 0 THEN 'exclude_tags must be a comma-separated string or JSON string array' END AS reject_reason FROM pages""",
)
def _(spark, sf):
    rows = table(spark, sf, "pages").selectExpr(
        "page_id",
        "'x' AS output",
        "CASE WHEN page_id % 7 <> 0 THEN url END AS url",
        "'article' AS include_tags",
        "CASE WHEN page_id % 3 = 0 THEN '[1' ELSE '[\"nav\"]' END AS exclude_tags",
        "30 AS timeout_s",
    )
    return validate_requests(rows, "scrape").select("page_id", "reject_reason")


@query(
    "clamp_limit",
    "SELECT l_orderkey, l_linenumber, CASE WHEN CAST(l_quantity * 3 AS INT) - 10 BETWEEN 1 AND 100 THEN CAST(l_quantity * 3 AS INT) - 10 ELSE 20 END AS n FROM lineitem",
)
def _(spark, sf):
    wanted = F.expr("CAST(l_quantity * 3 AS INT) - 10")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", clamp_limit(wanted).alias("n"))


def _fresh_sql(hours):
    return f"SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE ts BETWEEN TIMESTAMP '{_AS_OF}' - INTERVAL {hours} HOUR AND TIMESTAMP '{_AS_OF}'"


@query("fresh_captures", f"SELECT user_id, event_id, ts, props FROM ({_fresh_sql(48)}) WHERE rn = 1")
def _(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "ts", "props")
    return fresh_captures(events, "user_id", "ts", _AS_OF, tie="event_id")[0]


@query("stale_keys", f"SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM ({_fresh_sql(2)}))")
def _(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return fresh_captures(events, "user_id", "ts", _AS_OF, max_age_ms=7_200_000, tie="event_id")[1]


@query("top_papers", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20")
def _(spark, sf):
    papers = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return top_papers(papers, 20, score="p_retailprice", tie="p_partkey")


@query(
    "top_papers_per_query",
    """SELECT p_brand, p_partkey, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn <= 5""",
)
def _(spark, sf):
    papers = table(spark, sf, "part").select("p_brand", "p_partkey", "p_retailprice")
    return top_papers(papers, partition="p_brand", score="p_retailprice", tie="p_partkey")
