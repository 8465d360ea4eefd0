import datetime as dt

import pytest
from pyspark.sql import functions as F

from webcapture.operators.requests import (
    clamp_limit,
    file_extension,
    fresh_captures,
    has_all,
    in_date_window,
    limit_per_request,
    recent,
    split_requests,
    supported_documents,
    top_papers,
    validate_requests,
)
from webcapture.sources.readers import read_document_files


def reasons(spark, kind, ddl, *rows):
    return [r.reject_reason for r in validate_requests(spark.createDataFrame(rows, ddl).coalesce(1), kind).collect()]


def test_search_rules(spark):
    ddl = "query string, search_num int, timeout_s long, search_time string"
    rows = [
        ("q", 20, 120, "week"), (" ", 0, 0, "x"), ("q", 0, 0, "x"), ("q", 101, 1, ""), ("q", 100, 0, "x"), ("q", 1, 9223372037, None),
        ("q", 1, 9223372036, "weeks"), ("q", None, None, None), (None, 5, 5, None),
    ]
    assert reasons(spark, "search", ddl, *rows) == [
        None,
        "query is required",
        "search_num must be an integer from 1 to 100",
        "search_num must be an integer from 1 to 100",
        "timeout must be an integer greater than 0",
        "timeout is too large",
        "time filter must be hour, day, week, month or year",
        None,
        "query is required",
    ]
    assert reasons(spark, "scholar", "query string, search_num int, timeout_s long", ("q", 500, 1), ("q", 501, 1))[1].endswith("500")


def test_parse_rules(spark):
    ddl = "output string, url string, file string, timeout_s long"
    rows = [("o", "u", None, 1), ("o", None, "A.Docx", 1), ("o", "u", "f.pdf", 1), ("o", " ", "", 1), ("o", None, "f.txt", 1), ("", "u", "f.pdf", 0)]
    got = reasons(spark, "parse", ddl, *rows)
    assert got[:2] == [None, None]
    assert got[2].startswith("only one") and got[3].startswith("one of") and got[4].startswith("file extension") and got[5].startswith("output")
    good, bad = split_requests(spark.createDataFrame(rows, ddl), "parse")
    assert (good.count(), bad.count()) == (2, 4)
    with pytest.raises(ValueError):
        validate_requests(good, "other")


def test_small_columns(spark, column):
    df = spark.createDataFrame([(n,) for n in (0, 1, 100, 101, -5, None)], "n int")
    assert [r.x for r in df.select(clamp_limit("n").alias("x")).collect()] == [20, 1, 100, 20, 20, 20]
    assert column(["a.PDF", "x.tar.gz", "d.pdf/x", ".html", "none", None], file_extension("c")) == [".pdf", ".gz", "", ".html", "", None]
    df = spark.createDataFrame([(["a", "b"],), (["a"],), ([],), (None,)], "t array<string>")
    assert [r.x for r in df.select(has_all("t", ["a", "b", "a"]).alias("x")).collect()] == [True, False, False, False]
    assert [r.x for r in df.select(has_all("t", []).alias("x")).collect()] == [True] * 4


def test_document_files(spark, tmp_path):
    for name in ("a.html", "b.PDF", "c.txt", "sub/d.docx", "e.pdfx"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    got = {r.path.rsplit("/", 1)[1] for r in read_document_files(spark, str(tmp_path)).collect()}
    assert got == {"a.html", "b.PDF", "d.docx"}
    names = spark.createDataFrame([("a.html",), ("x.txt",)], "name string")
    assert [r.name for r in supported_documents(names, "name").collect()] == ["a.html"]


AS_OF = dt.datetime(2024, 3, 31, 12)


def test_recent_edges(spark):
    rows = [(dt.timedelta(0), 0), (dt.timedelta(hours=1), 1), (dt.timedelta(minutes=59), 2), (dt.timedelta(days=7), 3), (dt.timedelta(days=6), 4), (-dt.timedelta(seconds=1), 5)]
    df = spark.createDataFrame([(i, AS_OF - d) for d, i in rows], "i int, ts timestamp")

    def ids(code):
        return sorted(r.i for r in recent(df, "ts", code, AS_OF).collect())

    assert ids("qdr:h") == [0, 2]
    assert ids("qdr:w") == [0, 1, 2, 4]
    assert ids(None) == [0, 1, 2, 3, 4, 5]
    assert ids(F.when(F.col("i") != 5, "qdr:h")) == [0, 2, 5]
    with pytest.raises(ValueError):
        recent(df, "ts", "week", AS_OF)
    # A month is a calendar month: from the end of March it goes back to the end of February.
    month = spark.createDataFrame([(1, dt.datetime(2024, 2, 29, 13)), (2, dt.datetime(2024, 2, 29, 11))], "i int, ts timestamp")
    assert [r.i for r in recent(month, "ts", "qdr:m", AS_OF).collect()] == [1]


def test_recent_and_window_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = recent(events, "ts", "qdr:d", "2024-01-20")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = orders.filter(in_date_window(orders, "o_orderdate", "1996-01-01", "1996-12-31"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_date_window(spark):
    rows = [("2024-01-01", None), (None, "2024-01-31T23:59:59"), ("2023-12-31", "2024-02-01"), ("bad", None), (None, None)]
    df = spark.createDataFrame(rows, "created string, updated string")
    got = [r.x for r in df.select(in_date_window(df, ["created", "updated"], "2024-01-01", "2024-01-31").alias("x")).collect()]
    assert got == [True, True, False, False, False]
    with pytest.raises(ValueError):
        in_date_window(df, "created", "01/02/2024")


def test_freshness_with_a_hot_key(spark):
    """One key holds a third of the rows."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("k"),
        (F.lit(AS_OF).cast("timestamp") - F.expr("make_dt_interval(0, 0, CAST(id AS INT))")).alias("ts"),
        "id",
    )
    fresh, stale = fresh_captures(rows, "k", "ts", AS_OF, max_age_ms=10 * 60 * 1000, tie="id")
    want = {}
    for i in range(11):
        want.setdefault(0 if i % 3 == 0 else i % 50 + 1, i)
    assert {r.k: r.id for r in fresh.collect()} == want
    assert {r.k for r in stale.collect()} == {i % 50 + 1 for i in range(30000) if i % 3} - set(want)


def test_limits(spark):
    df = spark.createDataFrame([("a", i, 2) for i in range(5)] + [("b", 0, 9)], "r string, pos int, n int")
    assert limit_per_request(df, "n").count() == 3
    assert limit_per_request(df, 1).count() == 2
    papers = spark.range(1000).select((F.col("id") % 3 > 0).alias("q"), F.col("id").alias("paperId"), (F.col("id") % 10).cast("double").alias("score"))
    assert [r.paperId for r in top_papers(papers, 3).collect()] == [9, 19, 29]
    per = top_papers(papers, 2, "q")
    assert per.count() == 4
    assert "WindowGroupLimit" in per._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        top_papers(papers, 501)
