import json

import pytest
from pyspark.sql import functions as F

from webcapture.functions.text import to_compact_json
from webcapture.operators.responses import (
    av_records,
    classify,
    credit_snapshots,
    news_results,
    parse_records,
    scholar_results,
    scrape_records,
    search_envelope,
    search_results,
    split_outcomes,
    web_results,
)
from webcapture.plans.capture import flatten_scrapes, flatten_search
from webcapture.sources.readers import parse_responses, read_responses
from webcapture.sources.writers import render_capture


@pytest.fixture(scope="module")
def responses(spark):
    def make(*bodies, url="https://asked"):
        rows = [(str(i), url, b if b is None or isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
        return parse_responses(spark.createDataFrame(rows, "response_id string, target_url string, raw string"))

    return make


def values(df, *order):
    return [tuple(r)[1:] for r in df.orderBy("response_id", *order).collect()]


def test_items_tolerate_everything(responses):
    item = {"title": "t", "description": {"x": 1}, "url": 5, "extra": True}
    bodies = [
        {"data": {"web": [item, 5, None, {}, ["x"]]}},
        {"data": {"web": "none"}},
        {"data": {"web": item}},
        {"data": None},
        {"success": False},
        "not json",
        [1],
        None,
    ]
    none = (None, None, None)
    got = values(web_results(responses(*bodies)), "pos")
    assert got == [(0, "t", '{"x":1}', "5"), *[(i, *none) for i in range(1, 5)]]


def test_news_keeps_free_text_dates(responses):
    got = values(news_results(responses({"data": {"news": [{"title": "a", "url": "u", "date": "4 days ago"}]}})))
    assert got == [(0, "a", None, "u", "4 days ago")]


def test_search_results_equal_the_union_of_kinds(responses):
    body = {"data": {"web": [{"title": "w"}, 1], "images": [{"imageUrl": "i"}], "news": "x"}}
    got = search_results(responses(body, {"data": {}})).collect()
    assert {(r.kind, r.pos, r.title, r.imageUrl) for r in got} == {("web", 0, "w", None), ("web", 1, None, None), ("images", 0, None, "i")}
    assert search_results(responses(body), ("web",)).columns == ["response_id", "kind", "pos", "title", "description", "url"]


def test_envelope_passes_values_through(responses):
    body = {"success": "yes", "data": {"web": [{"title": {"a": 1}, "url": 2, "more": 3}, 7], "news": 5}, "creditsUsed": 1.5}
    got = search_envelope(responses(body, "[]")).select(to_compact_json("envelope").alias("e")).collect()
    none = {"title": None, "description": None, "url": None}
    assert json.loads(got[0].e) == {
        "success": "yes",
        "data": {"web": [{"title": {"a": 1}, "description": None, "url": 2}, none], "news": [], "images": []},
        "creditsUsed": 1.5,
    }
    assert json.loads(got[1].e) == {"success": None, "data": {"web": [], "news": [], "images": []}, "creditsUsed": None}


def test_scholar_reads_the_root(responses):
    body = {"success": True, "results": [{"title": "t", "paperId": "1", "primaryId": "arxiv:1", "score": 0.5, "ids": {}}], "data": {"results": [1]}}
    assert values(scholar_results(responses(body))) == [(0, "t", None, "1", "arxiv:1", 0.5)]


def test_scrape_record(responses):
    meta = {"title": "T", "description": None, "language": "en", "proxyUsed": "basic", "creditsUsed": 2, "url": " ", "ogUrl": "https://og"}
    bodies = [
        {"success": True, "creditsUsed": 9, "data": {"markdown": "hello%20world%21\\nnext%zz", "metadata": meta}},
        {"data": {"markdown": 5, "metadata": "x"}},
        {"success": False},
    ]
    assert values(scrape_records(responses(*bodies))) == [
        (True, "basic", "T", None, "https://og", "en", "hello world!\nnext%zz", 2),
        (None, None, None, None, "https://asked", None, None, None),
        (False, None, None, None, "https://asked", None, None, None),
    ]
    assert scrape_records(responses(bodies[0]), strict=True, repair=False).first().markdown == "hello%20world%21\\nnext%zz"


def test_parse_and_av_credits(responses):
    body = {"creditsUsed": 4, "data": {"metadata": {"sourceURL": "https://s"}, "audio": "a.mp3", "markdown": ""}}
    assert values(parse_records(responses(body))) == [(None, "https://s", None, 4, "")]
    assert av_records(responses(body), "audio").first().audio == "a.mp3"
    assert av_records(responses(body), "video").first().video is None
    with pytest.raises(ValueError):
        av_records(responses(body), "film")


@pytest.mark.parametrize("given,value,text", [
    ("1.5", 1.5, "1.5"), ("3", 3, "3"), ("2.0", 2, "2"), ("0", 0, "0"), ("-0.25", -0.25, "-0.25"), ("4503599627370497", 4503599627370497, "4503599627370497"),
    ("null", None, ""), ('"many"', None, ""), ('"NaN"', None, ""), ("[1]", None, ""),
])
def test_credits_as_given(responses, given, value, text):
    raw = '{"success":true,"data":{"markdown":"m","remainingCredits":%s,"metadata":{"creditsUsed":%s}}}' % (given, given)
    df = responses(raw)
    assert scrape_records(df).first().creditsUsed == parse_records(df).first().creditsUsed == av_records(df, "audio").first().creditsUsed == value
    assert credit_snapshots(df).first().remainingCredits == value
    assert f"## creditsUsed: {text}\n" in render_capture(scrape_records(df)).first().export_text


def test_credit_snapshot(responses):
    body = {"success": True, "data": {"remainingCredits": 1000, "planCredits": 500000, "billingPeriodStart": "2025-01-01T00:00:00Z", "billingPeriodEnd": "x"}}
    row = credit_snapshots(responses(body, "{}")).orderBy("response_id").first()
    assert (row.remainingCredits, row.planCredits, str(row.billingPeriodStart), row.billingPeriodEnd) == (1000, 500000, "2025-01-01 00:00:00", None)


OUTCOMES = [
    (None, 200, "empty"),
    (" \n", 200, "empty"),
    ("null", 200, "empty"),
    ("<html>", 200, "unparseable"),
    ('{"data":{}} trailing', 200, "unparseable"),
    ("[]", 200, "malformed"),
    ('"x"', 200, "malformed"),
    ('{"error":"x","success":false}', 200, "error"),
    ('{"error":true,"success":true,"data":{}}', 200, "error"),
    ('{"error":[],"success":false}', 200, "upstream_false"),
    ('{"success":"false","data":{}}', 200, "ok"),
    ('{"data":{}}', 201, "ok"),
    ('{"data":[]}', 200, "missing_data"),
    ('{"success":true}', 200, "missing_data"),
    ('{"data":{}}', 500, "http_error"),
    ("", 404, "http_error"),
    ('{"data":{}}', None, "ok"),
]


def test_outcomes(spark):
    rows = [(i, b, s) for i, (b, s, _) in enumerate(OUTCOMES)]
    df = parse_responses(spark.createDataFrame(rows, "response_id long, raw string, status int"))
    labelled = classify(df, "scrape", "status")
    assert [r.outcome for r in labelled.orderBy("response_id").collect()] == [o for _, _, o in OUTCOMES]
    good, bad = split_outcomes(labelled)
    assert good.count() == sum(o == "ok" for _, _, o in OUTCOMES)
    assert good.count() + bad.count() == len(OUTCOMES)
    assert bad.filter("message is null").count() == 0
    scholar = classify(df, "scholar").orderBy("response_id").collect()
    assert scholar[13].outcome == "ok"


def test_flatten(responses):
    web = {"data": {"web": [{"title": str(i)} for i in range(5)]}}
    df = responses(web, "bad", {"success": False, "error": "", "message": "why"}).withColumn("n", F.lit(3))
    rows, bad = flatten_search(df, "n")
    assert sorted(r.title for r in rows.collect()) == ["0", "1", "2"]
    assert {(r.outcome, r.message) for r in bad.collect()} == {("unparseable", "response is not JSON"), ("upstream_false", "why")}
    good, bad = flatten_scrapes(responses({"data": {"markdown": "m"}}, "{}"))
    assert good.first().export_text.endswith("---\n\nm\n") and bad.first().outcome == "missing_data"


def test_read_text_dump(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a":1}\nbad\n\n')
    df = read_responses(spark, str(tmp_path))
    assert set(df.columns) == {"response_id", "target_url", "raw", "v"}
    assert sorted((r.raw, r.x) for r in df.select("raw", F.to_json("v").alias("x")).collect()) == [("", None), ("bad", None), ('{"a":1}', '{"a":1}')]


def test_read_table_dump(spark, tmp_path):
    path = str(tmp_path / "dump")
    spark.createDataFrame([("r", "{}", 500)], "response_id string, raw string, status int").write.parquet(path)
    assert classify(read_responses(spark, path, "parquet"), status_col="status").first().outcome == "http_error"


def test_bodies_are_parsed_once(responses):
    plan = flatten_search(responses({"data": {}}).withColumn("n", F.lit(1)), "n")[0]._jdf.queryExecution().optimizedPlan().toString()
    # One parse inside brackets, one more that runs only for doubtful texts, one only for bodies beyond the limit.
    assert plan.count("parseJson") == 3
