"""Bodies that are longer than a parsed value may be give the same rows as short ones."""

import json

import pytest
from pyspark.sql import functions as F

from webcapture.functions import variant
from webcapture.operators.responses import av_records, classify, credit_snapshots, parse_records, scholar_results, scrape_records, search_results, web_results
from webcapture.sources.readers import parse_responses

BODIES = [
    {"success": True, "creditsUsed": 2, "data": {"markdown": "a%20b [x](y)]", "metadata": {"title": "T", "url": "u", "creditsUsed": 3, "language": None}, "audio": "s"}},
    {"success": False, "message": "no", "data": {"markdown": 5, "metadata": {"title": 7}}},
    {"error": {"a": 1}, "upstream": {"message": "deep"}},
    {"data": {"web": [{"title": "t", "url": 1}, 5, None], "news": "x", "images": [{"imageUrl": "i"}]}, "more": [[1]]},
    {"results": [{"title": "p", "paperId": "1", "score": 0.5}], "data": [1]},
    {"data": {"remainingCredits": 5, "planCredits": "6", "billingPeriodStart": "2024-01-02T00:00:00Z"}},
    {},
]
TEXTS = [json.dumps(b) for b in BODIES] + [
    '{"success":1,"success":true,"data":{"markdown":"x","markdown":"y"}}', '{"a":1} x', '{"a":1},{"b":2}', '{"a":1}]],[[{"b":2}', '{"a":', '{"data":{"markdown":"open', "", "  ", None,
]


def flattened(spark):
    df = parse_responses(spark.createDataFrame([(str(i), "asked", t) for i, t in enumerate(TEXTS)], "response_id string, target_url string, raw string"))
    frames = [classify(df).select("response_id", "outcome", "message"), classify(df, "scholar").select("response_id", "outcome"), scrape_records(df), parse_records(df), av_records(df, "audio"), web_results(df), search_results(df), scholar_results(df), credit_snapshots(df)]
    return [sorted(map(str, f.collect())) for f in frames]


def test_large_bodies_are_flattened_alike(spark, monkeypatch):
    want = flattened(spark)
    monkeypatch.setattr(variant, "VARIANT_BYTES", 1)
    assert flattened(spark) == want


@pytest.mark.parametrize("tail, outcome", [("", "ok"), ("}", "unparseable")])
def test_body_beyond_the_limit(spark, tail, outcome):
    raw = F.concat(F.lit('{"success":true,"data":{"metadata":{"title":"T"},"markdown":"'), F.repeat(F.lit("word%20"), 20_000_000), F.lit('"}}' + tail))
    df = classify(parse_responses(spark.range(1).select(F.lit("i").alias("response_id"), F.lit(None).cast("string").alias("target_url"), raw.alias("raw"))))
    assert [r.outcome for r in df.select("outcome").collect()] == [outcome]
    if outcome == "ok":
        row = scrape_records(df).select("title", F.length("markdown").alias("n")).first()
        assert (row.title, row.n) == ("T", 100_000_000)
