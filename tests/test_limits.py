from pyspark.sql import functions as F

from webcapture.operators.country import resolve_country
from webcapture.operators.requests import fresh_captures, limit_per_request, top_papers
from webcapture.operators.responses import classify, scrape_records
from webcapture.sources.readers import parse_responses


def test_missing_limit_is_the_default(spark):
    df = spark.range(30).select(F.col("id").alias("pos"), F.when(F.col("id") < 0, 1).alias("n"))
    assert limit_per_request(df, "n").count() == 20
    assert limit_per_request(df, 3).count() == 3


def test_repeated_keys_take_the_last(spark):
    df = spark.createDataFrame([('{"data":{"markdown":"a","markdown":"b"}}', "i", None)], "raw string, response_id string, target_url string")
    assert scrape_records(parse_responses(df)).first().markdown == "b"


def test_success_keeps_its_type(spark):
    df = spark.createDataFrame([('{"success":"no","data":{}}', "i", None)], "raw string, response_id string, target_url string")
    row = classify(parse_responses(df)).first()
    assert row.outcome == "ok" and scrape_records(parse_responses(df)).first().success is None


def test_newest_of_equal_times_is_stable(spark):
    df = spark.createDataFrame([("k", 1, v) for v in "abcdef"], "key string, t int, v string").withColumn("ts", F.timestamp_seconds("t"))
    got = {fresh_captures(df.repartition(n), "key", "ts", F.timestamp_seconds(F.lit(2)))[0].first().v for n in (1, 2, 5)}
    assert len(got) == 1


def test_top_papers_over_groups(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("paperId"), (F.col("id") % 37).cast("double").alias("score"))
    want = sorted(((-(i % 37), str(i)) for i in range(2000)))[:9]
    assert [(-r.score, r.paperId) for r in top_papers(df, 9).collect()] == want


def test_top_papers_of_a_hot_key(spark):
    """Most rows under one key, ties and nulls: the same k, cut in groups of the key before they meet."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("q"),
        F.col("id").cast("string").alias("paperId"), F.when(F.col("id") % 11 > 0, (F.col("id") % 37).cast("double")).alias("score"),
    )
    df = df.unionByName(df.filter("paperId < '2'"))
    rows = sorted(map(tuple, df.collect()), key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))
    want = sorted(x for q in {r[0] for r in rows} for x in [r for r in rows if r[0] == q][:8])
    best = top_papers(df, 8, "q")
    assert sorted(map(tuple, best.collect())) == want and best.columns == df.columns
    assert best._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 3


def test_equal_names_are_split(spark):
    df = spark.createDataFrame([("France",)] * 50 + [(None,)] * 50, "name string")
    index = spark.createDataFrame([("france", "FR")], "key string, code string")
    got = resolve_country(df, "name", index, salts=8).groupBy("country_code").count().collect()
    assert {r.country_code: r["count"] for r in got} == {"FR": 50, "US": 50}


def test_frequent_names_are_found_and_split(spark):
    """A third of the rows has one name, in two spellings, and nothing may be broadcast but what the sketch reports."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    name = F.when(F.col("id") % 6 == 0, "  France").when(F.col("id") % 6 == 1, "FRANCE.").when(F.col("id") % 6 == 2, F.lit(None)).otherwise(F.concat(F.lit("land "), F.col("id")))
    df = spark.range(0, 60_000, numPartitions=6).select("id", name.alias("name"), F.lit(0).alias("parts"))
    index = spark.range(59_000).select(F.concat(F.lit("land "), F.col("id")).alias("key"), F.lit("LD").alias("code")).union(spark.createDataFrame([("france", "FR")]))
    try:
        for k, v in zip(old, ("-1", "false", "12"), strict=True):
            spark.conf.set(k, v)
        found = resolve_country(df, "name", index)
        assert found.columns == [*df.columns, "country_code", "match_rule"]
        counts = {r.country_code: r["count"] for r in found.groupBy("country_code").count().collect()}
        assert counts == {"FR": 20_000, "LD": 29_499, "US": 10_501}
        sizes = sorted(r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert len(sizes) == 12 and sizes[-1] < 2 * sizes[6]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
