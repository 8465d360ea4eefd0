from statistics import median

import pytest
from pyspark.sql import functions as F

from webcapture.operators.balance import balanced_by_bytes, spread
from webcapture.plans.capture import capture_pages


def bytes_by_partition(df, text):
    found = df.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.octet_length(text)).alias("n")).collect()
    return {r.p: r.n for r in found}


def test_spread_gives_the_heaviest_out_first():
    got = dict(spread([(0, 1), (1, 9), (2, 5), (3, 5)], 2))
    assert got[1] != got[2] == got[3] and got[0] == got[1]
    assert spread([], 3) == []


def test_few_heavy_rows_do_not_share_a_task(spark):
    """A hundredth of the rows with nine tenths of the bytes, all of them in one input partition."""
    heavy = (F.col("id") < 40).cast("int")
    rows = spark.range(0, 4000, numPartitions=6).select("id", F.repeat(F.lit("x"), heavy * 22_000 + 25).alias("html"))
    got = balanced_by_bytes(rows, "html", ["id"], 8)
    loads = bytes_by_partition(got, "html")
    assert len(loads) == 8 and max(loads.values()) < 2 * median(loads.values())
    assert got.columns == rows.columns and got.exceptAll(rows).count() == 0 and got.count() == 4000


def test_equal_keys_are_spread_by_their_input_partitions(spark):
    rows = spark.range(0, 3000, numPartitions=24).select(F.lit(7).alias("id"), F.repeat(F.lit("y"), F.lit(500)).alias("html"))
    loads = bytes_by_partition(balanced_by_bytes(rows, "html", ["id"], 8), "html")
    assert max(loads.values()) < 2 * median(loads.values())


def test_odd_tables(spark):
    fields = "id long, html string, _part int"
    rows = spark.createDataFrame([(1, None, 1), (None, "", 2), (1, None, 1), (3, "z", None)], fields)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(balanced_by_bytes(rows, "html", ["id"], 3).collect(), key=key) == sorted(rows.collect(), key=key)
    assert balanced_by_bytes(rows.limit(0), "html", ["id"], 3).collect() == []
    for partitions, groups in ((0, 1), (1, 0)):
        with pytest.raises(ValueError):
            balanced_by_bytes(rows, "html", ["id"], partitions, groups)


def test_capture_is_the_same_when_balanced(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = capture_pages(pages)
    got = capture_pages(pages, partitions=4, balance=True)
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == want.count()
    with pytest.raises(ValueError):
        capture_pages(pages, balance=True)
