import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from webcapture.functions.text import export_path
from webcapture.operators.pages import clean_pages
from webcapture.operators.responses import classify, search_results
from webcapture.operators.search import grep_lines
from webcapture.plans.capture import capture_pages
from webcapture.sources.readers import read_responses
from webcapture.sources.writers import render_capture, render_parsed, write_exports
from webcapture.streaming.files import checkpoint_location, stream_table, write_available, write_exports_available

FIELDS = "title string, description string, url string, language string, creditsUsed long, markdown string, outcome string, export_name string"


def test_render(spark):
    df = spark.createDataFrame([("T", None, "u", "en", 3, "m", "ok", "x.md")], FIELDS)
    assert render_capture(df).first().export_text == (
        "## title: T\n## description: \n## url: u\n## language: en\n## creditsUsed: 3\n\n---\n\nm\n"
    )
    assert render_parsed(df).first().export_text == "## title: T\n## url: u\n## language: en\n## creditsUsed: 3\n\nm\n"


def test_failed_rows_touch_no_file(spark, tmp_path):
    path = str(tmp_path / "exports")

    def write(*rows):
        df = spark.createDataFrame([("t", None, "u", "en", 1, m, o, n) for n, m, o in rows], FIELDS)
        write_exports(render_capture(df), path, layout="files")

    def files():
        return {name: open(f"{path}/{name}").read() for name in os.listdir(path)}

    write(("a.md", "old a", "ok"), ("b.md", "old b", "ok"))
    before = files()
    assert before["a.md"].endswith("---\n\nold a\n")
    write(("a.md", "new a", "ok"), ("b.md", "new b", "error"), ("c.md", "c", "empty"))
    after = files()
    assert after["a.md"].endswith("new a\n") and after["b.md"] == before["b.md"] and set(after) == {"a.md", "b.md"}
    with pytest.raises(ValueError):
        write_exports(render_capture(spark.createDataFrame([], FIELDS)), path, layout="other")


def test_export_table(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.range(10).select(
        F.lit("t").alias("title"), F.lit("d").alias("description"), F.lit("u").alias("url"), F.lit("en").alias("language"),
        F.col("id").alias("creditsUsed"), F.lit("m").alias("markdown"),
        F.when(F.col("id") % 2 == 0, "ok").otherwise("error").alias("outcome"),
        export_path(F.concat(F.lit("p"), F.col("id"))).alias("export_name"),
    )
    write_exports(render_capture(df), path)
    assert {r.export_name for r in spark.read.parquet(path).collect()} == {f"p{i}.md" for i in range(0, 10, 2)}


def test_export_batches(spark, tmp_path):
    path = str(tmp_path / "batches")

    def rows(low, high, text="m", outcome="ok"):
        return spark.range(low, high, numPartitions=4).select(
            F.concat(F.lit("p"), F.col("id")).alias("export_name"), F.lit(text).alias("export_text"), F.lit(outcome).alias("outcome")
        )

    def found():
        return sorted((r.export_name, r.export_text, str(r.batch)) for r in spark.read.parquet(path).collect())

    first = [(f"p{i}", "m", "a") for i in range(8)]
    write_exports(rows(0, 8), path, batch="a")
    write_exports(rows(0, 8), path, batch="a", compact=True)
    assert found() == first
    # A job that fails after some of its tasks have written leaves the table as it was; run again, it is there once.
    failing = F.when(F.col("export_name") == "p15", F.raise_error(F.lit("lost"))).otherwise(F.col("export_text"))
    with pytest.raises(Exception, match="lost"):
        write_exports(rows(8, 16).withColumn("export_text", failing), path, batch="b")
    assert found() == first
    write_exports(rows(8, 16), path, batch="b")
    write_exports(rows(8, 16).union(rows(16, 20, outcome="error")), path, batch="b")
    assert found() == sorted(first + [(f"p{i}", "m", "b") for i in range(8, 16)])
    # Of a batch whose rows have all failed by now nothing stays; the other is untouched.
    write_exports(rows(8, 16, outcome="error"), path, batch="b")
    assert found() == first
    with pytest.raises(ValueError):
        write_exports(rows(0, 1), path, batch="../c")


def test_export_stream_batches(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), tmp_path / "cp"
    fields = "export_name string, export_text string, outcome string"
    spark.createDataFrame([(f"p{i}", "m", "ok" if i % 2 else "error") for i in range(12)], fields).repartition(3).write.parquet(str(source))

    def drain():
        write_exports_available(stream_table(spark, str(source), fields, files_per_trigger=1), out, f"exports-{uuid.uuid4().hex}", str(checkpoint)).awaitTermination()

    drain()
    # As if the driver was lost after the last micro-batch had written and before it was noted as done.
    last = max((checkpoint / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    drain()
    assert sorted(r.export_name for r in spark.read.parquet(out).collect()) == sorted(f"p{i}" for i in range(1, 12, 2))


PAGES = "page_id long, url string, html string"


def test_pages_stream_equals_batch(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages.repartition(4).write.parquet(source)
    stream = stream_table(spark, source, PAGES, files_per_trigger=1)
    write_available(capture_pages(stream, include=["h1"]), out, f"captures-{uuid.uuid4().hex}").awaitTermination()
    got = spark.read.parquet(out)
    want = capture_pages(pages, include=["h1"])
    assert got.count() == 50
    assert got.exceptAll(want.select(got.columns)).count() == 0
    lines = str(tmp_path / "lines")
    write_available(
        grep_lines(clean_pages(stream_table(spark, source, PAGES)), "<article>", "page_id", "clean_html"), lines, f"lines-{uuid.uuid4().hex}"
    ).awaitTermination()
    assert spark.read.parquet(lines).count() == grep_lines(clean_pages(pages), "<article>", "page_id", "clean_html").count()


def test_responses_stream(spark, tmp_path):
    source, out = tmp_path / "dump", str(tmp_path / "rows")
    source.mkdir()
    (source / "a.jsonl").write_text(json.dumps({"data": {"web": [{"title": "a"}, {"title": "b"}]}}) + "\nbad\n")
    df = classify(read_responses(spark, str(source), stream=True), "search").filter("outcome = 'ok'")
    write_available(search_results(df), out, "rows", checkpoint=str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.title for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_checkpoints_lie_in_the_shared_folder(spark):
    assert checkpoint_location(spark, "q") == spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/q"
