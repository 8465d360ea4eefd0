"""Rendering and writing of Markdown exports."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcapture.functions.variant import number_text


def _render(df: DataFrame, fields, tail: str) -> Column:
    lines = []
    for name in fields:
        value = number_text(name) if isinstance(df.schema[name].dataType, T.FractionalType) else F.col(name).cast("string")
        lines += [F.lit(f"## {name}: "), F.coalesce(value, F.lit("")), F.lit("\n")]
    return F.concat(*lines, F.lit(tail), F.coalesce(F.col("markdown"), F.lit("")), F.lit("\n"))


def render_capture(df: DataFrame) -> DataFrame:
    """Add ``export_text``: metadata lines, a rule, the Markdown."""
    fields = ("title", "description", "url", "language", "creditsUsed")
    return df.withColumn("export_text", _render(df, fields, "\n---\n\n"))


def render_parsed(df: DataFrame) -> DataFrame:
    """As ``render_capture`` for parsed documents: no description, no rule."""
    return df.withColumn("export_text", _render(df, ("title", "url", "language", "creditsUsed"), "\n"))


def _files(folder: str) -> Callable:
    def write(batches):
        where, root = fs.FileSystem.from_uri(re.sub("^file:/+", "/", folder))
        made = None
        for batch in batches:
            for name, text in zip(*(batch.column(n).to_pylist() for n in ("export_name", "export_text")), strict=True):
                if ".." in name.split("/"):
                    raise ValueError(f"export name leaves the folder: {name}")
                target = f"{root}/{name.lstrip('/')}"
                if (parent := target.rpartition("/")[0]) != made:
                    where.create_dir(parent, recursive=True)
                    made = parent
                part = f"{target}.{uuid.uuid4().hex}.part"
                with where.open_output_stream(part, compression=None) as out:
                    out.write(text.encode())
                try:
                    where.move(part, target)
                except OSError:  # some file systems do not replace a file by moving
                    where.delete_file(target)
                    where.move(part, target)
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], names=["written"])

    return write


def _write_batch(good: DataFrame, path: str, batch: int | str, compact: bool) -> None:
    name = str(batch)
    if not re.fullmatch(r"[A-Za-z0-9_-]+", name):
        raise ValueError(f"batch {name!r} is no word of letters, digits, - and _")
    written = Observation()
    if compact:
        good = good.hint("rebalance")
    rows = good.observe(written, F.count(F.lit(1)).alias("rows")).withColumn("batch", F.lit(name))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
    if not written.get["rows"]:
        # Nothing was written, so nothing was replaced: an earlier run of the batch may have left rows.
        good.write.mode("overwrite").parquet(f"{path}/batch={name}")


def write_exports(
    df: DataFrame, path: str, layout: str = "table", mode: str = "append", batch: int | str | None = None, compact: bool = False
) -> None:
    """Write ``export_name`` and ``export_text`` of the rows whose ``outcome`` is ok.

    ``table`` appends parquet, the form that scales. With ``batch``, the rows become the partition of that name in
    the column ``batch``, written aside and put in its place when the job ends: a batch that is written twice, or
    was killed half way and is run again, leaves each of its rows once and no other batch changed; ``mode`` does not
    matter then. ``compact`` deals the rows of a batch anew to files of
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, for which its texts are shuffled once.

    ``files`` writes one file per export name under ``path``, whole or not at all, and replaces only those of
    successful rows: files of failed rows are neither created nor touched. Of rows with one name, the text that sorts
    last is written. The executors write the files themselves, so ``path`` must be a folder that they share. Use it
    for small selections.
    """
    good = df.filter(F.col("outcome") == "ok").select("export_name", "export_text")
    if layout == "table" and batch is not None:
        _write_batch(good, path, batch, compact)
    elif layout == "table":
        good.write.mode(mode).parquet(path)
    elif layout == "files":
        one = good.groupBy("export_name").agg(F.max("export_text").alias("export_text"))
        one.mapInArrow(_files(path), "written long").agg(F.sum("written")).collect()
    else:
        raise ValueError(f"unknown layout {layout!r}")
