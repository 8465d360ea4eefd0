"""File streams in, file tables out.

Every row-level operator is a plain DataFrame function, so it runs on a stream as it is. Not for
streams: the fallback join, freshness, top papers and the dictionary audit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from webcapture.sources.writers import write_exports


def stream_table(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int = 1000
) -> DataFrame:
    """Stream of the files that arrive in a folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(fmt).load(path)


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """Folder of a query below the shared one that the cluster names in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("spark.checkpoint.dir is not set; pass a checkpoint folder")
    return f"{base.rstrip('/')}/{name}"


def write_available(
    df: DataFrame, path: str, name: str, checkpoint: str | None = None, fmt: str = "parquet"
) -> StreamingQuery:
    """Process all files that are there, append the result to a table, and stop."""
    location = checkpoint or checkpoint_location(df.sparkSession, name)
    writer = df.writeStream.queryName(name).option("checkpointLocation", location)
    return writer.format(fmt).outputMode("append").trigger(availableNow=True).start(path)


def write_exports_available(df: DataFrame, path: str, name: str, checkpoint: str | None = None) -> StreamingQuery:
    """Exports of all files that are there, as ``write_exports`` with a batch per micro-batch.

    A micro-batch that runs again after a loss keeps its number, so it replaces what it wrote before.
    """
    location = checkpoint or checkpoint_location(df.sparkSession, name)
    writer = df.writeStream.queryName(name).option("checkpointLocation", location)
    return writer.foreachBatch(lambda rows, number: write_exports(rows, path, batch=number)).trigger(availableNow=True).start()
