"""Readers for response dumps, alias dictionaries and document files."""

from __future__ import annotations

import importlib.resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcapture.functions.variant import is_large, large_body, parsed_bodies
from webcapture.operators.country import dictionary_aliases, dictionary_entries
from webcapture.operators.requests import DOCUMENT_EXTENSIONS


def parse_responses(df: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Add ``v``: the body as VARIANT, null where it is blank or not JSON.

    Of a repeated key the last value counts; the session is set to parse such objects. Bodies too long for
    a VARIANT come with the members that the flattening reads; their Markdown is read from ``raw``.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    bodies = F.when(is_large(raw_col), F.array(large_body(raw_col))).otherwise(parsed_bodies(raw_col))
    return df.select("*", F.explode(bodies).alias("v"))


def read_responses(spark: SparkSession, path: str, fmt: str = "text", stream: bool = False) -> DataFrame:
    """Response dump with ``response_id, target_url, raw, v``, and any further column such as a status.

    Text has one body per line and takes the hash of the body as its id, so that a task that runs
    again gives the same id. Other formats bring ``raw``, and may bring ``response_id`` and
    ``target_url``.
    """
    reader = spark.readStream if stream else spark.read
    if fmt == "text":
        df = reader.text(path).withColumnRenamed("value", "raw")
    else:
        if stream:
            reader = reader.schema(spark.read.format(fmt).load(path).schema)
        df = reader.format(fmt).load(path)
    if "response_id" not in df.columns:
        df = df.withColumn("response_id", F.sha2("raw", 256))
    if "target_url" not in df.columns:
        df = df.withColumn("target_url", F.lit(None).cast("string"))
    return parse_responses(df)


def load_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Entries ``(code, names)`` of one or more dictionary files, for the audit."""
    return dictionary_entries(spark.read.text(path, wholetext=True))


def load_aliases(spark: SparkSession, path: str) -> DataFrame:
    """``(code, alias)`` of dictionary files of the form ``{"code": ["alias", ...]}``."""
    return dictionary_aliases(load_dictionary(spark, path))


def iso_aliases(spark: SparkSession) -> DataFrame:
    """``(code, alias)`` from the public-domain country table of the tz database: every code, and its
    English name. A small seed; a full dictionary comes through ``load_aliases``."""
    table = importlib.resources.files("tzdata").joinpath("zoneinfo", "iso3166.tab").read_text("utf-8")
    rows = []
    for line in table.splitlines():
        if line and not line.startswith("#"):
            code, name = line.split("\t")
            rows += [(code, code), (code, name), (code, name.replace("&", "and"))]
    return spark.createDataFrame(sorted(set(rows)), "code string, alias string")


def read_document_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder tree that can be parsed, as ``path, length, content``; the extension decides,
    in any case, before a file is opened."""
    any_case = ",".join(
        "*." + "".join(f"[{c}{c.upper()}]" for c in ext[1:]) for ext in DOCUMENT_EXTENSIONS
    )
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return files.option("pathGlobFilter", "{" + any_case + "}").load(path).select("path", "length", "content")
