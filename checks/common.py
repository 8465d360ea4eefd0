"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def registry():
    """Queries, their SQL, and the decorator that fills both."""
    queries, oracles = {}, {}

    def query(name, sql=None):
        def register(fn):
            queries[name] = fn
            if sql is not None:
                oracles[name] = sql
            return fn

        return register

    return queries, oracles, query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def json_text(sql_value: str) -> str:
    """DuckDB: a text as a JSON string literal."""
    return f"CAST(to_json({sql_value}) AS VARCHAR)"
