"""Tasks of like weight for rows of very unlike size."""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Weight of a row besides its text, so that many empty ones are spread too.
ROW_BYTES = 64


def spread(weights: Iterable[tuple[int, int]], partitions: int) -> list[tuple[int, int]]:
    """Groups ``(group, weight)`` to partitions: the heaviest first, each to the one that has least so far."""
    loads = [(0, part) for part in range(partitions)]
    given = []
    for group, weight in sorted(weights, key=lambda w: (-w[1], w[0])):
        load, part = loads[0]
        heapq.heapreplace(loads, (load + weight, part))
        given.append((group, part))
    return given


def balanced_by_bytes(df: DataFrame, text: str, key: list[str], partitions: int, groups: int = 64) -> DataFrame:
    """The rows in ``partitions`` partitions of about the same bytes of ``text`` each.

    Two passes. The first hashes ``key`` and the input partition of a row into ``groups`` groups per partition and sums
    the bytes of each, combined before the shuffle; only the keys and the text's length are needed. The groups are
    then given out heaviest first, and one shuffle deals the rows by that table. The driver and the broadcast hold two
    numbers per group, ``groups * partitions`` in all, whatever the size of the table. No row is cut, so one that
    outweighs an even share makes a task of its own. Rows with one key are spread as far as their input partitions
    are. A null text or key counts like any other value; an empty table stays empty. Not for streams: the first
    pass is an action.
    """
    if df.isStreaming:
        raise ValueError("a stream cannot be read twice to be balanced")
    if partitions < 1 or groups < 1:
        raise ValueError("partitions and groups count from 1")
    spark, group, part = df.sparkSession, "_balance_group", "_balance_part"
    own = F.pmod(F.xxhash64(F.spark_partition_id(), *key), F.lit(partitions * groups)).cast("int")
    grouped = df.withColumn(group, own)
    size = F.coalesce(F.octet_length(text).cast("long"), F.lit(0)) + ROW_BYTES
    weights = grouped.select(group, size.alias("size")).groupBy(group).agg(F.sum("size").alias("weight"))
    table = spark.createDataFrame(spread(map(tuple, weights.collect()), partitions), f"{group} int, {part} int")
    # The input partitions of the second pass may differ where a shuffle before it is planned anew; a group that the
    # first pass has not seen goes by its number.
    dealt = grouped.join(F.broadcast(table), group, "left")
    target = F.coalesce(F.col(part), F.col(group) % F.lit(partitions))
    return dealt.repartitionById(partitions, target).select(*[F.col(f"`{c}`") for c in df.columns])
