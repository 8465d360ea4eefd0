"""Places of rows within ordered groups, found without a group ever meeting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from webcapture.llm.common import saved


def numbered(rows: DataFrame, group: list[str], order: list[str], copies: str | None = None) -> DataFrame:
    """``rows`` with ``idx``, the place of each within its group from 0, and ``width``, the size of the group.

    ``copies`` names a column that tells how many equal rows each row stands for; ``idx`` is then the place of
    the first of them. Rows are dealt into ranges of (group, order); a group of any size spans as many ranges as
    it fills, whose counts are summed up in order. Group columns must not be null; rows that tie in ``order``
    within a group must be alike, or the caller's order is not complete.
    """
    n = F.col(copies) if copies else F.lit(1).cast("long")
    ranged = saved(rows.repartitionByRange(*group, *order).withColumn("range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy("range", *group).agg(F.sum(n).alias("own"))
    whole = Window.partitionBy(*group)
    starts = sums.select("range", *group, (F.sum("own").over(whole.orderBy("range")) - F.col("own")).alias("start"), F.sum("own").over(whole).alias("width"))
    within = Window.partitionBy("range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.join(starts, ["range", *group]).withColumn("idx", F.col("start") + F.sum(n).over(within) - n)
    return placed.drop("range", "start")
