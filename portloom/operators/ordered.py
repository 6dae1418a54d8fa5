"""Numbering of rows in one order over all tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portloom.session import stored

_IN_PARTITION = 33  # monotonically_increasing_id: partition number above these bits, place in it below


def numbered(df: DataFrame, order: Sequence[Column], into: str) -> DataFrame:
    """Adds ``into``, 0 on the first row in ``order`` and one more on each next one.

    Rows are dealt to tasks by ranges of the order and sorted there; the row counts of the ranges, one
    number per task, tell how many rows stand before each. No key has to fit into one task. Rows equal
    in all of ``order`` stand in any order among themselves.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = stored(placed.withColumn("_place", F.monotonically_increasing_id()), "in-order")
    own = F.shiftright("_place", _IN_PARTITION).cast("int")
    before, so_far = [], 0
    for r in placed.groupBy(own.alias("own")).count().orderBy("own").collect():  # one row per range
        before.append((r.own, so_far))
        so_far += r["count"]
    starts = spark.createDataFrame(before, "_own int, _before long")
    inside = F.col("_place").bitwiseAND((1 << _IN_PARTITION) - 1)
    out = placed.withColumn("_own", own).join(starts, "_own")
    return out.select(*df.columns, (F.col("_before") + inside).alias(into))
