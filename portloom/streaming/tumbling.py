"""Tumbling aggregates and plain rows of a stream, drained in batches into day-partitioned tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portloom.sources.merge import merge_partitions

DAY = "_day"


def tumbling(
    df: DataFrame, ts: str, keys: Sequence[str], measures: Mapping[str, Column], width: str = "5 minutes",
    watermark: str | None = None,
) -> DataFrame:
    """(window_start, keys..., measures...) per window; the same code serves batch and stream.

    A stream needs ``watermark``, the lateness up to which a window is still corrected.
    """
    at, naive = F.col(ts), isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    df = df.withColumn(ts, at.cast("timestamp")) if naive else df
    if watermark:
        df = df.withWatermark(ts, watermark)
    out = df.groupBy(F.window(ts, width).alias("_w"), *keys).agg(*(m.alias(n) for n, m in measures.items()))
    start = F.col("_w.start").cast("timestamp_ntz") if naive else F.col("_w.start")
    return out.select(start.alias("window_start"), *keys, *measures)


def drain(
    rows: DataFrame,
    out: str,
    checkpoint: str,
    keys: Sequence[str],
    ts: str = "window_start",
    moving: bool = False,
    order_by: Sequence[Column] = (),
) -> None:
    """Processes everything that has arrived, then stops; the next drain goes on from there.

    Every micro-batch, changed windows or plain rows, is merged by key into a table partitioned by
    the day of ``ts``; only the days it touches are read and rewritten, however long the stream has
    run, and repeating a batch after a failure merges the same rows. ``moving`` and ``order_by`` as
    in :func:`merge_partitions`; late rows need no watermark here, their day is simply rewritten.
    """

    def land(batch: DataFrame, _: int) -> None:
        merge_partitions(batch.withColumn(DAY, F.to_date(ts)), out, keys, DAY, order_by, moving)

    writer = rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).foreachBatch(land).start().awaitTermination()


def current_rows(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The table that drains have filled."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])).parquet(out).drop(DAY)
