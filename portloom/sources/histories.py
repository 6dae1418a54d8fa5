"""A stored slowly changing history that takes in snapshots as they come, late ones included.

``path/rows`` holds the intervals of :func:`portloom.operators.history.scd2`: closed ones in a folder
per closing day, open ones in ``buckets`` folders by key. A day's snapshot reads the open intervals
and those closed on its own day or later, which only a late day has. Rows are compared by digests of their
columns, so only keys that changed go on; their few intervals are built anew and the difference is
applied: new intervals are appended first, replaced ones are taken out afterwards. A run that fails in
between leaves intervals too many, and applying the batch again ends at the same history.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portloom.functions.calendar import time_literal
from portloom.operators.history import scd2
from portloom.operators.skew import join_null_safe
from portloom.session import cut_lineage
from portloom.sources.tables import path_exists, replace_partitions

BUCKETS = 16
_PART = "_part"
_OPEN, _CLOSED = "open-", "closed-"  # in this order of the alphabet: closed days before all open ones


class RepeatedRows(ValueError):
    """A snapshot holds a key more than once."""


@dataclass(frozen=True)
class Applied:
    """Intervals that came in and that were replaced or taken out."""

    added: int
    removed: int


def _digest(cols: Sequence[str]) -> Column:
    return F.md5(F.to_json(F.struct(*cols)).cast("binary"))


def _part_of(keys: Sequence[str], buckets: int) -> Column:
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")
    closed = F.concat(F.lit(_CLOSED), F.date_format("valid_to", "yyyy-MM-dd"))
    return F.coalesce(closed, F.concat(F.lit(_OPEN), F.lpad(bucket, 3, "0")))


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if path_exists(spark, f"{path}/rows"):
        return spark.read.schema(schema).parquet(f"{path}/rows")
    return spark.createDataFrame([], schema)


def read_history(spark: SparkSession, path: str, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The intervals in the form that ``scd2`` gives."""
    rows = spark.read.parquet(f"{path}/rows")
    return rows.select(*keys, *cols, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


def apply_snapshots(
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    day: str,
    cols: Sequence[str],
    observed: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> Applied:
    """Takes one or several days' snapshots into the history at ``path``, which afterwards equals
    ``scd2`` over all rows given so far; a day given again replaces its keys' earlier rows.

    A key that a snapshot lacks is not observed that day; its interval goes on. ``observed`` holds
    (keys, day) of all landed snapshots; a late day needs it to find the next day on which the value
    it interrupts was seen again, and only later days of changed keys are read from it.
    """
    spark, keys, cols = batch.sparkSession, list(keys), list(cols)
    batch = cut_lineage(batch.select(*keys, day, *cols).distinct())
    per_key = batch.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("n"))
    first = per_key.agg(F.max("n").alias("n"), F.min(day).alias("t"), F.date_format(F.min(day), "yyyy-MM-dd").alias("d")).first()
    if first.t is None:
        return Applied(0, 0)
    if first.n > 1:
        raise RepeatedRows(f"a snapshot for {path} holds a key of {keys} more than once")
    time = batch.schema[day].dataType
    fields = [batch.schema[c] for c in (*keys, *cols)]
    fields += [T.StructField("valid_from", time), T.StructField("valid_to", time), T.StructField("_digest", T.StringType())]
    schema = T.StructType([*fields, T.StructField(_PART, T.StringType())])
    stored = _stored(spark, path, schema)
    known_days = f"{path}/days"
    newest = None
    if path_exists(spark, known_days):
        newest = spark.read.schema(T.StructType([T.StructField("day", time)])).parquet(known_days).agg(F.max("day")).first()[0]
    late = newest is not None and first.t <= newest
    if late and observed is None:
        raise ValueError("a late or repeated day needs the observed days")
    # what a day from the first on can change: open intervals and those closed on that day or later
    live = stored.where(F.col(_PART) >= f"{_CLOSED}{first.d}")

    held = live.select(
        *(F.col(k).alias(f"_held_{k}") for k in keys),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        F.col("_digest").alias("_held_digest"),
        F.struct(*cols).alias("_held"),
    )
    same_key = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys))
    covers = (F.col("_from") <= F.col(day)) & (F.col("_to").isNull() | (F.col(day) < F.col("_to")))
    differing = batch.withColumn("_digest", _digest(cols)).join(held, same_key & covers, "left")
    differing = differing.where(~F.col("_digest").eqNullSafe(F.col("_held_digest")))
    differing = cut_lineage(differing.select(*keys, day, "_from", "_to", "_held") if late else differing.select(*keys))
    changed = differing.select(*keys).distinct()

    own = [*keys, F.col(day), *cols]
    points = [
        join_null_safe(live, changed, keys, "left_semi").select(*keys, F.col("valid_from").alias(day), *cols, F.lit(0).alias("_rank")),
        join_null_safe(batch, changed, keys, "left_semi").select(*own, F.lit(2).alias("_rank")),
    ]
    if late:
        points.append(_resumed(differing.where(F.col("_from").isNotNull()), observed, keys, day, cols, time_literal(first.t, time)))
    rebuilt = scd2(reduce(DataFrame.unionAll, points), keys, [day, "_rank"], cols).drop("is_current")
    rebuilt = rebuilt.withColumn("_digest", _digest(cols)).withColumn(_PART, _part_of(keys, buckets)).select(*schema.names)
    before = join_null_safe(live, changed, keys, "left_semi").select(*schema.names)
    both = rebuilt.withColumn("_new", F.lit(True)).unionAll(before.withColumn("_new", F.lit(False)))
    identity = [*keys, "valid_from", "valid_to", "_digest"]
    sides = [F.max(F.when(F.col("_new") == new, F.struct(*cols, _PART))).alias(name) for name, new in (("_in", True), ("_out", False))]
    unlike = both.groupBy(*identity).agg(*sides).where(F.col("_in").isNull() | F.col("_out").isNull())
    unlike = cut_lineage(unlike.select(*identity, F.col("_in").isNotNull().alias("_new"), F.coalesce("_in", "_out").alias("_row")))
    unlike = unlike.select(*identity, "_new", "_row.*")
    changes = unlike.groupBy("_new", _PART).count().collect()  # closing days and buckets
    n_added, n_removed = (sum(r["count"] for r in changes if r._new == new) for new in (True, False))
    if n_added:
        added = unlike.where("_new").select(*schema.names).repartition(_PART)
        added.write.mode("append").partitionBy(_PART).parquet(f"{path}/rows")
    if n_removed:
        inside = F.col(_PART).isin([r[_PART] for r in changes if not r._new])
        rest = join_null_safe(_stored(spark, path, schema).where(inside), unlike.where("not _new"), identity, "left_anti")
        replace_partitions(cut_lineage(rest), f"{path}/rows", _PART, lambda old: old.where(inside), allow_empty=True)
    batch.select(F.col(day).alias("day")).distinct().coalesce(1).write.mode("append").parquet(known_days)
    return Applied(n_added, n_removed)


def _resumed(
    interrupted: DataFrame, observed: DataFrame, keys: Sequence[str], day: str, cols: Sequence[str], first: Column
) -> DataFrame:
    """Where an interval that a late row interrupts goes on: the next day its key was seen in it."""
    seen = observed.where(F.col(day) > first).select(*keys, F.col(day).alias("_seen")).distinct()
    later = join_null_safe(interrupted, seen, keys, "inner")
    later = later.where((F.col("_seen") > F.col(day)) & (F.col("_to").isNull() | (F.col("_seen") < F.col("_to"))))
    nearest = later.groupBy(*keys, day).agg(F.min("_seen").alias("_next"), F.first("_held").alias("_held"))
    return nearest.select(*keys, F.col("_next").alias(day), *(F.col(f"_held.{c}").alias(c) for c in cols), F.lit(1).alias("_rank"))
