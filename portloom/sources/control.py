"""Keyed upserts, watermarks, run audit and incremental loads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portloom.functions.calendar import time_literal
from portloom.operators.pick import pick_first

# fixed values
DETAIL_LENGTH = 2000
WATERMARK_KEYS = ("source_name", "table_name")
AUDIT_KEYS = ("dag_id", "logical_date")
WATERMARK_SCHEMA = "source_name string, table_name string, watermark_ts timestamp, last_loaded_at timestamp"
AUDIT_SCHEMA = (
    "dag_id string, logical_date timestamp, run_id string, status string, row_count long, "
    "started_at timestamp, finished_at timestamp, detail string"
)


def upsert(
    base: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    set_cols: Sequence[str] | None = None,
    order_by: Sequence[Column] = (),
    insert: bool = True,
) -> DataFrame:
    """Base rows with the delta merged in by key.

    On a match only ``set_cols`` (all by default) take the delta's value, null included. Unmatched
    delta rows are inserted unless ``insert`` is off. With ``order_by`` the delta may hold several
    rows per key and the first of them counts. Base keys are unique; a null key is a key.
    """
    keys = list(keys)
    if order_by:
        delta = pick_first(delta, keys, order_by)
    values = [c for c in base.columns if c not in keys]
    given = [c for c in values if c in delta.columns]
    set_cols = given if set_cols is None else list(set_cols)

    def side(df: DataFrame, cols: Sequence[str], tag: str) -> DataFrame:
        return df.select(*keys, F.struct(F.lit(1).alias("_in"), *cols).alias(tag))

    theirs = side(delta, given, "_d").withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same_key = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys))
    both = side(base, values, "_b").join(theirs, same_key, "full" if insert else "left")
    own_key = {k: F.when(F.col("_b").isNull(), F.col(f"_key_{k}")).otherwise(F.col(k)) for k in keys}

    def value(c: str) -> Column:
        old, new = F.col(f"_b.{c}"), F.col(f"_d.{c}") if c in given else F.lit(None)
        merged = F.when(F.col("_b").isNull(), new)
        if c in set_cols:
            merged = merged.when(F.col("_d").isNotNull(), new)
        return merged.otherwise(old).cast(base.schema[c].dataType).alias(c)

    return both.select(*[value(c) if c in values else own_key[c].alias(c) for c in base.columns])


def _now(now: Column | datetime | None) -> Column:
    if now is None:
        return F.current_timestamp()
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def advance_watermark(
    base: DataFrame, source: str, table: str, watermark_ts: datetime | None = None, now: datetime | None = None
) -> DataFrame:
    """Watermark row of one source table set to now; a snapshot source leaves ``watermark_ts``."""
    mark = {"watermark_ts": F.lit(watermark_ts).cast("timestamp")} if watermark_ts is not None else {}
    delta = base.sparkSession.range(1).select(
        F.lit(source).alias("source_name"),
        F.lit(table).alias("table_name"),
        *(c.alias(n) for n, c in mark.items()),
        _now(now).alias("last_loaded_at"),
    )
    return upsert(base, delta, WATERMARK_KEYS)


def audit_start(base: DataFrame, dag_id: str, logical_date: datetime, run_id: str, now=None) -> DataFrame:
    """Run marked as running; a retry clears the earlier end and detail but not its row count."""
    delta = base.sparkSession.range(1).select(
        F.lit(dag_id).alias("dag_id"),
        F.lit(logical_date).cast("timestamp").alias("logical_date"),
        F.lit(run_id).alias("run_id"),
        F.lit("running").alias("status"),
        _now(now).alias("started_at"),
        F.lit(None).cast("timestamp").alias("finished_at"),
        F.lit(None).cast("string").alias("detail"),
    )
    return upsert(base, delta, AUDIT_KEYS)


def audit_finish(
    base: DataFrame,
    dag_id: str,
    logical_date: datetime,
    status: str,
    row_count: int | None = None,
    detail: str | None = None,
    now=None,
) -> DataFrame:
    """End of a run that was started; an unknown run is left alone."""
    delta = base.sparkSession.range(1).select(
        F.lit(dag_id).alias("dag_id"),
        F.lit(logical_date).cast("timestamp").alias("logical_date"),
        F.lit(status).alias("status"),
        F.lit(row_count).cast("long").alias("row_count"),
        _now(now).alias("finished_at"),
        F.substring(F.lit(detail).cast("string"), 1, DETAIL_LENGTH).alias("detail"),
    )
    return upsert(base, delta, AUDIT_KEYS, insert=False)


def fold_audit(messages: DataFrame, order: Sequence[str], keys: Sequence[str] = AUDIT_KEYS) -> DataFrame:
    """State of the audit table after a whole log of start and finish messages.

    Messages carry ``kind`` (start or finish), ``run_id``, ``status``, ``row_count``, ``at`` and
    ``detail``. The result is what applying :func:`audit_start` and :func:`audit_finish` one by one
    gives, in a single combinable aggregate: the last start, the last finish and which of the two
    came later are all that counts.
    """
    place = F.struct(*order)
    start, finish = F.col("kind") == "start", F.col("kind") == "finish"
    last = messages.groupBy(*keys).agg(
        F.min(F.when(start, place)).alias("_first_start"),
        F.max(F.when(start, F.struct(place.alias("p"), "run_id", F.col("at").alias("at")))).alias("_s"),
        F.max(
            F.when(
                finish,
                F.struct(
                    place.alias("p"),
                    "status",
                    F.col("row_count").alias("row_count"),
                    F.col("at").alias("at"),
                    F.substring("detail", 1, DETAIL_LENGTH).alias("detail"),
                ),
            )
        ).alias("_f"),
    )
    ended = F.col("_f").isNotNull() & (F.col("_f.p") > F.col("_first_start"))
    closed = ended & (F.col("_f.p") > F.col("_s.p"))
    return last.where(F.col("_s").isNotNull()).select(
        *keys,
        F.col("_s.run_id").alias("run_id"),
        F.when(closed, F.col("_f.status")).otherwise("running").alias("status"),
        F.when(ended, F.col("_f.row_count")).alias("row_count"),
        F.col("_s.at").alias("started_at"),
        F.when(closed, F.col("_f.at")).alias("finished_at"),
        F.when(closed, F.col("_f.detail")).alias("detail"),
    )


def newer_than(source: DataFrame, ts: str, watermark: datetime | None, lookback: str) -> DataFrame:
    """Source rows newer than the watermark minus the lookback; all of them without a watermark.

    The bound is a constant, so it reaches the source scan as a pushed-down filter.
    """
    if watermark is None:
        return source
    since = time_literal(watermark, source.schema[ts].dataType) - F.expr(f"INTERVAL {lookback}")
    return source.where(F.col(ts) > since)


def incremental_load(
    source: DataFrame,
    target: DataFrame,
    ts: str,
    keys: Sequence[str],
    lookback: str,
    watermark: datetime | None = None,
) -> DataFrame:
    """Target with the source rows newer than its watermark minus the lookback merged in by key.

    The watermark is the one recorded for the table or, if none is given, the target's newest time.
    Rows late by at most ``lookback`` (such as ``"3 days"``) are added or corrected; older ones are
    left out.
    """
    if watermark is None:
        watermark = target.agg(F.max(ts).alias("m")).first().m
    return upsert(target, newer_than(source, ts, watermark, lookback), keys, order_by=[F.col(ts).desc()])
