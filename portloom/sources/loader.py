"""One declared extract, from contract check to bronze table, watermark and audit."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from portloom.session import cut_lineage
from portloom.sources import control
from portloom.sources.control import newer_than
from portloom.sources.landing import snapshot_scan, to_bronze
from portloom.sources.merge import merge_partitions
from portloom.sources.spec import SourceSpec
from portloom.sources.tables import Load, read_table, replace_table, table_exists


def control_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A control table, empty before its first write. It holds one row per run or source table."""
    return read_table(spark, path) if table_exists(spark, path) else spark.createDataFrame([], schema)


def target_path(root: str, spec: SourceSpec) -> str:
    return f"{root}/{spec.target.replace('.', '/')}"


class _Run:
    """Audit and watermark records of one run under ``root/ctl``."""

    def __init__(self, spark: SparkSession, root: str, dag_id: str, logical_date: datetime):
        self.spark, self.run = spark, (dag_id, logical_date)
        self.audit, self.marks = f"{root}/ctl/job_audit", f"{root}/ctl/watermark"

    def record(self, change, *args, **kw) -> None:
        seen = control_table(self.spark, self.audit, control.AUDIT_SCHEMA)
        replace_table(change(seen, *self.run, *args, **kw), self.audit)

    def watermark(self, source: str, target: str, kind: DataType) -> datetime | None:
        """The recorded watermark as a value of the source's own time type."""
        seen = control_table(self.spark, self.marks, control.WATERMARK_SCHEMA)
        mine = seen.where((F.col("source_name") == source) & (F.col("table_name") == target))
        row = mine.select(F.col("watermark_ts").cast(kind).alias("m")).first()
        return row.m if row else None

    def advance(self, source: str, target: str, watermark_ts: datetime | None = None) -> None:
        seen = control_table(self.spark, self.marks, control.WATERMARK_SCHEMA)
        replace_table(control.advance_watermark(seen, source, target, watermark_ts), self.marks)

    def audited(self, run_id: str, load: Callable[[], Load]) -> Load:
        self.record(control.audit_start, run_id)
        try:
            done = load()
        except Exception as failure:
            self.record(control.audit_finish, "failed", detail=str(failure))
            raise
        self.record(control.audit_finish, "success", done.row_count)
        return done


def load_snapshot(
    spark: SparkSession, spec: SourceSpec, root: str, dag_id: str, logical_date: datetime, run_id: str
) -> Load:
    """Full replace of ``spec.target`` under ``root``.

    A broken contract, an empty source or any other failure leaves the bronze table as it was, is
    recorded as a failed run and raised again. Rows go from the source to the staged version
    inside Spark tasks; only the row count comes back.
    """
    if spec.mode != "snapshot" or not spec.target:
        raise ValueError(f"{spec.name}: a snapshot load needs mode 'snapshot' and a target")
    run = _Run(spark, root, dag_id, logical_date)

    def load() -> Load:
        done = replace_table(to_bronze(snapshot_scan(spark, spec)), target_path(root, spec))
        run.advance(spec.name, spec.target)
        return done

    return run.audited(run_id, load)


def load_incremental(
    spark: SparkSession,
    spec: SourceSpec,
    root: str,
    ts: str,
    keys: Sequence[str],
    lookback: str,
    dag_id: str,
    logical_date: datetime,
    run_id: str,
) -> Load:
    """Source rows newer than the recorded watermark minus the lookback, merged into bronze.

    Bronze is partitioned by the day of ``ts`` (``part_date``) and only the days of the delta, and
    those its keys were in before, are rewritten. A key has one row; a row without ``ts`` comes in
    with a first load only, as nothing tells whether it is new. The delta is read once; the result
    counts its rows.
    """
    if spec.mode != "watermark" or not spec.target:
        raise ValueError(f"{spec.name}: an incremental load needs mode 'watermark' and a target")
    run = _Run(spark, root, dag_id, logical_date)

    def load() -> Load:
        source = snapshot_scan(spark, spec)
        mark = run.watermark(spec.name, spec.target, source.schema[ts].dataType)
        delta = cut_lineage(newer_than(source, ts, mark, lookback))
        newest = delta.agg(F.max(ts).alias("own"), F.max(F.col(ts).cast("timestamp")).alias("m")).first()
        day = F.to_date(F.col(ts)).alias("part_date")
        landed = to_bronze(delta.select("*", day), spec.columns + ("part_date",))
        landed = landed.withColumn("part_date", F.col("part_date").cast("date"))
        order = [F.col(ts).desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in spec.columns)]
        rows = merge_partitions(landed, target_path(root, spec), keys, "part_date", order, moving=True)
        if rows:  # late rows alone do not move the watermark back
            moves = newest.own is not None and (mark is None or newest.own > mark)
            run.advance(spec.name, spec.target, newest.m if moves else None)
        return Load(0, rows)

    return run.audited(run_id, load)
