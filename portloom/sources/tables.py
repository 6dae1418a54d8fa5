"""Replaceable tables on plain files.

A table is a folder of immutable versions plus a log naming them in order; readers follow the
newest log entry, so a replace is visible at once or not at all and a failed one leaves the
previous version in place. Partitioned tables replace only the partitions that a write touches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from portloom.session import cut_lineage

LOG_SCHEMA = "version long, folder string, row_count long, published_at timestamp"


class EmptySnapshot(RuntimeError):
    """A snapshot of no rows must not replace a table."""


@dataclass(frozen=True)
class Load:
    version: int
    row_count: int


def _log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).json(f"{path}/_versions_log")


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def table_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_versions_log")


def _newest(spark: SparkSession, path: str):
    """The last published entry; of two writers that took one number, the later one."""
    return _log(spark, path).orderBy(F.desc("version"), F.desc("published_at"), F.desc("folder")).first()


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    if version is None:
        entry = _newest(spark, path)
    else:
        entry = _log(spark, path).where(F.col("version") == version).first()
    if entry is None:
        raise LookupError(f"no version {version} of {path}")
    return spark.read.parquet(f"{path}/{entry.folder}")


def counted_write(df: DataFrame, folder: str, partition_by: tuple[str, ...] = (), mode: str = "errorifexists") -> int:
    """Writes parquet and returns the row count taken on the way, without a second scan."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(folder)
    return int(seen.get["n"])


@dataclass(frozen=True)
class Staged:
    """A written version of the table at ``path`` that no reader sees yet."""

    path: str
    folder: str
    row_count: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{self.folder}")


def stage_version(df: DataFrame, path: str) -> Staged:
    """Writes a new version beside the published ones. ``df`` may read the table itself."""
    folder = f"data/{uuid.uuid4().hex}"
    return Staged(path, folder, counted_write(df, f"{path}/{folder}"))


def publish_version(spark: SparkSession, staged: Staged) -> Load:
    """Makes a staged version the newest by one log line; nothing is copied."""
    newest = _newest(spark, staged.path) if table_exists(spark, staged.path) else None
    version = newest.version + 1 if newest else 1
    entry = spark.range(1).select(
        F.lit(version).cast("long").alias("version"),
        F.lit(staged.folder).alias("folder"),
        F.lit(staged.row_count).cast("long").alias("row_count"),
        F.current_timestamp().alias("published_at"),
    )
    entry.coalesce(1).write.mode("append").json(f"{staged.path}/_versions_log")
    return Load(version, staged.row_count)


def replace_table(df: DataFrame, path: str, allow_empty: bool = False) -> Load:
    """Full replace: stage a new version, refuse an empty one, then publish it with one log line.

    Running it again with the same rows gives the same table. ``df`` may read the table itself.
    """
    staged = stage_version(df, path)
    if staged.row_count == 0 and not allow_empty:
        raise EmptySnapshot(f"snapshot for {path} has no rows; the previous version stays")
    return publish_version(df.sparkSession, staged)


def write_partition(df: DataFrame, path: str, part_date: str, part_col: str = "part_date") -> int:
    """One daily snapshot partition; writing a date again replaces just that date."""
    dated = df.withColumn(part_col, F.lit(part_date).cast("date"))
    return counted_write(dated, path, (part_col,), mode="overwrite")


def replace_partitions(
    df: DataFrame,
    path: str,
    part_col: str,
    inside: Callable[[DataFrame], DataFrame],
    allow_empty: bool = False,
) -> int:
    """Writes the partitions of ``df`` and removes the other old rows that ``inside`` selects, which
    must be whole partitions. An empty ``df`` is refused and changes nothing unless it is allowed."""
    spark, old = df.sparkSession, None

    def files() -> DataFrame:
        present = inside(spark.read.schema(df.schema).parquet(path))
        return present.select(F.col("_metadata.file_path").alias("file")).distinct()

    if path_exists(spark, path):
        old = cut_lineage(files())
    rows = counted_write(df, path, (part_col,), mode="overwrite")
    if rows == 0 and not allow_empty:
        raise EmptySnapshot(f"nothing to publish to {path}; its partitions stay")
    if old is not None and not old.isEmpty():
        # the write took away the files of the partitions it replaced; folders that still hold old ones are stale
        folder = F.regexp_replace("file", "/[^/]*$", "").alias("folder")
        stale = files().join(old, "file").select(folder).where(F.col("folder").contains(f"/{part_col}=")).distinct()
        for row in stale.collect():  # one row per partition that is to go
            gone = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row.folder))
            gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return rows


def publish(
    df: DataFrame, path: str, partition_by: str | None = None, window: Column | None = None, allow_empty: bool = False
) -> int:
    """Stage and swap a whole table, or replace a partitioned one, whole or within a window.

    With ``window`` (a condition on the partition column) rows outside it are refused, so a
    publish cannot touch partitions it was not meant for. Partitions in the window, or of the whole
    table without one, for which ``df`` has no rows are removed.
    """
    if partition_by is None:
        return replace_table(df, path, allow_empty).row_count
    if window is None:
        return replace_partitions(df, path, partition_by, lambda old: old, allow_empty)
    inside = F.coalesce(window, F.lit(False))
    guarded = df.where(
        F.when(inside, F.lit(True)).otherwise(F.raise_error(F.lit("row outside the publish window")).cast("boolean"))
    )
    return replace_partitions(guarded, path, partition_by, lambda old: old.where(inside), allow_empty)
