"""Session settings and the shared folder used for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PARTITIONS_CONF = "spark.sql.shuffle.partitions"
ADVISORY_CONF = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
ROWS_PER_TASK = 500_000
BYTES_PER_TASK = "16m"


def local_session(cores: str | int = "*", app: str = "portloom", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local master may fall back to a machine-local temporary folder.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="portloom-"))
    return spark.sparkContext.getCheckpointDir()


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder path of the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_for(spark: SparkSession, rows: int, rows_per_task: int | None = None) -> Iterator[None]:
    """What runs inside shuffles into as many partitions as ``rows`` need, where the session's number is too small
    for them; adaptive execution puts small ones together, up to ``BYTES_PER_TASK`` as shuffled, since rows of
    codes may take thirty times that in memory. Only jobs that start inside count, so write their result there."""
    needed = -(-rows // (rows_per_task or ROWS_PER_TASK))
    if needed <= int(spark.conf.get(PARTITIONS_CONF)):
        yield
        return
    raised = {PARTITIONS_CONF: str(needed), ADVISORY_CONF: BYTES_PER_TASK}
    before = {name: spark.conf.get(name, None) for name in raised}
    try:
        for name, value in raised.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """The frame as a compressed table in the shared folder, for results that grow with the input: a
    checkpoint holds rows as they lie in memory, a table a fraction of that. What was shuffled for the
    table is removed as soon as it is written."""
    spark = df.sparkSession
    folder, before = workspace(spark, name), spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        df.write.option("compression", compression).parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)
    return spark.read.schema(df.schema).parquet(folder)
