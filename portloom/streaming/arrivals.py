"""Arrival-driven refresh: marts are rebuilt once every declared source has new data."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from portloom.sources.tables import Load, counted_write, path_exists, read_table, replace_table, table_exists

ARRIVAL_SCHEMA = "row_count long, source_name string, batch_id long"


class Arrivals:
    """Streams the files of each source into bronze and tells when a refresh is due.

    ``sources`` maps a name to (landing folder, schema). All state lives under ``root``: bronze
    rows and an arrival record per micro-batch, and the batches each refresh has used.
    """

    def __init__(self, spark: SparkSession, root: str, sources: Mapping[str, tuple[str, StructType]]):
        self.spark, self.root, self.sources = spark, root, dict(sources)

    def bronze(self, name: str) -> DataFrame:
        """Everything landed so far, with the source's own columns."""
        schema = self.sources[name][1]
        return self.spark.read.schema(schema).parquet(f"{self.root}/bronze/{name}").select(*schema.names)

    def drain(self) -> None:
        """Lands whatever has arrived in each source; files already taken are not read again."""
        for name, (folder, schema) in self.sources.items():
            stream = self.spark.readStream.schema(schema).parquet(folder)
            writer = stream.writeStream.option("checkpointLocation", f"{self.root}/progress/{name}")
            writer.trigger(availableNow=True).foreachBatch(self._lander(name)).start().awaitTermination()

    def _lander(self, name: str) -> Callable[[DataFrame, int], None]:
        def land(batch: DataFrame, batch_id: int) -> None:
            rows = counted_write(batch, f"{self.root}/bronze/{name}/landed_batch={batch_id}", mode="overwrite")
            record = self.spark.range(1).select(F.lit(rows).cast("long").alias("row_count"))
            record.write.mode("overwrite").parquet(
                f"{self.root}/arrivals/source_name={name}/batch_id={batch_id}"
            )

        return land

    def _newest(self) -> dict[str, int]:
        """Newest landed batch per source; one row per source reaches the driver."""
        if not path_exists(self.spark, f"{self.root}/arrivals"):
            return {}
        log = self.spark.read.schema(ARRIVAL_SCHEMA).parquet(f"{self.root}/arrivals").where("row_count > 0")
        return {r.source_name: r.b for r in log.groupBy("source_name").agg(F.max("batch_id").alias("b")).collect()}

    def _used(self) -> dict[str, int]:
        path = f"{self.root}/refreshed"
        if not table_exists(self.spark, path):
            return {}
        return {r.source_name: r.batch_id for r in read_table(self.spark, path).collect()}

    def waiting_for(self) -> list[str]:
        """Sources without new data since the last refresh."""
        newest, used = self._newest(), self._used()
        return sorted(s for s in self.sources if newest.get(s, -1) <= used.get(s, -1))

    def refresh(self, build: Callable[[Mapping[str, DataFrame]], DataFrame], out: str) -> Load | None:
        """Rebuilds and publishes the mart when all sources have arrived, else does nothing."""
        if self.waiting_for():
            return None
        newest = self._newest()
        load = replace_table(build({name: self.bronze(name) for name in self.sources}), out)
        used = self.spark.createDataFrame(list(newest.items()), "source_name string, batch_id long")
        replace_table(used, f"{self.root}/refreshed")
        return load

