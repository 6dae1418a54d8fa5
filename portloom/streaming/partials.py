"""Marts kept as mergeable partial aggregates, refreshed where their source has changed.

The source is a table partitioned by ``part_col`` whose loads are noted in a log, one row per
partition and load. The mart keeps sums, counts, least and greatest values per partition and group.
A refresh asks the lineage check which partitions are stale, reads those alone and replaces their
partials, which takes earlier, corrected or withdrawn rows of them out as well; what the mart shows is
merged from the partials, whose number does not depend on the rows of the source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portloom.plans.lineage import stale_partitions
from portloom.session import cut_lineage
from portloom.sources.tables import path_exists, replace_partitions

_KINDS = {"sum": (F.sum, F.sum), "count": (F.count, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}
_ROWS = "_rows"


@dataclass(frozen=True)
class Measure:
    """A column aggregated by ``sum``, ``count``, ``min`` or ``max``."""

    kind: str
    column: Column

    def __post_init__(self):
        if self.kind not in _KINDS:
            raise ValueError(f"measures are one of {sorted(_KINDS)}, not {self.kind!r}")


def _note(parts: DataFrame, path: str) -> None:
    parts.coalesce(1).write.mode("append").parquet(path)


def land_partitions(rows: DataFrame, path: str, part_col: str, withdrawn: Sequence[object] = ()) -> None:
    """Replaces the partitions that ``rows`` holds, empties those in ``withdrawn``, and notes the load."""
    spark, kind = rows.sparkSession, rows.schema[part_col].dataType
    rows = cut_lineage(rows)
    emptied = spark.createDataFrame([(p,) for p in withdrawn], T.StructType([T.StructField(part_col, kind)]))
    parts = rows.select(part_col).unionAll(emptied).distinct()
    gone = F.col(part_col).isin(list(withdrawn)) if withdrawn else F.lit(False)
    replace_partitions(rows, path, part_col, lambda old: old.where(gone), allow_empty=True)
    _note(parts.withColumn("loaded_at", F.current_timestamp()), f"{path}/_loads")


class PartialMart:
    """The mart at ``path`` over the source at ``source``, grouped by ``grain``."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        source: str,
        schema: T.StructType,
        part_col: str,
        grain: Mapping[str, Column],
        measures: Mapping[str, Measure],
    ):
        self.spark, self.path, self.source, self.schema = spark, path, source, schema
        self.part_col, self.grain, self.measures = part_col, dict(grain), dict(measures)

    def _loads(self, path: str) -> DataFrame:
        schema = T.StructType([self.schema[self.part_col], T.StructField("loaded_at", T.TimestampType())])
        known = path_exists(self.spark, path)
        return self.spark.read.schema(schema).parquet(path) if known else self.spark.createDataFrame([], schema)

    def stale(self) -> DataFrame:
        """Partitions that were loaded after the mart last used them, with the time of that load."""
        loads, used = self._loads(f"{self.source}/_loads"), self._loads(f"{self.path}/_used")
        return stale_partitions(loads, used, self.part_col, "loaded_at")

    def _partials(self, rows: DataFrame) -> DataFrame:
        keys = [self.part_col, *(e.alias(n) for n, e in self.grain.items())]
        sums = [_KINDS[m.kind][0](m.column).alias(n) for n, m in self.measures.items()]
        return rows.groupBy(*keys).agg(*sums, F.count(F.lit(1)).alias(_ROWS))

    def refresh(self) -> list[object]:
        """Brings the partials of stale partitions up to date and returns those partitions. Doing it
        again after a failure gives the same partials."""
        stale = cut_lineage(self.stale().select(self.part_col, F.col("upstream_loaded_at").alias("loaded_at")))
        parts = [r[0] for r in stale.select(self.part_col).collect()]  # one value per partition
        if not parts:
            return []
        named = [p for p in parts if p is not None]
        inside = F.col(self.part_col).isin(named) if named else F.lit(False)
        if len(named) < len(parts):
            inside = inside | F.col(self.part_col).isNull()
        rows = self.spark.read.schema(self.schema).parquet(self.source).where(inside)
        partials = cut_lineage(self._partials(rows))
        replace_partitions(partials, self.path, self.part_col, lambda old: old.where(inside), allow_empty=True)
        _note(stale, f"{self.path}/_used")
        return parts

    def read(self) -> DataFrame:
        """The mart over all partitions."""
        empty = self._partials(self.spark.createDataFrame([], self.schema))
        partials = self.spark.read.schema(empty.schema).parquet(self.path)
        return partials.groupBy(*self.grain).agg(*(_KINDS[m.kind][1](n).alias(n) for n, m in self.measures.items()))
