"""Keyed merge into a partitioned table that touches only the partitions of the delta."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portloom.operators.pick import pick_first
from portloom.operators.skew import join_null_safe
from portloom.session import cut_lineage
from portloom.sources.control import upsert
from portloom.sources.tables import path_exists, replace_partitions

INDEX_BUCKETS = 64
_BUCKET = "_bucket"


class RepeatedKeys(ValueError):
    """Several delta rows have one key and no order says which counts."""


class KeyIndex:
    """Which partitions of a table hold which keys, kept beside the table in buckets of key hashes.

    A delta reads the buckets of its own keys only. Entries are appended before the table is written
    and outdated ones are taken out afterwards, so after a failure there may be some too many, which
    costs the next merge a partition more, and never one too few.
    """

    def __init__(self, path: str, schema: T.StructType, keys: Sequence[str], part_col: str, buckets: int = INDEX_BUCKETS):
        self.path, self.buckets, self.entry = f"{path}/_keys", buckets, [*keys, part_col]
        self.schema = T.StructType([*(schema[c] for c in self.entry), T.StructField(_BUCKET, T.IntegerType())])
        self.keys = list(keys)

    def entries(self, rows: DataFrame) -> DataFrame:
        """The index rows of some rows of the table."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return rows.select(*self.entry).distinct().withColumn(_BUCKET, bucket)

    def append(self, entries: DataFrame) -> None:
        entries.repartition(_BUCKET).write.mode("append").partitionBy(_BUCKET).parquet(self.path)

    def ensure(self, base: DataFrame | None) -> None:
        """A table that has no index yet gets one from a scan of its key column."""
        if base is not None and not path_exists(base.sparkSession, self.path):
            self.append(self.entries(base))

    def held(self, own: DataFrame) -> DataFrame:
        """The index rows in the buckets of ``own`` entries."""
        spark = own.sparkSession
        if not path_exists(spark, self.path):
            return own.limit(0)
        buckets = [r[0] for r in own.select(_BUCKET).distinct().collect()]  # at most ``buckets``
        return spark.read.schema(self.schema).parquet(self.path).where(F.col(_BUCKET).isin(buckets))

    def of_same_keys(self, own: DataFrame) -> DataFrame:
        return join_null_safe(self.held(own), own.select(*self.keys, _BUCKET).distinct(), [*self.keys, _BUCKET], "left_semi")

    def drop(self, stale: DataFrame) -> None:
        """Takes entries out of their buckets; other buckets are not touched."""
        if stale.isEmpty():
            return
        rest = cut_lineage(join_null_safe(self.held(stale), stale, [*self.entry, _BUCKET], "left_anti"))
        inside = [r[0] for r in stale.select(_BUCKET).distinct().collect()]
        replace_partitions(rest, self.path, _BUCKET, lambda old: old.where(F.col(_BUCKET).isin(inside)), allow_empty=True)


def merge_partitions(
    delta: DataFrame,
    path: str,
    keys: Sequence[str],
    part_col: str,
    order_by: Sequence[Column] = (),
    moving: bool = False,
) -> int:
    """Merges delta rows by key into a parquet table partitioned by ``part_col`` and returns the
    number of rows merged in.

    The delta is landed once and everything is derived from that copy. Only partitions that it
    names, a null one included, are read and replaced; with ``moving`` a key may change its
    partition, and those that hold an earlier row of a delta key are replaced too. They are found in
    a :class:`KeyIndex`, so the table itself is not searched. A key counts once, a null one too: by
    ``order_by`` its first row, otherwise repeated keys are refused. Merging a delta again changes
    nothing.
    """
    spark, keys = delta.sparkSession, list(keys)
    own = keys if moving else list(dict.fromkeys([*keys, part_col]))
    landed = cut_lineage(pick_first(delta, own, order_by) if order_by else delta)
    if not order_by and not landed.groupBy(*own).count().where("count > 1").isEmpty():
        raise RepeatedKeys(f"several rows of the delta for {path} have the same {own}")
    rows = landed.count()
    if not rows:
        return 0
    known = path_exists(spark, path)
    base = spark.read.schema(delta.schema).parquet(path) if known else landed.limit(0)
    index = KeyIndex(path, delta.schema, keys, part_col)
    parts, outdated = landed.select(part_col).distinct(), None
    if moving:
        index.ensure(base if known else None)
        mine = cut_lineage(index.entries(landed))
        earlier = cut_lineage(index.of_same_keys(mine))
        identity = [*index.entry, _BUCKET]
        index.append(join_null_safe(mine, earlier, identity, "left_anti"))
        outdated = cut_lineage(join_null_safe(earlier, mine, identity, "left_anti"))
        parts = parts.unionAll(outdated.select(part_col)).distinct()
    elif path_exists(spark, index.path):
        index.append(index.entries(landed))
    parts = cut_lineage(parts)
    touched = join_null_safe(base, parts, [part_col], "left_semi")
    if moving:
        kept = join_null_safe(touched, landed.select(*keys), keys, "left_anti")
        merged = kept.select(*delta.columns).unionAll(landed)
    else:
        merged = upsert(touched, landed, own)
    merged = cut_lineage(merged)
    # the partitions are replaced while nothing reads them any more; with ``moving`` one may end empty
    replace_partitions(merged, path, part_col, lambda old: join_null_safe(old, parts, [part_col], "left_semi"))
    if outdated is not None:
        index.drop(outdated)
    return rows
