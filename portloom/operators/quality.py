"""Data checks. Each returns a frame of violations; a suite sums them up and a gate blocks a publish."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portloom.functions.calendar import time_literal
from portloom.functions.text import code_of
from portloom.session import cut_lineage, stored

RECONCILE_BUCKETS = 4096
GATE_SCHEMA = "check_name string, table_name string, column_name string, n_violations long, status string"


class GateFailed(RuntimeError):
    """A failing check stops everything downstream of the table."""


def _count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def _long(df: DataFrame, counts: Mapping[str, Column], name: str, value: str) -> DataFrame:
    """All aggregates in one pass over the table, then one row per entry."""
    one = df.agg(F.array(*(F.struct(F.lit(k).alias(name), v.alias(value)) for k, v in counts.items())).alias("_e"))
    return one.select(F.inline("_e"))


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, n_violations) for every column, from a single aggregate."""
    return _long(df, {c: _count_if(F.col(c).isNull()) for c in cols}, "column_name", "n_violations")


def _key_digest(cols: Sequence[str]) -> Column:
    return F.xxhash64(*cols)


def unique(
    df: DataFrame, cols: Sequence[str], count_as: str = "n_rows", digest: Callable[[Sequence[str]], Column] = _key_digest
) -> DataFrame:
    """Keys held by more than one row. A key with a null part is not compared.

    Composite and textual keys are first counted by a digest of eight bytes, so what is shuffled per
    row does not depend on the width of the key; whole keys are compared only where digests meet. These
    digests are written first, so Spark sees how few they are and need not shuffle the keys to match them.
    """
    cols = list(cols)
    keyed = df.dropna(subset=cols)
    if len(cols) > 1 or not isinstance(df.schema[cols[0]].dataType, T.NumericType):
        marked = keyed.select(*cols, digest(cols).alias("_digest"))
        met = marked.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_digest")
        keyed = marked.join(stored(met, "met-digests"), "_digest", "left_semi")
    return keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_as)).where(F.col(count_as) > 1)


def accepted_values(df: DataFrame, col: str, values: Sequence[str], count_as: str = "n_rows") -> DataFrame:
    """Values outside the list with their row count; null passes."""
    bad = df.where(F.col(col).isNotNull() & ~F.col(col).isin(*values))
    return bad.groupBy(col).agg(F.count(F.lit(1)).alias(count_as))


def relationships(child: DataFrame, cols: str | Sequence[str], parent: DataFrame, parent_col: str) -> DataFrame:
    """(column_name, value, n_rows): child values without a parent and how many rows hold them.

    Null passes. All columns are unfolded in one pass over the child and counted per value, beside each
    other, so a value held by most rows or by several columns leaves each task once, and the counts are
    matched with the parent where they are, once for all columns.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    held = F.array(*(F.struct(F.lit(i).alias("_c"), F.col(c).cast("string").alias("value")) for i, c in enumerate(cols)))
    values = child.select(F.inline(held)).where(F.col("value").isNotNull())
    counts = values.groupBy("value").agg(*(_count_if(F.col("_c") == i).alias(f"_n{i}") for i in range(len(cols))))
    known = parent.select(F.col(parent_col).cast("string").alias("value"))
    entries = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("n_rows")) for i, c in enumerate(cols)))
    lost = counts.join(known, "value", "left_anti").select("value", F.inline(entries))
    return lost.where("n_rows > 0").select("column_name", "value", "n_rows")


def scrubber_owner(nodes: DataFrame, ports: DataFrame) -> DataFrame:
    """Scrubbers that some equipment uses in NOR position, yet owned by an equipment that does not."""
    nor = ports.where(F.col("eqp_posn") == "NOR").select(
        code_of(F.col("seqp_id"), F.col("seqp_ch")).alias("code"), F.col("eqp_id").alias("main_equipment_code")
    )
    nor = nor.where(F.col("code").isNotNull()).distinct()
    scrubbers = nodes.where(F.col("type_code") == "SCRUBBER").select("code", "main_equipment_code")
    used = scrubbers.join(nor, "code", "left_semi")
    return used.join(nor, ["code", "main_equipment_code"], "left_anti")


def merge_owner(nodes: DataFrame, written: bool = False) -> DataFrame:
    """Merges whose owner differs from the owner of their scrubber; a null owner passes. Both sides read the
    nodes, so these are written first unless they are a ``written`` table."""
    kept = nodes.where(F.col("type_code").isin("SCRUBBER", "SCRUBBER_MERGE"))
    kept = kept.select("code", "type_code", "main_equipment_code", "group_code")
    kept = kept if written else stored(kept, "owned-nodes")
    m = kept.where(F.col("type_code") == "SCRUBBER_MERGE").select("code", "main_equipment_code", "group_code")
    s = kept.where(F.col("type_code") == "SCRUBBER").select(
        F.col("code").alias("group_code"), F.col("main_equipment_code").alias("_owner")
    )
    differing = m.join(s, "group_code").where(F.col("main_equipment_code") != F.col("_owner"))
    return differing.select("code", "main_equipment_code")


def freshness(
    df: DataFrame, ts: str, now: Column | datetime, warn_after: str, error_after: str, by: Sequence[str] = ()
) -> DataFrame:
    """Newest load per group against two thresholds such as ``"6 hours"``."""
    now = now if isinstance(now, Column) else time_literal(now, df.schema[ts].dataType)
    newest = F.max(ts)
    late = lambda after: newest < now - F.expr(f"INTERVAL {after}")
    status = (
        F.when(newest.isNull(), "never")
        .when(late(error_after), "error")
        .when(late(warn_after), "warn")
        .otherwise("pass")
    )
    return df.groupBy(*by).agg(newest.alias("last_loaded_at"), status.alias("status"))


def _bucket_digests(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """(bucket, digest): number and order-free digests of a bucket's rows."""
    own = [*keys, *cols]
    missing = F.array(*(F.col(c).isNull() for c in own))  # a hash alone passes over nulls
    marks = df.select(
        "_bucket", F.xxhash64(*own, missing).alias("a"), F.xxhash64(F.lit("other"), missing, *own).alias("b")
    )
    digest = F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col("a").cast("decimal(38,0)")).alias("a"), F.bit_xor("b").alias("b"))
    return marks.groupBy("_bucket").agg(digest.alias("digest"))


def reconcile(
    old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str], buckets: int = RECONCILE_BUCKETS
) -> DataFrame:
    """Differences between two outputs by key, with the key's rows on either side.

    ``difference`` is ``missing`` or ``extra`` for a key of one side only, ``duplicate`` for one held
    by several rows of a side (besides the former, if it is also on one side only), and ``changed``
    with one row per changed column. Of a repeated key the largest row of each side is compared.

    Keys are dealt into buckets by hash, and both sides' buckets are first compared by digests that
    do not depend on the order of rows, at most ``buckets`` numbers a side. Only rows of buckets that
    differ go on and are compared by key; the others are not shuffled.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    sides = [df.select(*keys, *cols, bucket.alias("_bucket")) for df in (old, new)]
    mine, theirs = (_bucket_digests(s, keys, cols) for s in sides)
    unlike = mine.join(theirs.withColumnRenamed("digest", "other"), "_bucket", "full").where(
        ~F.col("digest").eqNullSafe(F.col("other"))
    )
    unlike = F.broadcast(cut_lineage(unlike.select("_bucket")))  # at most ``buckets`` rows
    old, new = (s.join(unlike, "_bucket", "left_semi") for s in sides)
    return _compared(old, new, keys, cols)


def _compared(old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Both sides go through one grouped pass instead of an outer join, so a repeated key stays linear."""
    packed = F.struct(*cols)
    both = old.select(*keys, packed.alias("_row"), F.lit(True).alias("_old")).unionAll(
        new.select(*keys, packed.alias("_row"), F.lit(False).alias("_old"))
    )
    old_row, new_row = F.when(F.col("_old"), F.col("_row")), F.when(~F.col("_old"), F.col("_row"))
    paired = both.groupBy(*keys).agg(
        F.count(F.when(F.col("_old"), 1)).alias("n_old"),
        F.count(F.when(~F.col("_old"), 1)).alias("n_new"),
        F.max(old_row).alias("_o"),
        F.max(new_row).alias("_n"),
    )
    none = F.lit(None).cast("string")

    def finding(kind: str, column: Column = none, a: Column = none, b: Column = none) -> Column:
        return F.struct(
            F.lit(kind).alias("difference"),
            column.alias("column_name"),
            a.cast("string").alias("old_value"),
            b.cast("string").alias("new_value"),
        )

    on_both = (F.col("n_old") > 0) & (F.col("n_new") > 0)
    found = [
        F.when((F.col("n_old") > 1) | (F.col("n_new") > 1), finding("duplicate")),
        F.when(F.col("n_new") == 0, finding("missing")),
        F.when(F.col("n_old") == 0, finding("extra")),
    ]
    for c in cols:
        differs = on_both & ~F.col(f"_o.{c}").eqNullSafe(F.col(f"_n.{c}"))
        found.append(F.when(differs, finding("changed", F.lit(c), F.col(f"_o.{c}"), F.col(f"_n.{c}"))))
    return paired.select(*keys, "n_old", "n_new", F.inline(F.array_compact(F.array(*found))))


@dataclass(frozen=True)
class Check:
    """A named check and its violations; with ``counted`` the violations carry their own count."""

    name: str
    table: str
    column: str
    violations: DataFrame
    counted: str | None = None


def run_suite(checks: Sequence[Check]) -> DataFrame:
    """One row per check: (check_name, table_name, column_name, n_violations, status)."""

    def summary(c: Check) -> DataFrame:
        n = F.coalesce(F.sum(c.counted), F.lit(0)).cast("long") if c.counted else F.count(F.lit(1))
        return c.violations.agg(n.alias("n_violations")).select(
            F.lit(c.name).alias("check_name"),
            F.lit(c.table).alias("table_name"),
            F.lit(c.column).alias("column_name"),
            "n_violations",
            F.when(F.col("n_violations") > 0, "fail").otherwise("pass").alias("status"),
        )

    return reduce(DataFrame.unionAll, (summary(c) for c in checks))


def gate(result: DataFrame) -> None:
    """Raises when any check of the suite failed. The suite holds one row per check."""
    failed = result.where(F.col("status") == "fail").collect()
    if failed:
        raise GateFailed(
            "; ".join(f"{r.check_name} {r.table_name}.{r.column_name}: {r.n_violations}" for r in failed)
        )
