"""Change detection, slowly changing intervals and point-in-time lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portloom.operators.skew import ROWS_PER_SLICE, Sliced, with_next, with_previous


def _differs(cols: Sequence[str], prev: str = "_prev") -> Column:
    changed = F.lit(False)
    for c in cols:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"{prev}.{c}"))
    return changed


def change_flags(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    deltas: Sequence[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Adds ``prev_<c>`` and ``is_<c>_changed`` per tracked column and ``<c>_delta`` per numeric one.

    The first row of a key has no previous value and counts as not changed.
    """
    sliced = Sliced(df, keys, order, rows_per_slice)
    tracked = list(dict.fromkeys([*cols, *deltas]))
    out = with_previous(sliced, sliced.rows, tracked)
    known = F.col("_prev").isNotNull()
    added = {f"prev_{c}": F.col(f"_prev.{c}") for c in tracked}
    added |= {f"is_{c}_changed": known & ~F.col(c).eqNullSafe(F.col(f"_prev.{c}")) for c in cols}
    added |= {f"{c}_delta": F.col(c) - F.col(f"_prev.{c}") for c in deltas}
    return out.withColumns(added).drop("_prev", "_slice")


def _changed_rows(sliced: Sliced, rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    out = with_previous(sliced, rows, cols)
    return out.where(F.col("_prev").isNull() | _differs(cols))


def transitions(
    snapshots: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    keep_first: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Successive snapshots turned into change events ``from_<c>`` -> ``to_<c>``.

    Only real changes become rows; ``keep_first`` also keeps the first appearance of an entity.
    """
    sliced = Sliced(snapshots, keys, order, rows_per_slice)
    out = _changed_rows(sliced, sliced.rows, cols)
    if not keep_first:
        out = out.where(F.col("_prev").isNotNull())
    moves = []
    for c in cols:
        moves += [F.col(f"_prev.{c}").alias(f"from_{c}"), F.col(c).alias(f"to_{c}")]
    return out.select(*keys, *order, *moves)


def scd2(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Validity intervals [valid_from, valid_to) of ``cols``; equal neighbours become one.

    The first column of ``order`` is the time. The open interval has a null ``valid_to``. Of several
    rows of one time the last in ``order`` holds; the others were never valid and do not appear.
    """
    at = order[0]
    sliced = Sliced(df, keys, order, rows_per_slice)
    last = with_next(sliced, sliced.rows, at, "_next").where(F.col("_next").isNull() | (F.col(at) < F.col("_next")))
    starts = _changed_rows(sliced, last.drop("_next"), cols).select(*keys, *order, *cols, "_slice")
    out = with_next(sliced, starts, at, "valid_to")
    return out.select(
        *keys,
        *cols,
        F.col(at).alias("valid_from"),
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def point_in_time_join(
    fact: DataFrame,
    hist: DataFrame,
    keys: Sequence[str],
    ts: str,
    cols: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "left",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """The ``cols`` valid at the fact's time: valid_from <= ts < valid_to.

    Both sides are merged in time order and the last interval start is carried forward, so the
    work is linear in the rows of a key; no fact is paired with every interval. The intervals of
    one key must not overlap, as those built by :func:`scd2`; empty ones are ignored.
    """
    keys, fact_cols = list(keys), [c for c in fact.columns if c not in keys]
    real = F.col(valid_to).isNull() | (F.col(valid_from) < F.col(valid_to))
    starts = hist.where(real).select(
        *keys,
        F.col(valid_from).alias("_at"),
        F.lit(0).alias("_side"),
        F.struct(*cols, F.col(valid_to).alias("_until")).alias("_hist"),
    )
    probes = fact.select(*keys, F.col(ts).alias("_at"), F.lit(1).alias("_side"), F.struct(*fact_cols).alias("_fact"))
    merged = starts.unionByName(probes, allowMissingColumns=True)

    sliced = Sliced(merged, keys, ["_at", "_side"], rows_per_slice)
    so_far = sliced.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = sliced.rows.withColumn("_now", F.last("_hist", ignorenulls=True).over(so_far))
    hot = sliced.of_hot_keys(sliced.rows)
    if hot is not None:
        last_start = F.max_by("_hist", F.when(F.col("_side") == 0, F.col("_at")))
        seen = hot.groupBy(*keys, "_slice").agg(last_start.alias("_last"))
        out = sliced.attach(out, sliced.carried(seen, "_last"))
        out = out.withColumn("_now", F.coalesce("_now", "_carry"))
    valid = F.col("_now._until").isNull() | (F.col("_at") < F.col("_now._until"))
    valid = F.col("_now").isNotNull() & valid
    out = out.where(F.col("_side") == 1)
    if how == "inner":
        out = out.where(valid)
    return out.select(
        *keys,
        *(F.col(f"_fact.{c}").alias(c) for c in fact_cols),
        *(F.when(valid, F.col(f"_now.{c}")).alias(c) for c in cols),
    )


def valid_on(hist: DataFrame, day: Column, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Intervals that hold on a day: valid_from <= day < valid_to, an open end holds for ever."""
    return hist.where((F.col(valid_from) <= day) & (F.col(valid_to).isNull() | (day < F.col(valid_to))))


def relation_snapshot(
    left: DataFrame, right: DataFrame, keys: Sequence[str], day: Column, path: Mapping[str, Sequence[str]]
) -> DataFrame:
    """The relation of two historised dimensions on one day: both sides' rows valid then, joined by
    key, with an array of columns (top first) for each entry of ``path``, nulls left out."""
    sides = [valid_on(h, day).drop("valid_from", "valid_to", "is_current") for h in (left, right)]
    arrays = {name: F.array_compact(F.array(*cols)) for name, cols in path.items()}
    return sides[0].join(sides[1], list(keys)).withColumns(arrays)


def accumulating_snapshot(
    df: DataFrame, entity: Sequence[str], stage: str, ts: str, stages: Sequence[str]
) -> DataFrame:
    """One row per entity with the first time of each stage as ``<stage>_at``."""
    firsts = [F.min(F.when(F.col(stage) == s, F.col(ts))).alias(f"{s}_at") for s in stages]
    return df.groupBy(*entity).agg(*firsts)
