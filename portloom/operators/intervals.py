"""Two histories into one: which rows of both sides hold at the same time, for all times."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portloom.operators.ordered import numbered
from portloom.operators.skew import join_null_safe
from portloom.session import stored

# a bound of a key's time line: before all times, at a time, after all times
_EARLIEST, _TIMED, _LATEST = 0, 1, 2


def _bound(at: Column, missing: int) -> list[Column]:
    return [F.when(at.isNull(), missing).otherwise(_TIMED).alias("_kind"), at.alias("_at")]


def intersect_histories(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_cols: Sequence[str],
    right_cols: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """(keys, left columns, right columns, valid_from, valid_to, is_current): one row per pair of a
    left and a right interval [valid_from, valid_to) of a key that overlap, for their common time.

    A null ``valid_from`` holds from the beginning, a null ``valid_to`` for ever; empty intervals hold
    never; a null key is a key. Intervals of one side may overlap each other, and equal rows count
    each.

    All bounds of both sides are put in one order of key and time and numbered, which cuts each key's
    time line into segments. An interval is the run of segments from its start to its end; a pair
    overlaps first in the segment in which the later of the two starts. So one side's starts meet the
    other side's segments by equal number: every match is a row of the result, whatever the key, and
    intervals of a history without overlaps have as many segments as there are bounds.
    """
    keys, left_cols, right_cols = list(keys), list(left_cols), list(right_cols)
    if set(left_cols) & set(right_cols):
        raise ValueError(f"both sides have {sorted(set(left_cols) & set(right_cols))}")

    def timed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
        start, end = F.col(valid_from), F.col(valid_to)
        real = df.where(start.isNull() | end.isNull() | (start < end))
        return real.select(*keys, F.struct(*cols).alias("_row"), start.alias("_start"), end.alias("_end"))

    sides = [stored(timed(df, cols), "intervals") for df, cols in ((left, left_cols), (right, right_cols))]
    ends = [s.select(*keys, *_bound(F.col(c), m)) for s in sides for c, m in (("_start", _EARLIEST), ("_end", _LATEST))]
    bounds = numbered(
        reduce(DataFrame.unionAll, ends).distinct(), [F.col(c) for c in (*keys, "_kind", "_at")], "_number"
    )
    bounds = stored(bounds, "bounds")

    def placed(side: DataFrame) -> DataFrame:
        for c, missing, number in (("_start", _EARLIEST, "_first"), ("_end", _LATEST, "_beyond")):
            kind, at = _bound(F.col(c), missing)
            side = side.withColumns({"_kind": kind, "_at": at})
            side = join_null_safe(side, bounds.withColumnRenamed("_number", number), [*keys, "_kind", "_at"], "inner")
            side = side.drop("_kind", "_at")
        return stored(side, "placed")

    mine, theirs = (placed(s) for s in sides)

    def segments(side: DataFrame) -> DataFrame:
        return side.withColumn("_segment", F.explode(F.sequence("_first", F.col("_beyond") - 1)))

    def starts(side: DataFrame) -> DataFrame:
        return side.withColumn("_segment", F.col("_first"))

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        other = b.select("_segment", *(F.col(c).alias(f"{c}_b") for c in ("_row", "_start", "_end", "_first")))
        return a.join(other, "_segment")

    later_right = met(segments(mine), starts(theirs))
    later_left = met(starts(mine), segments(theirs)).where(F.col("_first") > F.col("_first_b"))
    end = F.least("_end", "_end_b")  # passes over nulls, as does greatest
    return later_right.unionAll(later_left).select(
        *keys,
        *(F.col(f"_row.{c}").alias(c) for c in left_cols),
        *(F.col(f"_row_b.{c}").alias(c) for c in right_cols),
        F.greatest("_start", "_start_b").alias("valid_from"),
        end.alias("valid_to"),
        end.isNull().alias("is_current"),
    )
