"""Joins and ordered look-backs that stay balanced when one key holds a large share of the rows.

Hot keys are found by an exact, map-side combined count. A key is hot when it has more than
``rows_per_slice`` rows, so at most ``rows / rows_per_slice`` keys are hot; all of them are split.
The list is written once, before the plan that uses it is built: without hot keys the plan is the
plain one, with them Spark sees the list's size and chooses between broadcast and shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portloom.session import ROWS_PER_TASK, workspace

ROWS_PER_SLICE = 1_000_000
NULL_KEY_SLICES = 1024
SAMPLES_PER_SLICE = 64
_SEARCH_STEPS = 32  # halvings that find a place among up to 2**32 cuts


def _written(df: DataFrame, name: str) -> DataFrame | None:
    """The frame as a table in the shared folder, None if it has no rows."""
    folder = workspace(df.sparkSession, name)
    df.write.parquet(folder)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    return None if out.isEmpty() else out


def _slices(rows: Column, rows_per_slice: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(rows / F.lit(rows_per_slice))).cast("int")


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi join in which null keys match; the result has the left keys."""
    named = {c: f"_right_{c}" for c in on}
    other = right.withColumnsRenamed(named)
    out = left.join(other, reduce(and_, (F.col(c).eqNullSafe(F.col(r)) for c, r in named.items())), how)
    return out.drop(*named.values())


def dealt(df: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The frame dealt by ``on`` into as many tasks as its rows need, for steps that hold a task's rows in memory.

    It is left as it is where the session's shuffle partitions are enough, and where one key alone has more rows
    than a task should get: Spark's adaptive joins split such a key, but not a frame dealt by number.
    """
    per_key = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    rows, most = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    tasks = -(-rows // rows_per_task)
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) or most > rows_per_task:
        return df
    return df.repartition(tasks, *on)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Equi join whose hot keys are spread over a grid of tasks.

    For a hot key the left rows are cut into A slices and the right rows into B slices; each left
    slice is copied to the B right slices and the other way round, so a pair of rows meets in
    exactly one task. ``left``, ``left_semi`` and ``left_anti`` keep B at 1: a left row lives in
    one task and sees every right row of its key there. Use those with a right side that is small
    per key.
    """
    on = list(on)
    both_sides = how == "inner"
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type not supported: {how}")

    counted = left.select(*on, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
    if both_sides:
        counted = counted.unionAll(right.select(*on, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    hot = (
        counted.groupBy(*on)
        .agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
        .where((F.col("_l") > rows_per_slice) | (F.col("_r") > rows_per_slice))
        .dropna(subset=on)
        .select(
            *on,
            _slices(F.col("_l"), rows_per_slice).alias("_a"),
            (_slices(F.col("_r"), rows_per_slice) if both_sides else F.lit(1)).alias("_b"),
        )
    )
    hot = _written(hot, "hot-join-keys")
    if hot is None:
        return left.join(right, on, how)

    def own_slice(df: DataFrame, n: str) -> Column:
        row = F.xxhash64(*df.columns)
        own = F.when(F.col(n) > 1, F.pmod(row, F.col(n)))
        if not both_sides:  # a null key matches nothing, its rows may go anywhere
            no_key = reduce(or_, (F.col(c).isNull() for c in on))
            own = own.when(no_key, F.pmod(row, F.lit(NULL_KEY_SLICES)))
        return own.otherwise(F.lit(0)).cast("int")

    def copies(n: str) -> Column:
        return F.sequence(F.lit(0), F.coalesce(F.col(n), F.lit(1)) - 1)

    def sliced(df: DataFrame, own: str, other: str, own_col: str, other_col: str, copy: bool) -> DataFrame:
        out = df.join(hot, on, "left")
        cols = [F.col(c) for c in df.columns]
        out = out.select(*cols, own_slice(df, own).alias(own_col), F.col(other).alias("_n"))
        if not copy:
            return out.drop("_n").withColumn(other_col, F.lit(0))
        return out.withColumn(other_col, F.explode(copies("_n"))).drop("_n")

    if both_sides:
        lhs = sliced(left, "_a", "_b", "_sa", "_sb", copy=True)
        rhs = sliced(right, "_b", "_a", "_sb", "_sa", copy=True)
        return lhs.join(rhs, [*on, "_sa", "_sb"], how).drop("_sa", "_sb")
    lhs = sliced(left, "_a", "_b", "_sa", "_sb", copy=False).drop("_sb")
    rhs = sliced(right, "_b", "_a", "_sb", "_sa", copy=True).drop("_sb")
    return lhs.join(rhs, [*on, "_sa"], how).drop("_sa")


class Sliced:
    """Rows with a ``_slice`` column: hot keys are cut along their order, others stay whole.

    A hot key is cut by count: a sample of its rows, taken by their hash, is put in order and every
    ``SAMPLES_PER_SLICE``-th of it is a cut. All columns of ``order`` count, of any type that has an
    order, nulls first as in a window; rows without a key are a key too. Slices of one key are
    ordered like its rows, so a window over (key, slice) gives the right neighbours inside a slice,
    and only the rows at slice edges need a value carried over from the slice next to theirs. Rows
    equal in all of ``order`` share a slice.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        rows_per_slice: int = ROWS_PER_SLICE,
    ):
        self.keys, self.order = list(keys), list(order)
        counted = df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_slice)
        self.hot = _written(counted.select(*self.keys), "hot-keys")
        if self.hot is None:
            self.rows = df.withColumn("_slice", F.lit(0).cast("long"))
            return
        one_in = max(1, rows_per_slice // SAMPLES_PER_SLICE)
        per_cut = max(1, rows_per_slice // one_in)
        place = F.struct(*self.order)
        sample = self.of_hot_keys(df).where(F.pmod(F.xxhash64(*df.columns), F.lit(one_in)) == 0)
        nth = F.row_number().over(Window.partitionBy(*self.keys).orderBy(*self.order))
        cuts = sample.select(*self.keys, place.alias("_cut"), nth.alias("_nth")).where(F.col("_nth") % per_cut == 0)
        cuts = cuts.groupBy(*self.keys).agg(F.sort_array(F.collect_list("_cut")).alias("_cuts"))
        cuts = _written(cuts, "cuts")
        if cuts is None:
            self.rows = df.withColumn("_slice", F.lit(0).cast("long"))
            return

        def halve(found: Column, _: Column) -> Column:
            low, high = found["low"], found["high"]
            middle = F.floor((low + high) / 2).cast("int")
            before = F.get("_cuts", middle) < place
            narrowed = F.struct(
                F.when(before, middle + 1).otherwise(low).alias("low"), F.when(before, high).otherwise(middle).alias("high")
            )
            return F.when(low < high, narrowed).otherwise(found)

        whole = F.struct(F.lit(0).alias("low"), F.size("_cuts").alias("high"))
        found = F.aggregate(F.sequence(F.lit(1), F.lit(_SEARCH_STEPS)), whole, halve)["low"]
        at = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(found).cast("long")
        self.rows = join_null_safe(df, cuts, self.keys).withColumn("_slice", at).select(*df.columns, "_slice")

    def of_hot_keys(self, df: DataFrame) -> DataFrame | None:
        """Only the rows of hot keys, None if there are none."""
        return None if self.hot is None else join_null_safe(df, self.hot, self.keys, "left_semi")

    def window(self) -> Window:
        return Window.partitionBy(*self.keys, "_slice").orderBy(*self.order)

    def carried(self, per_slice: DataFrame, value: str, backwards: bool = False) -> DataFrame:
        """From one row per (hot key, slice), the nearest non-null value of an earlier slice
        (of a later one if ``backwards``) as ``_carry``."""
        w = Window.partitionBy(*self.keys).orderBy("_slice")
        if backwards:
            near = F.first(value, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
        else:
            near = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        return per_slice.select(*self.keys, "_slice", near.alias("_carry"))

    def attach(self, df: DataFrame, carry: DataFrame) -> DataFrame:
        """Left join of the carried values."""
        return join_null_safe(df, carry, [*self.keys, "_slice"])


def with_previous(sliced: Sliced, df: DataFrame, cols: Sequence[str], into: str = "_prev") -> DataFrame:
    """Struct of ``cols`` of the preceding row of the key; null on the first row."""
    packed = F.struct(*cols)
    out = df.withColumn(into, F.lag(packed).over(sliced.window()))
    hot = sliced.of_hot_keys(df)
    if hot is None:
        return out
    tails = hot.groupBy(*sliced.keys, "_slice").agg(F.max_by(packed, F.struct(*sliced.order)).alias("_tail"))
    out = sliced.attach(out, sliced.carried(tails, "_tail"))
    return out.withColumn(into, F.coalesce(F.col(into), F.col("_carry"))).drop("_carry")


def with_next(sliced: Sliced, df: DataFrame, col: str, into: str) -> DataFrame:
    """Value of ``col`` on the following row of the key; null on the last row.

    ``col`` must not hold nulls."""
    out = df.withColumn(into, F.lead(col).over(sliced.window()))
    hot = sliced.of_hot_keys(df)
    if hot is None:
        return out
    heads = hot.groupBy(*sliced.keys, "_slice").agg(F.min_by(col, F.struct(*sliced.order)).alias("_head"))
    out = sliced.attach(out, sliced.carried(heads, "_head", backwards=True))
    return out.withColumn(into, F.coalesce(F.col(into), F.col("_carry"))).drop("_carry")
