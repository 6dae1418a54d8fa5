"""One row per key by a total order. Spark keeps the best row per map task before the shuffle
(WindowGroupLimit), so a hot key costs at most one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """First row of each key; give an order without ties."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def precedence_dedup(df: DataFrame, key: str, priority: str, tiebreak: Sequence[str]) -> DataFrame:
    """Of rows sharing ``key`` the one with the lowest priority stays; nulls sort last."""
    order = [F.col(priority).asc_nulls_last(), *(F.col(c).asc_nulls_last() for c in tiebreak)]
    return pick_first(df, [key], order)


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    modified: str,
    version: str | None = None,
    tiebreak: Sequence[str] = (),
    null_modified_wins: bool = False,
) -> DataFrame:
    """Newest version per business key: latest ``modified``, then highest ``version``.

    A textual version is compared as a number; text that is none sorts last.
    """
    m = F.col(modified)
    order = [m.desc_nulls_first() if null_modified_wins else m.desc_nulls_last()]
    if version:
        order.append(F.col(version).try_cast("int").desc_nulls_last())
    order += [F.col(c).desc_nulls_last() for c in tiebreak]
    return pick_first(df, keys, order)


def representative(
    df: DataFrame, keys: Sequence[str], value: str, into: str | None = None, count_as: str = "n_rows"
) -> DataFrame:
    """Most frequent value per group, the smallest one on equal counts. Nulls are not counted."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias(count_as))
    best = pick_first(counts, keys, [F.col(count_as).desc(), F.col(value).asc()])
    return best.withColumnRenamed(value, into or value)
