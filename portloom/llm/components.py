"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portloom.llm.staging import staged


def _measure(links: DataFrame) -> tuple:
    mixed = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), mixed).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the smallest of its neighbourhood."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node ties its smaller neighbours and itself to the smallest of them; here ``a > b``."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node, the root being its component's smallest node, itself
    included. ``links`` has two columns of numbers without nulls; self links are ignored.

    Every round is written as a table; rounds end when the links no longer change."""
    a, b = links.columns
    now = staged(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct(),
        "links",
    )
    before, measure = None, _measure(now)
    while measure[0] and measure != before:
        now = staged(_small_star(_large_star(now)), "links")
        before, measure = measure, _measure(now)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
