"""Fact and dimension building blocks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portloom.operators.pick import latest_version
from portloom.operators.shape import conform


def join_details(
    base: DataFrame, details: Sequence[tuple[DataFrame, Sequence[str]]], coalesced: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Left joins of (detail table, key columns) and one column per ``{name: columns by priority}``.

    Each detail table holds one row per key; the columns merged into a new one are dropped.
    """
    out = base
    for detail, on in details:
        out = out.join(detail, list(on), "left")
    out = out.withColumns({name: F.coalesce(*cols) for name, cols in coalesced.items()})
    spent = {c for name, cols in coalesced.items() for c in cols if c != name}
    return out.drop(*spent)


def with_preagg(
    dim: DataFrame, fact: DataFrame, on: Mapping[str, str], aggs: Sequence[Column], zero: Sequence[str] = ()
) -> DataFrame:
    """Fact aggregated per key first, then left joined to the dimension; ``on`` maps dim to fact.

    Counts listed in ``zero`` are 0 where the dimension has no fact.
    """
    summed = fact.groupBy(*(F.col(f).alias(d) for d, f in on.items())).agg(*aggs)
    out = dim.join(summed, list(on), "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero}) if zero else out


def rollup(df: DataFrame, grain: Mapping[str, Column] | Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Fact mart at a declared grain."""
    keys = [e.alias(n) for n, e in grain.items()] if isinstance(grain, Mapping) else list(grain)
    return df.groupBy(*keys).agg(*(m.alias(n) for n, m in measures.items()))


def enrich(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]], how: str = "left") -> DataFrame:
    """Star joins on unique dimension keys. Spark broadcasts a dimension below its size threshold."""
    for dim, on in dims:
        fact = fact.join(dim, list(on), how)
    return fact


@dataclass(frozen=True)
class MetricSpec:
    """A source, the dimensions it is cut by and named measures (aggregate columns)."""

    source: str
    dims: tuple[str, ...]
    measures: Mapping[str, Column] = field(hash=False)
    where: str | None = None


def evaluate(sources: Mapping[str, DataFrame], spec: MetricSpec) -> DataFrame:
    """All measures of a spec in one grouped pass, as rows (source, dims..., metric, value)."""
    df = sources[spec.source]
    df = df.where(spec.where) if spec.where else df
    wide = df.groupBy(*spec.dims).agg(*(m.cast("double").alias(n) for n, m in spec.measures.items()))
    long = wide.unpivot(list(spec.dims), list(spec.measures), "metric_name", "metric_value")
    return long.select(F.lit(spec.source).alias("source_name"), *spec.dims, "metric_name", "metric_value")


def _one_scan(df: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """(dimensions, metric_name, metric_value) of several specs of one source from a single scan.

    A row stands once for each spec whose condition it meets; the dimensions that a spec does not use
    are null in its copies, and partial aggregates leave each task once per spec and group.
    """
    conditions = [F.expr(s.where) if s.where else F.lit(True) for s in specs]
    own = F.array_compact(F.array(*(F.when(c, F.lit(i)) for i, c in enumerate(conditions))))
    copies = df.withColumn("_spec", F.explode(own))
    dims = sorted({d for s in specs for d in s.dims})
    users = {d: [i for i, s in enumerate(specs) if d in s.dims] for d in dims}
    keys = [F.when(F.col("_spec").isin(users[d]), F.col(d)).alias(f"_dim_{d}") for d in dims]
    measures = {(i, n): m.cast("double").alias(f"_{i}_{n}") for i, s in enumerate(specs) for n, m in s.measures.items()}
    wide = copies.groupBy("_spec", *keys).agg(*measures.values())

    def text(s: MetricSpec) -> Column:
        parts = [F.concat(F.lit(f"{d}="), F.coalesce(F.col(f"_dim_{d}").cast("string"), F.lit("null"))) for d in sorted(s.dims)]
        return F.concat_ws(",", *parts)

    def entries(i: int, s: MetricSpec) -> Column:
        return F.array(
            *(F.struct(F.lit(n).alias("metric_name"), F.col(f"_{i}_{n}").alias("metric_value")) for n in s.measures)
        )

    dimensions, found = F.lit(None).cast("string"), None
    for i, s in enumerate(specs):
        mine = F.col("_spec") == i
        dimensions = F.when(mine, text(s)).otherwise(dimensions)
        found = F.when(mine, entries(i, s)) if found is None else found.when(mine, entries(i, s))
    return wide.select(dimensions.alias("dimensions"), F.inline(found))


def metric_rows(sources: Mapping[str, DataFrame], specs: Sequence[MetricSpec]) -> DataFrame:
    """Metrics of several specs in one table; the dimensions become sorted ``name=value`` text. Each
    source is scanned once for all its specs that have dimensions."""
    parts = []
    for source in dict.fromkeys(s.source for s in specs):
        mine = [s for s in specs if s.source == source]
        cut = [s for s in mine if s.dims]
        if cut:
            parts.append(_one_scan(sources[source], cut).select(F.lit(source).alias("source_name"), "*"))
        for s in mine:
            if not s.dims:  # a total has a row for an empty source too
                total = evaluate(sources, s)
                parts.append(total.select("source_name", F.lit("").alias("dimensions"), "metric_name", "metric_value"))
    return reduce(DataFrame.unionAll, parts)


def entity_dimension(
    df: DataFrame,
    keys: Sequence[str],
    modified: str,
    renames: Mapping[str, str],
    tiebreak: Sequence[str] = (),
    casts: Mapping[str, str] | None = None,
    enums: Mapping[str, Mapping[str, object]] | None = None,
) -> DataFrame:
    """A dimension of the latest version of each entity, its attributes conformed, without copies."""
    latest = latest_version(df, keys, modified, tiebreak=tiebreak)
    return conform(latest, renames, casts, enums).distinct()
