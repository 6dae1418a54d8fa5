"""Row filters, conforming, melting and uniting of versions and sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portloom.operators.pick import pick_first


def valid_rows(
    df: DataFrame,
    not_null: Sequence[str],
    not_empty: Sequence[str] = (),
    implications: Sequence[tuple[Column, Column]] = (),
) -> DataFrame:
    """Rows with every listed column filled and every (if, then) pair held."""
    conds = [F.col(c).isNotNull() for c in not_null]
    conds += [F.col(c) != "" for c in not_empty]
    conds += [~given | then for given, then in implications]
    return df.where(reduce(and_, conds))


def encode(col: Column | str, mapping: Mapping[str, object], default: object = None) -> Column:
    """Enum encoding as a CASE over the mapping."""
    c = F.col(col) if isinstance(col, str) else col
    items = iter(mapping.items())
    key, value = next(items)
    out = F.when(c == key, F.lit(value))
    for key, value in items:
        out = out.when(c == key, F.lit(value))
    return out.otherwise(F.lit(default))


def conform(
    df: DataFrame,
    renames: Mapping[str, str],
    casts: Mapping[str, str] | None = None,
    enums: Mapping[str, Mapping[str, object]] | None = None,
    flags: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Source columns renamed to the domain standard, cast, enum-encoded and flagged.

    ``casts``, ``enums`` and ``flags`` use the new names; only renamed columns and flags remain.
    """
    out = df.select(*(F.col(old).alias(new) for old, new in renames.items()))
    changed = {c: F.col(c).cast(t) for c, t in (casts or {}).items()}
    changed |= {c: encode(c, m) for c, m in (enums or {}).items()}
    flagged = out.withColumns(flags) if flags else out
    return flagged.withColumns(changed) if changed else flagged


def soft_delete_flag(df: DataFrame, col: str = "deleted_at", into: str = "is_deleted") -> DataFrame:
    return df.withColumn(into, F.col(col).isNotNull())


def melt(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str, val: str, drop_null: bool = True
) -> DataFrame:
    """Measure columns unfolded to rows; zeros stay, nulls go unless asked for."""
    out = df.unpivot(list(ids), list(values), var, val)
    return out.where(F.col(val).isNotNull()) if drop_null else out


def union_sources(sources: Mapping[str, DataFrame], tag: str = "source_tag") -> DataFrame:
    """The same logical table from several databases, tagged; a column one lacks is null there."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def unify_versions(
    versions: Mapping[str, DataFrame], maps: Mapping[str, Mapping[str, Column | str]], tag: str = "schema_version"
) -> DataFrame:
    """Schema versions of one event brought to one layout by ``{version: {target: source}}``."""

    def mapped(name: str) -> DataFrame:
        exprs = ((F.col(s) if isinstance(s, str) else s).alias(t) for t, s in maps[name].items())
        return versions[name].select(*exprs)

    return union_sources({name: mapped(name) for name in versions}, tag)


def canonical_merge(
    sources: Mapping[str, DataFrame],
    keys: Sequence[str],
    fill: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    provenance: str = "source_name",
) -> DataFrame:
    """One row per key from several lists; an earlier source wins and is named as provenance.

    Columns in ``fill`` take the first non-null value in source order instead of the winner's.
    """
    ranks = {name: i for i, name in enumerate(sources)}
    tagged = union_sources(sources, provenance).withColumn("_rank", encode(provenance, ranks))
    order = [F.col("_rank"), *(F.col(c).asc_nulls_last() for c in tiebreak)]
    if not fill:
        return pick_first(tagged, keys, order).drop("_rank")
    place = F.struct("_rank", *(x for c in tiebreak for x in (F.col(c).isNull(), F.col(c))))
    rest = [c for c in tagged.columns if c not in (*keys, *fill, "_rank")]
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in fill]
    # winner and filled values come from one aggregate, so every source is read once
    one = tagged.groupBy(*keys).agg(F.min_by(F.struct(*rest), place).alias("_winner"), *firsts)
    return one.select(*(F.col(f"_winner.{c}").alias(c) if c in rest else F.col(c) for c in tagged.columns if c != "_rank"))
