"""Column helpers for keys, codes and JSON text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_PART = "\u0000"


def code_of(*parts: Column | str) -> Column:
    """Composite code; a plain string is literal text. Null as soon as one part is null."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 over the parts. A null part is written as a mark, so (a, null) and (null, a) differ."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws("||", *(F.coalesce(p.cast("string"), F.lit(NULL_PART)) for p in parts)))


def parse_json(df: DataFrame, col: str, paths: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Adds a typed column per ``name: (json path, type)``; text that does not fit becomes null."""
    return df.withColumns({n: F.get_json_object(col, p).try_cast(t) for n, (p, t) in paths.items()})


def to_messages(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Rows as (key, value) text for a message bus: joined key columns and the row as JSON."""
    key = F.concat_ws("|", *(F.col(c).cast("string") for c in key_cols))
    return df.select(key.alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def send_messages(df: DataFrame, key_cols: Sequence[str], options: Mapping[str, str], fmt: str = "kafka") -> None:
    """Messages written to a bus; broker and topic come with the options, its connector with the cluster."""
    to_messages(df, key_cols).write.format(fmt).options(**options).save()
