"""Declared scans, schema contracts and as-is bronze landing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portloom.sources.jdbc import jdbc_reader
from portloom.sources.spec import SourceSpec


class ContractViolation(RuntimeError):
    """The source lacks a column its declaration expects."""


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    if spec.format == "jdbc":
        return jdbc_reader(spark, spec).load()
    return spark.read.format(spec.format).options(**spec.options).load(spec.location)


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    actual = {c.lower() for c in df.columns}
    return sorted(c for c in expected if c.lower() not in actual)


def enforce_contract(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Fails before any row is read when an expected column is absent; extra columns are allowed."""
    missing = missing_columns(df, expected)
    if missing:
        raise ContractViolation(f"expected columns not in the source: {missing}")
    return df


def check_contract(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """(column_name, status, n_rows, n_null) per declared or found column.

    ``missing`` breaks the contract; ``unexpected`` is drift worth a look. One aggregate over the
    table fills all counts.
    """
    actual = {c.lower(): c for c in df.columns}
    declared = [c.lower() for c in expected]
    rows = []
    for name in [*declared, *(c for c in actual if c not in declared)]:
        present = name in actual
        status = "missing" if not present else "present" if name in declared else "unexpected"
        nulls = F.count(F.when(F.col(actual[name]).isNull(), 1)) if present else F.lit(None).cast("long")
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(status).alias("status"),
                F.count(F.lit(1)).alias("n_rows"),
                nulls.alias("n_null"),
            )
        )
    return df.agg(F.array(*rows).alias("_e")).select(F.inline("_e"))


def snapshot_scan(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Contract check, then the declared columns and filter, both pushed into the source."""
    df = enforce_contract(read_source(spark, spec), spec.expected_columns)
    df = df.where(spec.filter) if spec.filter else df
    return df.select(*spec.columns)


def to_bronze(df: DataFrame, cols: Sequence[str] | None = None, loaded_at: Column | None = None) -> DataFrame:
    """Every column as text, values untouched, plus the load time."""
    texts = [F.col(c).cast(T.StringType()).alias(c) for c in (cols or df.columns)]
    return df.select(*texts, (F.current_timestamp() if loaded_at is None else loaded_at).alias("loaded_at"))


def load_seed(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Curated CSV reference table; the types are declared, never inferred."""
    return spark.read.schema(schema).option("enforceSchema", "false").csv(path, header=True, mode="FAILFAST")
