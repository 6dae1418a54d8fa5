"""Database extract and staging sink over JDBC, read in parallel by a range of one column."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from portloom.sources.spec import FETCH_SIZE, SourceSpec


def _query(spec: SourceSpec) -> str:
    where = f" WHERE {spec.filter}" if spec.filter else ""
    return f"(SELECT {', '.join(spec.columns)} FROM {spec.location}{where}) src"


def extract_options(
    spec: SourceSpec,
    partition_col: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. With a partition column the table is read by ``partitions`` range queries;
    the bounds only place the cuts, rows outside them are read by the first and last query."""
    options = {"fetchsize": str(FETCH_SIZE), "dbtable": _query(spec), **spec.options}
    split = (partition_col, lower, upper, partitions)
    if all(v is None for v in split):
        return options
    if any(v is None for v in split):
        raise ValueError("partition_col, lower, upper and partitions go together")
    if partition_col not in spec.columns:
        raise ValueError(f"{partition_col} is not among the extracted columns")
    return options | {
        "partitionColumn": partition_col,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def reader_options(spec: SourceSpec) -> dict[str, str]:
    """Options for the whole table; Spark pushes columns and filters down into every range query."""
    options = {"fetchsize": str(FETCH_SIZE), "dbtable": spec.location, **spec.options}
    if spec.split is None:
        return options
    s = spec.split
    return options | {
        "partitionColumn": s.column,
        "lowerBound": str(s.lower),
        "upperBound": str(s.upper),
        "numPartitions": str(s.partitions),
    }


def jdbc_reader(spark: SparkSession, spec: SourceSpec) -> DataFrameReader:
    """Reader used by contract checks, scans and loaders; with ``spec.split`` it reads in parallel."""
    return spark.read.format("jdbc").options(**reader_options(spec))


def jdbc_extract(
    spark: SparkSession,
    spec: SourceSpec,
    partition_col: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
) -> DataFrame:
    options = extract_options(spec, partition_col, lower, upper, partitions)
    return spark.read.format("jdbc").options(**options).load()


def balanced_bounds(keys: DataFrame, column: str, partitions: int, accuracy: int = 10_000) -> list[object]:
    """Values of a numeric or time column that cut ``keys``, a table or a sample of it, into
    ``partitions`` ranges of about equal row counts; fewer where one value holds several shares.

    The quantiles are sketched in one pass; only the bounds reach the driver."""
    shares = [i / partitions for i in range(1, partitions)]
    if not shares:
        return []
    found = keys.agg(F.percentile_approx(column, shares, accuracy).alias("b")).first().b
    return sorted(set(found or []))


def _literal(value: object) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, date):
        return f"DATE '{value:%Y-%m-%d}'"
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    raise ValueError(f"{value!r} cannot bound a range")


def range_predicates(column: str, bounds: Sequence[object]) -> list[str]:
    """SQL conditions of the ranges that the bounds cut; every row meets one of them, a null the first."""
    if not bounds:
        return ["1 = 1"]
    texts = [_literal(b) for b in bounds]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(texts, texts[1:], strict=False)]
    return [f"{column} < {texts[0]} OR {column} IS NULL", *between, f"{column} >= {texts[-1]}"]


def jdbc_balanced(spark: SparkSession, spec: SourceSpec, predicates: Sequence[str]) -> DataFrame:
    """The declared columns and rows, read by one query per condition."""
    options = extract_options(spec)
    table, url = options.pop("dbtable"), options.pop("url")
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)


def jdbc_writer(df: DataFrame, table: str, options: dict[str, str]) -> DataFrameWriter:
    return df.write.format("jdbc").options(**{"batchsize": str(FETCH_SIZE), **options, "dbtable": table})


def write_jdbc(df: DataFrame, table: str, options: dict[str, str], mode: str = "overwrite") -> None:
    """Staging sink; ``truncate`` keeps the target's own column types and grants on overwrite."""
    jdbc_writer(df, table, {"truncate": "true", **options}).mode(mode).save()
