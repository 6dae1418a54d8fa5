"""Intermediate tables written once in the shared folder, so that later steps do not repeat the work
and a lost executor costs only its own tasks. What was shuffled for a table is removed once it is written."""

from __future__ import annotations

from pyspark.sql import DataFrame

from portloom.session import stored


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Writes the frame as Parquet in the shared folder and returns the table."""
    return stored(df, name, compression)
