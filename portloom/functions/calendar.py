"""Fiscal calendar and time zone columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values
FISCAL_BOUNDARY_DAY = 16
SOURCE_ZONE = "UTC"
LOCAL_ZONE = "Asia/Seoul"


def time_literal(value: datetime, kind: T.DataType) -> Column:
    """A point in time as a constant of the column type it is compared with."""
    if isinstance(kind, T.TimestampNTZType):  # as text, so that no zone shifts the wall time
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    return F.lit(value).cast(kind)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fiscal_month_of(c: Column | str, boundary_day: int = FISCAL_BOUNDARY_DAY) -> Column:
    """First calendar day of the month the date counts for: from the boundary day on, the next one."""
    d = F.to_date(_col(c))
    first = F.trunc(d, "MM")
    return F.when(F.dayofmonth(d) >= boundary_day, F.add_months(first, 1)).otherwise(first)


def fiscal_year(c: Column | str, boundary_day: int = FISCAL_BOUNDARY_DAY) -> Column:
    return F.year(fiscal_month_of(c, boundary_day))


def fiscal_month(c: Column | str, boundary_day: int = FISCAL_BOUNDARY_DAY) -> Column:
    return F.month(fiscal_month_of(c, boundary_day))


def fiscal_month_start(c: Column | str, boundary_day: int = FISCAL_BOUNDARY_DAY) -> Column:
    """Day the fiscal month begins: the boundary day of the calendar month before."""
    return F.date_add(F.add_months(fiscal_month_of(c, boundary_day), -1), boundary_day - 1)


def fiscal_week(c: Column | str, boundary_day: int = FISCAL_BOUNDARY_DAY) -> Column:
    """Week inside the fiscal month, counted from 1 in steps of seven days."""
    days = F.date_diff(F.to_date(_col(c)), fiscal_month_start(c, boundary_day))
    return (F.floor(days / 7) + 1).cast("int")


def with_fiscal(df: DataFrame, date_col: str, boundary_day: int = FISCAL_BOUNDARY_DAY) -> DataFrame:
    return df.withColumns(
        {
            "fiscal_year": fiscal_year(date_col, boundary_day),
            "fiscal_month": fiscal_month(date_col, boundary_day),
            "fiscal_week": fiscal_week(date_col, boundary_day),
        }
    )


def local_time(df: DataFrame, col: str, zone: str = LOCAL_ZONE) -> Column:
    """UTC wall time shown in the local zone, whatever the session's zone is."""
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        return F.convert_timezone(F.lit(SOURCE_ZONE), F.lit(zone), F.col(col))
    return F.from_utc_timestamp(F.col(col), zone)


def to_local(df: DataFrame, cols: Sequence[str], zone: str = LOCAL_ZONE) -> DataFrame:
    """Time columns shown in the local zone; the source value is kept as ``db_<column>``."""
    kept = {f"db_{c}": F.col(c) for c in cols}
    return df.withColumns(kept | {c: local_time(df, c, zone) for c in cols})


def updated_or_created(updated: str, created: str) -> Column:
    return F.coalesce(F.col(updated), F.col(created))
