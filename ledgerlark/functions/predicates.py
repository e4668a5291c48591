"""Column predicates shared by scans and operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def utc_day(at: Column) -> Column:
    """The day of a timestamp in UTC, whatever the session's time zone: tables written under one zone are
    pruned and merged alike under another."""
    return F.to_date(F.to_utc_timestamp(at, F.current_timezone()))


def in_range(column: str, start: str | None = None, end: str | None = None) -> Column:
    """Inclusive timestamp range; either bound may be absent.

    A bare date as ``end`` is that day's midnight, so later rows of the day fall outside.
    """
    condition = F.lit(True)
    if start is not None:
        condition = condition & (F.col(column) >= F.lit(start).cast("timestamp"))
    if end is not None:
        condition = condition & (F.col(column) <= F.lit(end).cast("timestamp"))
    return condition


def filter_range(df: DataFrame, column: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """``in_range`` plus the same bounds on the derived partition column (``day``, ``partition_month`` or
    ``partition_year``) where the table has one, so that only what is asked for is listed and read."""
    out = df.where(in_range(column, start, end))
    for part, grain in (("day", None), ("partition_month", "month"), ("partition_year", "year")):
        if part in df.columns:
            for bound, low in ((start, True), (end, False)):
                if bound is not None:
                    day = utc_day(F.lit(bound).cast("timestamp"))
                    day = day if grain is None else F.trunc(day, grain)
                    out = out.where(F.col(part) >= day if low else F.col(part) <= day)
    return out
