"""Time parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_time(c: Column | str) -> Column:
    """ISO-8601 local text (``2024-03-01T00:00``) -> TIMESTAMP_NTZ.

    ``try_cast`` gives NULL for unparseable text instead of failing the job under
    ANSI mode, and NTZ keeps wall-clock labels such as a DST-gap hour intact.
    """
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("timestamp_ntz")


def with_calendar(df: DataFrame, time_col: str = "Time") -> DataFrame:
    """Add Hour, Date, Year, Month derived from ``time_col``."""
    t = F.col(time_col)
    return df.withColumns(
        {
            "Hour": F.hour(t),
            "Date": F.to_date(t),
            "Year": F.year(t),
            "Month": F.month(t),
        }
    )


def date_text(c: Column | str) -> Column:
    """Date part of an ISO time text: everything before ``T``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.split(c, "T", 2).getItem(0)


def iso_date(c: Column | str) -> Column:
    """Format a date or timestamp as ``yyyy-MM-dd``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd")


def days_before(end: Column | str, days: int) -> Column:
    """``end`` minus ``days`` days."""
    end = F.col(end) if isinstance(end, str) else end
    return F.date_sub(end, days)
