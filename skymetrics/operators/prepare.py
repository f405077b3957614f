"""Null policies, filters and unions.

Period and range filters are written on the raw ``Time`` column so they reach
the scan as pushed filters (parquet row-group skipping) and prune ``Date``
partitions of a partitioned landing layout.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CONTINUOUS

ZERO_FILLED = CONTINUOUS + ("WeatherCode",)


def fill_zero(obs: DataFrame, subset: Sequence[str] = ZERO_FILLED) -> DataFrame:
    """The processors' policy - missing measures become 0.

    This biases means and minima (a missing pressure reads as 0 hPa) and turns
    a missing wind direction into north; the default policy keeps NULLs.
    """
    return obs.fillna(0, subset=list(subset))


def fill_zero_all(df: DataFrame) -> DataFrame:
    """Every numeric NULL becomes 0."""
    return df.fillna(0)


def apply_null_policy(obs: DataFrame, fill_zero_measures: bool = False) -> DataFrame:
    return fill_zero(obs) if fill_zero_measures else obs


def rainy_rows(obs: DataFrame) -> DataFrame:
    """rows with precipitation above zero."""
    return obs.filter(F.col("Precipitation") > 0)


def _ts(d: dt.date) -> F.Column:
    return F.lit(dt.datetime(d.year, d.month, d.day)).cast("timestamp_ntz")


def for_period(obs: DataFrame, year: int, month: int, station: str | None = None) -> DataFrame:
    """F2 (+F3): the rows of one calendar month, optionally one station."""
    start = dt.date(year, month, 1)
    end = dt.date(year + (month == 12), month % 12 + 1, 1)
    cond = (F.col("Time") >= _ts(start)) & (F.col("Time") < _ts(end))
    if station is not None:
        cond = cond & (F.col("Station") == station)
    return obs.filter(cond)


def for_station(obs: DataFrame, station: str) -> DataFrame:
    """one station (a partition filter on a Station-partitioned layout)."""
    return obs.filter(F.col("Station") == station)


def trailing_range(obs: DataFrame, end: dt.date, days: int = 3650) -> DataFrame:
    """rows dated within ``days`` days up to and including ``end``
    (the downloader's ten-year window, with an explicit end date)."""
    start = end - dt.timedelta(days=days)
    stop = end + dt.timedelta(days=1)
    return obs.filter((F.col("Time") >= _ts(start)) & (F.col("Time") < _ts(stop)))


def union_positional(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by position (Catalyst flattens the chain into one Union)."""
    return reduce(DataFrame.union, frames)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union aligned by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
