"""Dimension lookups: station attributes (S10) and WMO conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.dimensions import WMO_CODES, dimension_join, wmo_codes
from .aggregates import Keys


def with_station(obs: DataFrame, stations: DataFrame, known_rows: int | None = None) -> DataFrame:
    """Attach Island, Latitude, Longitude, UtcOffsetSeconds to each row."""
    return dimension_join(obs, stations, "Station", "left", known_rows)


def station_overview(obs: DataFrame, stations: DataFrame, known_rows: int | None = None) -> DataFrame:
    """One row per station - its attributes, rows and time span.

    Aggregating before the lookup keeps the join to one row per station.
    """
    per_station = obs.groupBy("Station").agg(
        F.count(F.lit(1)).alias("Rows"),
        F.min("Time").alias("FirstTime"),
        F.max("Time").alias("LastTime"),
    )
    return dimension_join(per_station, stations, "Station", "left", known_rows)


def weather_conditions(obs: DataFrame, by: Keys = ("Station",)) -> DataFrame:
    """Hours per WMO code with its description and category.

    Counts are taken first (partial aggregation per task), so the lookup joins
    a few rows per station to the 28-row code table, which is broadcast.
    """
    counts = obs.groupBy(*by, "WeatherCode").agg(F.count(F.lit(1)).alias("Hours"))
    codes = wmo_codes(obs.sparkSession)
    return dimension_join(counts, codes, "WeatherCode", "left", known_rows=len(WMO_CODES))
