"""Daily aggregations of hourly rows, as the service documents them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import binary_sum, exact_mean, total
from .aggregates import Keys, rainy


def daily_summary(obs: DataFrame, by: Keys = ("Station",), ordered: bool = True) -> DataFrame:
    """MaxTemperature, AvgTemperature, MinTemperature, TotalPrecipitation,
    PrecipitationHours (hours with rain) and MaxWindSpeed per day."""
    keys = [*by, "Date"]
    out = obs.groupBy(*keys).agg(
        F.max("Temperature").alias("MaxTemperature"),
        exact_mean("Temperature").alias("AvgTemperature"),
        F.min("Temperature").alias("MinTemperature"),
        total("Precipitation").alias("TotalPrecipitation"),
        F.count_if(rainy()).alias("PrecipitationHours"),
        F.max("WindSpeed").alias("MaxWindSpeed"),
    )
    return out.orderBy(*keys) if ordered else out


def daily_weather_code(obs: DataFrame, by: Keys = ("Station",), ordered: bool = True) -> DataFrame:
    """The day's most severe condition, taken as the highest WMO code."""
    keys = [*by, "Date"]
    out = obs.groupBy(*keys).agg(F.max("WeatherCode").alias("WeatherCode"))
    return out.orderBy(*keys) if ordered else out


def wind_vector(speed: str = "WindSpeed", direction: str = "WindDirection") -> tuple[Column, Column]:
    """Summed (east, north) components in one exact unit, so neither the order of rows nor their number blurs them."""
    rad = F.radians(F.col(direction))
    return binary_sum(F.col(speed) * F.sin(rad)), binary_sum(F.col(speed) * F.cos(rad))


def direction_of(east: Column, north: Column) -> Column:
    """Direction of a summed vector in [0, 360), 3 decimals; 0 for one without length."""
    degrees = F.round(F.degrees(F.atan2(east.cast("double"), north.cast("double"))), 3)  # before the turn, so that 360 is none
    return F.round(F.pmod(degrees, F.lit(360.0)), 3)


def dominant_direction(speed: str = "WindSpeed", direction: str = "WindDirection") -> Column:
    """Speed-weighted vector mean of the direction, in [0, 360), 3 decimals."""
    return direction_of(*wind_vector(speed, direction))


def daily_wind_direction(obs: DataFrame, by: Keys = ("Station",), ordered: bool = True) -> DataFrame:
    """D3: DominantWindDirection per day (rows with a speed and a direction)."""
    keys = [*by, "Date"]
    out = (
        obs.filter(F.col("WindDirection").isNotNull() & F.col("WindSpeed").isNotNull())
        .groupBy(*keys)
        .agg(dominant_direction().alias("DominantWindDirection"))
    )
    return out.orderBy(*keys) if ordered else out
