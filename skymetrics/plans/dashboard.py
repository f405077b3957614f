"""The whole station dashboard from one scan.

The reference computes ten result tables with ten actions and scans its input
eleven times.  Here one ``GROUPING SETS`` aggregation over the observations
produces three grains in a single scan and a single shuffle:

* (Station, Date)          -> daily tables, and months rolled up from days
* (Station, Hour)          -> hour-of-day profiles
* (Station, WindDirection) -> wind table and wind rose

Every measure is kept as mergeable parts (exact DECIMAL sums, counts,
minima, maxima), so the monthly tables are exact roll-ups of the daily rows:
rainy days become "days whose rain-hour count is positive" without a second
distinct aggregation over raw rows.  The aggregate is small (stations x days)
and is written once to the cluster's checkpoint folder, so every table is
read from it and a lost executor costs a re-read, not a re-scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import exact_parts, mean_of, merged, total_of
from ..operators.daily import direction_of, wind_vector
from ..sources.sinks import persist_table

STAT_MEASURES = ("Temperature", "Humidity", "Pressure")
GRAINS = {"day": "Date", "hour": "Hour", "direction": "WindDirection"}


def _parts() -> list[Column]:
    cols: list[Column] = [F.count(F.lit(1)).alias("Rows")]
    for m in STAT_MEASURES + ("Precipitation", "WindSpeed"):
        cols += [exact_parts(m).alias(f"{m}_s"), F.count(m).alias(f"{m}_n")]
    for m in STAT_MEASURES:
        cols += [F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max")]
    east, north = wind_vector()  # rows without a speed or a direction have no components
    both = F.col("WindDirection").isNotNull() & F.col("WindSpeed").isNotNull()
    cols += [
        F.count_if(F.col("Precipitation") > 0).alias("RainHours"),
        F.max("WindSpeed").alias("WindSpeed_max"),
        F.max("WeatherCode").alias("WeatherCode_max"),
        east.alias("East"),
        north.alias("North"),
        F.count_if(both).alias("Vectors"),
    ]
    return cols


def aggregate(obs: DataFrame, by: Sequence[str] = ("Station",)) -> DataFrame:
    """One-pass multi-grain aggregate; ``Grain`` names the slice of each row."""
    by = list(by)
    sets = [[*by, GRAINS["day"]], [*by, GRAINS["hour"]], [*by, GRAINS["direction"]]]
    g = obs.groupingSets(sets, *by, "Date", "Hour", "WindDirection").agg(*_parts(), F.grouping_id().alias("gid"))
    # grouping_id bit order follows the column list: Date, Hour, WindDirection last
    grain = (
        F.when(F.col("gid") == 3, F.lit("day"))
        .when(F.col("gid") == 5, F.lit("hour"))
        .when(F.col("gid") == 6, F.lit("direction"))
    )
    return g.withColumn("Grain", grain).drop("gid")


def materialize(df: DataFrame) -> DataFrame:
    """Write the small aggregate to the shared checkpoint folder and read it back."""
    return persist_table(df, "dashboard")


# ----------------------------------------------------------------- roll-ups


def _mean(m: str, s: str | None = None, n: str | None = None) -> Column:
    return mean_of(s or f"{m}_s", n or f"{m}_n")


def _sum_parts(m: str) -> list[Column]:
    return [merged(f"{m}_s").alias(f"{m}_s"), F.sum(f"{m}_n").alias(f"{m}_n")]


def _mmm(m: str) -> list[Column]:
    return [_mean(m).alias(f"Avg{m}"), F.col(f"{m}_min").alias(f"Min{m}"), F.col(f"{m}_max").alias(f"Max{m}")]


def _total(m: str) -> Column:
    return total_of(f"{m}_s")


def slice_of(agg: DataFrame, grain: str) -> DataFrame:
    return agg.filter(F.col("Grain") == grain)


def monthly_parts(agg: DataFrame, by: Sequence[str] = ("Station",)) -> DataFrame:
    days = slice_of(agg, "day").filter(F.col("Date").isNotNull())
    parts: list[Column] = []
    for m in STAT_MEASURES + ("Precipitation", "WindSpeed"):
        parts += _sum_parts(m)
    for m in STAT_MEASURES:
        parts += [F.min(f"{m}_min").alias(f"{m}_min"), F.max(f"{m}_max").alias(f"{m}_max")]
    parts += [F.count_if(F.col("RainHours") > 0).alias("RainyDays"), F.sum("RainHours").alias("RainHours")]
    return days.groupBy(*by, F.year("Date").alias("Year"), F.month("Date").alias("Month")).agg(*parts)


def monthly_summary(agg: DataFrame, by: Sequence[str] = ("Station",)) -> DataFrame:
    m = monthly_parts(agg, by)
    return m.select(*by, "Year", "Month", *_mmm("Temperature"), *_mmm("Humidity"),
                    _total("Precipitation").alias("TotalPrecipitation"), *_mmm("Pressure"))


def monthly_temperature(agg, by=("Station",)):
    return monthly_parts(agg, by).select(*by, "Year", "Month", *_mmm("Temperature"))


def monthly_pressure(agg, by=("Station",)):
    return monthly_parts(agg, by).select(*by, "Year", "Month", *_mmm("Pressure"))


def monthly_precipitation(agg, by=("Station",)):
    return monthly_parts(agg, by).select(*by, "Year", "Month", _total("Precipitation").alias("TotalPrecipitation"), "RainyDays")


def monthly_precip_series(agg, by=("Station",)):
    return monthly_parts(agg, by).select(*by, "Year", "Month", _total("Precipitation").alias("Precipitation"))


def monthly_summary_narrow(agg, by=("Station",)):
    m = monthly_parts(agg, by)
    return m.select(*by, "Year", "Month", _mean("Temperature").alias("AvgTemperature"),
                    _mean("Humidity").alias("AvgHumidity"), _total("Precipitation").alias("TotalPrecipitation"),
                    _mean("Pressure").alias("AvgPressure"))


def hourly_profile(agg, measure: str, by=("Station",)):
    return slice_of(agg, "hour").filter(F.col("Hour").isNotNull()).select(*by, "Hour", *_mmm(measure))


def wind_by_direction(agg, by=("Station",)):
    w = slice_of(agg, "direction").filter(F.col("WindDirection").isNotNull())
    return w.select(*by, "WindDirection", _mean("WindSpeed").alias("AvgWindSpeed"), F.col("Rows").alias("Count"))


def wind_rose(agg, by=("Station",)):
    w = slice_of(agg, "direction").filter(F.col("WindDirection").isNotNull())
    return w.select(*by, "WindDirection", F.col("Rows").alias("Count"))


def daily_summary(agg, by=("Station",)):
    d = slice_of(agg, "day").filter(F.col("Date").isNotNull())
    return d.select(
        *by, "Date", F.col("Temperature_max").alias("MaxTemperature"), _mean("Temperature").alias("AvgTemperature"),
        F.col("Temperature_min").alias("MinTemperature"), _total("Precipitation").alias("TotalPrecipitation"),
        F.col("RainHours").alias("PrecipitationHours"), F.col("WindSpeed_max").alias("MaxWindSpeed"),
    )


def daily_precipitation(agg, by=("Station",)):
    d = slice_of(agg, "day").filter(F.col("Date").isNotNull())
    return d.select(*by, "Date", _total("Precipitation").alias("Precipitation"))


def daily_wind_direction(agg, by=("Station",)):
    d = slice_of(agg, "day").filter(F.col("Date").isNotNull() & (F.col("Vectors") > 0))
    return d.select(*by, "Date", direction_of(F.col("East"), F.col("North")).alias("DominantWindDirection"))


def daily_weather_code(agg, by=("Station",)):
    d = slice_of(agg, "day").filter(F.col("Date").isNotNull())
    return d.select(*by, "Date", F.col("WeatherCode_max").alias("WeatherCode"))


def daily_tables(agg: DataFrame, by: Sequence[str] = ("Station",)) -> dict[str, DataFrame]:
    """The service's daily series (A10, D2, D3), from the same aggregate."""
    return {
        "daily_precipitation": daily_precipitation(agg, by),
        "daily_weather_code": daily_weather_code(agg, by),
        "daily_wind_direction": daily_wind_direction(agg, by),
    }


def tables(agg: DataFrame, by: Sequence[str] = ("Station",)) -> dict[str, DataFrame]:
    """Every dashboard table, all read from the one aggregate."""
    return {
        "monthly_temperature": monthly_temperature(agg, by),
        "monthly_precipitation": monthly_precipitation(agg, by),
        "monthly_pressure": monthly_pressure(agg, by),
        "wind_by_direction": wind_by_direction(agg, by),
        "hourly_temperature": hourly_profile(agg, "Temperature", by),
        "hourly_humidity": hourly_profile(agg, "Humidity", by),
        "hourly_pressure": hourly_profile(agg, "Pressure", by),
        "monthly_precip_series": monthly_precip_series(agg, by),
        "wind_rose": wind_rose(agg, by),
        "monthly_summary_narrow": monthly_summary_narrow(agg, by),
        "monthly_summary": monthly_summary(agg, by),
        "daily_summary": daily_summary(agg, by),
    }


def run_all(spark: SparkSession, sf_dir: str) -> dict[str, list]:
    """Compute the aggregate once, write it, and collect every table."""
    from .catalog import obs

    agg = materialize(aggregate(obs(spark, sf_dir)))
    return {name: df.collect() for name, df in tables(agg).items()}


# ----------------------------------------------------------------- one month, one station


def kpis_from_days(agg: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A14/A15 of everything in the aggregate, rolled up from its day slice."""
    days = slice_of(agg, "day").filter(F.col("Date").isNotNull())
    parts = []
    for m in STAT_MEASURES + ("Precipitation", "WindSpeed"):
        parts += _sum_parts(m)
    for m in STAT_MEASURES:
        parts += [F.min(f"{m}_min").alias(f"{m}_min"), F.max(f"{m}_max").alias(f"{m}_max")]
    parts.append(F.sum("RainHours").alias("RainHours"))
    rolled = days.groupBy(*by).agg(*parts) if by else days.agg(*parts)
    return rolled.select(
        *by,
        _mean("Temperature").alias("AvgTemperature"), F.col("Temperature_max").alias("MaxTemperature"),
        F.col("Temperature_min").alias("MinTemperature"),
        _mean("Humidity").alias("AvgHumidity"), F.col("Humidity_max").alias("MaxHumidity"),
        F.col("Humidity_min").alias("MinHumidity"),
        _total("Precipitation").alias("TotalPrecipitation"),
        F.coalesce(F.col("RainHours"), F.lit(0)).alias("RainyHours"),
        _mean("WindSpeed").alias("AvgWindSpeed"),
        _mean("Pressure").alias("AvgPressure"), F.col("Pressure_max").alias("MaxPressure"),
        F.col("Pressure_min").alias("MinPressure"),
    )


MONTH_VIEW_TABLES = ("hourly_temperature", "hourly_humidity", "daily_precipitation", "wind_rose", "kpis")


def month_view(obs: DataFrame, year: int, month: int, station: str | None = None,
               tables: Sequence[str] = MONTH_VIEW_TABLES) -> dict[str, DataFrame]:
    """The interactive month view: hourly temperature and humidity, daily
    precipitation, wind rose and KPIs of one (station, month).

    The period filter reaches the scan (pushed ``Time`` range, pruned
    ``Station`` partition); one grouping-sets aggregate feeds every table.
    """
    from ..operators.prepare import for_period

    agg = aggregate(for_period(obs, year, month, station), by=())
    build = {
        "hourly_temperature": lambda: hourly_profile(agg, "Temperature", by=()),
        "hourly_humidity": lambda: hourly_profile(agg, "Humidity", by=()),
        "daily_precipitation": lambda: daily_precipitation(agg, by=()),
        "wind_rose": lambda: wind_rose(agg, by=()),
        "kpis": lambda: kpis_from_days(agg),
    }
    return {name: build[name]() for name in tables}
