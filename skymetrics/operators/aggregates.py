"""Monthly, hourly, daily and wind statistics.

All of them are algebraic (sum / count / min / max), so Spark aggregates
partially inside each map task before the shuffle: a hot station costs one
partial row per key per task, not its raw rows.  Rainy days are a set of days
of the month, kept as bits of a number (``functions.masks``): one aggregate and
one exchange, like a sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import masks
from ..functions.stats import exact_mean, mean_min_max, total

Keys = Sequence[str]
MONTH = ("Year", "Month")


def _keys(by: Keys, *more: str) -> list[str]:
    return [*by, *more]


def _finish(df: DataFrame, order: list[Column | str] | None) -> DataFrame:
    return df.orderBy(*order) if order else df


def rainy(c: str = "Precipitation") -> Column:
    """Rain predicate (F1): precipitation strictly above zero."""
    return F.col(c) > 0


def monthly_temperature(obs: DataFrame, by: Keys = ("Station",), ordered: bool = True) -> DataFrame:
    """A1: AvgTemperature, MinTemperature, MaxTemperature per month."""
    keys = _keys(by, *MONTH)
    return _finish(obs.groupBy(*keys).agg(*mean_min_max("Temperature")), keys if ordered else None)


def monthly_pressure(obs: DataFrame, by: Keys = ("Station",), ordered: bool = True) -> DataFrame:
    """A5: AvgPressure, MinPressure, MaxPressure per month."""
    keys = _keys(by, *MONTH)
    return _finish(obs.groupBy(*keys).agg(*mean_min_max("Pressure")), keys if ordered else None)


def monthly_precipitation(obs: DataFrame, by: Keys = ("Station",), ordered: bool = True) -> DataFrame:
    """A3 + A4 in one pass: TotalPrecipitation and RainyDays (distinct dates
    with rain) per month; a month without rain has 0 rainy days."""
    keys = _keys(by, *MONTH)
    out = obs.groupBy(*keys).agg(
        total("Precipitation").alias("TotalPrecipitation"),
        masks.size(masks.days_of_month(F.when(rainy(), F.col("Date")))).cast("long").alias("RainyDays"),
    )
    return _finish(out, keys if ordered else None)


def rainy_dates(obs: DataFrame, by: Keys = ("Station",)) -> DataFrame:
    """A16 + F1: the distinct (keys, Year, Month, Date) that had rain."""
    return obs.filter(rainy()).select(*by, *MONTH, "Date").distinct()


def monthly_precipitation_join(obs: DataFrame, by: Keys = ("Station",), ordered: bool = True) -> DataFrame:
    """J1 form of A3/A4: monthly totals LEFT JOIN per-month rainy-date counts
    on the month keys (USING semantics), unmatched months get 0 (P7).

    Both sides are aggregates of the same rows on the same keys, so the joined
    row is one aggregate of the month: its total, and its set of rainy days, which
    is NULL where the right side has no row.  The input is scanned once.
    """
    keys = _keys(by, *MONTH)
    sides = obs.groupBy(*keys).agg(
        total("Precipitation").alias("TotalPrecipitation"), masks.days_of_month(F.when(rainy(), F.col("Date"))).alias("days"))
    out = sides.select(*keys, "TotalPrecipitation", F.when(F.col("days").isNotNull(), masks.size("days")).cast("long").alias("RainyDays"))
    return _finish(out.fillna(0, subset=["RainyDays"]), keys if ordered else None)


def monthly_precip_series(obs: DataFrame, by: Keys = ("Station",), ordered: bool = True) -> DataFrame:
    """Precipitation (monthly total) per month."""
    keys = _keys(by, *MONTH)
    out = obs.groupBy(*keys).agg(total("Precipitation").alias("Precipitation"))
    return _finish(out, keys if ordered else None)


def daily_precipitation(obs: DataFrame, by: Keys = ("Station",), ordered: bool = True) -> DataFrame:
    """A10: Precipitation (daily total) per Date."""
    keys = _keys(by, "Date")
    out = obs.groupBy(*keys).agg(total("Precipitation").alias("Precipitation"))
    return _finish(out, keys if ordered else None)


def wind_by_direction(obs: DataFrame, by: Keys = ("Station",), ordered: bool = True) -> DataFrame:
    """A2: AvgWindSpeed and Count (rows) per exact WindDirection.

    Rows without a direction are left out rather than counted as north.
    Ordered by Count descending with the direction as tie-break (O2).
    """
    keys = _keys(by, "WindDirection")
    out = (
        obs.filter(F.col("WindDirection").isNotNull())
        .groupBy(*keys)
        .agg(exact_mean("WindSpeed").alias("AvgWindSpeed"), F.count(F.lit(1)).alias("Count"))
    )
    return _finish(out, [*by, F.col("Count").desc(), "WindDirection"] if ordered else None)


def wind_rose(obs: DataFrame, by: Keys = ("Station",), ordered: bool = True) -> DataFrame:
    """Count of rows per exact WindDirection (non-null directions)."""
    keys = _keys(by, "WindDirection")
    out = obs.filter(F.col("WindDirection").isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("Count"))
    return _finish(out, keys if ordered else None)


def hourly_profile(obs: DataFrame, measure: str, by: Keys = ("Station",), ordered: bool = True) -> DataFrame:
    """Avg/Min/Max of ``measure`` per hour of day."""
    keys = _keys(by, "Hour")
    return _finish(obs.groupBy(*keys).agg(*mean_min_max(measure)), keys if ordered else None)


def monthly_summary_narrow(obs: DataFrame, by: Keys = ("Station",), ordered: bool = True) -> DataFrame:
    """AvgTemperature, AvgHumidity, TotalPrecipitation, AvgPressure."""
    keys = _keys(by, *MONTH)
    out = obs.groupBy(*keys).agg(
        exact_mean("Temperature").alias("AvgTemperature"),
        exact_mean("Humidity").alias("AvgHumidity"),
        total("Precipitation").alias("TotalPrecipitation"),
        exact_mean("Pressure").alias("AvgPressure"),
    )
    return _finish(out, keys if ordered else None)


SUMMARY_COLUMNS = (
    "AvgTemperature", "MinTemperature", "MaxTemperature",
    "AvgHumidity", "MinHumidity", "MaxHumidity",
    "TotalPrecipitation",
    "AvgPressure", "MinPressure", "MaxPressure",
)


def summary_aggregates() -> list[Column]:
    return [
        *mean_min_max("Temperature"),
        *mean_min_max("Humidity"),
        total("Precipitation").alias("TotalPrecipitation"),
        *mean_min_max("Pressure"),
    ]


def monthly_summary(obs: DataFrame, by: Keys = ("Station",), ordered: bool = True) -> DataFrame:
    """The wide monthly table (mean/min/max of temperature, humidity,
    pressure and the precipitation total) - the saved report's shape."""
    keys = _keys(by, *MONTH)
    return _finish(obs.groupBy(*keys).agg(*summary_aggregates()), keys if ordered else None)


def kpi_aggregates() -> list[Column]:
    """A14 + A15 measures of a period."""
    return [
        exact_mean("Temperature").alias("AvgTemperature"),
        F.max("Temperature").alias("MaxTemperature"),
        F.min("Temperature").alias("MinTemperature"),
        exact_mean("Humidity").alias("AvgHumidity"),
        F.max("Humidity").alias("MaxHumidity"),
        F.min("Humidity").alias("MinHumidity"),
        total("Precipitation").alias("TotalPrecipitation"),
        F.count_if(rainy()).alias("RainyHours"),
        exact_mean("WindSpeed").alias("AvgWindSpeed"),
        exact_mean("Pressure").alias("AvgPressure"),
        F.max("Pressure").alias("MaxPressure"),
        F.min("Pressure").alias("MinPressure"),
    ]


def period_kpis(obs: DataFrame, by: Keys = ()) -> DataFrame:
    """KPIs of whatever rows ``obs`` holds (filter first with
    ``prepare.for_period``); ``by=()`` gives one global row."""
    return obs.groupBy(*by).agg(*kpi_aggregates()) if by else obs.agg(*kpi_aggregates())


def available_periods(obs: DataFrame, by: Keys = ("Station",), ordered: bool = True) -> DataFrame:
    """The distinct (Year, Month) present, sorted."""
    keys = _keys(by, *MONTH)
    out = obs.select(*keys).where(F.col("Year").isNotNull()).distinct()
    return _finish(out, keys if ordered else None)
