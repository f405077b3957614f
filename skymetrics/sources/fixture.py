"""Projection of the shared synthetic ``events`` table onto observations.

The test tables hold no weather data, so each event becomes one observation
(the column mapping is fixed so that an independent SQL engine can rebuild the
same rows).  The projection is a single narrow ``select`` over the parquet
scan: it adds no shuffle and lets the scan prune to the six columns it reads.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import OBSERVATION
from ..session import checkpoint_dir
from .dimensions import WMO_CODE_LIST, stations

# The fixture's station names (the five event types, sorted).
FIXTURE_STATIONS = ["click", "error", "purchase", "signup", "view"]


# Loaded source plans per live session: a DataFrame is an immutable plan, so
# queries over the same table share one file listing and one analysed
# projection, as a user holding ``obs = load(...)`` would.
_PLANS: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def _memo(spark: SparkSession, key: tuple, build):
    plans = _PLANS.setdefault(spark, {})
    if key not in plans:
        plans[key] = build()
    return plans[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return _memo(spark, ("table", path), lambda: spark.read.parquet(path))


def observations_from_events(events: DataFrame) -> DataFrame:
    """events -> Station, Time, Temperature, Humidity, Precipitation,
    WeatherCode, WindSpeed, WindDirection, Pressure."""
    k = F.get_json_object("props", "$.k").cast("int")
    codes = F.lit(WMO_CODE_LIST)
    eid = F.col("event_id")
    return events.select(
        F.col("event_type").alias("Station"),
        (F.col("ts") + F.make_ym_interval(F.lit(0), (F.col("user_id") % 36).cast("int"))).alias("Time"),
        F.col("value").alias("Temperature"),
        k.cast("double").alias("Humidity"),
        F.when(k >= 70, F.col("value")).otherwise(F.lit(0.0)).alias("Precipitation"),
        F.element_at(codes, (eid % len(WMO_CODE_LIST)).cast("int") + 1).alias("WeatherCode"),
        (k / F.lit(2.0)).alias("WindSpeed"),
        F.when(eid % 89 == 0, F.lit(None).cast("double"))
        .otherwise(((eid * 37) % 361).cast("double")).alias("WindDirection"),
        F.when(eid % 97 == 0, F.lit(None).cast("double"))
        .otherwise((k + 1000).cast("double")).alias("Pressure"),
    )


def observations(spark: SparkSession, sf_dir: str, compact: bool = True) -> DataFrame:
    """Fixture observations.  With ``compact`` (the default) the projection is
    written once per session as a Station-partitioned Parquet table in the
    checkpoint folder, rows ordered by Time inside each file (row groups then
    cover time ranges that pushed Time filters can skip) - the compaction a
    landed table gets - and every query scans that table; otherwise (or when the session names no shared folder)
    the projection is recomputed per query."""
    def build() -> DataFrame:
        obs = observations_from_events(table(spark, sf_dir, "events"))
        if not compact or checkpoint_dir(spark, required=False) is None:
            return obs
        from .sinks import persist_table
        return persist_table(obs, "observations", partition_by=("Station",), schema=OBSERVATION, sort_by=("Time",))
    return _memo(spark, ("observations", sf_dir, compact), build)


def fixture_stations(spark: SparkSession) -> DataFrame:
    """Station dimension for the fixture: the fixture stations take the first
    five island coordinates in order."""
    return stations(spark, names=FIXTURE_STATIONS)
