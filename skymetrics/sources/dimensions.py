"""Small fixed dimension tables: stations (S10) and WMO weather codes.

Both are built from literals, so their row count is known without running a
job; ``dimension_join`` broadcasts them only while that known size is under a
limit and otherwise leaves the join strategy to the planner (AQE re-plans it
from real shuffle statistics).

The rows are a constant array expanded with ``inline`` inside the JVM (a
one-row range, one task): no Python RDD behind the table, so neither the
broadcast nor a retried task needs a Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The seven island stations and their coordinates.
ISLANDS = [
    ("Tenerife", 28.2916, -16.6291),
    ("Gran Canaria", 27.9545, -15.5920),
    ("Lanzarote", 29.0469, -13.5899),
    ("Fuerteventura", 28.3587, -14.0537),
    ("La Palma", 28.6829, -17.7649),
    ("La Gomera", 28.1026, -17.1110),
    ("El Hierro", 27.7406, -18.0204),
]

# WMO weather interpretation codes (WW) and their descriptions,
# grouped as the service documents them.
WMO_CODES = [
    (0, "Clear sky", "Clear"),
    (1, "Mainly clear", "Cloud"),
    (2, "Partly cloudy", "Cloud"),
    (3, "Overcast", "Cloud"),
    (45, "Fog", "Fog"),
    (48, "Depositing rime fog", "Fog"),
    (51, "Drizzle: light", "Drizzle"),
    (53, "Drizzle: moderate", "Drizzle"),
    (55, "Drizzle: dense", "Drizzle"),
    (56, "Freezing drizzle: light", "Freezing drizzle"),
    (57, "Freezing drizzle: dense", "Freezing drizzle"),
    (61, "Rain: slight", "Rain"),
    (63, "Rain: moderate", "Rain"),
    (65, "Rain: heavy", "Rain"),
    (66, "Freezing rain: light", "Freezing rain"),
    (67, "Freezing rain: heavy", "Freezing rain"),
    (71, "Snow fall: slight", "Snow"),
    (73, "Snow fall: moderate", "Snow"),
    (75, "Snow fall: heavy", "Snow"),
    (77, "Snow grains", "Snow"),
    (80, "Rain showers: slight", "Rain showers"),
    (81, "Rain showers: moderate", "Rain showers"),
    (82, "Rain showers: violent", "Rain showers"),
    (85, "Snow showers: slight", "Snow showers"),
    (86, "Snow showers: heavy", "Snow showers"),
    (95, "Thunderstorm: slight or moderate", "Thunderstorm"),
    (96, "Thunderstorm with slight hail", "Thunderstorm"),
    (99, "Thunderstorm with heavy hail", "Thunderstorm"),
]

WMO_CODE_LIST = [c for c, _, _ in WMO_CODES]

# Rows a dimension may have and still be broadcast to every executor.
BROADCAST_ROW_LIMIT = 100_000


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A small table of constant rows, evaluated in the JVM."""
    st = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, st.fields)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


STATION_SCHEMA = "Station string, Island string, Latitude double, Longitude double, UtcOffsetSeconds int"
WMO_SCHEMA = "WeatherCode int, Description string, Category string"


def stations(spark: SparkSession, names: list[str] | None = None,
             utc_offset_seconds: int = 0) -> DataFrame:
    """Station dimension: Station, Island, Latitude, Longitude, UtcOffsetSeconds.

    ``names`` relabels the islands in order (used to attach coordinates to the
    fixture stations); by default the station name is the island name.
    """
    rows = []
    for i, (island, lat, lon) in enumerate(ISLANDS):
        if names is not None and i >= len(names):
            break
        rows.append(((names[i] if names else island), island, lat, lon, utc_offset_seconds))
    return literal_table(spark, rows, STATION_SCHEMA)


def wmo_codes(spark: SparkSession) -> DataFrame:
    return literal_table(spark, WMO_CODES, WMO_SCHEMA)


def dimension_join(fact: DataFrame, dim: DataFrame, on, how: str = "left",
                   known_rows: int | None = None) -> DataFrame:
    """Join a fact table to a dimension, broadcasting only a size-proven side."""
    if known_rows is not None and known_rows <= BROADCAST_ROW_LIMIT:
        dim = F.broadcast(dim)
    return fact.join(dim, on, how)
