"""Independent SQL (DuckDB dialect) for every registered query.

The SQL is written against the raw shared tables; ``OBS`` rebuilds the
fixture observations with the same column mapping, so each statement checks
the Spark plan end to end.  Sums add the decimal numbers that the values' texts
name, and become doubles once; means are such a sum by the number of values.
"""

from __future__ import annotations

from ..sources.dimensions import ISLANDS, WMO_CODE_LIST, WMO_CODES
from ..sources.fixture import FIXTURE_STATIONS

_CODES = ", ".join(str(c) for c in WMO_CODE_LIST)


def ssum(x: str) -> str:
    return f"CAST(CAST(sum(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 12))) AS VARCHAR) AS DOUBLE)"


def mean(x: str) -> str:
    return f"{ssum(x)} / count({x})"


def total(x: str) -> str:
    return f"coalesce({ssum(x)}, 0.0::DOUBLE)"


def mmm(x: str) -> str:
    return f"{mean(x)} AS Avg{x}, min({x}) AS Min{x}, max({x}) AS Max{x}"


OBS_CTE = f"""
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
raw_obs AS (
  SELECT event_type AS Station,
         ts + to_months(CAST(user_id % 36 AS INTEGER)) AS Time,
         value AS Temperature,
         CAST(k AS DOUBLE) AS Humidity,
         CASE WHEN k >= 70 THEN value ELSE 0.0::DOUBLE END AS Precipitation,
         CAST(list_extract([{_CODES}], CAST(event_id % 28 AS INTEGER) + 1) AS INTEGER) AS WeatherCode,
         k / 2.0::DOUBLE AS WindSpeed,
         CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST((event_id * 37) % 361 AS DOUBLE) END AS WindDirection,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(1000 + k AS DOUBLE) END AS Pressure
  FROM ev
),
obs AS (
  SELECT *,
         CAST(hour(Time) AS INTEGER) AS Hour,
         CAST(Time AS DATE) AS Date,
         CAST(year(Time) AS INTEGER) AS Year,
         CAST(month(Time) AS INTEGER) AS Month
  FROM raw_obs
)"""


def with_obs(select: str, *ctes: str) -> str:
    more = "".join(f",\n{c}" for c in ctes)
    return f"WITH {OBS_CTE}{more}\n{select}"


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STATIONS_VALUES = "stations(Station, Island, Latitude, Longitude, UtcOffsetSeconds) AS (VALUES " + ", ".join(
    f"({_sql_str(name)}, {_sql_str(isl)}, {lat}::DOUBLE, {lon}::DOUBLE, 0)"
    for name, (isl, lat, lon) in zip(FIXTURE_STATIONS, ISLANDS)
) + ")"

WMO_VALUES = "codes(WeatherCode, Description, Category) AS (VALUES " + ", ".join(
    f"({c}, {_sql_str(d)}, {_sql_str(g)})" for c, d, g in WMO_CODES
) + ")"

STATION_INDEX = "(list_position([" + ", ".join(_sql_str(s) for s in FIXTURE_STATIONS) + "], Station) - 1)"
