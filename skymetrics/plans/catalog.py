"""Registered queries over the shared test tables and their SQL twins.

Every query reads whole tables (``events`` projected to observations,
``lineitem``, ``orders``); none subsets rows to keep the check cheap.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar, display, units
from ..functions.stats import exact_mean, total
from ..operators import aggregates as A
from ..operators import coverage, daily, enrich, prepare
from ..schema import OBSERVATION
from ..session import checkpoint_dir
from ..sources import csv_files, fixture, sinks
from ..sources import json_responses as J
from ..sources.dimensions import ISLANDS, literal_table
from . import oracle as O

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the parameterised queries.
KPI_STATION, KPI_YEAR, KPI_MONTH = "click", 2024, 6
TRAILING_END, TRAILING_DAYS = dt.date(2025, 12, 31), 365
MULTI_BATCH = 50


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture observations with calendar parts."""
    return fixture._memo(spark, ("calendar", sf_dir),
                         lambda: calendar.with_calendar(fixture.observations(spark, sf_dir)))


_Q: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _Q[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


# Queries that read the landed CSV folder (``landed_folder``), whose one-time
# landing the bench times as its own step.
USES_LANDING = frozenset({"landed_csv", "landed_list", "landed_headers", "landed_gaps", "landed_stream", "daily_summary_stream",
                          "monthly_precipitation_stream", "coverage_hours_stream"})


def queries() -> dict[str, Query]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


MK = "Station, Year, Month"

# ---------------------------------------------------------------- monthly


@register("monthly_temperature", O.with_obs(f"SELECT {MK}, {O.mmm('Temperature')} FROM obs GROUP BY {MK}"))
def q_monthly_temperature(spark, sf):
    return A.monthly_temperature(obs(spark, sf))


@register("monthly_pressure", O.with_obs(f"SELECT {MK}, {O.mmm('Pressure')} FROM obs GROUP BY {MK}"))
def q_monthly_pressure(spark, sf):
    return A.monthly_pressure(obs(spark, sf))


@register(
    "monthly_precipitation",
    O.with_obs(
        f"SELECT {MK}, {O.total('Precipitation')} AS TotalPrecipitation, "
        f"count(DISTINCT CASE WHEN Precipitation > 0 THEN Date END) AS RainyDays FROM obs GROUP BY {MK}"
    ),
)
def q_monthly_precipitation(spark, sf):
    return A.monthly_precipitation(obs(spark, sf))


@register(
    "monthly_precipitation_join",
    O.with_obs(
        f"SELECT t.Station, t.Year, t.Month, t.TotalPrecipitation, coalesce(d.RainyDays, 0) AS RainyDays "
        f"FROM (SELECT {MK}, {O.total('Precipitation')} AS TotalPrecipitation FROM obs GROUP BY {MK}) t "
        f"LEFT JOIN (SELECT {MK}, count(*) AS RainyDays FROM "
        f"  (SELECT DISTINCT {MK}, Date FROM obs WHERE Precipitation > 0) GROUP BY {MK}) d "
        f"USING (Station, Year, Month)"
    ),
)
def q_monthly_precipitation_join(spark, sf):
    return A.monthly_precipitation_join(obs(spark, sf))


@register(
    "monthly_precip_series",
    O.with_obs(f"SELECT {MK}, {O.total('Precipitation')} AS Precipitation FROM obs GROUP BY {MK}"),
)
def q_monthly_precip_series(spark, sf):
    return A.monthly_precip_series(obs(spark, sf))


@register(
    "monthly_summary_narrow",
    O.with_obs(
        f"SELECT {MK}, {O.mean('Temperature')} AS AvgTemperature, {O.mean('Humidity')} AS AvgHumidity, "
        f"{O.total('Precipitation')} AS TotalPrecipitation, {O.mean('Pressure')} AS AvgPressure "
        f"FROM obs GROUP BY {MK}"
    ),
)
def q_monthly_summary_narrow(spark, sf):
    return A.monthly_summary_narrow(obs(spark, sf))


SUMMARY_SQL = (
    f"{O.mmm('Temperature')}, {O.mmm('Humidity')}, {O.total('Precipitation')} AS TotalPrecipitation, "
    f"{O.mmm('Pressure')}"
)


@register("monthly_summary", O.with_obs(f"SELECT {MK}, {SUMMARY_SQL} FROM obs GROUP BY {MK}"))
def q_monthly_summary(spark, sf):
    return A.monthly_summary(obs(spark, sf))


@register(
    "monthly_report",
    O.with_obs(
        f'SELECT Station, Year AS "Año", Month AS "Mes", {O.mean("Temperature")} AS "Temp Prom", '
        'min(Temperature) AS "Temp Min", max(Temperature) AS "Temp Max", '
        f'{O.mean("Humidity")} AS "Humedad Prom", min(Humidity) AS "Humedad Min", max(Humidity) AS "Humedad Max", '
        f'{O.total("Precipitation")} AS "Precip Total", {O.mean("Pressure")} AS "Presión Prom", '
        f'min(Pressure) AS "Presión Min", max(Pressure) AS "Presión Max" FROM obs GROUP BY {MK}'
    ),
)
def q_monthly_report(spark, sf):
    """A13 under the saved report's headers (P9, the S8 export shape)."""
    return sinks.with_spanish_headers(A.monthly_summary(obs(spark, sf)))


@register(
    "monthly_summary_zero_filled",
    O.with_obs(
        f"SELECT {MK}, {SUMMARY_SQL} FROM ("
        "SELECT Station, Year, Month, coalesce(Temperature, 0) AS Temperature, coalesce(Humidity, 0) AS Humidity, "
        "coalesce(Precipitation, 0) AS Precipitation, coalesce(Pressure, 0) AS Pressure FROM obs) "
        f"GROUP BY {MK}"
    ),
)
def q_monthly_summary_zero_filled(spark, sf):
    return A.monthly_summary(prepare.fill_zero(obs(spark, sf)))


# ---------------------------------------------------------------- hourly, daily, wind


def _hourly_sql(m: str) -> str:
    return O.with_obs(f"SELECT Station, Hour, {O.mmm(m)} FROM obs GROUP BY Station, Hour")


for _m, _name in (("Temperature", "hourly_temperature"), ("Humidity", "hourly_humidity"), ("Pressure", "hourly_pressure")):
    register(_name, _hourly_sql(_m))(lambda spark, sf, _m=_m: A.hourly_profile(obs(spark, sf), _m))


@register(
    "daily_precipitation",
    O.with_obs(f"SELECT Station, Date, {O.total('Precipitation')} AS Precipitation FROM obs GROUP BY Station, Date"),
)
def q_daily_precipitation(spark, sf):
    return A.daily_precipitation(obs(spark, sf))


@register(
    "wind_by_direction",
    O.with_obs(
        f"SELECT Station, WindDirection, {O.mean('WindSpeed')} AS AvgWindSpeed, count(*) AS Count "
        "FROM obs WHERE WindDirection IS NOT NULL GROUP BY Station, WindDirection"
    ),
)
def q_wind_by_direction(spark, sf):
    return A.wind_by_direction(obs(spark, sf))


@register(
    "wind_rose",
    O.with_obs("SELECT Station, WindDirection, count(*) AS Count FROM obs WHERE WindDirection IS NOT NULL GROUP BY Station, WindDirection"),
)
def q_wind_rose(spark, sf):
    return A.wind_rose(obs(spark, sf))


# ---------------------------------------------------------------- periods

KPI_SQL = (
    f"{O.mean('Temperature')} AS AvgTemperature, max(Temperature) AS MaxTemperature, min(Temperature) AS MinTemperature, "
    f"{O.mean('Humidity')} AS AvgHumidity, max(Humidity) AS MaxHumidity, min(Humidity) AS MinHumidity, "
    f"{O.total('Precipitation')} AS TotalPrecipitation, count_if(Precipitation > 0) AS RainyHours, "
    f"{O.mean('WindSpeed')} AS AvgWindSpeed, "
    f"{O.mean('Pressure')} AS AvgPressure, max(Pressure) AS MaxPressure, min(Pressure) AS MinPressure"
)


@register(
    "period_kpis",
    O.with_obs(
        f"SELECT {KPI_SQL} FROM obs WHERE Station = '{KPI_STATION}' "
        f"AND Time >= TIMESTAMP '{KPI_YEAR}-{KPI_MONTH:02d}-01' AND Time < TIMESTAMP '{KPI_YEAR}-{KPI_MONTH + 1:02d}-01'"
    ),
)
def q_period_kpis(spark, sf):
    return A.period_kpis(prepare.for_period(obs(spark, sf), KPI_YEAR, KPI_MONTH, KPI_STATION))


@register("monthly_kpis", O.with_obs(f"SELECT {MK}, {KPI_SQL} FROM obs GROUP BY {MK}"))
def q_monthly_kpis(spark, sf):
    return A.period_kpis(obs(spark, sf), by=("Station", "Year", "Month"))


@register("available_periods", O.with_obs(f"SELECT DISTINCT {MK} FROM obs WHERE Year IS NOT NULL"))
def q_available_periods(spark, sf):
    return A.available_periods(obs(spark, sf))


# ---------------------------------------------------------------- row-level projections and filters


@register(
    "calendar_parts",
    O.with_obs(
        "SELECT Station, TimeText, ParsedTime, CAST(hour(ParsedTime) AS INTEGER) AS Hour, CAST(ParsedTime AS DATE) AS Date, "
        "CAST(year(ParsedTime) AS INTEGER) AS Year, CAST(month(ParsedTime) AS INTEGER) AS Month, "
        "split_part(TimeText, 'T', 1) AS DateText, strftime(CAST(ParsedTime AS DATE), '%Y-%m-%d') AS IsoDate, "
        "CAST(CAST(ParsedTime AS DATE) - INTERVAL 3650 DAY AS DATE) AS TenYearsBefore "
        "FROM (SELECT Station, strftime(Time, '%Y-%m-%dT%H:%M') AS TimeText, "
        "CAST(strptime(strftime(Time, '%Y-%m-%dT%H:%M'), '%Y-%m-%dT%H:%M') AS TIMESTAMP) AS ParsedTime FROM obs)"
    ),
)
def q_calendar_parts(spark, sf):
    o = fixture.observations(spark, sf).select("Station", F.date_format("Time", "yyyy-MM-dd'T'HH:mm").alias("TimeText"))
    o = o.withColumn("ParsedTime", calendar.parse_time("TimeText"))
    o = calendar.with_calendar(o, "ParsedTime")
    return o.select(
        "Station", "TimeText", "ParsedTime", "Hour", "Date", "Year", "Month",
        calendar.date_text("TimeText").alias("DateText"),
        calendar.iso_date("Date").alias("IsoDate"),
        calendar.days_before("Date", 3650).alias("TenYearsBefore"),
    )


_ROW_COLS = "Station, Time, Temperature, Humidity, Precipitation, WeatherCode, WindSpeed, WindDirection, Pressure"


@register(
    "zero_filled",
    O.with_obs(
        "SELECT Station, Time, coalesce(Temperature, 0) AS Temperature, coalesce(Humidity, 0) AS Humidity, "
        "coalesce(Precipitation, 0) AS Precipitation, coalesce(WeatherCode, 0) AS WeatherCode, "
        "coalesce(WindSpeed, 0) AS WindSpeed, coalesce(WindDirection, 0) AS WindDirection, "
        "coalesce(Pressure, 0) AS Pressure FROM obs"
    ),
)
def q_zero_filled(spark, sf):
    return prepare.fill_zero(fixture.observations(spark, sf))


@register("rainy_rows", O.with_obs(f"SELECT {_ROW_COLS} FROM obs WHERE Precipitation > 0"))
def q_rainy_rows(spark, sf):
    return prepare.rainy_rows(fixture.observations(spark, sf))


_TR_START = TRAILING_END - dt.timedelta(days=TRAILING_DAYS)
_TR_STOP = TRAILING_END + dt.timedelta(days=1)


@register(
    "trailing_range",
    O.with_obs(f"SELECT {_ROW_COLS} FROM obs WHERE Time >= TIMESTAMP '{_TR_START}' AND Time < TIMESTAMP '{_TR_STOP}'"),
)
def q_trailing_range(spark, sf):
    return prepare.trailing_range(fixture.observations(spark, sf), TRAILING_END, TRAILING_DAYS)


# ---------------------------------------------------------------- daily service aggregations


@register(
    "daily_summary",
    O.with_obs(
        f"SELECT Station, Date, max(Temperature) AS MaxTemperature, {O.mean('Temperature')} AS AvgTemperature, "
        f"min(Temperature) AS MinTemperature, {O.total('Precipitation')} AS TotalPrecipitation, "
        "count_if(Precipitation > 0) AS PrecipitationHours, max(WindSpeed) AS MaxWindSpeed "
        "FROM obs GROUP BY Station, Date"
    ),
)
def q_daily_summary(spark, sf):
    return daily.daily_summary(obs(spark, sf))


@register("daily_weather_code", O.with_obs("SELECT Station, Date, max(WeatherCode) AS WeatherCode FROM obs GROUP BY Station, Date"))
def q_daily_weather_code(spark, sf):
    return daily.daily_weather_code(obs(spark, sf))


def _vec(f: str) -> str:
    return f"sum(WindSpeed * {f}(radians(WindDirection)))"


@register(
    "daily_wind_direction",
    O.with_obs(
        f"SELECT Station, Date, round(CASE WHEN d < 0 THEN d + 360.0 ELSE abs(d) END, 3) AS DominantWindDirection FROM ("
        f"SELECT Station, Date, round(degrees(atan2({_vec('sin')}, {_vec('cos')})), 3) AS d FROM obs "
        "WHERE WindDirection IS NOT NULL AND WindSpeed IS NOT NULL GROUP BY Station, Date)"
    ),
)
def q_daily_wind_direction(spark, sf):
    return daily.daily_wind_direction(obs(spark, sf))


# ---------------------------------------------------------------- conversions


@register(
    "unit_conversion",
    O.with_obs(
        "SELECT Station, Time, Temperature * 9.0::DOUBLE / 5.0::DOUBLE + 32.0::DOUBLE AS TemperatureF, "
        "WindSpeed / 3.6::DOUBLE AS WindSpeedMs, WindSpeed / 1.609344::DOUBLE AS WindSpeedMph, "
        "WindSpeed / 1.852::DOUBLE AS WindSpeedKn, Precipitation / 25.4::DOUBLE AS PrecipitationInch FROM obs"
    ),
)
def q_unit_conversion(spark, sf):
    o = fixture.observations(spark, sf)
    return o.select(
        "Station", "Time",
        units.celsius_to_fahrenheit("Temperature").alias("TemperatureF"),
        units.kmh_to_ms("WindSpeed").alias("WindSpeedMs"),
        units.kmh_to_mph("WindSpeed").alias("WindSpeedMph"),
        units.kmh_to_knots("WindSpeed").alias("WindSpeedKn"),
        units.mm_to_inch("Precipitation").alias("PrecipitationInch"),
    )


@register(
    "epoch_local_time",
    O.with_obs(
        "SELECT Station, Time, UtcOffsetSeconds, EpochSeconds, "
        "TIMESTAMP '1970-01-01 00:00:00' + to_seconds(EpochSeconds + UtcOffsetSeconds) AS LocalTime FROM ("
        "SELECT o.Station, o.Time, s.UtcOffsetSeconds, "
        "CAST(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', o.Time) AS BIGINT) - s.UtcOffsetSeconds AS EpochSeconds "
        "FROM obs o LEFT JOIN stations s USING (Station))",
        O.STATIONS_VALUES,
    ),
)
def q_epoch_local_time(spark, sf):
    st = fixture.fixture_stations(spark).select("Station", "UtcOffsetSeconds")
    o = enrich.with_station(fixture.observations(spark, sf).select("Station", "Time"), st, known_rows=len(ISLANDS))
    o = o.withColumn("EpochSeconds", units.epoch_seconds("Time", "UtcOffsetSeconds"))
    return o.withColumn("LocalTime", units.local_time("EpochSeconds", "UtcOffsetSeconds"))


# ---------------------------------------------------------------- dimensions


@register(
    "station_enriched",
    O.with_obs(
        f"SELECT {_ROW_COLS}, Island, Latitude, Longitude, UtcOffsetSeconds FROM obs LEFT JOIN stations USING (Station)",
        O.STATIONS_VALUES,
    ),
)
def q_station_enriched(spark, sf):
    return enrich.with_station(fixture.observations(spark, sf), fixture.fixture_stations(spark), known_rows=len(ISLANDS))


@register(
    "station_overview",
    O.with_obs(
        "SELECT p.Station, p.Rows, p.FirstTime, p.LastTime, s.Island, s.Latitude, s.Longitude, s.UtcOffsetSeconds FROM "
        "(SELECT Station, count(*) AS Rows, min(Time) AS FirstTime, max(Time) AS LastTime FROM obs GROUP BY Station) p "
        "LEFT JOIN stations s USING (Station)",
        O.STATIONS_VALUES,
    ),
)
def q_station_overview(spark, sf):
    return enrich.station_overview(fixture.observations(spark, sf), fixture.fixture_stations(spark), known_rows=len(ISLANDS))


@register(
    "weather_conditions",
    O.with_obs(
        "SELECT c.WeatherCode, c.Station, c.Hours, d.Description, d.Category FROM "
        "(SELECT Station, WeatherCode, count(*) AS Hours FROM obs GROUP BY Station, WeatherCode) c "
        "LEFT JOIN codes d USING (WeatherCode)",
        O.WMO_VALUES,
    ),
)
def q_weather_conditions(spark, sf):
    return enrich.weather_conditions(fixture.observations(spark, sf))


# ---------------------------------------------------------------- coverage


@register(
    "coverage_gaps",
    O.with_obs(
        "SELECT e.Station, e.Date FROM (SELECT Station, CAST(unnest(generate_series(min(Date), max(Date), INTERVAL 1 DAY)) AS DATE) AS Date "
        "FROM landed GROUP BY Station) e ANTI JOIN landed l ON e.Station = l.Station AND e.Date = l.Date",
        "landed AS (SELECT DISTINCT Station, CAST(Time AS DATE) AS Date FROM raw_obs WHERE Time IS NOT NULL)",
    ),
)
def q_coverage_gaps(spark, sf):
    return coverage.missing_days(fixture.observations(spark, sf))


_HOURS_SQL = "SELECT Station, Date, bit_or(1 << Hour)::INTEGER AS HourMask, count(DISTINCT Hour)::INTEGER AS Hours, count(DISTINCT Hour) = 24 AS Complete"


@register("coverage_hours", O.with_obs(f"{_HOURS_SQL} FROM obs WHERE Time IS NOT NULL GROUP BY Station, Date"))
def q_coverage_hours(spark, sf):
    """S7 below the day: how many of its 24 hours each landed day has."""
    return coverage.hour_coverage(coverage.hour_masks(fixture.observations(spark, sf)))


@register(
    "missing_hours",
    O.with_obs(
        "SELECT e.Station, e.Date, e.Hour FROM (SELECT Station, Date, unnest(range(24))::INTEGER AS Hour FROM "
        "(SELECT Station, CAST(unnest(generate_series(min(Date), max(Date), INTERVAL 1 DAY)) AS DATE) AS Date FROM obs WHERE Time IS NOT NULL GROUP BY Station)) e "
        "ANTI JOIN obs o ON e.Station = o.Station AND e.Date = o.Date AND e.Hour = o.Hour"
    ),
)
def q_missing_hours(spark, sf):
    """The station-hours without an observation between a station's first and last day."""
    return coverage.missing_hours(fixture.observations(spark, sf))


# ---------------------------------------------------------------- landed CSV files


def landed_folder(spark: SparkSession, sf: str) -> str:
    """The fixture landed as one headered CSV per station-day (S6) in the
    shared checkpoint folder, written once per session."""
    def build() -> str:
        path = f"{checkpoint_dir(spark).rstrip('/')}/skymetrics-landed-{uuid.uuid4().hex}"
        # many tasks: the cost of this small table is its thousands of files
        sinks.write_daily_csv(fixture.observations(spark, sf), path, tasks=int(spark.conf.get("spark.sql.shuffle.partitions")))
        return path
    return fixture._memo(spark, ("landed", sf), build)


@register(
    "landed_csv",
    O.with_obs(
        "SELECT Station, Time, Temperature, Humidity, Precipitation, WeatherCode, "
        "WindSpeed, WindDirection, Pressure FROM raw_obs"
    ),
)
def q_landed_csv(spark, sf):
    return csv_files.load_observations(spark, landed_folder(spark, sf))


def headers_folder(spark: SparkSession, sf: str) -> str:
    """The fixture landed under three headers in one folder, by hour: the order of the
    observations, another order, and without Pressure but with a column that is no observation's."""
    def build() -> str:
        path = f"{checkpoint_dir(spark).rstrip('/')}/skymetrics-headers-{uuid.uuid4().hex}"
        o = fixture.observations(spark, sf).withColumn("kind", F.coalesce(F.hour("Time") % 3, F.lit(0))).withColumn("Time", sinks.time_text())
        swapped = ("Pressure", "Humidity", "Temperature", "Time", "WindDirection", "WeatherCode", "WindSpeed", "Precipitation")
        fewer = ("Time", "Note", *[c for c in reversed(swapped) if c not in ("Pressure", "Time")])
        rows = o.withColumn("Note", F.lit('a "note", quoted'))
        for kind, columns in enumerate((csv_files.CSV_COLUMNS, swapped, fewer)):
            (rows.filter(F.col("kind") == kind).select("Station", *columns)
             .write.mode("append").partitionBy("Station").option("header", True).option("escape", '"').csv(path))
        return path
    return fixture._memo(spark, ("headers", sf), build)


@register(
    "landed_headers",
    O.with_obs(
        "SELECT Station, Time, Temperature, Humidity, Precipitation, WeatherCode, WindSpeed, WindDirection, "
        "CASE WHEN hour(Time) % 3 = 2 THEN NULL ELSE Pressure END AS Pressure FROM raw_obs"
    ),
)
def q_landed_headers(spark, sf):
    """Files whose headers name the columns in other orders, lack one, or have one more."""
    return csv_files.load_observations(spark, headers_folder(spark, sf))


def landed_stream_table(spark: SparkSession, sf: str) -> str:
    """The landing folder ingested by the file-source stream (one
    ``availableNow`` run, checkpointed) into a Station/BatchId-partitioned
    Parquet table in the shared checkpoint folder, once per session."""
    def build() -> str:
        from ..streaming import landing

        base = f"{checkpoint_dir(spark).rstrip('/')}/skymetrics-stream-{uuid.uuid4().hex}"
        q = landing.start_ingest(spark, landed_folder(spark, sf), f"{base}/table", f"{base}/checkpoint",
                                 f"{base}/rejects")
        q.awaitTermination()
        return f"{base}/table"
    return fixture._memo(spark, ("landed_stream", sf), build)


def daily_stream_table(spark: SparkSession, sf: str) -> str:
    """The daily statistics stream run over the landing folder (``availableNow``,
    several micro-batches) into a table in the shared checkpoint folder."""
    def build() -> str:
        from ..streaming import landing

        base = f"{checkpoint_dir(spark).rstrip('/')}/skymetrics-daily-stream-{uuid.uuid4().hex}"
        landing.start_daily_summary(spark, landed_folder(spark, sf), f"{base}/table", f"{base}/checkpoint",
                                    max_files_per_trigger=DAILY_STREAM_FILES, merge_every=DAILY_STREAM_MERGE).awaitTermination()
        return f"{base}/table"
    return fixture._memo(spark, ("daily_stream", sf), build)


DAILY_STREAM_FILES = 1_500
DAILY_STREAM_MERGE = 2


@register("daily_summary_stream", _SQL["daily_summary"])
def q_daily_summary_stream(spark, sf):
    """D1 kept up to date by a stream: every day that landed, in whatever batch."""
    from ..streaming import landing
    return landing.daily_summary_so_far(landing.parts_so_far(spark, daily_stream_table(spark, sf)))


@register("monthly_precipitation_stream", _SQL["monthly_precipitation"])
def q_monthly_precipitation_stream(spark, sf):
    """A3 + A4 from the daily stream's parts: totals and rainy days of what has landed."""
    from ..streaming import landing
    return landing.monthly_precipitation_so_far(landing.parts_so_far(spark, daily_stream_table(spark, sf)))


@register("coverage_hours_stream", _SQL["coverage_hours"])
def q_coverage_hours_stream(spark, sf):
    """S7 by the hour from the daily stream's parts."""
    from ..streaming import landing
    return landing.hour_coverage_so_far(landing.parts_so_far(spark, daily_stream_table(spark, sf)))


@register("landed_stream", _SQL["landed_csv"])
def q_landed_stream(spark, sf):
    # explicit schema: partition values (Station, BatchId) keep their types
    # instead of being inferred from the folder names
    schema = T.StructType(OBSERVATION.fields + [T.StructField("BatchId", T.LongType(), True)])
    table = spark.read.schema(schema).parquet(landed_stream_table(spark, sf))
    return table.select(*_ROW_COLS.split(", "))


@register(
    "landing_paths",
    O.with_obs(
        "SELECT d.Station, d.Date, 'weather_data_hourly_' || d.Station || '_' || CAST(s.Latitude AS VARCHAR) || '_' "
        "|| CAST(s.Longitude AS VARCHAR) || '/weather_' || strftime(d.Date, '%Y-%m-%d') || '.csv' AS LandingPath "
        "FROM (SELECT DISTINCT Station, Date FROM obs WHERE Date IS NOT NULL) d LEFT JOIN stations s USING (Station)",
        O.STATIONS_VALUES,
    ),
)
def q_landing_paths(spark, sf):
    """X4 + X2: where the downloader's layout lands each observed station-day."""
    days = coverage.landed_days(fixture.observations(spark, sf))
    st = fixture.fixture_stations(spark).select("Station", "Latitude", "Longitude")
    days = enrich.with_station(days, st, known_rows=len(ISLANDS))
    return days.select("Station", "Date", csv_files.landing_path_column().alias("LandingPath"))


@register("landed_gaps", _SQL["coverage_gaps"])
def q_landed_gaps(spark, sf):
    return coverage.missing_files(csv_files.landed_files(spark, landed_folder(spark, sf)))


# Split point of the two-layout and union queries.
_SPLIT = dt.datetime(2025, 1, 1)

# Fixed parameters of the range-completeness query.
COMPLETE_START, COMPLETE_END = dt.date(2024, 1, 1), dt.date(2024, 12, 31)


# stations that coverage is asked for: those of the fixture and one that never landed
EXPECTED_STATIONS = (*fixture.FIXTURE_STATIONS, "never landed")
_RANGE_DAYS = (COMPLETE_END - COMPLETE_START).days + 1


@register(
    "range_complete",
    O.with_obs(
        f"SELECT Station, CAST({_RANGE_DAYS} - count(Date) AS BIGINT) AS MissingDays, count(Date) = {_RANGE_DAYS} AS Complete "
        "FROM expected LEFT JOIN (SELECT DISTINCT Station, Date FROM obs "
        f"WHERE Date BETWEEN DATE '{COMPLETE_START}' AND DATE '{COMPLETE_END}') USING (Station) GROUP BY Station",
        "expected(Station) AS (VALUES " + ", ".join(f"('{x}')" for x in EXPECTED_STATIONS) + ")",
    ),
)
def q_range_complete(spark, sf):
    """S7's decision: is every day of the range landed, per expected station."""
    expected = literal_table(spark, [(x,) for x in EXPECTED_STATIONS], "Station string")
    return coverage.is_complete(fixture.observations(spark, sf), COMPLETE_START, COMPLETE_END, expected)


def layout_folder(spark: SparkSession, sf: str) -> str:
    """The fixture landed in two CSV layouts in one folder (written once per
    session): rows before the split with (Time, Temperature, Pressure), later
    rows with (Time, Temperature, Humidity), under ``Station=`` folders."""
    def build() -> str:
        path = f"{checkpoint_dir(spark).rstrip('/')}/skymetrics-layouts-{uuid.uuid4().hex}"
        o = fixture.observations(spark, sf)
        text_time = sinks.time_text().alias("Time")
        early = F.coalesce(F.col("Time") < F.lit(_SPLIT).cast("timestamp_ntz"), F.lit(False))
        (o.filter(early).select("Station", text_time, "Temperature", "Pressure")
         .write.partitionBy("Station").option("header", True).csv(path))
        (o.filter(~early).select("Station", text_time, "Temperature", "Humidity")
         .write.mode("append").partitionBy("Station").option("header", True).csv(path))
        return path
    return fixture._memo(spark, ("layouts", sf), build)


@register(
    "layout_union",
    O.with_obs(
        "SELECT Station, Time, Temperature, "
        "CASE WHEN Time < TIMESTAMP '2025-01-01' THEN NULL ELSE Humidity END AS Humidity, "
        "CASE WHEN Time < TIMESTAMP '2025-01-01' THEN Pressure ELSE NULL END AS Pressure FROM raw_obs"
    ),
)
def q_layout_union(spark, sf):
    """S3 + U2: files of two layouts read by header and stacked by name."""
    df = csv_files.read_by_layout(spark, layout_folder(spark, sf))
    return df.select(csv_files.station_of_file("SourceFile").alias("Station"), "Time", "Temperature", "Humidity", "Pressure")


# ---------------------------------------------------------------- sets

@register("union_positional", O.with_obs(f"SELECT {_ROW_COLS} FROM obs"))
def q_union_positional(spark, sf):
    o = fixture.observations(spark, sf)
    split = F.lit(_SPLIT).cast("timestamp_ntz")
    return prepare.union_positional([o.filter(F.col("Time") < split), o.filter(~(F.col("Time") < split) | F.col("Time").isNull())])


@register(
    "union_by_name",
    O.with_obs(
        "SELECT Station, Time, Temperature, CASE WHEN Time < TIMESTAMP '2025-01-01' THEN NULL ELSE Humidity END AS Humidity, "
        "CASE WHEN Time < TIMESTAMP '2025-01-01' THEN Pressure ELSE NULL END AS Pressure FROM obs"
    ),
)
def q_union_by_name(spark, sf):
    o = fixture.observations(spark, sf)
    split = F.lit(_SPLIT).cast("timestamp_ntz")
    early = o.filter(F.col("Time") < split).select("Pressure", "Time", "Station", "Temperature")
    late = o.filter(~(F.col("Time") < split) | F.col("Time").isNull()).select("Station", "Time", "Temperature", "Humidity")
    return prepare.union_by_name([early, late]).select("Station", "Time", "Temperature", "Humidity", "Pressure")


# ---------------------------------------------------------------- JSON responses
# Rows without Time are packed, too; they come back as hours that ``J.hourly_rows`` rejects.


@register("json_pivot", O.with_obs(f"SELECT {_ROW_COLS} FROM obs WHERE Time IS NOT NULL"))
def q_json_pivot(spark, sf):
    o = fixture.observations(spark, sf)
    docs = J.to_documents(J.pack_days(o, fixture.fixture_stations(spark), len(fixture.FIXTURE_STATIONS)))
    good, _ = J.split_responses(J.parse_responses(docs.select("Station", "json")))
    return J.pivot_hourly(good)


def landed_json_folder(spark: SparkSession, sf: str) -> str:
    """The fixture's responses landed as JSON lines under ``Station=`` folders
    in the shared checkpoint folder, written once per session."""
    def build() -> str:
        path = f"{checkpoint_dir(spark).rstrip('/')}/skymetrics-landed-json-{uuid.uuid4().hex}"
        o = fixture.observations(spark, sf)
        docs = J.to_documents(J.pack_days(o, fixture.fixture_stations(spark), len(fixture.FIXTURE_STATIONS)))
        docs.select("Station", "json").write.partitionBy("Station").text(path)
        return path
    return fixture._memo(spark, ("landed_json", sf), build)


@register("landed_json", _SQL["json_pivot"])
def q_landed_json(spark, sf):
    rows, _ = J.load_responses(spark, landed_json_folder(spark, sf))
    return rows.select(*_ROW_COLS.split(", "))


@register(
    "multi_location",
    O.with_obs(
        f"SELECT CAST(Time AS DATE) AS Date, CAST({O.STATION_INDEX} % {MULTI_BATCH} AS INTEGER) AS LocationId, {_ROW_COLS} "
        "FROM obs WHERE Time IS NOT NULL"
    ),
)
def q_multi_location(spark, sf):
    names = F.array(*[F.lit(s) for s in fixture.FIXTURE_STATIONS])
    idx = F.array_position(names, F.col("Station")) - 1
    n = len(fixture.FIXTURE_STATIONS)
    o = fixture.observations(spark, sf)
    docs = J.pack_locations(J.pack_days(o, fixture.fixture_stations(spark), n), idx, n, MULTI_BATCH)
    parsed = J.parse_multi(docs)
    station = F.element_at(names, (F.col("Batch") * MULTI_BATCH + F.col("LocationId") + 1).cast("int"))
    parsed = parsed.withColumn("Station", station)
    return J.pivot_hourly(parsed).select("Date", "LocationId", *_ROW_COLS.split(", "))


@register(
    "response_errors",
    O.with_obs(
        "SELECT Station, Date, CASE WHEN bool_or(Pressure IS NULL) THEN "
        "'error: Cannot initialize WeatherVariable pressure_msl for ' || strftime(Date, '%Y-%m-%d') "
        "ELSE 'no hourly block' END AS Reason "
        "FROM obs WHERE Time IS NOT NULL GROUP BY Station, Date "
        "HAVING bool_or(Pressure IS NULL) OR bool_or(WindDirection IS NULL)"
    ),
)
def q_response_errors(spark, sf):
    st, n = fixture.fixture_stations(spark), len(fixture.FIXTURE_STATIONS)
    o = fixture.observations(spark, sf)
    flags = o.filter(F.col("Time").isNotNull()).groupBy("Station", F.to_date("Time").alias("Date")).agg(
        F.bool_or(F.col("Pressure").isNull()).alias("NoPressure"),
        F.bool_or(F.col("WindDirection").isNull()).alias("NoDirection"),
    )
    flags = J.with_station_columns(flags, st, n)
    # a batch of responses as the service sends them: an error object for a day
    # with a missing variable, a response without hourly block for a day with a
    # missing direction, full (chunked) responses for the other days
    errors = flags.filter("NoPressure").select("Station", "Date", F.to_json(F.struct(
        F.lit(True).alias("error"),
        F.concat(F.lit("Cannot initialize WeatherVariable pressure_msl for "), F.date_format("Date", "yyyy-MM-dd")).alias("reason"),
    )).alias("json"))
    partial = flags.filter("NOT NoPressure AND NoDirection").select(
        "Station", "Date", F.to_json(J.empty_response().dropFields("hourly")).alias("json"))
    flagged = flags.filter("NoPressure OR NoDirection").select("Station", "Date")
    full = J.to_documents(J.pack_days(o, st, n)).join(flagged, ["Station", "Date"], "left_anti").select("Station", "Date", "json")
    batch = errors.unionByName(partial).unionByName(full)
    _, rejects = J.split_responses(J.parse_responses(batch))
    return rejects.select("Station", "Date", "Reason")


# Fixed parameter: hours by which the stations of ``response_units`` are ahead of GMT, by place in the list.
_OFFSET_HOURS = 2


@register(
    "response_units",
    O.with_obs(
        "SELECT Station, date_trunc('second', Time) AS Time, round(Temperature, 6) AS Temperature, round(Precipitation, 6) AS Precipitation, "
        "round(WindSpeed, 6) AS WindSpeed FROM obs WHERE Time IS NOT NULL"
    ),
)
def q_response_units(spark, sf):
    """D4 + D5 + D7 on read: landed lists of responses in °F, inch and mph, times in
    whole UNIX seconds of stations with different offsets, back as observations."""
    def build() -> str:
        path = f"{checkpoint_dir(spark).rstrip('/')}/skymetrics-landed-units-{uuid.uuid4().hex}"
        names = F.array(*[F.lit(x) for x in fixture.FIXTURE_STATIONS])
        offset = ((F.array_position(names, "Station").cast("int") - 1) * (3600 * _OFFSET_HOURS)).cast("int")
        docs = J.pack_days(fixture.observations(spark, sf))
        docs = docs.withColumn("offset", offset)
        h = F.col("response.hourly")
        changed = F.col("response").withField("utc_offset_seconds", F.col("offset")).withField("hourly", h.withField(
            "time", F.transform(h["time"], lambda t: units.epoch_seconds(t.cast("timestamp_ntz"), "offset"))
        ).withField("temperature_2m", F.transform(h["temperature_2m"], units.celsius_to_fahrenheit)
        ).withField("precipitation", F.transform(h["precipitation"], units.mm_to_inch)
        ).withField("wind_speed_10m", F.transform(h["wind_speed_10m"], units.kmh_to_mph)))
        named = F.create_map(*[F.lit(x) for pair in (("time", "unixtime"), ("temperature_2m", "°F"), ("precipitation", "inch"),
                                                     ("wind_speed_10m", "mph")) for x in pair])
        response = changed.withField("hourly_units", named)
        # a list of two: the second location has no hours
        listed = F.to_json(F.array(response, response.withField("hourly", F.transform(F.array(h), lambda x: J.empty_response()["hourly"])[0])))
        docs.select("Station", listed.alias("json")).write.partitionBy("Station").text(path)
        return path

    rows, _ = J.load_responses(spark, fixture._memo(spark, ("landed_units", sf), build))
    return rows.select("Station", "Time", *[F.round(c, 6).alias(c) for c in ("Temperature", "Precipitation", "WindSpeed")])


# ---------------------------------------------------------------- reports, display, lists of files, malformed cells


@register("monthly_report_csv", _SQL["monthly_report"])
def q_monthly_report_csv(spark, sf):
    """The monthly report written as one CSV per station, and read back."""
    report = q_monthly_report(spark, sf)

    def build() -> str:
        path = f"{checkpoint_dir(spark).rstrip('/')}/skymetrics-report-{uuid.uuid4().hex}"
        sinks.write_station_reports(report, path)
        return path

    back = spark.read.schema(report.schema).option("header", True).csv(fixture._memo(spark, ("report", sf), build))
    return back.select(*report.columns)


@register("collected_report", _SQL["monthly_summary"])
def q_collected_report(spark, sf):
    """The monthly summary brought to the driver in batches, as a report or a chart takes it."""
    report = A.monthly_summary(obs(spark, sf))
    tables = list(sinks.collect_batches(report, rows=100))
    return spark.createDataFrame(pa.concat_tables(tables) if tables else report.limit(0).toArrow(), report.schema)


@register("landed_list", _SQL["landed_csv"])
def q_landed_list(spark, sf):
    """The landed files read as a list of paths."""
    folder = landed_folder(spark, sf)
    return csv_files.load_observations(spark, [f"{folder}/Station={x}" for x in fixture.FIXTURE_STATIONS])


@register(
    "filled_all",
    O.with_obs("SELECT Station, Time, " + ", ".join(
        f"coalesce({c}, 0) AS {c}" for c in ("Temperature", "Humidity", "Precipitation", "WeatherCode", "WindSpeed", "WindDirection", "Pressure"))
        + " FROM obs"),
)
def q_filled_all(spark, sf):
    """Every numeric NULL becomes 0."""
    return prepare.fill_zero_all(fixture.observations(spark, sf))


def _shown_sql(column: str) -> str:
    exact = f"CAST(CAST({column} AS VARCHAR) AS DECIMAL(18, 6))"
    return f"CAST(CAST(round({exact}, 1) AS DECIMAL(18, 1)) AS VARCHAR) || '{display.SUFFIX[column]}' AS {column}"


@register("display_values", O.with_obs(f"SELECT Station, Time, {_shown_sql('Temperature')}, {_shown_sql('WindSpeed')} FROM obs"))
def q_display_values(spark, sf):
    """Measures as they are shown, one decimal and a unit."""
    shown = {c: display.SUFFIX[c] for c in ("Temperature", "WindSpeed")}
    return display.format_columns(fixture.observations(spark, sf).select("Station", "Time", *shown), shown)


# rows of a landed file at most: some 13 MB
LANDED_RECORDS = 200_000


def malformed_folder(spark: SparkSession, sf: str) -> str:
    """The fixture landed with infinite pressures for missing ones, codes that are none, and ``N/A`` for a code 0."""
    def build() -> str:
        path = f"{checkpoint_dir(spark).rstrip('/')}/skymetrics-malformed-{uuid.uuid4().hex}"
        o = fixture.observations(spark, sf)
        text = o.withColumns({
            "Time": sinks.time_text(),
            "Pressure": F.coalesce(F.col("Pressure").cast("string"), F.lit("Infinity")),
            "WeatherCode": F.when(F.col("Pressure").isNotNull() & F.col("WindDirection").isNull(), F.lit("1e12"))
            .when(F.col("WeatherCode") == 0, F.lit("N/A")).otherwise(F.col("WeatherCode").cast("string")),
        })
        # a stream takes a file whole, so none is larger the more rows there are
        (text.select("Station", *csv_files.CSV_COLUMNS)
         .write.partitionBy("Station").option("header", True).option("maxRecordsPerFile", LANDED_RECORDS).csv(path))
        return path
    return fixture._memo(spark, ("malformed", sf), build)


@register(
    "daily_rejects_stream",
    O.with_obs("SELECT Station, Date, count(*) AS Rejects FROM obs WHERE Pressure IS NULL OR WindDirection IS NULL GROUP BY Station, Date"),
)
def q_daily_rejects_stream(spark, sf):
    """F7 in the stream of D1: station-days that lost rows, counted in the pass that sums their days up."""
    from ..streaming import landing

    def build() -> str:
        base = f"{checkpoint_dir(spark).rstrip('/')}/skymetrics-rejects-stream-{uuid.uuid4().hex}"
        landing.start_daily_summary(spark, malformed_folder(spark, sf), f"{base}/table", f"{base}/checkpoint",
                                    max_files_per_trigger=MALFORMED_STREAM_FILES).awaitTermination()
        return f"{base}/table"

    return landing.rejects_so_far(landing.parts_so_far(spark, fixture._memo(spark, ("rejects_stream", sf), build)))


MALFORMED_STREAM_FILES = 20


@register(
    "landed_malformed",
    O.with_obs(
        "SELECT Station, CASE WHEN Pressure IS NULL THEN 'Pressure' WHEN WindDirection IS NULL THEN 'WeatherCode' "
        "ELSE 'good' END AS Cells, count(*) AS Hours, "
        "count(CASE WHEN Pressure IS NOT NULL AND WindDirection IS NOT NULL AND WeatherCode <> 0 THEN 1 END) AS Codes FROM obs GROUP BY 1, 2"
    ),
)
def q_landed_malformed(spark, sf):
    """S4 + F7: hours with an infinite pressure or a code that is none are rejected;
    a code ``N/A`` is a missing one, its hour is read."""
    good, rejects = csv_files.load_once(spark, malformed_folder(spark, sf))
    rejected = rejects.select(csv_files.station_of_file("SourceFile").alias("Station"),
                              F.concat_ws(",", "BadColumns").alias("Cells"), F.lit(None).cast("int").alias("WeatherCode"))
    every = good.select("Station", F.lit("good").alias("Cells"), "WeatherCode").unionByName(rejected)
    return every.groupBy("Station", "Cells").agg(F.count(F.lit(1)).alias("Hours"), F.count("WeatherCode").alias("Codes"))


# ---------------------------------------------------------------- the same monthly shape on other tables


@register(
    "lineitem_monthly",
    "SELECT CAST(year(l_shipdate) AS INTEGER) AS Year, CAST(month(l_shipdate) AS INTEGER) AS Month, "
    f"{O.mean('l_quantity')} AS AvgQuantity, min(l_quantity) AS MinQuantity, max(l_quantity) AS MaxQuantity, "
    f"{O.mean('l_extendedprice')} AS AvgPrice, min(l_extendedprice) AS MinPrice, max(l_extendedprice) AS MaxPrice, "
    f"{O.total('l_discount')} AS TotalDiscount, "
    f"{O.mean('l_tax')} AS AvgTax, min(l_tax) AS MinTax, max(l_tax) AS MaxTax, count(*) AS Lines "
    "FROM lineitem GROUP BY 1, 2",
)
def q_lineitem_monthly(spark, sf):
    li = fixture.table(spark, sf, "lineitem")
    li = li.select(
        F.year("l_shipdate").alias("Year"), F.month("l_shipdate").alias("Month"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    )
    return li.groupBy("Year", "Month").agg(
        exact_mean("l_quantity").alias("AvgQuantity"), F.min("l_quantity").alias("MinQuantity"), F.max("l_quantity").alias("MaxQuantity"),
        exact_mean("l_extendedprice").alias("AvgPrice"), F.min("l_extendedprice").alias("MinPrice"), F.max("l_extendedprice").alias("MaxPrice"),
        total("l_discount").alias("TotalDiscount"),
        exact_mean("l_tax").alias("AvgTax"), F.min("l_tax").alias("MinTax"), F.max("l_tax").alias("MaxTax"),
        F.count(F.lit(1)).alias("Lines"),
    ).orderBy("Year", "Month")


@register(
    "orders_daily_totals",
    "SELECT CAST(o_orderdate AS DATE) AS Date, "
    f"{O.total('o_totalprice')} AS TotalPrice, count(*) AS Orders FROM orders GROUP BY 1",
)
def q_orders_daily_totals(spark, sf):
    o = fixture.table(spark, sf, "orders")
    return (
        o.groupBy(F.to_date("o_orderdate").alias("Date"))
        .agg(total("o_totalprice").alias("TotalPrice"), F.count(F.lit(1)).alias("Orders"))
        .orderBy("Date")
    )


# ---------------------------------------------------------------- single-scan dashboard (roll-ups of one aggregate)


def _dash(name: str, fn):
    from . import dashboard as D

    def q(spark, sf):
        return fn(D, D.aggregate(obs(spark, sf)))
    register(f"dashboard_{name}", _SQL[name])(q)


_dash("monthly_summary", lambda D, agg: D.monthly_summary(agg))
_dash("monthly_precipitation", lambda D, agg: D.monthly_precipitation(agg))
_dash("hourly_temperature", lambda D, agg: D.hourly_profile(agg, "Temperature"))
_dash("wind_by_direction", lambda D, agg: D.wind_by_direction(agg))
_dash("daily_summary", lambda D, agg: D.daily_summary(agg))
_dash("daily_wind_direction", lambda D, agg: D.daily_wind_direction(agg))
_dash("daily_weather_code", lambda D, agg: D.daily_weather_code(agg))
_dash("daily_precipitation", lambda D, agg: D.daily_precipitation(agg))


# ---------------------------------------------------------------- interactive month view (one station-month, one scan)

_PERIOD_WHERE = (
    f"Station = '{KPI_STATION}' AND Time >= TIMESTAMP '{KPI_YEAR}-{KPI_MONTH:02d}-01' "
    f"AND Time < TIMESTAMP '{KPI_YEAR}-{KPI_MONTH + 1:02d}-01'"
)


def _month_view(spark, sf, table):
    from . import dashboard as D
    return D.month_view(obs(spark, sf), KPI_YEAR, KPI_MONTH, KPI_STATION, tables=(table,))[table]


register("month_view_kpis", O.with_obs(f"SELECT {KPI_SQL} FROM obs WHERE {_PERIOD_WHERE}"))(
    lambda spark, sf: _month_view(spark, sf, "kpis"))
register(
    "month_view_wind_rose",
    O.with_obs(f"SELECT WindDirection, count(*) AS Count FROM obs WHERE {_PERIOD_WHERE} AND WindDirection IS NOT NULL GROUP BY WindDirection"),
)(lambda spark, sf: _month_view(spark, sf, "wind_rose"))
register(
    "month_view_hourly_humidity",
    O.with_obs(f"SELECT Hour, {O.mmm('Humidity')} FROM obs WHERE {_PERIOD_WHERE} GROUP BY Hour"),
)(lambda spark, sf: _month_view(spark, sf, "hourly_humidity"))
register(
    "month_view_daily_precipitation",
    O.with_obs(f"SELECT Date, {O.total('Precipitation')} AS Precipitation FROM obs WHERE {_PERIOD_WHERE} GROUP BY Date"),
)(lambda spark, sf: _month_view(spark, sf, "daily_precipitation"))
