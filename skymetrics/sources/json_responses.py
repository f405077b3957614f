"""Service JSON responses <-> observation rows.

A response carries its hourly block as parallel arrays (``hourly.time[i]``
pairs with every variable's ``[i]``).  Each document is parsed once inside the
scan task, ``arrays_zip`` aligns the arrays by index and ``inline``
turns them into rows: no shuffle, no Python, one row per document in and one
row per hour out.  Error objects and documents without an hourly block are
split into a reject table instead of being printed and dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import units
from .csv_files import station_of_file, validate
from .dimensions import dimension_join

# The service's hourly variable names for each observation column.
HOURLY_VARIABLES = {
    "Temperature": "temperature_2m",
    "Humidity": "relative_humidity_2m",
    "Precipitation": "precipitation",
    "WeatherCode": "weather_code",
    "WindSpeed": "wind_speed_10m",
    "WindDirection": "wind_direction_10m",
    "Pressure": "pressure_msl",
}

# Values are parsed as text and then like the cells of a landed CSV file, so one
# bad value rejects its hour, not the whole response.
HOURLY = T.StructType(
    [T.StructField(v, T.ArrayType(T.StringType()), True) for v in ("time", *HOURLY_VARIABLES.values())]
)

RESPONSE = T.StructType(
    [
        T.StructField("latitude", T.DoubleType(), True),
        T.StructField("longitude", T.DoubleType(), True),
        T.StructField("utc_offset_seconds", T.IntegerType(), True),
        T.StructField("timezone", T.StringType(), True),
        T.StructField("hourly_units", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("hourly", HOURLY, True),
        T.StructField("error", T.BooleanType(), True),
        T.StructField("reason", T.StringType(), True),
    ]
)

# The service's names of its alternative units (D4), each with what
# turns a value into the unit of the observations.  Other units are as observed.
CONVERSIONS = {
    "temperature_2m": {"°F": lambda c: (c - 32.0) * 5.0 / 9.0},
    "precipitation": {"inch": lambda c: c * units.MM_PER_INCH},
    "wind_speed_10m": {
        "m/s": lambda c: c * units.KMH_PER_MS,
        "mp/h": lambda c: c * units.KM_PER_MILE,
        "mph": lambda c: c * units.KM_PER_MILE,
        "kn": lambda c: c * units.KMH_PER_KNOT,
    },
}
OBSERVED_UNITS = {"time": ("iso8601", "unixtime"), "temperature_2m": ("°C",), "precipitation": ("mm",), "wind_speed_10m": ("km/h",)}

# A parsed single response also keeps the text of a malformed document (the
# PERMISSIVE parser puts it in this field and leaves the others NULL).
CORRUPT = "_corrupt_record"
PARSED = T.StructType(RESPONSE.fields + [T.StructField(CORRUPT, T.StringType(), True)])
PARSE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def parse_responses(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """Parse one response document per row into column ``response``.

    The parsed struct is produced by a generator (one element per document):
    a filter on it (``split_responses``) then runs on the parsed value.  From
    a plain projection, Catalyst would push the filter below it by
    substituting ``from_json`` into every reference, parsing each document
    several times.
    """
    rest = [c for c in docs.columns if c != json_col]
    parsed = F.struct(F.from_json(F.col(json_col), PARSED, PARSE_OPTIONS).alias("response"))
    return docs.select(*rest, F.inline(F.array(parsed)))


def parse_multi(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """A document holding a list of responses -> one row per response with
    its 0-based ``LocationId`` (position in the list); a single response is
    location 0.

    The text is parsed once, as a VARIANT; the list is taken apart and every
    element read as a response in that form, so that one that is no response is
    rejected alone.  A document that is not JSON (or beyond a VARIANT's 128 MB) is one
    malformed response without a LocationId.
    """
    rest = [c for c in docs.columns if c != json_col]
    text = F.col(json_col)
    # out of a generator, as in parse_responses
    whole = docs.select(*rest, F.inline(F.array(F.struct(F.try_parse_json(text).alias("_variant"), text.rlike(r"^\s*\[").alias("_list")))))
    nothing = F.lit(None).cast("variant")
    elements = F.when(F.col("_list"), F.try_variant_get("_variant", "$", "array<variant>")).otherwise(F.array("_variant"))
    listed = whole.select(*rest, F.col("_variant").isNull().alias("_malformed"),
                          F.posexplode(F.coalesce(elements, F.array(nothing))).alias("LocationId", "_element"))
    response = F.struct(F.try_variant_get("_element", "$", PARSED.simpleString()).alias("response"))
    return listed.select(*rest, F.when(~F.col("_malformed"), F.col("LocationId")).alias("LocationId"), F.inline(F.array(response)))


def reject_reason(response: Column) -> Column:
    """Why a parsed response cannot be used (NULL when it can): F6, D8."""
    return (
        F.when(response.isNull() | response[CORRUPT].isNotNull(), F.lit("malformed document"))
        .when(F.coalesce(response["error"], F.lit(False)), F.concat(F.lit("error: "), F.coalesce(response["reason"], F.lit(""))))
        .when(response["hourly"].isNull(), F.lit("no hourly block"))
        .when(response["hourly"]["time"].isNull(), F.lit("no time array"))
        .when(_unknown_unit(response), F.lit("unknown unit"))
    )


def _unknown_unit(response: Column) -> Column:
    """Whether a variable that has several units comes in one that is not known."""
    found = F.lit(False)
    for variable, observed in OBSERVED_UNITS.items():
        unit = F.try_element_at(response["hourly_units"], F.lit(variable))
        found |= F.coalesce(~unit.isin(*observed, *CONVERSIONS.get(variable, ())), F.lit(False))
    return found


def split_responses(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable responses, rejects with a ``Reason`` column)."""
    reason = reject_reason(F.col("response"))
    good = parsed.filter(reason.isNull())
    rejects = parsed.withColumn("Reason", reason).filter(F.col("Reason").isNotNull()).drop("response")
    return good, rejects


# what the Time of a value beyond the end of the time array reads
NO_TIME = "no time"


def hourly_rows(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Responses -> (one observation row per hourly index, rejected hours as
    text with ``BadColumns``).

    Columns other than ``response`` are carried along (e.g. the Station a
    document was landed for).  Arrays that are absent or shorter than ``time``
    pad with NULL.  An hour is rejected when a value does not parse
    (``csv_files.validate``) or stands beyond the end of ``time``.  Values come
    out in the observations' units, whatever ``hourly_units`` says they came in,
    and UNIX times as the local time that ``utc_offset_seconds`` makes them.
    """
    keep = [c for c in parsed.columns if c != "response"]
    h = F.col("response.hourly")
    empty = F.array().cast("array<string>")  # a NULL array would make the zipped one NULL, and lose every hour
    zipped = F.arrays_zip(*[F.coalesce(h[v], empty).alias(v) for v in ("time", *HOURLY_VARIABLES.values())])
    carried = F.col("response.hourly_units").alias("_units"), F.coalesce("response.utc_offset_seconds", F.lit(0)).alias("_offset")
    rows = parsed.select(*keep, *carried, F.inline(zipped))
    local = units.local_time(F.col("time").try_cast("long"), "_offset").cast("string")
    time = F.when(F.try_element_at("_units", F.lit("time")) == "unixtime", F.coalesce(local, "time")).otherwise(F.col("time"))
    text = rows.select(
        *keep, "_units",
        F.coalesce(time, F.lit(NO_TIME)).alias("Time"),
        *[F.col(v).alias(name) for name, v in HOURLY_VARIABLES.items()],
    )
    good, rejects = validate(text)
    return good.select(*keep, "Time", *[_observed(name) for name in HOURLY_VARIABLES]), rejects.drop("_units")


def _observed(name: str) -> Column:
    """A value in the unit of the observations."""
    variable = HOURLY_VARIABLES[name]
    unit, out = F.try_element_at("_units", F.lit(variable)), F.col(name)
    for other, convert in CONVERSIONS.get(variable, {}).items():
        out = F.when(unit == other, convert(F.col(name))).otherwise(out)
    return out.alias(name)


def pivot_hourly(parsed: DataFrame) -> DataFrame:
    """The observation rows of ``hourly_rows``."""
    return hourly_rows(parsed)[0]


def hourly_block(rows: Column) -> Column:
    """Parallel-array ``hourly`` struct from an array of observation structs
    whose ``Time`` is already ISO text (``row_struct``): every array is a
    plain field extraction, no per-element lambda."""
    return F.struct(
        rows["Time"].alias("time"),
        *[
            (rows[name].cast("array<double>") if name == "WeatherCode" else rows[name]).alias(v)
            for name, v in HOURLY_VARIABLES.items()
        ],
    )


# Most observation rows one response document may hold.
MAX_ROWS_PER_DOCUMENT = 4096


ROW_STRUCT = (
    "array<struct<Time:string,Temperature:double,Humidity:double,Precipitation:double,"
    "WeatherCode:int,WindSpeed:double,WindDirection:double,Pressure:double>>"
)


def row_struct() -> Column:
    """One observation as packed into a document: Time formatted once per row
    as fixed-width ISO text, which sorts in time order."""
    return F.struct(F.date_format("Time", ISO_MICROS).alias("Time"), *[F.col(m) for m in HOURLY_VARIABLES])


def _response(rows: Column | None, coords: bool = True) -> Column:
    """Response struct; coordinates come from the joined station columns, or
    are NULL when ``coords`` is false.  ``rows=None`` gives empty arrays."""
    if rows is None:
        rows = F.array().cast(ROW_STRUCT)

    def c(name, t):
        return F.col(name) if coords else F.lit(None).cast(t)

    return F.struct(
        c("Latitude", "double").alias("latitude"),
        c("Longitude", "double").alias("longitude"),
        c("UtcOffsetSeconds", "int").alias("utc_offset_seconds"),
        F.lit("GMT").alias("timezone"),
        hourly_block(rows).alias("hourly"),
    )


def with_station_columns(df: DataFrame, stations: DataFrame | None, station_rows: int | None) -> DataFrame:
    if stations is not None:
        dim = stations.select("Station", "Latitude", "Longitude", "UtcOffsetSeconds")
        return dimension_join(df, dim, "Station", "left", station_rows)
    return df.select("*", *[F.lit(None).cast(t).alias(n) for n, t in
                            (("Latitude", "double"), ("Longitude", "double"), ("UtcOffsetSeconds", "int"))])


def pack_days(obs: DataFrame, stations: DataFrame | None = None, station_rows: int | None = None,
              max_rows: int = MAX_ROWS_PER_DOCUMENT) -> DataFrame:
    """Observation rows -> response documents in the service's shape, one per
    (Station, Date, Chunk).

    ``Chunk`` numbers runs of ``max_rows`` consecutive rows of an input split
    (from ``monotonically_increasing_id``, stable when a split is recomputed),
    so no document ever holds more than ``max_rows`` rows however many rows a
    station-day has.  A day landed as one file stays one document.
    """
    chunked = obs.withColumn("Chunk", F.floor(F.monotonically_increasing_id() / max_rows))
    days = chunked.groupBy("Station", F.to_date("Time").alias("Date"), "Chunk").agg(
        F.sort_array(F.collect_list(row_struct())).alias("rows")
    )
    days = with_station_columns(days, stations, station_rows)
    return days.select("Station", "Date", "Chunk", _response(F.col("rows")).alias("response"))


def empty_response() -> Column:
    """A response without coordinates and with empty hourly arrays: the entry
    for a requested location that has no data."""
    return _response(None, coords=False)


def pack_locations(packed: DataFrame, index: Column, n_locations: int, batch: int = 50) -> DataFrame:
    """D7 inverse: per-location responses -> multi-location documents.

    Locations are requested in batches of ``batch`` (by ``index``); a document
    lists every location of its batch in index order, an empty response where
    a location has no data, so a response's position is its location.  The
    documents of a (Date, batch) are keyed by ``Chunk`` (``pack_days``): the
    chunk ids of all locations come from the same input positions, so a day
    whose rows span several chunks gives several documents, each holding at
    most one response per location - at most ``batch`` responses, each bounded
    by ``pack_days``, with no ranking or re-join of a hot day's chunks.
    """
    keyed = packed.withColumn("Idx", index).withColumn("Batch", F.floor(F.col("Idx") / batch))
    grouped = keyed.groupBy("Date", "Batch", "Chunk").agg(
        F.collect_list(F.struct("Idx", "response")).alias("items")
    )
    width = F.least(F.lit(batch), F.lit(n_locations) - F.col("Batch") * batch)
    # Idx is unique within a document (one response per location and chunk)
    by_idx = F.map_from_entries("items")
    listed = F.transform(
        F.sequence(F.lit(0), width - 1),
        lambda i: F.coalesce(F.try_element_at(by_idx, F.col("Batch") * batch + i), empty_response()),
    )
    return grouped.select("Date", "Batch", "Chunk", F.to_json(listed).alias("json"))


def read_documents(spark: SparkSession, path: str | list[str], one_per_file: bool = False) -> DataFrame:
    """Landed response documents -> rows (``SourceFile``, ``json``).

    JSON lines (one document per line) by default; ``one_per_file`` reads each
    file whole, the way a saved response body is stored (one request's
    response: bounded by the request, not by the data set).  Files are found
    recursively; parsing happens later, inside the tasks (``parse_responses``).
    """
    docs = spark.read.text(path, wholetext=one_per_file, recursiveFileLookup=True)
    return docs.select(F.col("_metadata.file_path").alias("SourceFile"), F.col("value").alias("json"))


def load_responses(spark: SparkSession, path: str | list[str], one_per_file: bool = False) -> tuple[DataFrame, DataFrame]:
    """S5 + F6 + D7 + D8 from storage: (observation rows, rejected documents and hours).

    A document is one response or a list of them; ``LocationId`` is the place in it.

    ``Station`` comes from the file's ``Station=`` or landing directory
    (``csv_files.station_of_file``); rejects keep ``SourceFile`` and ``Reason``
    (of an hour: its time and the columns that are bad).
    """
    docs = read_documents(spark, path, one_per_file)
    docs = docs.select(station_of_file("SourceFile").alias("Station"), "SourceFile", "json")
    good, rejects = split_responses(parse_multi(docs))
    rows, hours = hourly_rows(good)
    reason = F.concat(F.lit("bad hour "), F.col("Time"), F.lit(": "), F.concat_ws(", ", "BadColumns"))
    return rows.drop("SourceFile"), rejects.unionByName(hours.select(*rejects.drop("Reason").columns, reason.alias("Reason")), allowMissingColumns=True)


def to_documents(packed: DataFrame) -> DataFrame:
    """Serialise the ``response`` struct to JSON text (column ``json``)."""
    keep = [c for c in packed.columns if c != "response"]
    return packed.select(*keep, F.to_json("response").alias("json"))
