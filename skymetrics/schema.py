"""Observation data model.

One row per station-hour.  ``Time`` is station-local wall-clock time without an
offset, so it is kept as ``TIMESTAMP_NTZ``: re-reading it through a session time
zone would shift or drop the DST-gap hours.
"""

from pyspark.sql import types as T

STATION = "Station"
TIME = "Time"

# Measures in the order the landed CSV files carry them.
MEASURES = (
    "Temperature",
    "Humidity",
    "Precipitation",
    "WeatherCode",
    "WindSpeed",
    "WindDirection",
    "Pressure",
)

# Measures that are continuous quantities (everything but the WMO code).
CONTINUOUS = tuple(m for m in MEASURES if m != "WeatherCode")

# Columns derived from Time by ``functions.calendar.with_calendar``.
CALENDAR = ("Hour", "Date", "Year", "Month")

OBSERVATION = T.StructType(
    [
        T.StructField(STATION, T.StringType(), True),
        T.StructField(TIME, T.TimestampNTZType(), True),
        T.StructField("Temperature", T.DoubleType(), True),
        T.StructField("Humidity", T.DoubleType(), True),
        T.StructField("Precipitation", T.DoubleType(), True),
        T.StructField("WeatherCode", T.IntegerType(), True),
        T.StructField("WindSpeed", T.DoubleType(), True),
        T.StructField("WindDirection", T.DoubleType(), True),
        T.StructField("Pressure", T.DoubleType(), True),
    ]
)

# Header of a landed daily CSV file (no Station column: the station is the
# directory the file sits in).
CSV_COLUMNS = (TIME,) + MEASURES

TARGET_TYPES = {f.name: f.dataType for f in OBSERVATION.fields}
