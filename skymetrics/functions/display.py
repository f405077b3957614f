"""Display formatting of statistics (X5): one decimal plus a unit suffix.

Spark's ``format_string`` rounds exact ties half-up (``0.25 -> 0.3``) where
Python and C round half-even; use it for display only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unit suffixes shown after each kind of statistic.
SUFFIX = {
    "Temperature": "°C",
    "Humidity": "%",
    "Precipitation": " mm",
    "Pressure": " hPa",
    "WindSpeed": " km/h",
}


def one_decimal(c: Column | str, suffix: str = "") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.format_string("%.1f" + suffix.replace("%", "%%"), c)


def format_columns(df: DataFrame, suffixes: dict[str, str]) -> DataFrame:
    """Replace each named numeric column by its one-decimal text."""
    return df.withColumns({name: one_decimal(name, s) for name, s in suffixes.items()})
