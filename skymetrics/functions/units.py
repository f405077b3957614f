"""Unit and time conversions the weather service applies on request."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Conversion factors of the service's alternative units.
KMH_PER_MS = 3.6
KM_PER_MILE = 1.609344
KMH_PER_KNOT = 1.852
MM_PER_INCH = 25.4


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def celsius_to_fahrenheit(c: Column | str) -> Column:
    return _col(c) * 9.0 / 5.0 + 32.0


def kmh_to_ms(c: Column | str) -> Column:
    return _col(c) / KMH_PER_MS


def kmh_to_mph(c: Column | str) -> Column:
    return _col(c) / KM_PER_MILE


def kmh_to_knots(c: Column | str) -> Column:
    return _col(c) / KMH_PER_KNOT


def mm_to_inch(c: Column | str) -> Column:
    return _col(c) / MM_PER_INCH


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_seconds(local_time: Column | str, utc_offset_seconds: Column | str | int) -> Column:
    """Station-local NTZ time -> UNIX seconds (GMT), the service's ``unixtime`` form."""
    off = F.lit(utc_offset_seconds) if isinstance(utc_offset_seconds, int) else _col(utc_offset_seconds)
    return F.timestamp_diff("SECOND", _epoch_ntz(), _col(local_time)) - off


def local_time(epoch: Column | str, utc_offset_seconds: Column | str | int) -> Column:
    """UNIX seconds (GMT) plus the response's ``utc_offset_seconds`` -> local NTZ time.

    Pure arithmetic on NTZ, so the session time zone never enters.
    """
    off = F.lit(utc_offset_seconds) if isinstance(utc_offset_seconds, int) else _col(utc_offset_seconds)
    return F.timestamp_add("SECOND", _col(epoch) + off, _epoch_ntz())
