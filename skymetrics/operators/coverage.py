"""Coverage of landed days (S7): which (Station, Date) in the expected range
have no observation at all.

Every expected day is checked, not only the two ends of the range.  The
input is read once: its distinct (Station, Date) are ordered per station and
each landed day looks at the next one (``lead``); the days strictly between
two landed days, before the first and after the last (when the range is
given) are generated with ``sequence``.  Only distinct days reach the window,
so its size per station is bounded by the calendar, not by the rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import masks


def landed_days(obs: DataFrame) -> DataFrame:
    return obs.select("Station", F.to_date("Time").alias("Date")).where(F.col("Date").isNotNull()).distinct()


def missing_days(obs: DataFrame, start: dt.date | None = None, end: dt.date | None = None,
                 stations: DataFrame | None = None) -> DataFrame:
    """(Station, Date) expected but absent.  Without ``start``/``end`` each
    station's own first and last landed day bound its range.  ``stations``: see
    ``missing_of_landed``."""
    return missing_of_landed(landed_days(obs), start, end, stations)


def missing_files(files: DataFrame, start: dt.date | None = None, end: dt.date | None = None,
                  stations: DataFrame | None = None) -> DataFrame:
    """S7 on a landing folder: the station-days with no landed file.

    ``files`` is ``sources.csv_files.landed_files(...)``; only file paths are
    used, as the downloader's skip check does, but every day is checked.
    """
    landed = files.select("Station", "Date").where(F.col("Station").isNotNull() & F.col("Date").isNotNull()).distinct()
    return missing_of_landed(landed, start, end, stations)


def _days(first: Column, last: Column) -> Column:
    """The dates first..last as an array (empty when first > last)."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def _gap_arrays(landed: DataFrame, start: dt.date | None, end: dt.date | None,
                stations: DataFrame | None = None) -> DataFrame:
    """(Station, Missing): per landed day, the array of missing days that
    follow it (and, for a station's first day, precede it); every day of the
    range for each of ``stations`` that has none landed."""
    if stations is not None and (start is None or end is None):
        raise ValueError("a range is needed to tell what a station without landed days misses")
    w = Window.partitionBy("Station").orderBy("Date")
    date, prev, nxt = F.col("Date"), F.lag("Date").over(w), F.lead("Date").over(w)
    lo = F.lit(start) if start else None
    hi = F.lit(end) if end else None

    def clamp_lo(c: Column) -> Column:
        return F.greatest(c, lo) if lo is not None else c

    def clamp_hi(c: Column) -> Column:
        return F.least(c, hi) if hi is not None else c

    # days after this landed day, up to the next one (or the end of the range)
    after_last = hi if hi is not None else date
    after = _days(clamp_lo(F.date_add(date, 1)), clamp_hi(F.coalesce(F.date_sub(nxt, 1), after_last)))
    # days from the start of the range up to the first landed day
    before = (
        F.when(prev.isNull(), _days(lo, clamp_hi(F.date_sub(date, 1)))).otherwise(F.array().cast("array<date>"))
        if lo is not None else F.array().cast("array<date>")
    )
    gaps = landed.select("Station", F.concat(before, after).alias("Missing"))
    if stations is None:
        return gaps
    expected = stations.select("Station").distinct()
    never = expected.join(landed.select("Station").distinct(), "Station", "left_anti")
    never = never.select("Station", _days(lo, hi).alias("Missing"))
    return gaps.join(expected, "Station", "left_semi").unionByName(never)


def missing_of_landed(landed: DataFrame, start: dt.date | None = None, end: dt.date | None = None,
                      stations: DataFrame | None = None) -> DataFrame:
    """Expected (Station, Date) minus the distinct ``landed`` days.

    The range is [start, end]; without them each station's own first and last
    landed day bound it.  A station whose landed days all fall outside the
    given range misses every day of it.  ``stations`` (column Station) names the
    stations to answer for; one that was never landed misses the whole range,
    which then has to be given.
    """
    gaps = _gap_arrays(landed, start, end, stations)
    return gaps.select("Station", F.explode("Missing").alias("Date"))


def is_complete(obs: DataFrame, start: dt.date, end: dt.date, stations: DataFrame | None = None) -> DataFrame:
    """Per station: MissingDays in [start, end] and Complete (none missing).

    Same single pass as ``missing_days``: the gap sizes are summed per station,
    so every station with a landed day gets a row, complete ones with 0; with
    ``stations`` each of those gets one, landed or not.
    """
    gaps = _gap_arrays(landed_days(obs), start, end, stations)
    return (
        gaps.groupBy("Station").agg(F.sum(F.size("Missing")).alias("MissingDays"))
        .withColumn("Complete", F.col("MissingDays") == 0)
    )


def hour_masks(obs: DataFrame) -> DataFrame:
    """(Station, Date, HourMask): which hours of each landed day have an observation, as 24 bits.

    Masks of separate parts of the input are united by ``bit_or``.  Hours are
    those of the local wall clock: the day a clock is put forward has 23.
    """
    landed = obs.filter(F.col("Time").isNotNull())
    return landed.groupBy("Station", F.to_date("Time").alias("Date")).agg(masks.hours("Time").alias("HourMask"))


def hour_coverage(hour_masks: DataFrame) -> DataFrame:
    """(Station, Date, HourMask, Hours, Complete) of each landed day; a half-empty one is not complete."""
    hours = masks.size("HourMask")
    return hour_masks.select("Station", "Date", "HourMask", hours.alias("Hours"), (hours == masks.HOURS).alias("Complete"))


def missing_hours(obs: DataFrame, start: dt.date | None = None, end: dt.date | None = None,
                  stations: DataFrame | None = None) -> DataFrame:
    """(Station, Date, Hour) expected but absent: the hours that landed days lack, and
    all hours of the days that ``missing_days`` lists for the same arguments.

    One aggregate of the input gives both: the masks are its distinct days.
    """
    days = hour_masks(obs)
    lost = missing_of_landed(days.select("Station", "Date"), start, end, stations).withColumn("HourMask", F.lit(0))
    if start is not None:
        days = days.filter(F.col("Date") >= F.lit(start))
    if end is not None:
        days = days.filter(F.col("Date") <= F.lit(end))
    if stations is not None:
        days = days.join(stations.select("Station").distinct(), "Station", "left_semi")
    absent = masks.members("HourMask", masks.HOURS, inside=False)
    return days.unionByName(lost).select("Station", "Date", F.explode(absent).alias("Hour"))
