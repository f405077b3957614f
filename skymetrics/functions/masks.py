"""Small sets as bits of a whole number.

The hours of a day (24) and the days of a month (31) fit a number.  Such a set is
built by ``bit_or``, an ordinary aggregate: it is computed partially in each map
task, and sets of separate parts (tasks, files, micro-batches) are united by
``bit_or`` again.  Counting distinct hours or days so takes one exchange, and
the parts can be kept in a table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOURS = 24
WHOLE_DAY = (1 << HOURS) - 1


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), place)


def hours(time: Column | str) -> Column:
    """Aggregate: the hours of the times, bit 0 for hour 0; NULL without any."""
    return F.bit_or(_bit(F.hour(time)))


def days_of_month(date: Column | str) -> Column:
    """Aggregate: the days of the month of the dates, bit 0 for the first; NULL without any."""
    return F.bit_or(_bit(F.dayofmonth(date) - 1))


def size(mask: Column | str) -> Column:
    """How many members a set has; none if it is NULL."""
    return F.coalesce(F.bit_count(mask), F.lit(0))


def members(mask: Column | str, n: int, inside: bool = True) -> Column:
    """The places below ``n`` that are members, or those that are none, as an array."""
    mask = F.coalesce(F.col(mask) if isinstance(mask, str) else mask, F.lit(0))
    places = F.sequence(F.lit(0), F.lit(n - 1))
    return F.filter(places, lambda x: (mask.bitwiseAND(_bit(x)) != 0) == F.lit(inside))
