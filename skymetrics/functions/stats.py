"""Exact sums and means of measures, whatever order rows are added in.

A value is taken as the decimal number that its shortest text names.  One with
at most ``DIGITS`` digits after the point, which is what stations report, is a
whole number of millionths and summed in two long parts, inside generated code
and without overflow; only any other value is summed as a DECIMAL, to
``REST_DIGITS`` digits.  Parts of sums are DECIMAL and merge exactly; a sum or
mean becomes a double once, when it is given out.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS, REST_DIGITS = 6, 12
#: parts and sums of measures; adding two of them keeps every digit
EXACT = f"decimal(36,{REST_DIGITS})"
# whole numbers up to here are exact as doubles; the low part of one has this many bits
_WHOLE, _LOW_BITS = float(1 << 53), 26
# resolution of measures that are computed in binary
_BINARY_BITS = 40


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sum_whole(n: Column) -> Column:
    """Exact SUM of whole numbers below 2**53 in size as a DECIMAL, in two parts that cannot overflow."""
    high = F.sum(F.shiftright(n, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(n.bitwiseAND(F.lit((1 << _LOW_BITS) - 1).cast("long"))).cast("decimal(20,0)")
    return high * F.lit(Decimal(1 << _LOW_BITS)) + low


def exact_parts(c: Column | str) -> Column:
    """SUM of a measure as an ``EXACT`` DECIMAL that merges; NULL when every value is NULL."""
    x = _col(c).cast("double")
    scaled = F.rint(x * float(10**DIGITS))
    plain = (F.abs(scaled) < _WHOLE) & (scaled / float(10**DIGITS) == x)
    whole = (_sum_whole(F.when(plain, scaled.cast("long"))) * F.lit(Decimal(1).scaleb(-DIGITS))).cast(EXACT)
    rest = F.sum(F.when(~plain, x.cast(EXACT))).cast(EXACT)
    return F.coalesce((whole + rest).cast(EXACT), whole, rest)


def merged(c: Column | str) -> Column:
    """SUM of parts."""
    return F.sum(_col(c)).cast(EXACT)


def mean_of(parts: Column | str, n: Column | str) -> Column:
    """Mean from a sum's parts and the number of its values."""
    return F.try_divide(_col(parts).cast("double"), _col(n).cast("double"))


def total_of(parts: Column | str) -> Column:
    """Sum from its parts, 0 rather than NULL over no values (reference totals)."""
    return F.coalesce(_col(parts).cast("double"), F.lit(0.0))


def exact_sum(c: Column | str) -> Column:
    """SUM of a measure, NULL when every value is NULL."""
    return exact_parts(c).cast("double")


def exact_mean(c: Column | str) -> Column:
    """AVG of a measure over its non-NULL values."""
    return mean_of(exact_parts(c), F.count(_col(c)))


def binary_sum(c: Column | str) -> Column:
    """SUM, as a DECIMAL number of 2**-40, of a measure computed in binary and below 8,192 in size: same in any order."""
    return _sum_whole(F.rint(_col(c) * float(1 << _BINARY_BITS)).cast("long"))


def total(c: Column | str) -> Column:
    """SUM that is 0 rather than NULL over no values (reference totals)."""
    return total_of(exact_parts(c))


def mean_min_max(name: str, prefix: tuple[str, str, str] = ("Avg", "Min", "Max")) -> list[Column]:
    """``[Avg<name>, Min<name>, Max<name>]`` aggregate columns."""
    return [
        exact_mean(name).alias(f"{prefix[0]}{name}"),
        F.min(name).alias(f"{prefix[1]}{name}"),
        F.max(name).alias(f"{prefix[2]}{name}"),
    ]
