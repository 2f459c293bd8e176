"""Small column helpers shared by the models and marts. All are built-in expressions."""

from __future__ import annotations

from datetime import timedelta
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: first and last hour of each named part of the day; every other hour is night ---
DAY_PARTS = (("morning", 6, 11), ("afternoon", 12, 16), ("evening", 17, 21))
OTHER_DAY_PART = "night"


def interleaved(*ranks: Column, bits: int = 9) -> Column:
    """One number whose bits are those of the ranks in turn, so that near numbers are near in every rank.

    Ranks are whole numbers from 0 to ``2^bits - 1``; others count as the nearest of these, null as 0.
    """
    top = (1 << bits) - 1
    held = [F.coalesce(F.least(F.greatest(rank.cast("long"), F.lit(0)), F.lit(top)), F.lit(0)) for rank in ranks]
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for place, rank in enumerate(held):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(held) + len(held) - 1 - place))
    return key


def round2(value: Column) -> Column:
    """Round a double to cents as ``round(x * 100) / 100``.

    Spark's own ``round(double, 2)`` goes through the decimal text of the number (1.005 -> 1.01),
    SQL engines scale and round the binary value (1.005 -> 1.0); the marts follow the latter.
    """
    return F.round(value * F.lit(100.0)) / F.lit(100.0)


def hundredths(scaled: Column) -> Column:
    """``round(scaled) / 100``, halves away from zero, for values worked out on every row.

    Gives what ``round`` gives without its detour through a decimal text. ``scaled`` is used four
    times, so pass a plain column and not the expression behind it.
    """
    nearest = F.rint(scaled)
    is_half = F.abs(scaled - nearest) == F.lit(0.5)
    return F.when(is_half, scaled + F.signum(scaled) * F.lit(0.5)).otherwise(nearest) / F.lit(100.0)


# Values from 1e-6 to 1e15 are added as whole numbers and billionths.
_LEAST, _MOST = 1e-6, 1e15


def _fixed(value: Column) -> Column:
    """Whether a value is added in whole numbers and billionths; NaN, infinities and others are not."""
    size = F.abs(value)
    return (size < F.lit(_MOST)) & ((size >= F.lit(_LEAST)) | (size == F.lit(0.0)))


def halved_sum(part: Column, bits: int) -> Column:
    """Sum of whole numbers that may exceed 64 bits: the halves above and below ``bits`` are added apart."""
    high = F.sum(F.shiftright(part, bits)).cast("decimal(20,0)") * F.lit(Decimal(1 << bits))
    return high + F.sum(part.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))).cast("decimal(20,0)")


def fixed_sum(value: Column) -> Column:
    """The sum of the values from 1e-6 to 1e15 (either sign) and zeros as ``decimal(38,9)``; null if there are none.

    Each value counts as its whole part and its billionths, rounded, so the resolution is 5e-10 a value. Both parts are added in two
    halves of 15 to 26 bits, which leaves room for more than 1e11 rows a group however large their values, and
    no order of addition, partitioning or repeated task can change the sum.
    """
    value = value.cast("double")
    kept = F.when(_fixed(value), value)
    whole = F.floor(kept)
    billionths = F.rint((kept - whole) * F.lit(1e9)).cast("long")

    small = halved_sum(billionths, 15).cast("decimal(25,0)") * F.lit(Decimal("0.000000001"))
    return (halved_sum(whole, 24).cast("decimal(28,0)") + small.cast("decimal(25,9)")).cast("decimal(38,9)")


def other_sum(value: Column) -> Column:
    """The sum of the values ``fixed_sum`` leaves out, as a double; null if there are none."""
    value = value.cast("double")
    return F.sum(F.when(~_fixed(value), value))


def joined_sum(fixed: Column, other: Column) -> Column:
    """A total as a double out of both sums; each is used twice."""
    return F.when(other.isNull(), fixed.cast("double")).otherwise(F.coalesce(fixed.cast("double"), F.lit(0.0)) + other)


def exact_sum(value: Column) -> Column:
    """Sum of doubles as a double that does not depend on the order of addition; null without values.

    Exact to 5e-10 a value for sizes from 1e-6 to 1e15. Smaller and larger values, NaN and infinities are added
    to the result as doubles.
    """
    return joined_sum(fixed_sum(value), other_sum(value))


def total2(value: Column) -> Column:
    """Sum with two decimals."""
    return round2(exact_sum(value))


def mean2(value: Column) -> Column:
    """Average of the values that are not null, with two decimals."""
    return round2(F.try_divide(exact_sum(value), F.count(value).cast("double")))


def whole_mean2(value: Column) -> Column:
    """Average of the whole numbers that are not null, with two decimals; their plain sum is exact."""
    return round2(F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double")))


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole`` with two decimals; null when ``whole`` is zero or null."""
    return round2(F.try_divide(part * F.lit(100.0), whole))


def month_start(day: Column) -> Column:
    """First day of the month as a date (``date_trunc`` would give a timestamp)."""
    return F.trunc(day, "month")


def whole_minutes(start: Column, end: Column) -> Column:
    """Exact difference in minutes, truncated toward zero.

    Dividing intervals is plain integer arithmetic on zone-free timestamps; ``timestamp_diff``
    would take them through the session time zone.
    """
    return F.call_function("div", end - start, F.lit(timedelta(minutes=1)))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Difference of the two instants after each is floored to the second."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def day_part(hour: Column) -> Column:
    """Name of the part of the day an hour (0-23) falls in; a null hour counts as night."""
    first, *others = DAY_PARTS
    chain = F.when(hour.between(first[1], first[2]), first[0])
    for name, low, high in others:
        chain = chain.when(hour.between(low, high), name)
    return chain.otherwise(OTHER_DAY_PART)


def ratio_when_positive(part: Column, base: Column) -> Column:
    """``part / base`` where ``base`` is positive, else null."""
    return F.when(base > 0, part / base)
