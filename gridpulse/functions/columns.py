"""Scalar column helpers: coercion, calendar fields, totals, ratios, counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from gridpulse.schemas import DECIMALS, MEASURES

# Fixed value: text form of a timestamp, fields may be unpadded (2013-1-1 0:0:0).
TIMESTAMP_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parse_timestamp(c) -> Column:
    """Text to ``timestamp_ntz``; anything off the fixed pattern becomes null.

    The cast alone would also take bare dates and zone suffixes, hence the
    guard. NTZ keeps the wall clock, whatever the session's zone is.
    """
    text = F.trim(as_column(c))
    return F.when(text.rlike(TIMESTAMP_PATTERN), text.try_cast("timestamp_ntz"))


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def is_negative(measures=MEASURES) -> Column:
    """True when any present measure is below zero; null measures do not count."""
    return any_of([F.coalesce(F.col(m) < 0, F.lit(False)) for m in measures])


def calendar(ts="timestamp") -> dict[str, Column]:
    """date, hour 0-23 and day of week 1=Sunday..7=Saturday."""
    t = as_column(ts)
    return {"date": F.to_date(t), "hour": F.hour(t), "day_of_week": F.dayofweek(t)}


def day_name(ts="timestamp") -> Column:
    """English day name; the number-to-name lookup keeps it locale independent."""
    names = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.dayofweek(as_column(ts)))


def pair_totals(decimals: int | None = None) -> dict[str, Column]:
    """total_sms and total_calls from the measures."""
    sms = F.col("sms_in") + F.col("sms_out")
    calls = F.col("call_in") + F.col("call_out")
    if decimals is not None:
        sms, calls = rounded(sms, decimals), rounded(calls, decimals)
    return {"total_sms": sms, "total_calls": calls}


def grand_total(decimals: int | None = None) -> dict[str, Column]:
    """total_activity from both totals and the internet activity."""
    total = F.col("total_sms") + F.col("total_calls") + F.col("internet_activity")
    return {"total_activity": total if decimals is None else rounded(total, decimals)}


def rounded(c, decimals: int = DECIMALS) -> Column:
    """Half-up rounding of a double, equal to ``round`` in every bit.

    ``round`` goes through a decimal object per value, which dominates a pass
    over many measures. Away from a tie the nearest whole number of the scaled
    value is the answer, and dividing it by the power of ten gives the same
    double; near a tie, and for very large values, NaN and infinity, ``round``
    decides.
    """
    x = as_column(c)
    power = F.lit(10.0 ** decimals)
    scaled = x * power
    whole = F.rint(scaled)
    clear = (F.abs(scaled - whole) < 0.49) & (F.abs(scaled) < 1e12)
    # adding 0.0 turns a negative zero into zero
    return F.when(clear, whole / power + F.lit(0.0)).otherwise(F.round(x, decimals))


def safe_ratio(numerator, denominator) -> Column:
    """Null, not an error, when the denominator is zero or null."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def percent_of(part, whole, decimals: int = 2) -> Column:
    return F.round(safe_ratio(as_column(part) * F.lit(100.0), whole), decimals)


def null_count(c) -> Column:
    return F.count_if(as_column(c).isNull())


def seconds_between(start, end) -> Column:
    """Whole seconds between two wall-clock times, whatever the session's zone.

    Built from dates and times of day: the difference functions would pass
    through instants, where a clock change in the session's zone counts.
    """
    a, b = as_column(start), as_column(end)

    def of_day(t: Column) -> Column:
        return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)

    days = F.date_diff(F.to_date(b), F.to_date(a)).cast("bigint")
    return days * 86400 + of_day(b) - of_day(a)
