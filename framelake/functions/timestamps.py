"""UTC stamps, Modified Julian Dates and unit conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# MJD of 1970-01-01.
EPOCH_MJD = 40587


def utc_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd-HH:mm:ss")


def mjd(ts: Column) -> Column:
    """Days since 1858-11-17, with the time of day in whole seconds."""
    day = F.unix_date(F.to_date(ts)) + F.lit(EPOCH_MJD)
    seconds = F.second(ts).cast("double")
    hours = F.hour(ts) + F.minute(ts) / F.lit(60.0) + seconds / F.lit(3600.0)
    return day + hours / F.lit(24.0)


def mjd_text(value: Column) -> Column:
    """The double printed with 15 decimals, digit for digit.

    A double between 2^15 and 2^17 (years 1948 to 2217) is a whole number of
    2^-37 steps, so the fraction is an exact integer and its decimal digits
    follow from integer arithmetic. ``format_string`` would pad the shortest
    representation with zeros instead. Other dates would be rounded, so they give null.
    """
    whole = F.floor(value)
    steps = ((value - whole) * F.lit(float(1 << 37))).cast("decimal(12,0)")
    digits = F.round(
        steps * F.lit(5 ** 15).cast("decimal(11,0)") / F.lit(1 << 22).cast("decimal(7,0)"), 0
    ).cast("bigint")
    unit = F.lit(10 ** 15)
    text = F.concat((whole + F.when(digits >= unit, 1).otherwise(0)).cast("string"), F.lit("."),
                    F.lpad((digits % unit).cast("string"), 15, "0"))
    return F.when((value >= 1 << 15) & (value < 1 << 17), text)


def whole_kb(n_bytes: Column) -> Column:
    return F.shiftright(n_bytes.cast("bigint"), 10)


def gbps(n_bytes: Column, micros: Column) -> Column:
    return F.try_divide(n_bytes.cast("double") * F.lit(8.0), micros.cast("double")) / F.lit(1000.0)


def percent(part: Column, total: Column) -> Column:
    return F.when(total > 0, part.cast("double") * F.lit(100.0) / total).otherwise(F.lit(0.0))
