"""Small column helpers: lenient parsing, dates, keys, vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_comma(text: Column) -> Column:
    """``'1,5'`` to 1.5; unreadable text to null."""
    return F.regexp_replace(text, ",", ".").try_cast("double")


def lenient_double(text: Column) -> Column:
    """Text to double; unreadable text (blanks included) to null."""
    return F.trim(text).try_cast("double")


def lenient_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def parse_date(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date by format; unreadable text to null."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def hash_key(*columns: Column) -> Column:
    """Surrogate key of natural keys. ``concat_ws`` skips nulls, so reject null keys first."""
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in columns]))


def moment_id(ts: Column) -> Column:
    """Microseconds since 1970 of a zoneless timestamp; the session zone plays no part."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = (days * 24 + F.hour(ts)) * 3600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Rounded ratio, null where the denominator is zero."""
    return F.round(F.try_divide(numerator, denominator), digits)


def first_day_of_month(date: Column) -> Column:
    return F.trunc(date, "month")


def first_day_of_week(date: Column) -> Column:
    return F.trunc(date, "week")


def weekday_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def arg_max(values: Column) -> Column:
    """Zero-based position of the first largest element."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def larger_of(a: Column, b: Column) -> Column:
    """``a`` where it exceeds ``b``, else ``b`` (a null comparison gives ``b``)."""
    return F.when(a > b, a).otherwise(b)
