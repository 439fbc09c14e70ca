"""Casts that never fail a job: what does not convert becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The number spellings a lenient text-to-number reader accepts.
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INFINITE_TEXT = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text to double; NULL for anything that is not a finite number.

    The pattern keeps out spellings such as `1d` that a bare cast accepts.
    """
    text = _col(c).cast("string")
    value = F.trim(text).try_cast("double")
    return F.when(text.rlike(NUMBER_TEXT) & (F.abs(value) < F.lit(float("inf"))), value)


def is_infinite_text(c: Column | str) -> Column:
    return _col(c).cast("string").rlike(INFINITE_TEXT)


def to_int(c: Column | str) -> Column:
    """Whole number from text or a number: '3.0' is 3, '2 (4)' is NULL."""
    return to_number(c).try_cast("int")


def to_float(c: Column | str) -> Column:
    return to_number(c).try_cast("float")


def to_day(c: Column | str) -> Column:
    return _col(c).try_cast("date")


def to_moment(c: Column | str) -> Column:
    return _col(c).try_cast("timestamp")


def whole_or_zero(c: Column | str) -> Column:
    """Lenient numeric coercion: unreadable or missing is 0, fractions are cut."""
    return F.coalesce(to_number(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def iso_text(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss")
