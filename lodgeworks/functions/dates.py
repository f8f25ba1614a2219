"""Booking dates from day / month / year columns, without Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The span a nanosecond timestamp can hold; dates outside it count as unreadable.
FIRST_DATE, LAST_DATE = "1677-09-22", "2262-04-11"


def _int(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).try_cast("int")


def _clamp(value: Column, low: int, high: int | Column) -> Column:
    return F.greatest(F.least(value, F.lit(high) if isinstance(high, int) else high), F.lit(low))


def month_length(year: Column, month: Column) -> Column:
    """Days of the month; year and month must already be in range."""
    return F.day(F.last_day(F.make_date(year, month, F.lit(1))))


def repair_date(
    day: Column | str,
    month: Column | str,
    year: Column | str,
    *,
    years: tuple[int, int] | None = (2017, 2019),
    default_year: int = 2018,
) -> Column:
    """A valid date from possibly impossible parts; null when a part is absent or unreadable.

    A year outside ``years`` becomes ``default_year``, month and day are clamped into range (the
    day to the length of its month). With ``years=None`` the year is taken as it is, and a date
    outside the readable span gives null.
    """
    d, m, y = _int(day), _int(month), _int(year)
    known = d.isNotNull() & m.isNotNull() & y.isNotNull()
    if years is not None:
        y = F.when(y.between(*years), y).otherwise(F.lit(default_year))
    # Clamped into what make_date accepts, so that no row can raise under ANSI mode.
    safe_year = _clamp(y, 1, 9999)
    safe_month = _clamp(m, 1, 12)
    safe_day = _clamp(d, 1, month_length(safe_year, safe_month))
    date = F.make_date(safe_year, safe_month, safe_day)
    if years is None:
        known = known & (safe_year == y) & date.between(
            F.lit(FIRST_DATE).cast("date"), F.lit(LAST_DATE).cast("date")
        )
    return F.when(known, date)


def is_valid_date(day: Column | str, month: Column | str, year: Column | str) -> Column:
    """True when the parts name a real calendar day; false for absent parts."""
    d, m, y = _int(day), _int(month), _int(year)
    last = month_length(_clamp(y, 1, 9999), _clamp(m, 1, 12))
    return F.coalesce(
        y.between(1, 9999) & m.between(1, 12) & (d >= 1) & (d <= last), F.lit(False)
    )


def strict_date(day: Column | str, month: Column | str, year: Column | str) -> Column:
    """The date when the parts name a real calendar day in the readable span, else null."""
    exact = repair_date(day, month, year, years=None)
    return F.when(is_valid_date(day, month, year), exact)


def parse_date(day: Column | str, month: Column | str, year: Column | str) -> Column:
    """Join the parts as text and parse them; an impossible date fails the job."""
    parts = [F.col(c) if isinstance(c, str) else c for c in (day, month, year)]
    text = F.concat_ws("-", *[p.cast("string") for p in parts])
    return F.to_date(F.when(parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull(), text), "d-M-yyyy")
