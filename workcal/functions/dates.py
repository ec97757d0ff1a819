"""Date expressions. All are built-in Spark functions, none raises on bad input."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SUNDAY, SATURDAY = 1, 7


def day_of_week(date: Column) -> Column:
    """1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(date)


def is_weekend(date: Column) -> Column:
    return F.dayofweek(date).isin(SUNDAY, SATURDAY)


def load_stamp(moment: dt.datetime) -> Column:
    """A load's time as a timestamp; without a zone it is taken as UTC, in every layer
    and whatever the zones of session and process."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    since = moment - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return F.timestamp_micros(F.lit(since // dt.timedelta(microseconds=1)).cast("long"))


def parse_date(text: Column) -> Column:
    """Date of ``yyyy-[M]M-[d]d`` text, NULL when it is none."""
    # Spark alone would also take a year, a month, or a date with more text behind it.
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"), F.try_to_date(text))


def parse_padded_date(text: Column) -> Column:
    """Date of zero-padded ``yyyy-MM-dd`` text, NULL when it is none."""
    return F.try_to_date(text, "yyyy-MM-dd")


def fixed_date(year: Column, month: Column, day: Column) -> Column:
    """Calendar date, NULL for a day the month does not have (29 February)."""
    found = F.date_add(F.make_date(year, month, F.lit(1)), day - 1)
    return F.when(F.month(found) == month, found)


def easter_sunday(year: str) -> Column:
    """Gregorian Easter Sunday of a year, given as a column name or SQL expression.

    The anonymous (Meeus/Jones/Butcher) algorithm, as one SQL expression: days
    from 22 March to the paschal full moon, and on to the next Sunday.
    """
    y = f"CAST({year} AS INT)"
    century, in_century = f"({y} div 100)", f"({y} % 100)"
    moon_shift = f"(({century} - ({century} + 8) div 25 + 1) div 3)"
    epact = f"((19 * ({y} % 19) + {century} - {century} div 4 - {moon_shift} + 15) % 30)"
    to_sunday = (
        f"((32 + 2 * ({century} % 4) + 2 * ({in_century} div 4) - {epact} - {in_century} % 4) % 7)"
    )
    correction = f"(({y} % 19 + 11 * {epact} + 22 * {to_sunday}) div 451)"
    days = f"CAST({epact} + {to_sunday} - 7 * {correction} AS INT)"
    return F.expr(f"date_add(make_date({y}, 3, 22), {days})")
