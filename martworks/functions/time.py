"""Dates, calendar differences and run parameters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def trunc_week(c: Column) -> Column:
    """Monday of the week."""
    return F.trunc(c, "week")


def trunc_month(c: Column) -> Column:
    return F.trunc(c, "month")


def to_second(c: Column) -> Column:
    return F.date_trunc("second", c)


def date_parts(c: Column) -> dict[str, Column]:
    """Year, month, day, time-of-day text and date of a timestamp."""
    return {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "time": F.date_format(c, "HH:mm:ss"),
        "date": F.to_date(c),
    }


def local_time(ts: Column, zone: Column) -> Column:
    """UTC wall time to the wall time of `zone` (timestamps without zone)."""
    return F.convert_timezone(F.lit("UTC"), zone, ts.cast("timestamp_ntz"))


def now_epoch() -> Column:
    return F.unix_timestamp()


def _seconds_of_day(c: Column) -> Column:
    return (F.hour(c) * 3600 + F.minute(c) * 60).cast("decimal(20,6)") + F.extract(F.lit("SECOND"), c)


def wall_seconds(c: Column) -> Column:
    """Seconds since 1970 of a wall time, exact to the microsecond."""
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date"))
    return (days.cast("decimal(10,0)") * 86400 + _seconds_of_day(c)).cast("decimal(20,6)")


def calendar_age(end: Column, start: Column) -> dict[str, Column]:
    """Calendar difference end - start as whole months, days and seconds.

    Counts full months back from the later field, borrowing days from the
    month of the earlier one; a negative difference has all parts negative.
    """
    negative = end < start
    late = F.when(negative, start).otherwise(end)
    early = F.when(negative, end).otherwise(start)
    sign = F.when(negative, F.lit(-1)).otherwise(F.lit(1))
    late_tod, early_tod = _seconds_of_day(late), _seconds_of_day(early)
    short_day = (late_tod < early_tod).cast("int")
    months = (F.year(late) - F.year(early)) * 12 + F.month(late) - F.month(early)
    days = F.dayofmonth(late) - F.dayofmonth(early) - short_day
    borrowed = days < 0
    seconds = late_tod - early_tod + short_day * F.lit(86400).cast("decimal(20,6)")
    return {
        "months": sign * (months - borrowed.cast("int")),
        "days": sign * F.when(borrowed, days + F.dayofmonth(F.last_day(early))).otherwise(days),
        "seconds": (sign * seconds).cast("decimal(20,6)"),
    }


def calendar_partition(c: Column, active_months: int, active_years: int, as_of: dt.date) -> Column:
    """Partition label by age: each day while recent, then month, then year."""
    ref = F.lit(as_of.isoformat()).cast("date")
    month_age = (F.year(ref) - F.year(c)) * 12 + F.month(ref) - F.month(c)
    year_age = F.year(ref) - F.year(c)
    return (
        F.when(year_age >= active_years, F.trunc(c, "year"))
        .when(month_age >= active_months, F.trunc(c, "month"))
        .otherwise(F.to_date(c))
    )


def run_dates(date: str, depth: int) -> list[str]:
    """The `depth` ISO dates which end at `date`, newest first."""
    last = dt.date.fromisoformat(date)
    return [(last - dt.timedelta(days=back)).isoformat() for back in range(depth)]
