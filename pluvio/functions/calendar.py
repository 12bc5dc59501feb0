"""Calendar functions over date columns: day of year, lead months, unit conversion, windows of days in the year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def doy(time: Column, leap_mode: str = "reference") -> Column:
    """Day of year on a 365-day calendar.

    "reference" takes one from every day of a year divisible by 4, so that its first of January is 0; "correct" does so
    after 29 February of leap years only, so that 29 February shares day 59 with the 28th's successor, 1 March with day 60.
    """
    day, year = F.dayofyear(time), F.year(time)
    if leap_mode == "reference":
        return day - F.when(year % 4 == 0, 1).otherwise(0)
    if leap_mode == "correct":
        leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
        return day - F.when(leap & (day > 59), 1).otherwise(0)
    raise ValueError(f"leap_mode {leap_mode!r}")


def month_begin(time: Column) -> Column:
    return F.trunc(time, "MM")


def month_end(time: Column) -> Column:
    return F.last_day(time)


def valid_month(init: Column, step: Column, sign: int = 1) -> Column:
    """The month that a lead step points to (sign 1), or the start month of a valid month (sign -1)."""
    return F.add_months(init, sign * step)


def days_in_month(time: Column) -> Column:
    return F.day(F.last_day(time))


def monthly_from_daily_rate(value: Column, time: Column) -> Column:
    """mm/day to mm/month."""
    return value * days_in_month(time)


def monthly_from_rate(value: Column, init: Column, step: Column, units: str = "m s**-1") -> Column:
    """A forecast rate to mm in the valid month: metres a second, or mm/day passed through."""
    scale = {"m s**-1": 1000.0 * 86400.0, "mm/day": 1.0}
    if units not in scale:
        raise ValueError(f"units {units!r}")
    return value * F.lit(scale[units]) * days_in_month(valid_month(init, step))


def kelvin_to_celsius(value: Column) -> Column:
    return value - F.lit(273.15)


def metres_to_millimetres(value: Column) -> Column:
    return value * F.lit(1000.0)


def period_label(init: Column, step: Column, months: int = 3) -> Column:
    """Name of the months that a period ending at this step covers, such as "January-March"."""
    last = valid_month(init, step)
    if months == 1:
        return F.date_format(last, "MMMM")
    return F.concat_ws("-", F.date_format(F.add_months(last, -(months - 1)), "MMMM"), F.date_format(last, "MMMM"))


def drop_leap_days(df: DataFrame, time: str = "time") -> DataFrame:
    return df.where(~((F.month(time) == 2) & (F.day(time) == 29)))


def around_days(targets: DataFrame, buffer: int, years: tuple[int, int], time: str = "time") -> DataFrame:
    """(time, day): for every target date the days within `buffer` of its calendar day in every year of the range.

    29 February stands for 28 February in other years. The small side is expanded, so that facts join it by equality.
    """
    year = F.explode(F.sequence(F.lit(years[0]), F.lit(years[1])))
    centred = targets.select(time).distinct().select(time, year.alias("_year"))
    february = (F.month(time) == 2) & (F.day(time) == 29)
    centre = F.coalesce(F.try_make_timestamp("_year", F.month(time), F.day(time), F.lit(0), F.lit(0), F.lit(0)).cast("date"), F.when(february, F.make_date("_year", F.lit(2), F.lit(28))))
    return centred.select(time, F.explode(F.transform(F.sequence(F.lit(-buffer), F.lit(buffer)), lambda i: F.date_add(centre, i))).alias("day"))


def require_past(cycle, today) -> None:
    """A cycle date after today is an error."""
    if cycle > today:
        raise ValueError(f"cycle date {cycle} is in the future")
