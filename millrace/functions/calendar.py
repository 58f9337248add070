"""Business calendar: Easter, Polish public holidays and the date dimension, as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Public holidays (month, day), and moveable ones as days after Easter Sunday.
FIXED_HOLIDAYS = [(1, 1), (1, 6), (5, 1), (5, 3), (8, 15), (11, 1), (11, 11), (12, 25), (12, 26)]
EASTER_OFFSETS = [0, 1, 60]


def _div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("int")


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by Gauss's method in its century-corrected form.

    The full moon is found first (golden number, solar and lunar century corrections, the two
    short-month exceptions), then the Sunday after it.
    """
    golden = year % 19
    century = _div(year, 100)
    solar = century - _div(century, 4)
    lunar = _div(century * 8 + 13, 25)
    moon = (golden * 19 + solar - lunar + 15) % 30
    moon = moon - F.when((moon == 29) | ((moon == 28) & (golden > 10)), 1).otherwise(0)
    full_moon = F.date_add(F.make_date(year, F.lit(3), F.lit(21)), moon)
    return F.date_add(full_moon, F.lit(7) - (F.weekday(full_moon) + 1) % 7)


def holidays(years: DataFrame, year: str = "year") -> DataFrame:
    """All public holidays of the given years, one row per date."""
    y = F.col(year)
    easter = easter_sunday(y)
    dates = [F.make_date(y, F.lit(m), F.lit(d)) for m, d in FIXED_HOLIDAYS]
    dates += [F.date_add(easter, n) for n in EASTER_OFFSETS]
    return years.select(F.explode(F.array_distinct(F.array(*dates))).alias("holiday")).distinct()


def is_holiday(day: Column) -> Column:
    """Holiday test on the date alone; equal to looking it up in `holidays`."""
    easter = easter_sunday(F.year(day))
    month_day = F.month(day) * 100 + F.dayofmonth(day)
    offset = F.datediff(day, easter)
    return month_day.isin([m * 100 + d for m, d in FIXED_HOLIDAYS]) | offset.isin(EASTER_OFFSETS)


def calendar(days: DataFrame, day: str = "date_id") -> DataFrame:
    """The date dimension over a frame of distinct dates."""
    d = F.col(day)
    iso_day = F.weekday(d) + 1
    weekend = iso_day >= 6
    holiday = is_holiday(d)
    return days.select(
        d.alias("date_id"),
        iso_day.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        weekend.alias("is_weekend"),
        (~weekend & ~holiday).alias("is_business_day"),
        F.weekofyear(d).alias("week_iso"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        holiday.alias("is_polish_public_holiday"),
    )


def days_between(bounds: DataFrame, low: str = "low", high: str = "high") -> DataFrame:
    """All dates between two bounds (one row in, one row per day out)."""
    return bounds.select(
        F.explode(F.sequence(F.col(low), F.col(high), F.expr("interval 1 day"))).alias("date_id")
    )
