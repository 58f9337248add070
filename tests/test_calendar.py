from datetime import date

from dateutil.easter import easter
from pyspark.sql import functions as F

from millrace.functions.calendar import easter_sunday, holidays
from millrace.functions.scalars import lbs_to_kg, month_from_text, ratio, within_limit
from millrace.plans import dims


def test_easter_of_four_centuries(spark):
    rows = spark.range(1700, 2200).select(F.col("id").cast("int").alias("y"), easter_sunday(F.col("id").cast("int")).alias("e"))
    assert all(r.e == easter(r.y) for r in rows.collect())


def test_calendar_spot_days(spark):
    days = {r.date_id: r for r in dims.dim_date(spark).collect()}
    assert len(days) == 730
    for day in (date(2026, 1, 1), date(2026, 4, 6), date(2026, 5, 1), date(2026, 12, 25), date(2026, 6, 4)):
        assert days[day].is_polish_public_holiday and not days[day].is_business_day
    new_year = days[date(2027, 1, 1)]
    assert (new_year.year, new_year.week_iso, new_year.day_name, new_year.day_of_week) == (2027, 53, "Friday", 5)
    listed = holidays(spark.createDataFrame([(2026,), (2027,)], "year int")).collect()
    assert {r.holiday for r in listed} == {d for d, r in days.items() if r.is_polish_public_holiday}


def test_scalars(spark):
    row = spark.range(1).select(
        month_from_text(F.lit("2026-02")).alias("m"),
        month_from_text(F.lit("soon")).alias("bad"),
        lbs_to_kg(F.lit("10").cast("decimal(18,6)")).cast("decimal(12,4)").alias("kg"),
        within_limit(F.lit(1_000_001)).alias("over"),
        within_limit(F.lit(1_000_000)).alias("edge"),
        ratio(F.lit(1), F.lit(0)).alias("none"),
        ratio(F.lit(-1), F.lit(20000)).alias("tie"),
    ).first()
    assert (row.m, row.bad, row.over, row.edge, row.none) == (date(2026, 2, 1), None, None, 1_000_000, None)
    assert (float(row.kg), float(row.tie)) == (4.5359, -0.0001)
