import datetime as dt

import pytest

from demand_engine.functions import calendar
from demand_engine.operators.holidays import add_holidays, federal_holidays


def test_record_of_a_monday(rows):
    r = calendar.temporal_record(rows([("2024-01-01 12:00:00",)], "ts timestamp"), "ts").first()
    assert (r.hour, r.day_of_week, r.month, r.day_of_month, r.is_weekend, r.is_holiday) == (12, 0, 1, 1, 0, 0)


def test_sunday(rows):
    df = rows([("2024-12-29 05:30:00",), ("2024-12-30 00:00:00",)], "ts timestamp")
    sunday, monday = calendar.calendar_parts(df, "ts").orderBy("ts").collect()
    assert (sunday.day_of_week, sunday.is_weekend, sunday.week_of_year) == (1, 1, 52)
    assert (monday.day_of_week, monday.is_weekend, monday.week_of_year) == (2, 0, 1)


def test_cyclic_is_on_the_circle(spark):
    sin, cos = calendar.cyclic("id", 24)
    for r in spark.range(24).select(sin.alias("s"), cos.alias("c")).collect():
        assert r.s**2 + r.c**2 == pytest.approx(1.0)


def test_axis_has_both_ends(spark):
    axis = calendar.hour_axis(spark, "2023-07-22 00:00:00", "2023-11-22 23:59:59")
    assert axis.count() == 2976


def test_weekday_bases(spark):
    got = [r[0] for r in spark.range(1, 8).select(calendar.sun1_to_mon0("id")).collect()]
    assert got == [6, 0, 1, 2, 3, 4, 5]


def test_unknown_holiday_rule():
    with pytest.raises(ValueError):
        calendar.is_holiday("ts", "lunar")


def test_federal_calendar(spark):
    days = {r.holiday_date: r.holiday for r in federal_holidays(spark, 2021, 2024).collect()}
    named = {
        (2024, 1, 15): "Martin Luther King Jr. Day",
        (2024, 2, 19): "Washington's Birthday",
        (2024, 5, 27): "Memorial Day",
        (2021, 5, 31): "Memorial Day",
        (2024, 6, 19): "Juneteenth",
        (2024, 9, 2): "Labor Day",
        (2024, 10, 14): "Columbus Day",
        (2024, 11, 28): "Thanksgiving",
        (2021, 7, 5): "Independence Day",
        (2021, 12, 24): "Christmas Day",
        (2021, 12, 31): "New Year's Day",
    }
    for day, name in named.items():
        assert days[dt.date(*day)] == name
    assert all(2021 <= d.year <= 2024 for d in days)
    assert sum(d.year == 2024 for d in days) == 11


def test_holiday_join_keeps_rows(spark, rows):
    df = rows([("2024-07-04 10:00:00",), ("2024-07-05 10:00:00",), (None,)], "ts timestamp")
    made = add_holidays(df, federal_holidays(spark, 2024, 2024), "ts")
    assert sorted(r.is_holiday for r in made.collect()) == [0, 0, 1]
    with pytest.raises(ValueError):
        federal_holidays(spark, 1950, 1960)


def test_holidays_of_the_rows_own_years(spark, rows):
    df = rows([("1999-07-05",), ("2022-06-20",), ("2022-06-21",)], "ts timestamp")
    assert [r.is_holiday for r in add_holidays(df, time="ts").orderBy("ts").collect()] == [1, 1, 0]
    with pytest.raises(Exception, match="rules hold"):
        add_holidays(rows([("1950-01-01",)], "ts timestamp"), time="ts").collect()
