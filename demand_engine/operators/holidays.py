"""Federal holiday calendar, made from its rules, and the join that flags its dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Name, month, day, first year.
FIXED_DATES = [
    ("New Year's Day", 1, 1, 1871),
    ("Juneteenth", 6, 19, 2021),
    ("Independence Day", 7, 4, 1871),
    ("Veterans Day", 11, 11, 1978),
    ("Christmas Day", 12, 25, 1871),
]

# Name, month, weekday, which one (-1 is the last of the month), first year.
FLOATING_DATES = [
    ("Martin Luther King Jr. Day", 1, "MON", 3, 1986),
    ("Washington's Birthday", 2, "MON", 3, 1971),
    ("Memorial Day", 5, "MON", -1, 1971),
    ("Labor Day", 9, "MON", 1, 1894),
    ("Columbus Day", 10, "MON", 2, 1971),
    ("Thanksgiving", 11, "THU", 4, 1942),
]

RULES_HOLD_FROM = 1978


def federal_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """(holiday_date, holiday): the dates and, where a fixed date falls on a weekend, also the day it
    is observed on. About a dozen rows per year."""
    if first_year < RULES_HOLD_FROM:
        raise ValueError(f"the rules hold from {RULES_HOLD_FROM} on")
    # one year more, because its New Year's Day may be observed on the last day before it
    years = spark.range(first_year, last_year + 2).select(F.col("id").cast("int").alias("y"))
    return _holidays(years).where(F.year("holiday_date").between(first_year, last_year))


def holidays_of(df: DataFrame, time: str = "timestamp_hour") -> DataFrame:
    """The same for the years from the first to the last time of the rows, read when the plan runs. Rows
    before the rules hold raise then."""
    seen = df.agg(F.min(F.year(time)).alias("first"), F.max(F.year(time)).alias("last"))
    early = F.raise_error(F.lit(f"the rules hold from {RULES_HOLD_FROM} on")).cast("int")
    first = F.when(F.col("first") < RULES_HOLD_FROM, early).otherwise(F.col("first"))
    return _holidays(seen.where("first is not null").select(F.explode(F.sequence(first, F.col("last") + 1)).alias("y")))


def _holidays(years: DataFrame) -> DataFrame:
    fixed = [
        F.when(F.col("y") >= since, F.struct(F.make_date("y", F.lit(m), F.lit(d)).alias("d"), F.lit(name).alias("holiday"), F.lit(True).alias("fixed")))
        for name, m, d, since in FIXED_DATES
    ]
    floating = []
    for name, month, weekday, nth, since in FLOATING_DATES:
        month_start = F.make_date("y", F.lit(month), F.lit(1))
        if nth > 0:
            day = F.date_add(F.next_day(F.date_sub(month_start, 1), weekday), 7 * (nth - 1))
        else:
            day = F.next_day(F.date_sub(F.last_day(month_start), 7), weekday)
        floating.append(
            F.when(F.col("y") >= since, F.struct(day.alias("d"), F.lit(name).alias("holiday"), F.lit(False).alias("fixed")))
        )
    named = years.select(F.inline(F.filter(F.array(*fixed, *floating), lambda r: r.isNotNull())))
    shift = F.when(F.col("fixed") & (F.weekday("d") == 5), -1).when(F.col("fixed") & (F.weekday("d") == 6), 1)
    both = F.filter(F.array(F.col("d"), F.date_add("d", shift)), lambda d: d.isNotNull())
    return named.select(F.explode(both).alias("holiday_date"), "holiday")


def add_holidays(
    df: DataFrame, calendar: DataFrame | None = None, time: str = "timestamp_hour", name: str = "is_holiday"
) -> DataFrame:
    """Flags the rows whose date is in the calendar, by default that of the rows' own years. The calendar
    is bounded by its years, so it is broadcast."""
    calendar = holidays_of(df, time) if calendar is None else calendar
    dates = calendar.select(F.col("holiday_date").alias("_date")).distinct()
    joined = df.withColumn("_day", F.to_date(time)).join(
        F.broadcast(dates), F.col("_day") == F.col("_date"), "left"
    )
    return joined.withColumn(name, F.col("_date").isNotNull().cast("int")).drop("_day", "_date")
