"""Calendar columns: truncation, weekday numberings, cyclic encodings, holidays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Month-day of the three holidays of the simple rule.
FIXED_HOLIDAYS = ["01-01", "07-04", "12-25"]

WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def step_interval(step: str = "hour", n: int = 1) -> Column:
    return F.expr(f"interval {int(n)} {step}")


def timestamp_literal(value) -> Column:
    """Literal timestamp from text or datetime; folds to a constant, so it reaches the scan."""
    return F.lit(str(value).replace("T", " ").removesuffix("Z")).cast("timestamp")


def hour_of(ts: Column | str, step: str = "hour") -> Column:
    return F.date_trunc(step, _col(ts))


def dow_sun1(ts: Column | str) -> Column:
    """Sunday 1 .. Saturday 7."""
    return F.dayofweek(_col(ts))


def dow_mon0(ts: Column | str) -> Column:
    """Monday 0 .. Sunday 6."""
    return F.weekday(_col(ts))


def sun1_to_mon0(dow: Column | str) -> Column:
    return F.pmod(_col(dow) + 5, F.lit(7))


def iso_week(ts: Column | str) -> Column:
    return F.weekofyear(_col(ts))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is null)."""
    return F.when(condition, 1).otherwise(0)


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def is_weekend(ts: Column | str) -> Column:
    return flag(dow_mon0(ts) >= 5)


def is_holiday(ts: Column | str, kind: str = "fixed") -> Column:
    """``sunday``: every Sunday; ``fixed``: the three fixed dates. The federal calendar is a
    table: see :func:`demand_engine.operators.holidays.add_holidays`."""
    if kind == "sunday":
        return flag(dow_mon0(ts) == 6)
    if kind == "fixed":
        return flag(F.date_format(_col(ts), "MM-dd").isin(FIXED_HOLIDAYS))
    raise ValueError(f"unknown holiday rule: {kind}")


def cyclic(value: Column | str, period: int) -> tuple[Column, Column]:
    angle = 2 * F.pi() * _col(value) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def day_name(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "EEEE")


def day_of(ts: Column | str) -> Column:
    return F.to_date(_col(ts))


def hour_axis(spark: SparkSession, start, end, step: str = "hour", name: str = "timestamp_hour") -> DataFrame:
    """All steps from start to end, both ends included; either may be a column, as of a scalar subquery."""
    low, high = (v if isinstance(v, Column) else timestamp_literal(v) for v in (start, end))
    span = F.sequence(low, high, step_interval(step))
    return spark.range(1).select(F.explode(span).alias(name))


def calendar_parts(df: DataFrame, time: str = "timestamp_hour") -> DataFrame:
    """The nine calendar features of the prepared table; ``day_of_week`` is Sunday 1 .. Saturday 7."""
    hour_sin, hour_cos = cyclic(F.hour(time), 24)
    return df.withColumns(
        {
            "hour": F.hour(time).cast("bigint"),
            "day_of_week": dow_sun1(time).cast("bigint"),
            "month": F.month(time).cast("bigint"),
            "year": F.year(time).cast("bigint"),
            "day_of_year": F.dayofyear(time).cast("bigint"),
            "week_of_year": iso_week(time).cast("bigint"),
            "is_weekend": is_weekend(time).cast("bigint"),
            "hour_sin": hour_sin,
            "hour_cos": hour_cos,
        }
    )


def temporal_features(df: DataFrame, time: str, period: int = 24) -> DataFrame:
    """Hour, weekday (Monday 0) and month, plus cyclic hour columns named after the time column."""
    hour_sin, hour_cos = cyclic(F.hour(time), period)
    return df.withColumns(
        {
            "hour": F.hour(time),
            "dayofweek": dow_mon0(time),
            "month": F.month(time),
            f"{time}_hour_sin": hour_sin,
            f"{time}_hour_cos": hour_cos,
        }
    )


def temporal_record(df: DataFrame, time: str) -> DataFrame:
    """Hour, weekday, month, day of month, weekend and (Sunday) holiday flags."""
    return df.withColumns(
        {
            "hour": F.hour(time),
            "day_of_week": dow_mon0(time),
            "month": F.month(time),
            "day_of_month": F.dayofmonth(time),
            "is_weekend": is_weekend(time),
            "is_holiday": is_holiday(time, "sunday"),
        }
    )


def start_parts(df: DataFrame, time: str = "trip_start_timestamp") -> DataFrame:
    """Start hour, weekday number and name, month and weekend flag of a trip."""
    return df.withColumns(
        {
            "start_hour": F.hour(time),
            "day_of_week": dow_mon0(time),
            "day_name": day_name(time),
            "month": F.month(time),
            "is_weekend": is_weekend(time),
        }
    )
