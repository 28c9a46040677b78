"""Shared inputs of the registered queries, and the SQL blocks their oracles start with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand_engine import fixtures
from demand_engine.operators.clean import filter_window, window_bounds
from demand_engine.operators.demand import demand_table
from demand_engine.operators.series import seasonal_naive

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

END_DATE, MAX_POINTS = "2024-01-30", 720
START, END = window_bounds(END_DATE, MAX_POINTS)
TRAIN_END, VAL_END = "2024-01-16", "2024-01-23"
FORECAST_START, HORIZON = "2024-01-23 00:00:00", 168
FORECAST_END = "2024-01-30 00:00:00"
SAMPLE_AREAS = [8, 28, 32, 56, 76]


def register(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return keep


def out(df: DataFrame) -> DataFrame:
    """The result in the types the oracle has: zone-less times, dates as text, rounded doubles."""
    shown = {
        "timestamp": lambda c: c.cast("timestamp_ntz"),
        "date": lambda c: c.cast("string"),
        "double": lambda c: F.round(c, 6),
    }
    changed = {name: shown[dtype](F.col(f"`{name}`")) for name, dtype in df.dtypes if dtype in shown}
    return df.withColumns(changed) if changed else df


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.trips(spark, sf_dir)


def window_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_window(
        trips(spark, sf_dir), START, END, "trip_start_timestamp", not_null=["pickup_community_area"]
    )


def demand(spark: SparkSession, sf_dir: str, bounds: str = "window") -> DataFrame:
    return demand_table(trips(spark, sf_dir), START, END, bounds)


def naive_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasonal naive forecast of the last week, the stand-in for a model's predictions."""
    table = demand(spark, sf_dir).select("timestamp_hour", "pickup_community_area", "trip_count")
    reach = filter_window(table, "2024-01-16 00:00:00", FORECAST_END, "timestamp_hour", closed="left")
    made = filter_window(seasonal_naive(reach, 168), FORECAST_START, FORECAST_END, "timestamp_hour", closed="left")
    return made.select("timestamp_hour", "pickup_community_area", "prediction")


def r6(expr: str) -> str:
    return f"round({expr}, 6) + 0e0"


_BASE = "base AS (SELECT " + ", ".join(f"{text} AS {name}" for name, text in fixtures.TRIP_COLUMNS.items()) + " FROM events)"

TRIPS = (
    f"WITH {_BASE}, trips AS (SELECT *, fare + tips + tolls + extras AS trip_total, "
    "trip_start_timestamp + to_seconds(trip_seconds) AS trip_end_timestamp, trip_seconds / 60e0 AS trip_minutes, "
    "CASE WHEN trip_seconds > 0 THEN trip_miles / (trip_seconds / 60e0 / 60) END AS average_speed_mph FROM base)"
)

COUNTS = TRIPS + f""", raw AS (
  SELECT trip_start_timestamp, pickup_community_area FROM trips
  WHERE pickup_community_area IS NOT NULL
    AND trip_start_timestamp >= TIMESTAMP '{START}' AND trip_start_timestamp <= TIMESTAMP '{END}'
), counts AS MATERIALIZED (
  SELECT date_trunc('hour', trip_start_timestamp) AS timestamp_hour, pickup_community_area, count(*) AS trip_count
  FROM raw GROUP BY 1, 2
), areas AS (SELECT DISTINCT pickup_community_area FROM raw)"""


def _demand_sql(low: str, high: str) -> str:
    return COUNTS + f""", hours AS (
  SELECT unnest(generate_series({low}, {high}, INTERVAL 1 HOUR)) AS timestamp_hour
), filled AS (
  SELECT h.timestamp_hour, a.pickup_community_area, coalesce(c.trip_count, 0) AS trip_count
  FROM hours h CROSS JOIN areas a LEFT JOIN counts c
    ON c.timestamp_hour = h.timestamp_hour AND c.pickup_community_area = a.pickup_community_area
), demand AS MATERIALIZED (
  SELECT timestamp_hour, pickup_community_area, trip_count,
    hour(timestamp_hour) AS hour, dayofweek(timestamp_hour) + 1 AS day_of_week,
    month(timestamp_hour) AS month, year(timestamp_hour) AS year, dayofyear(timestamp_hour) AS day_of_year,
    week(timestamp_hour) AS week_of_year, CASE WHEN isodow(timestamp_hour) >= 6 THEN 1 ELSE 0 END::BIGINT AS is_weekend,
    {r6("sin(2 * pi() * hour(timestamp_hour) / 24)")} AS hour_sin,
    {r6("cos(2 * pi() * hour(timestamp_hour) / 24)")} AS hour_cos
  FROM filled)"""


DEMAND = _demand_sql(f"TIMESTAMP '{START}'", f"TIMESTAMP '{END}'")
OBSERVED_DEMAND = _demand_sql(
    "(SELECT min(timestamp_hour) FROM counts)", "(SELECT max(timestamp_hour) FROM counts)"
)

NAIVE = DEMAND + f""", lagged AS MATERIALIZED (
  SELECT timestamp_hour, pickup_community_area,
    CAST(lag(trip_count, 168) OVER (PARTITION BY pickup_community_area ORDER BY timestamp_hour) AS DOUBLE) AS prediction
  FROM demand
), naive AS MATERIALIZED (
  SELECT * FROM lagged WHERE timestamp_hour >= TIMESTAMP '{FORECAST_START}' AND timestamp_hour < TIMESTAMP '{FORECAST_END}'
), pairs AS MATERIALIZED (
  SELECT n.timestamp_hour AS timestamp, n.pickup_community_area AS series_id, n.prediction, d.trip_count AS actual
  FROM naive n JOIN demand d USING (timestamp_hour, pickup_community_area))"""
