"""Views over the given tables that stand for raw trips.

Nulls, zeros and text that is no number are put in by fixed rules on the key, so the cleaning
operators have work to do. The same text runs as an oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demand_engine.session import use_utc

TRIP_COLUMNS = {
    "trip_id": "event_id",
    "trip_start_timestamp": "CAST(ts AS TIMESTAMP)",
    "trip_seconds": "CASE WHEN event_id % 20 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(floor(value * 60) AS BIGINT) END",
    "trip_miles": "CASE WHEN event_id % 23 = 0 THEN CAST(0 AS DOUBLE) WHEN event_id % 29 = 0 THEN CAST(0.05 AS DOUBLE) ELSE value / 5 END",
    "fare": "CASE WHEN event_type = 'error' THEN CAST(0 AS DOUBLE) ELSE CAST(3.25 AS DOUBLE) + value * CAST(0.4 AS DOUBLE) END",
    "tips": "CASE WHEN event_type = 'purchase' THEN CAST(2 AS DOUBLE) WHEN event_id % 3 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "tolls": "CAST(0 AS DOUBLE)",
    "extras": "CAST(0 AS DOUBLE)",
    "payment_type": "event_type",
    "pickup_community_area": "CASE WHEN event_id % 50 = 0 THEN CAST(NULL AS INT) ELSE CAST(user_id % 77 + 1 AS INT) END",
    "dropoff_community_area": "CASE WHEN event_id % 40 = 0 THEN CAST(NULL AS INT) ELSE CAST((user_id * 7 + event_id) % 77 + 1 AS INT) END",
    "pickup_latitude": "CASE WHEN event_id % 50 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(41.65 AS DOUBLE) + (user_id % 77) * CAST(0.005 AS DOUBLE) END",
    "pickup_longitude": "CASE WHEN event_id % 50 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(-87.85 AS DOUBLE) + (user_id % 77) * CAST(0.004 AS DOUBLE) END",
    "dropoff_latitude": "CASE WHEN event_id % 40 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(41.65 AS DOUBLE) + ((user_id * 7 + event_id) % 77) * CAST(0.005 AS DOUBLE) END",
    "dropoff_longitude": "CASE WHEN event_id % 40 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(-87.85 AS DOUBLE) + ((user_id * 7 + event_id) % 77) * CAST(0.004 AS DOUBLE) END",
    "raw_number": "CASE WHEN event_id % 31 = 0 THEN 'n/a' ELSE CAST(event_id % 97 AS VARCHAR(10)) END",
    "raw_time": "CASE WHEN event_id % 37 = 0 THEN 'not a time' ELSE '2024-01-01 00:00:00' END",
}

AREAS = list(range(1, 78))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def as_trips(events: DataFrame) -> DataFrame:
    """The trips view of any frame with the columns of events, batch or stream."""
    rows = events.selectExpr(*[f"{text} AS {name}" for name, text in TRIP_COLUMNS.items()])
    return rows.selectExpr(
        "*",
        "fare + tips + tolls + extras AS trip_total",
        "timestampadd(SECOND, CAST(trip_seconds AS INT), trip_start_timestamp) AS trip_end_timestamp",
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_trips(raw_events(spark, sf_dir))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{table}.parquet")
