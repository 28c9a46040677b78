"""Preparation job: raw events to the stored demand table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demand_engine.operators.clean import window_bounds
from demand_engine.operators.demand import demand_table
from demand_engine.operators.ordering import sorted_for_storage
from demand_engine.session import use_utc
from demand_engine.sources.tables import DEMAND_SCHEMA, read_table, scan_events, write_table


def prepare_demand(
    spark: SparkSession,
    source: str,
    target: str,
    end_date: str,
    max_points: int,
    time: str = "trip_start_timestamp",
    id: str = "pickup_community_area",
) -> DataFrame:
    """Reads two columns of the source, writes the gap-free demand of the window, returns the table.

    The files hold ranges of time, so a later job that filters on time skips the others.
    """
    start, end = window_bounds(end_date, max_points)
    events = scan_events(use_utc(spark), source, [time, id])
    table = demand_table(events, start, end, time=time, id=id).withColumnRenamed(id, "pickup_community_area")
    write_table(sorted_for_storage(table, "timestamp_hour", "pickup_community_area"), target, DEMAND_SCHEMA)
    return read_table(spark, target)
