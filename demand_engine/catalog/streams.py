"""Registered queries that run a stream over the events until it has read everything."""

from datetime import timedelta

from pyspark.sql import functions as F

from demand_engine import fixtures
from demand_engine.catalog.common import TRIPS, out, register
from demand_engine.operators.demand import distinct_ids
from demand_engine.session import cut_lineage, shared_folder, use_utc
from demand_engine.sources.committed import CommittedTable
from demand_engine.streaming import hourly
from demand_engine.streaming.copy import incremental_copy, read_copy


#: Slices of time that the events land in, one after the other.
SLICES = 6


def _landing(spark, sf_dir):
    """The events as they would land, a slice of time after the other: a path pattern, yielded again whenever the next
    slice is there, so that a run per slice is a stream in which nothing comes too late.

    One write makes all slices, each by as many tasks as its rows need; rows without a time land first. A slice lands by
    moving its folder."""
    folder, events = shared_folder(use_utc(spark), "landed"), fixtures.raw_events(spark, sf_dir)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    seen = events.agg(F.struct(F.min(at).alias("low"), F.max(at).alias("high")).alias("seen")).scalar()
    low, high = seen.getField("low"), seen.getField("high")
    part = F.coalesce(F.floor((at - low) * SLICES / (high - low + 1)), F.lit(0)).cast("int")
    sliced = events.withColumn("slice", part)
    sliced.repartition("slice", F.pmod(F.xxhash64("event_id"), F.lit(8))).write.partitionBy("slice").parquet(f"{folder}/all")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(f"{folder}/landed"))
    if not files.exists(path(f"{folder}/all/slice=0")):
        events.limit(0).write.parquet(f"{folder}/all/slice=0")
    for k in range(SLICES):
        if files.rename(path(f"{folder}/all/slice={k}"), path(f"{folder}/landed/{k}")):
            yield f"{folder}/landed/*"


def _trip_stream(spark, sf_dir, landed):
    return fixtures.as_trips(spark.readStream.schema(fixtures.raw_events(spark, sf_dir).schema).parquet(landed))


@register("incremental_copy", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def copy_events(spark, sf_dir):
    """After each slice one batch, then the others from the same checkpoint; a last run finds nothing new."""
    folder = shared_folder(use_utc(spark), "copy")
    for landed in _landing(spark, sf_dir):
        incremental_copy(spark, landed, f"{folder}/table", f"{folder}/checkpoint", 2, 1)
    for _ in range(2):
        incremental_copy(spark, landed, f"{folder}/table", f"{folder}/checkpoint", 100)
    return read_copy(spark, f"{folder}/table")


@register(
    "stream_hourly_demand",
    TRIPS
    + """ SELECT date_trunc('hour', trip_start_timestamp) AS timestamp_hour, pickup_community_area, count(*) AS trip_count
    FROM trips WHERE pickup_community_area IS NOT NULL GROUP BY 1, 2""",
)
def stream_hourly_demand(spark, sf_dir):
    folder = shared_folder(spark, "running")
    for landed in _landing(spark, sf_dir):
        counts = hourly.stream_hourly_demand(_trip_stream(spark, sf_dir, landed))
        hourly.write_running_counts(counts, f"{folder}/table", f"{folder}/checkpoint")
    hourly.compact_running_counts(spark, f"{folder}/table")
    return out(hourly.read_running_counts(spark, f"{folder}/table"))


_CLOSED = TRIPS + """, seen AS (SELECT trip_start_timestamp, pickup_community_area FROM trips WHERE pickup_community_area IS NOT NULL),
  counts AS (SELECT date_trunc('hour', trip_start_timestamp) AS timestamp_hour, pickup_community_area, count(*) AS trip_count
    FROM seen GROUP BY 1, 2),
  closed AS (SELECT * FROM counts
    WHERE timestamp_hour + INTERVAL 1 HOUR <= (SELECT max(trip_start_timestamp) FROM seen) - INTERVAL 2 HOUR)"""


@register("stream_closed_hours", _CLOSED + " SELECT * FROM closed")
def stream_closed_hours(spark, sf_dir):
    folder = shared_folder(spark, "closed")
    for landed in _landing(spark, sf_dir):
        counts = hourly.stream_hourly_demand(_trip_stream(spark, sf_dir, landed))
        hourly.write_closed_steps(counts, f"{folder}/table", f"{folder}/checkpoint")
    return out(spark.read.parquet(f"{folder}/table"))


@register(
    "stream_filled_demand",
    _CLOSED
    + """, hours AS (SELECT unnest(generate_series((SELECT min(timestamp_hour) FROM closed), (SELECT max(timestamp_hour) FROM closed), INTERVAL 1 HOUR)) AS timestamp_hour),
  areas AS (SELECT DISTINCT pickup_community_area FROM seen)
  SELECT h.timestamp_hour, a.pickup_community_area, coalesce(c.trip_count, 0) AS trip_count FROM hours h CROSS JOIN areas a
  LEFT JOIN closed c ON c.timestamp_hour = h.timestamp_hour AND c.pickup_community_area = a.pickup_community_area""",
)
def stream_filled_demand(spark, sf_dir):
    folder = shared_folder(spark, "filled")
    seen = fixtures.trips(spark, sf_dir).where("pickup_community_area is not null")
    earliest = seen.select(F.min_by("pickup_community_area", "trip_start_timestamp")).scalar()
    # Read again by every batch. The earliest zone is left out: the stream meets it.
    ids = cut_lineage(distinct_ids(seen).where(F.col("pickup_community_area") != earliest))
    for landed in _landing(spark, sf_dir):
        counts = hourly.stream_hourly_demand(_trip_stream(spark, sf_dir, landed))
        hourly.stream_filled_demand(counts, ids, f"{folder}/table", f"{folder}/checkpoint")
    return out(spark.read.parquet(f"{folder}/table").drop("batch_id"))


@register(
    "closed_by_the_clock",
    TRIPS
    + """, seen AS (SELECT trip_start_timestamp, pickup_community_area FROM trips WHERE pickup_community_area IS NOT NULL AND trip_start_timestamp IS NOT NULL),
  counts AS (SELECT date_trunc('hour', trip_start_timestamp) AS timestamp_hour, pickup_community_area, count(*) AS trip_count FROM seen GROUP BY 1, 2),
  hours AS (SELECT unnest(generate_series((SELECT min(timestamp_hour) FROM counts),
    (SELECT date_trunc('hour', max(trip_start_timestamp) + INTERVAL 5 HOUR) FROM seen), INTERVAL 1 HOUR)) AS timestamp_hour),
  areas AS (SELECT DISTINCT pickup_community_area FROM seen)
  SELECT h.timestamp_hour, a.pickup_community_area, coalesce(c.trip_count, 0) AS trip_count FROM hours h CROSS JOIN areas a
  LEFT JOIN counts c ON c.timestamp_hour = h.timestamp_hour AND c.pickup_community_area = a.pickup_community_area""",
)
def closed_by_the_clock(spark, sf_dir):
    """All events are counted; then the clock alone closes their hours and idle ones after them, in two steps and a repeat."""
    folder = shared_folder(spark, "clock")
    for landed in _landing(spark, sf_dir):
        pass
    counts = hourly.stream_hourly_demand(_trip_stream(spark, sf_dir, landed))
    hourly.write_running_counts(counts, f"{folder}/counts", f"{folder}/checkpoint")
    table = CommittedTable(spark, f"{folder}/table")
    last = fixtures.trips(spark, sf_dir).where("pickup_community_area is not null").agg(F.max("trip_start_timestamp")).first()[0]
    if last is not None:
        for hours in (-100, 8, 8):
            hourly.close_steps(spark, f"{folder}/counts", table, str(last + timedelta(hours=hours)), "2 hours")
    return out(table.read())
