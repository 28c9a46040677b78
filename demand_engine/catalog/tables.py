"""Registered queries: sources, sinks, sorts and pages."""

from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demand_engine.catalog.common import COUNTS, DEMAND, FORECAST_START, HORIZON, TRIPS, demand, out, r6, register, trips
from demand_engine.fixtures import read
from demand_engine.functions.calendar import hour_axis
from demand_engine.operators.demand import future_grid
from demand_engine.operators.ordering import append, page, preview, sort_table, top_k
from demand_engine.session import shared_folder, use_utc
from demand_engine.sources import tables
from demand_engine.sources.committed import CommittedTable

_STORED_DEMAND = DEMAND + " SELECT * REPLACE (pickup_community_area::BIGINT AS pickup_community_area) FROM demand"


@register("scan_events", "SELECT ts, user_id FROM events")
def scan_events(spark, sf_dir):
    return out(tables.scan_events(use_utc(spark), f"{sf_dir}/events.parquet", ["ts", "user_id"]))


@register(
    "sample_range",
    TRIPS
    + """ SELECT trip_id, trip_start_timestamp, trip_seconds, pickup_community_area, payment_type FROM trips
    WHERE trip_start_timestamp BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-07'
    ORDER BY trip_id LIMIT 100000""",
)
def sample_range(spark, sf_dir):
    rows = tables.sample_range(trips(spark, sf_dir), "2024-01-01", "2024-01-07", 100_000, "trip_id")
    return out(rows.select("trip_id", "trip_start_timestamp", "trip_seconds", "pickup_community_area", "payment_type"))


@register(
    "sample_rows",
    TRIPS
    + f""" SELECT trip_id, {r6("pickup_latitude")} AS pickup_latitude, {r6("pickup_longitude")} AS pickup_longitude
    FROM trips WHERE pickup_latitude IS NOT NULL AND pickup_longitude IS NOT NULL
    ORDER BY md5('42:' || trip_id), trip_id LIMIT 5000""",
)
def sample_rows(spark, sf_dir):
    cols = ["pickup_latitude", "pickup_longitude"]
    return out(tables.sample_rows(trips(spark, sf_dir), cols, 5000, 42, "trip_id"))


_FUTURE_GRID = f""", steps AS (
  SELECT unnest(generate_series(TIMESTAMP '{FORECAST_START}', TIMESTAMP '{FORECAST_START}' + INTERVAL {HORIZON - 1} HOUR, INTERVAL 1 HOUR)) AS timestamp_hour)
  SELECT timestamp_hour, pickup_community_area FROM steps CROSS JOIN areas"""


@register("csv_round_trip", COUNTS + _FUTURE_GRID)
def csv_round_trip(spark, sf_dir):
    rows = future_grid(demand(spark, sf_dir), FORECAST_START, HORIZON)
    folder = shared_folder(spark, "csv")
    tables.write_csv(rows, folder)
    schema = T.StructType(
        [T.StructField("timestamp_hour", T.TimestampType()), T.StructField("pickup_community_area", T.IntegerType())]
    )
    return out(tables.read_csv(spark, folder, schema, "timestamp_hour"))


@register("replace_table", _STORED_DEMAND)
def replace_table(spark, sf_dir):
    """Written, replaced, and left as it was by a replacement that fails half-way."""
    table = demand(spark, sf_dir)
    folder = shared_folder(spark, "table")
    tables.write_table(table.where("trip_count > 0"), folder, tables.DEMAND_SCHEMA)
    tables.write_table(table, folder, tables.DEMAND_SCHEMA)
    fraction = table.withColumn("trip_count", F.when(F.col("hour") < 12, F.col("trip_count").cast("double")).otherwise(0.5))
    try:
        tables.write_table(fraction, folder, tables.DEMAND_SCHEMA)
    except PySparkException:
        pass
    return out(tables.read_table(spark, folder))


@register("enforce_schema", _STORED_DEMAND)
def enforce_schema(spark, sf_dir):
    return out(tables.enforce_schema(demand(spark, sf_dir), tables.DEMAND_SCHEMA))


@register(
    "narrow_numbers",
    TRIPS
    + f""" SELECT trip_id, CAST(tips AS BIGINT) AS tips, {r6("trip_miles")} AS trip_miles,
    CAST(pickup_community_area AS DOUBLE) AS pickup_area FROM trips""",
)
def narrow_numbers(spark, sf_dir):
    rows = trips(spark, sf_dir).select(
        "trip_id", "tips", "trip_miles", F.col("pickup_community_area").cast("double").alias("pickup_area")
    )
    return out(tables.narrow_numbers(rows))


@register("preview", DEMAND + " SELECT * FROM demand ORDER BY timestamp_hour, pickup_community_area LIMIT 5")
def preview_table(spark, sf_dir):
    return out(preview(demand(spark, sf_dir)))


_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


@register("append_missing", _EVENTS)
def append_missing(spark, sf_dir):
    """Half of the events are there; the others are appended as new files, and a repeated call adds nothing."""
    src = read(spark, sf_dir, "events")
    table = CommittedTable(spark, shared_folder(spark, "appended"), ["event_id"])
    table.append(src.where((F.col("ts") < F.lit("2024-01-16").cast("timestamp")) & (F.col("event_id") % 3 > 0)), "loaded")
    table.append_missing(src)
    table.append_missing(src)
    return table.read()


@register("missing_rows", _EVENTS)
def missing_rows(spark, sf_dir):
    src = read(spark, sf_dir, "events")
    loaded = src.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp"))
    return tables.append_missing(src, loaded, ["event_id"])


@register("copy_by_key", _EVENTS)
def copy_by_key(spark, sf_dir):
    """A table copied in ranges of its key: three calls of three batches, each going on behind the last one's mark, and
    one for the rest."""
    src = read(spark, sf_dir, "events")
    size = max(1, src.count() // 11)
    table = CommittedTable(spark, shared_folder(spark, "copied"))
    for batches in (3, 3, 3, 100):
        table.copy_from(src, "event_id", size, batches)
    return table.read()


@register("sorted_demand", DEMAND + " SELECT * FROM demand ORDER BY timestamp_hour, pickup_community_area")
def sorted_demand(spark, sf_dir):
    return sort_table(out(demand(spark, sf_dir)), "timestamp_hour", "pickup_community_area")


@register(
    "top_k",
    TRIPS
    + f""" SELECT payment_type, {r6("sum(trip_total)")} AS total FROM trips
    GROUP BY 1 ORDER BY sum(trip_total) DESC, 1 LIMIT 3""",
)
def top_payment_types(spark, sf_dir):
    totals = trips(spark, sf_dir).groupBy("payment_type").agg(F.sum("trip_total").alias("total"))
    return out(top_k(totals, "total", "payment_type", 3))


@register(
    "page",
    TRIPS + " SELECT trip_id, trip_start_timestamp, payment_type FROM trips ORDER BY trip_id LIMIT 1000 OFFSET 2500",
)
def page_of_trips(spark, sf_dir):
    rows = trips(spark, sf_dir).select("trip_id", "trip_start_timestamp", "payment_type")
    return out(page(rows, "trip_id", 2500, 1000))


@register("append_batches", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def append_batches(spark, sf_dir):
    rows = read(spark, sf_dir, "events")
    return append(rows.where("event_type = 'purchase'"), rows.where("event_type <> 'purchase' OR event_type IS NULL"))


@register(
    "hour_axis",
    """SELECT h AS timestamp_hour, count(e.ts) AS n_events
    FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)), max(ts), INTERVAL 1 HOUR)) AS h FROM events)
    LEFT JOIN events e ON date_trunc('hour', e.ts) = h GROUP BY 1""",
)
def events_on_hour_axis(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    seen = events.agg(F.struct(F.min("ts").alias("low"), F.max("ts").alias("high")).alias("seen")).scalar()
    axis = hour_axis(spark, F.date_trunc("hour", seen.getField("low")), seen.getField("high"))
    per_hour = events.groupBy(F.date_trunc("hour", "ts").alias("timestamp_hour")).agg(F.count("ts").alias("n"))
    joined = axis.join(per_hour, "timestamp_hour", "left")
    return out(joined.select("timestamp_hour", F.coalesce("n", F.lit(0)).alias("n_events")))
