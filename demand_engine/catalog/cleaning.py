"""Registered queries: filters, casts, naming, derived trip measures, validation, clipping."""

from pyspark.sql import functions as F

from demand_engine.catalog.common import (
    DEMAND,
    END,
    NAIVE,
    SAMPLE_AREAS,
    START,
    TRAIN_END,
    TRIPS,
    demand,
    naive_forecast,
    out,
    r6,
    register,
    trips,
)
from demand_engine.functions import trip
from demand_engine.operators import clean
from demand_engine.session import shared_folder, use_utc
from demand_engine.sources.committed import CommittedTable
from demand_engine.sources.tables import require


@register(
    "filter_window",
    TRIPS
    + f""" SELECT trip_id, trip_start_timestamp, pickup_community_area FROM trips
    WHERE pickup_community_area IS NOT NULL AND trip_start_timestamp >= TIMESTAMP '{START}'
    AND trip_start_timestamp <= TIMESTAMP '{END}'""",
)
def filter_window(spark, sf_dir):
    rows = require(trips(spark, sf_dir), ["trip_id", "trip_start_timestamp", "pickup_community_area"])
    kept = clean.filter_window(rows, START, END, "trip_start_timestamp", ["pickup_community_area"])
    return out(kept.select("trip_id", "trip_start_timestamp", "pickup_community_area"))


@register(
    "filter_half_open",
    TRIPS
    + f""" SELECT trip_id, trip_start_timestamp FROM trips
    WHERE trip_start_timestamp >= TIMESTAMP '{START}' AND trip_start_timestamp < TIMESTAMP '{TRAIN_END}'""",
)
def filter_half_open(spark, sf_dir):
    kept = clean.filter_window(trips(spark, sf_dir), START, TRAIN_END, "trip_start_timestamp", closed="left")
    return out(kept.select("trip_id", "trip_start_timestamp"))


@register(
    "window_bounds",
    """SELECT min(ts) AS first_event, max(ts) AS last_event, count(*) AS n_events FROM events
    WHERE ts >= TIMESTAMP '2024-01-30' - INTERVAL 30 DAY AND ts <= TIMESTAMP '2024-01-30 23:59:59'""",
)
def window_bounds(spark, sf_dir):
    start, end = clean.window_bounds("2024-01-30", 720)
    inside = clean.filter_window(trips(spark, sf_dir), start, end, "trip_start_timestamp")
    t = "trip_start_timestamp"
    return out(inside.agg(F.min(t).alias("first_event"), F.max(t).alias("last_event"), F.count(t).alias("n_events")))


_COERCED = TRIPS + """ SELECT trip_id, try_cast(raw_number AS DOUBLE) AS raw_number, try_cast(raw_time AS TIMESTAMP) AS raw_time
    FROM trips"""


@register("coerce", _COERCED)
def coerce(spark, sf_dir):
    rows = trips(spark, sf_dir).select("trip_id", "raw_number", "raw_time")
    return out(clean.coerce(rows, ["raw_time"], ["raw_number"]))


_REPORT = (
    TRIPS
    + """ SELECT 'raw_time' AS column_name, count(*) FILTER (WHERE raw_time IS NULL) AS nulls_before,
      count(*) FILTER (WHERE try_cast(raw_time AS TIMESTAMP) IS NULL) AS nulls_after,
      count(*) FILTER (WHERE raw_time IS NOT NULL AND try_cast(raw_time AS TIMESTAMP) IS NULL) AS nulls_coerced FROM trips
    UNION ALL SELECT 'raw_number', count(*) FILTER (WHERE raw_number IS NULL),
      count(*) FILTER (WHERE try_cast(raw_number AS DOUBLE) IS NULL),
      count(*) FILTER (WHERE raw_number IS NOT NULL AND try_cast(raw_number AS DOUBLE) IS NULL) FROM trips"""
)


@register("coercion_report", _REPORT)
def coercion_report(spark, sf_dir):
    return out(clean.coercion_report(trips(spark, sf_dir), ["raw_time"], ["raw_number"]))


def _coerced(spark, sf_dir):
    table = CommittedTable(use_utc(spark), shared_folder(spark, "coerced"))
    rows = trips(spark, sf_dir).select("trip_id", "raw_number", "raw_time")
    return table, clean.coerce_into(table, rows, ["raw_time"], ["raw_number"])


@register("coerce_while_writing", _COERCED)
def coerce_while_writing(spark, sf_dir):
    return out(_coerced(spark, sf_dir)[0].read())


@register("coercion_report_of_a_write", _REPORT)
def coercion_report_of_a_write(spark, sf_dir):
    """The same report, counted by the write of the coerced rows."""
    return out(_coerced(spark, sf_dir)[1])


@register(
    "drop_null",
    TRIPS
    + """ SELECT trip_id, pickup_community_area, dropoff_community_area FROM trips
    WHERE pickup_community_area IS NOT NULL AND dropoff_community_area IS NOT NULL""",
)
def drop_null(spark, sf_dir):
    areas = ["pickup_community_area", "dropoff_community_area"]
    return out(clean.drop_null(trips(spark, sf_dir), areas).select("trip_id", *areas))


@register("normalize_columns", TRIPS + " SELECT trip_id, payment_type AS payment_type, trip_seconds FROM trips")
def normalize_columns(spark, sf_dir):
    raw = trips(spark, sf_dir).select(
        F.col("trip_id").alias(" Trip ID "), F.col("payment_type").alias("Payment Type"), F.col("trip_seconds").alias("TRIP_SECONDS ")
    )
    return out(clean.normalize_columns(raw))


@register("order_columns", DEMAND + " SELECT * FROM demand")
def order_columns(spark, sf_dir):
    return out(clean.order_columns(demand(spark, sf_dir)))


@register("with_aliases", DEMAND + " SELECT *, timestamp_hour AS timestamp, trip_count AS target FROM demand")
def with_aliases(spark, sf_dir):
    return out(clean.with_aliases(demand(spark, sf_dir)))


@register(
    "canonical_names",
    NAIVE + " SELECT timestamp_hour AS timestamp, pickup_community_area AS series_id, prediction FROM naive",
)
def canonical_names(spark, sf_dir):
    rows = naive_forecast(spark, sf_dir)
    return out(clean.canonical(rows, "timestamp_hour", "pickup_community_area", "prediction", "prediction"))


@register("keep_ids", DEMAND + " SELECT * FROM demand WHERE pickup_community_area IN (8, 28, 32, 56, 76)")
def keep_ids(spark, sf_dir):
    return out(clean.keep_ids(demand(spark, sf_dir), SAMPLE_AREAS))


@register(
    "trip_minutes",
    TRIPS
    + f""" SELECT trip_id, {r6("trip_minutes")} AS trip_minutes,
    {r6("(epoch_us(trip_end_timestamp) - epoch_us(trip_start_timestamp)) / 6e7")} AS minutes_from_times FROM trips""",
)
def trip_minutes(spark, sf_dir):
    rows = trip.add_trip_minutes(trips(spark, sf_dir))
    between = trip.minutes_between("trip_start_timestamp", "trip_end_timestamp")
    return out(rows.select("trip_id", "trip_minutes", between.alias("minutes_from_times")))


@register("speed_or_null", TRIPS + f" SELECT trip_id, {r6('average_speed_mph')} AS average_speed_mph FROM trips")
def speed_or_null(spark, sf_dir):
    rows = trip.add_speed(trip.add_trip_minutes(trips(spark, sf_dir)))
    return out(rows.select("trip_id", "average_speed_mph"))


@register(
    "speed_or_zero",
    TRIPS
    + f""" SELECT trip_id, {r6("CASE WHEN trip_minutes <= 0 THEN 0e0 ELSE average_speed_mph END")} AS average_speed_mph
    FROM trips""",
)
def speed_or_zero(spark, sf_dir):
    rows = trip.add_speed(trip.add_trip_minutes(trips(spark, sf_dir)), on_invalid="zero")
    return out(rows.select("trip_id", "average_speed_mph"))


_FIRST_MISSING = " ".join(
    f"WHEN {source} IS NULL THEN 'Missing required field: {name}'"
    for name, source in [
        ("trip_miles", "trip_miles"),
        ("pickup_latitude", "pickup_latitude"),
        ("pickup_longitude", "pickup_longitude"),
        ("dropoff_latitude", "dropoff_latitude"),
        ("dropoff_longitude", "dropoff_longitude"),
    ]
)


@register(
    "validate_trips",
    TRIPS
    + f""" SELECT trip_id, message, message = 'Valid' AS is_valid FROM (
      SELECT trip_id, CASE {_FIRST_MISSING}
        WHEN trip_miles <= 0 THEN 'Invalid trip_miles (must be positive)'
        WHEN least(pickup_latitude, dropoff_latitude) < -90 OR greatest(pickup_latitude, dropoff_latitude) > 90
          THEN 'Invalid latitude (must be -90 to 90)'
        WHEN least(pickup_longitude, dropoff_longitude) < -180 OR greatest(pickup_longitude, dropoff_longitude) > 180
          THEN 'Invalid longitude (must be -180 to 180)'
        ELSE 'Valid' END AS message FROM trips)""",
)
def validate_trips(spark, sf_dir):
    rows = trip.with_model_inputs(trips(spark, sf_dir))
    return out(trip.validate_trips(rows).select("trip_id", "message", "is_valid"))


@register(
    "iqr_clip",
    TRIPS
    + f""", q AS (SELECT quantile_cont(trip_miles, 0.25) AS q1, quantile_cont(trip_miles, 0.75) AS q3 FROM trips)
    SELECT trip_id, {r6("least(greatest(trip_miles, greatest(0e0, q1 - 1.5e0 * (q3 - q1))), q3 + 1.5e0 * (q3 - q1))")}
      AS trip_miles_iqr_capped FROM trips, q""",
)
def iqr_clip(spark, sf_dir):
    rows = trips(spark, sf_dir).select("trip_id", "trip_miles")
    return out(clean.iqr_clip(rows, "trip_miles").select("trip_id", "trip_miles_iqr_capped"))


@register(
    "clip",
    TRIPS
    + f""" SELECT trip_id, {r6("CASE WHEN average_speed_mph > 10 THEN 10e0 ELSE average_speed_mph END")} AS average_speed_mph,
    {r6("CASE WHEN fare - 5 < 0 THEN 0e0 ELSE fare - 5 END")} AS fare_over_five FROM trips""",
)
def clip(spark, sf_dir):
    rows = trip.add_speed(trip.add_trip_minutes(trips(spark, sf_dir)))
    rows = rows.select("trip_id", "average_speed_mph", (F.col("fare") - 5).alias("fare_over_five"))
    rows = clean.clip(rows, "average_speed_mph", upper=10.0)
    return out(clean.clip(rows, "fare_over_five", lower=0.0))


@register(
    "flatten_predictions",
    NAIVE
    + """ SELECT timestamp_hour, CAST(pickup_community_area AS INT) AS pickup_community_area,
    prediction AS predicted_trip_count FROM naive""",
)
def flatten_predictions(spark, sf_dir):
    nested = naive_forecast(spark, sf_dir).select(
        "timestamp_hour",
        F.col("pickup_community_area").cast("string").alias("pickup_community_area"),
        F.struct(F.col("prediction").cast("float").alias("value")).alias("predicted_trip_count"),
    )
    return out(clean.flatten_predictions(nested))


@register(
    "prediction_payload",
    TRIPS
    + f""" SELECT trip_id, {r6("trip_minutes")} AS predicted_duration_minutes, {r6("trip_miles")} AS trip_miles,
    hour(trip_start_timestamp) AS hour_of_day, '2024-01-31T00:00:00' AS generated_at FROM trips""",
)
def prediction_payload(spark, sf_dir):
    """The payload is JSON text; its fields are read back for the comparison."""
    rows = trip.with_model_inputs(trip.add_trip_minutes(trips(spark, sf_dir)))
    made = trip.prediction_payload(rows, "2024-01-31T00:00:00", "trip_minutes").select("trip_id", "payload")

    def field(path):
        return F.get_json_object("payload", path)

    return out(
        made.select(
            "trip_id",
            field("$.predicted_duration_minutes").cast("double").alias("predicted_duration_minutes"),
            field("$.input_data.trip_miles").cast("double").alias("trip_miles"),
            field("$.input_data.hour_of_day").cast("bigint").alias("hour_of_day"),
            field("$.timestamp").alias("generated_at"),
        )
    )


@register(
    "feature_array",
    TRIPS
    + f""" SELECT trip_id, 8 AS n_features, CAST(hour(trip_start_timestamp) AS DOUBLE) AS f0,
    CAST(isodow(trip_start_timestamp) - 1 AS DOUBLE) AS f1, CAST(month(trip_start_timestamp) AS DOUBLE) AS f2,
    {r6("trip_miles")} AS f3, {r6("pickup_latitude")} AS f4, {r6("pickup_longitude")} AS f5,
    {r6("dropoff_latitude")} AS f6, {r6("dropoff_longitude")} AS f7 FROM trips""",
)
def feature_array(spark, sf_dir):
    made = trip.to_feature_array(trip.with_model_inputs(trips(spark, sf_dir)))
    items = [F.col("features")[i].alias(f"f{i}") for i in range(len(trip.MODEL_INPUTS))]
    return out(made.select("trip_id", F.size("features").alias("n_features"), *items))


@register(
    "haversine_distance",
    TRIPS
    + f""" SELECT trip_id, {r6('''2 * 6371 * asin(sqrt(
      pow(sin(radians(dropoff_latitude - pickup_latitude) / 2), 2)
      + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude))
      * pow(sin(radians(dropoff_longitude - pickup_longitude) / 2), 2)))''')} AS distance_km FROM trips""",
)
def haversine_distance(spark, sf_dir):
    km = trip.haversine_km(*[F.col(f"{side}_{c}") for side in ("pickup", "dropoff") for c in ("latitude", "longitude")])
    return out(trips(spark, sf_dir).select("trip_id", km.alias("distance_km")))
