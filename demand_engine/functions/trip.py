"""Trip measures: distance, duration, speed, validation, model input and payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371

# The eight model inputs, in the order the model takes them.
MODEL_INPUTS = [
    "hour_of_day",
    "day_of_week",
    "month",
    "trip_miles",
    "pickup_latitude",
    "pickup_longitude",
    "dropoff_latitude",
    "dropoff_longitude",
]


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(chord))


def minutes_between(start: str, end: str) -> Column:
    return (F.unix_micros(F.col(end)) - F.unix_micros(F.col(start))) / F.lit(6e7)


def add_trip_minutes(
    df: DataFrame, seconds: str | None = "trip_seconds", start: str | None = None, end: str | None = None
) -> DataFrame:
    """``trip_minutes`` from the seconds column, or from start and end times."""
    minutes = F.col(seconds) / 60 if start is None else minutes_between(start, end)
    return df.withColumn("trip_minutes", minutes)


def add_speed(
    df: DataFrame,
    miles: str = "trip_miles",
    minutes: str = "trip_minutes",
    on_invalid: str = "null",
    name: str = "average_speed_mph",
) -> DataFrame:
    """Miles per hour; ``on_invalid`` says what a duration of zero or less gives."""
    speed = F.col(miles) / (F.col(minutes) / 60)
    if on_invalid == "null":
        speed = F.when(F.col(minutes) > 0, speed)
    elif on_invalid == "zero":
        speed = F.when(F.col(minutes) <= 0, F.lit(0.0)).otherwise(speed)
    else:
        raise ValueError("on_invalid must be 'null' or 'zero'")
    return df.withColumn(name, speed)


def with_model_inputs(df: DataFrame, time: str = "trip_start_timestamp") -> DataFrame:
    """Adds the time-based model inputs a trip row lacks."""
    return df.withColumns(
        {"hour_of_day": F.hour(time), "day_of_week": F.weekday(time), "month": F.month(time)}
    )


def to_feature_array(df: DataFrame, name: str = "features") -> DataFrame:
    return df.withColumn(name, F.array(*[F.col(c).cast("double") for c in MODEL_INPUTS]))


def validate_trips(df: DataFrame) -> DataFrame:
    """Adds ``is_valid`` and ``message``; the first failing rule names the message.

    A null stands for a missing field; a field without a column is missing on every row.
    """
    present = {c: F.col(c) if c in df.columns else F.lit(None).cast("double") for c in MODEL_INPUTS}

    def outside(low, high, *names):
        bad = F.lit(False)
        for name in names:
            bad = bad | ~present[name].between(low, high)
        return bad

    # The message texts.
    rules = [(present[c].isNull(), f"Missing required field: {c}") for c in MODEL_INPUTS]
    rules += [
        (outside(0, 23, "hour_of_day"), "Invalid hour_of_day (must be 0-23)"),
        (outside(0, 6, "day_of_week"), "Invalid day_of_week (must be 0-6)"),
        (outside(1, 12, "month"), "Invalid month (must be 1-12)"),
        (present["trip_miles"] <= 0, "Invalid trip_miles (must be positive)"),
        (outside(-90, 90, "pickup_latitude", "dropoff_latitude"), "Invalid latitude (must be -90 to 90)"),
        (outside(-180, 180, "pickup_longitude", "dropoff_longitude"), "Invalid longitude (must be -180 to 180)"),
    ]
    message = F.coalesce(*[F.when(bad, F.lit(text)) for bad, text in rules], F.lit("Valid"))
    return df.withColumn("message", message).withColumn("is_valid", F.col("message") == "Valid")


def prediction_payload(
    df: DataFrame, generated_at: str, prediction: str = "prediction", inputs: list[str] | None = None
) -> DataFrame:
    """Adds ``payload``: the prediction, the row it was made from and the time, as JSON text."""
    # The field names of the payload.
    body = F.struct(
        F.col(prediction).cast("double").alias("predicted_duration_minutes"),
        F.struct(*(inputs or MODEL_INPUTS)).alias("input_data"),
        F.lit(generated_at).alias("timestamp"),
    )
    return df.withColumn("payload", F.to_json(body))
