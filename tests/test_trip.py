import json

import pytest
from pyspark.sql import functions as F

from demand_engine.functions import trip

ROW = "hour_of_day int, day_of_week int, month int, trip_miles double, pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double"
VALID = (12, 0, 1, 5.0, 41.8781, -87.6298, 41.8781, -87.6298)


def test_minutes_and_speed_from_times(rows):
    df = rows(
        [
            ("2024-01-01 08:00:00", "2024-01-01 08:30:00", 5.0),
            ("2024-01-01 09:00:00", "2024-01-01 09:00:00", 1.0),
            ("2024-01-01 10:00:00", "2024-01-01 11:00:00", None),
        ],
        "s timestamp, e timestamp, trip_miles double",
    )
    made = trip.add_speed(trip.add_trip_minutes(df, start="s", end="e")).orderBy("s").collect()
    assert [r.trip_minutes for r in made] == [30.0, 0.0, 60.0]
    assert [r.average_speed_mph for r in made] == [10.0, None, None]


def test_speed_is_zero_for_no_duration(rows):
    df = rows([(10.0, 30.0), (10.0, 0.0), (10.0, -30.0)], "trip_miles double, trip_minutes double")
    assert [r[2] for r in trip.add_speed(df, on_invalid="zero").collect()] == [20.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        trip.add_speed(df, on_invalid="drop")


def test_haversine(spark):
    cols = [F.lit(v) for v in (41.8781, -87.6298, 40.7128, -74.0060)]
    assert 1140 < spark.range(1).select(trip.haversine_km(*cols)).first()[0] < 1150
    assert spark.range(1).select(trip.haversine_km(*cols[:2], *cols[:2])).first()[0] == 0.0


def test_feature_array_order(rows):
    assert trip.to_feature_array(rows([VALID], ROW)).first()["features"] == [float(v) for v in VALID]


@pytest.mark.parametrize(
    "position, value, message",
    [
        (0, 12, "Valid"),
        (0, 24, "Invalid hour_of_day (must be 0-23)"),
        (1, 7, "Invalid day_of_week (must be 0-6)"),
        (2, 0, "Invalid month (must be 1-12)"),
        (3, 0.0, "Invalid trip_miles (must be positive)"),
        (3, None, "Missing required field: trip_miles"),
        (6, -90.5, "Invalid latitude (must be -90 to 90)"),
        (5, 180.5, "Invalid longitude (must be -180 to 180)"),
    ],
)
def test_validation(rows, position, value, message):
    made = trip.validate_trips(rows([VALID[:position] + (value,) + VALID[position + 1 :]], ROW)).first()
    assert (made.message, made.is_valid) == (message, message == "Valid")


def test_first_failing_rule_wins_and_missing_column(rows):
    bad = (24, 9, 13, -1.0, 95.0, 0.0, 0.0, 0.0)
    assert trip.validate_trips(rows([bad], ROW)).first().message.startswith("Invalid hour_of_day")
    lacking = rows([VALID], ROW).drop("trip_miles")
    assert trip.validate_trips(lacking).first().message == "Missing required field: trip_miles"


def test_payload(rows):
    df = rows([VALID], ROW).withColumn("prediction", F.lit(30))
    payload = json.loads(trip.prediction_payload(df, "2024-01-01T00:00:00").first()["payload"])
    assert payload["predicted_duration_minutes"] == 30.0
    assert payload["input_data"] == dict(zip(trip.MODEL_INPUTS, VALID))
    assert payload["timestamp"] == "2024-01-01T00:00:00"
