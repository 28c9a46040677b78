"""Registered queries: joining forecasts with actuals, accuracy, choosing the best."""

from functools import reduce

from pyspark.sql import functions as F

from demand_engine.catalog.common import (
    DEMAND,
    FORECAST_END,
    FORECAST_START,
    NAIVE,
    demand,
    naive_forecast,
    out,
    r6,
    register,
)
from demand_engine.operators import score
from demand_engine.operators.clean import canonical, filter_window
from demand_engine.operators.series import sample_series, seasonal_naive
from demand_engine.plans.forecast import evaluate
from demand_engine.plans.training import best_trial

_TIME, _ID = "timestamp_hour", "pickup_community_area"


def _predictions(spark, sf_dir):
    return canonical(naive_forecast(spark, sf_dir), _TIME, _ID, "prediction", "prediction")


def _actuals(spark, sf_dir):
    return canonical(demand(spark, sf_dir), _TIME, _ID, "trip_count", "actual")


def _pairs(spark, sf_dir):
    return score.join_actuals(_predictions(spark, sf_dir), _actuals(spark, sf_dir))


@register("join_actuals", NAIVE + " SELECT * FROM pairs")
def join_actuals(spark, sf_dir):
    return out(_pairs(spark, sf_dir))


@register("join_on_text_ids", NAIVE + " SELECT * REPLACE (CAST(series_id AS VARCHAR) AS series_id) FROM pairs")
def join_on_text_ids(spark, sf_dir):
    pred = _predictions(spark, sf_dir).withColumn("series_id", F.col("series_id").cast("string"))
    return out(score.join_actuals(pred, _actuals(spark, sf_dir)))


@register(
    "restrict_to_range",
    NAIVE
    + """, bounds AS MATERIALIZED (SELECT min(timestamp_hour) AS low, max(timestamp_hour) AS high FROM naive)
    SELECT timestamp_hour AS timestamp, pickup_community_area AS series_id, trip_count AS actual
    FROM demand JOIN bounds ON timestamp_hour BETWEEN low AND high""",
)
def restrict_to_range(spark, sf_dir):
    return out(score.restrict_to_range(_actuals(spark, sf_dir), _predictions(spark, sf_dir)))


@register(
    "prediction_sample",
    NAIVE + " SELECT * FROM pairs WHERE series_id = (SELECT min(series_id) FROM pairs)",
)
def prediction_sample(spark, sf_dir):
    return out(sample_series(_pairs(spark, sf_dir)))


_MEASURES = f"""count(*) AS n, {r6("avg(abs(actual - prediction))")} AS mae, {r6("sqrt(avg(pow(actual - prediction, 2)))")} AS rmse,
  {r6('''CASE WHEN count(*) FILTER (WHERE actual <> 0) > 0
    THEN 100 * avg(abs((actual - prediction) / actual)) FILTER (WHERE actual <> 0)
    WHEN sum(abs(prediction)) > 0 THEN 'infinity'::DOUBLE ELSE 0 END''')} AS mape"""


@register("accuracy", NAIVE + f" SELECT {_MEASURES} FROM pairs")
def accuracy(spark, sf_dir):
    return out(evaluate(naive_forecast(spark, sf_dir), demand(spark, sf_dir)))


@register("accuracy_by_area", NAIVE + f" SELECT series_id, {_MEASURES} FROM pairs GROUP BY 1")
def accuracy_by_area(spark, sf_dir):
    return out(score.accuracy_by(_pairs(spark, sf_dir)))


@register(
    "accuracy_extra",
    NAIVE
    + f""", scale AS (SELECT avg(abs(trip_count - before)) AS s FROM (
      SELECT timestamp_hour, trip_count, lag(trip_count, 24) OVER (PARTITION BY pickup_community_area ORDER BY timestamp_hour) AS before
      FROM demand WHERE timestamp_hour < TIMESTAMP '{FORECAST_START}'))
    SELECT {_MEASURES}, {r6("sum(abs(actual - prediction)) / sum(actual)")} AS wape,
      {r6("1 - sum(pow(actual - prediction, 2)) / (var_pop(actual) * count(*))")} AS r2,
      {r6("avg(abs(actual - prediction)) / (SELECT s FROM scale)")} AS mase FROM pairs""",
)
def accuracy_extra(spark, sf_dir):
    table = demand(spark, sf_dir)
    history = table.where(F.col(_TIME) < F.lit(FORECAST_START).cast("timestamp")).select(_TIME, _ID, "trip_count")
    scale = score.naive_scale(history, 24, _ID, _TIME, "trip_count")
    return out(score.accuracy(_pairs(spark, sf_dir), extra=True, scale=scale))


@register("rmse", NAIVE + f" SELECT {r6('sqrt(avg(pow(actual - prediction, 2)))')} AS rmse FROM pairs")
def rmse(spark, sf_dir):
    return out(score.rmse(_pairs(spark, sf_dir)))


_SEASONS = [24, 48, 168]
_TRIALS = " UNION ALL ".join(
    f"""SELECT 'season-{s}' AS trial_id, {s} AS season, 'SUCCEEDED' AS state, {r6("sqrt(avg(pow(trip_count - p, 2)))")} AS rmse FROM (
      SELECT timestamp_hour, trip_count, lag(trip_count, {s}) OVER (PARTITION BY pickup_community_area ORDER BY timestamp_hour) AS p FROM demand)
    WHERE timestamp_hour >= TIMESTAMP '{FORECAST_START}' AND timestamp_hour < TIMESTAMP '{FORECAST_END}'"""
    for s in _SEASONS
)


@register("best_trial", DEMAND + f" SELECT * FROM ({_TRIALS}) ORDER BY rmse, trial_id LIMIT 1")
def best_season(spark, sf_dir):
    """Which season makes the best naive forecast of the last week."""
    table = demand(spark, sf_dir).select(_TIME, _ID, "trip_count")

    def trial(season):
        made = filter_window(seasonal_naive(table, season), FORECAST_START, FORECAST_END, _TIME, closed="left")
        scored = score.rmse(made, "trip_count")
        return scored.select(
            F.lit(f"season-{season}").alias("trial_id"), F.lit(season).alias("season"), F.lit("SUCCEEDED").alias("state"), "rmse"
        )

    return out(best_trial(reduce(lambda a, b: a.unionByName(b), map(trial, _SEASONS))))
