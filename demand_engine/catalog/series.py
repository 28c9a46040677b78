"""Registered queries: lags, rolling means, context windows, splits, features."""

from pyspark.sql import functions as F

from demand_engine.catalog.common import (
    COUNTS,
    DEMAND,
    FORECAST_START,
    HORIZON,
    TRAIN_END,
    VAL_END,
    demand,
    out,
    r6,
    register,
)
from demand_engine.fixtures import AREAS
from demand_engine.operators import features as feats
from demand_engine.operators import series
from demand_engine.plans.forecast import future_features
from demand_engine.session import shared_folder
from demand_engine.sources.series import read_series, write_series

_W = "OVER (PARTITION BY pickup_community_area ORDER BY timestamp_hour"
_LAGS = ", ".join(f"lag(trip_count, {k}) {_W}) AS target_lag_{k}" for k in series.LAGS)


def _rolls(horizon: int) -> str:
    return ", ".join(
        f"{r6(f'avg(trip_count) {_W} ROWS BETWEEN {horizon + k - 1} PRECEDING AND {horizon} PRECEDING)')} AS target_rollmean_{k}"
        for k in series.ROLLING_WINDOWS
    )


def _demand(spark, sf_dir):
    return demand(spark, sf_dir).select("timestamp_hour", "pickup_community_area", "trip_count")


def _stored(spark, sf_dir):
    """The demand table stored by series, and read again."""
    folder = shared_folder(spark, "series")
    write_series(_demand(spark, sf_dir), folder)
    return read_series(spark, folder)


_KEYS = "timestamp_hour, pickup_community_area, trip_count"


@register("lags", DEMAND + f" SELECT {_KEYS}, {_LAGS} FROM demand")
def lags(spark, sf_dir):
    return out(series.add_lags(_demand(spark, sf_dir)))


@register("features_of_stored_series", DEMAND + f" SELECT {_KEYS}, {_LAGS}, {_rolls(1)} FROM demand")
def features_of_stored_series(spark, sf_dir):
    """Lags and rolling means on the layout of the files, without a shuffle."""
    return out(series.add_rolling_means(series.add_lags(_stored(spark, sf_dir))))


@register("lags_in_pieces", DEMAND + f" SELECT {_KEYS}, {_LAGS}, {_rolls(1)} FROM demand")
def lags_in_pieces(spark, sf_dir):
    """Series cut into pieces of 240 steps, each worked on by its own task."""
    made = series.add_lags(_demand(spark, sf_dir), chunk=240)
    return out(series.add_rolling_means(made, chunk=240))


@register("rolling_means", DEMAND + f" SELECT {_KEYS}, {_rolls(1)} FROM demand")
def rolling_means(spark, sf_dir):
    return out(series.add_rolling_means(_demand(spark, sf_dir)))


@register(
    "seasonal_naive",
    DEMAND + f" SELECT {_KEYS}, CAST(lag(trip_count, 24) {_W}) AS DOUBLE) AS prediction FROM demand",
)
def seasonal_naive(spark, sf_dir):
    return out(series.seasonal_naive(_demand(spark, sf_dir), 24))


_CONTEXT = (
    DEMAND
    + f""", w AS (SELECT timestamp_hour, pickup_community_area,
      list(trip_count) {_W} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS context,
      list(trip_count) {_W} ROWS BETWEEN 1 FOLLOWING AND 24 FOLLOWING) AS future FROM demand)
    SELECT timestamp_hour, pickup_community_area, array_to_string(context, ',') AS context, array_to_string(future, ',') AS future
    FROM w WHERE len(context) = 168 AND len(future) = 24"""
)


def _context(rows):
    made = series.context_windows(rows)
    return out(made.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("context", "future")}))


@register("context_windows", _CONTEXT)
def context_windows(spark, sf_dir):
    return _context(_demand(spark, sf_dir))


@register("context_of_stored_series", _CONTEXT)
def context_of_stored_series(spark, sf_dir):
    return _context(_stored(spark, sf_dir))


@register(
    "split_by_fraction",
    DEMAND
    + """, t AS (SELECT timestamp_hour, row_number() OVER (ORDER BY timestamp_hour) - 1 AS i, count(*) OVER () AS n
      FROM (SELECT DISTINCT timestamp_hour FROM demand))
    SELECT d.timestamp_hour, d.pickup_community_area, CASE WHEN i < n * 0.8e0 THEN 'train' WHEN i < n * 0.9e0 THEN 'validation' ELSE 'test' END AS split
    FROM demand d JOIN t USING (timestamp_hour)""",
)
def split_by_fraction(spark, sf_dir):
    made = series.split_by_fraction(_demand(spark, sf_dir))
    return out(made.select("timestamp_hour", "pickup_community_area", "split"))


@register(
    "split_by_date",
    DEMAND
    + f""" SELECT timestamp_hour, pickup_community_area, CASE WHEN timestamp_hour < TIMESTAMP '{TRAIN_END}' THEN 'train' ELSE 'validation' END AS split
    FROM demand WHERE timestamp_hour < TIMESTAMP '{VAL_END}'""",
)
def split_by_date(spark, sf_dir):
    made = series.split_by_date(_demand(spark, sf_dir), TRAIN_END, VAL_END)
    return out(made.select("timestamp_hour", "pickup_community_area", "split"))


@register(
    "sample_series",
    DEMAND + f" SELECT {_KEYS} FROM demand WHERE pickup_community_area = (SELECT min(pickup_community_area) FROM demand)",
)
def sample_series(spark, sf_dir):
    return out(series.sample_series(_demand(spark, sf_dir), "pickup_community_area"))


_ONE_HOT = ", ".join(f"CASE WHEN pickup_community_area = {a} THEN 1 ELSE 0 END AS area_{a}" for a in AREAS)
_CYCLIC = ", ".join(
    f"{r6(f'{fn}(2 * pi() * {angle})')} AS {name}_{fn}"
    for name, angle in {"hour": "hour(timestamp_hour) / 24", "dow": "(isodow(timestamp_hour) - 1) / 7"}.items()
    for fn in ("sin", "cos")
)


@register("one_hot", DEMAND + f" SELECT {_KEYS}, {_ONE_HOT} FROM demand")
def one_hot(spark, sf_dir):
    return out(feats.one_hot(_demand(spark, sf_dir), AREAS))


@register(
    "training_features",
    DEMAND
    + f""", f AS (SELECT timestamp_hour, pickup_community_area, {_ONE_HOT}, {_LAGS}, {_rolls(1)}, {_CYCLIC}, trip_count FROM demand)
    SELECT * FROM f WHERE target_lag_168 IS NOT NULL""",
)
def training_features(spark, sf_dir):
    return out(feats.features(_demand(spark, sf_dir), AREAS))


@register(
    "feature_columns",
    DEMAND
    + f""", f AS (SELECT timestamp_hour, pickup_community_area, {_LAGS}, {_rolls(1)}, {_CYCLIC} FROM demand)
    SELECT target_lag_1, target_lag_2, target_lag_3, target_lag_24, target_lag_48, target_lag_168,
      target_rollmean_3, target_rollmean_6, target_rollmean_12, target_rollmean_24, hour_sin, hour_cos, dow_sin, dow_cos FROM f""",
)
def feature_columns(spark, sf_dir):
    made = feats.add_cyclic(feats.add_target_features(_demand(spark, sf_dir)))
    return out(made.select(*feats.feature_columns(made)))


@register(
    "features_with_missing",
    DEMAND + f" SELECT timestamp_hour, pickup_community_area, {_LAGS}, {_rolls(1)}, {_CYCLIC} FROM demand",
)
def features_with_missing(spark, sf_dir):
    made = feats.add_cyclic(feats.add_target_features(_demand(spark, sf_dir)))
    return out(feats.finalize_features(made, ["timestamp_hour", "pickup_community_area"], train=False))


_HORIZON_SQL = f""", f AS (SELECT timestamp_hour, pickup_community_area, {_ONE_HOT},
  lag(trip_count, 168) {_W}) AS target_lag_168, {_rolls(HORIZON)}, {_CYCLIC} FROM demand)
  SELECT * FROM f WHERE timestamp_hour >= TIMESTAMP '{FORECAST_START}' AND timestamp_hour < TIMESTAMP '{FORECAST_START}' + INTERVAL {HORIZON} HOUR"""


@register("future_features", DEMAND + _HORIZON_SQL)
def features_of_the_future(spark, sf_dir):
    return out(future_features(_demand(spark, sf_dir), FORECAST_START, HORIZON, AREAS))


@register(
    "future_features_24h",
    COUNTS
    + f""", steps AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-31', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR)) AS timestamp_hour)
    SELECT timestamp_hour, pickup_community_area, {_ONE_HOT}, {_CYCLIC} FROM steps CROSS JOIN areas""",
)
def future_features_24h(spark, sf_dir):
    return out(future_features(_demand(spark, sf_dir), "2024-01-31", 24, AREAS, with_target_features=False))


@register("align_features", DEMAND + _HORIZON_SQL.replace("SELECT * FROM f", "SELECT timestamp_hour, pickup_community_area, target_lag_168, hour_sin, hour_cos, area_8 FROM f"))
def align_features(spark, sf_dir):
    made = future_features(_demand(spark, sf_dir), FORECAST_START, HORIZON, AREAS)
    wanted = ["target_lag_168", "hour_sin", "hour_cos", "area_8"]
    return out(feats.align_features(made, wanted, ["timestamp_hour", "pickup_community_area"]))


_HORIZON_SQL_24 = f""", f AS (SELECT timestamp_hour, pickup_community_area, {_ONE_HOT},
  {", ".join(f"lag(trip_count, {k}) {_W}) AS target_lag_{k}" for k in (24, 48, 168))}, {_rolls(24)}, {_CYCLIC} FROM demand)
  SELECT * FROM f WHERE timestamp_hour >= TIMESTAMP '{FORECAST_START}' AND timestamp_hour < TIMESTAMP '{FORECAST_START}' + INTERVAL 24 HOUR"""


@register("future_features_24h_lags", DEMAND + _HORIZON_SQL_24)
def future_features_24h_lags(spark, sf_dir):
    """The 24-hour horizon with the lags known a day ahead."""
    return out(future_features(_demand(spark, sf_dir), FORECAST_START, 24, AREAS))
