"""Registered queries that fit a model; every query fits its own.

A fit has no SQL form. The oracles state what SQL knows about its result: the keys, the seasonal naive error that
the model has to stay under, the names of the features, the ranges of the search.

``train_model`` and ``forecast_accuracy`` fit the library's defaults (100 trees); the searches have the library's ranges
(50 to 500 trees) and number of trials. TREES bounds the trees of the others.
"""

from pyspark.sql import functions as F

from demand_engine.catalog.common import (
    DEMAND,
    END_DATE,
    FORECAST_END,
    FORECAST_START,
    HORIZON,
    MAX_POINTS,
    NAIVE,
    TRAIN_END,
    VAL_END,
    demand,
    naive_forecast,
    out,
    r6,
    register,
    trips,
)
from demand_engine.fixtures import read
from demand_engine.operators.clean import filter_window
from demand_engine.operators.features import add_cyclic
from demand_engine.operators.score import rmse
from demand_engine.operators.series import ROLLING_WINDOWS, seasonal_naive, split_by_date
from demand_engine.plans import training
from demand_engine.plans.forecast import evaluate, future_target_features
from demand_engine.plans.run import Settings, run_forecasting
from demand_engine.session import shared_folder, use_utc
from demand_engine.sources.tables import read_table

TREES = 20
_TIME, _ID = "timestamp_hour", "pickup_community_area"


def _rows(spark, sf_dir):
    return training.model_rows(demand(spark, sf_dir), HORIZON)


def _model(spark, sf_dir, **params):
    return training.train(_rows(spark, sf_dir), TRAIN_END, VAL_END, params or {"n_estimators": TREES})


def _forecast(spark, sf_dir, **params):
    rows = add_cyclic(future_target_features(demand(spark, sf_dir), FORECAST_START, HORIZON))
    return training.predict(_model(spark, sf_dir, **params), rows)


_WEEK = f"timestamp_hour >= TIMESTAMP '{TRAIN_END}' AND timestamp_hour < TIMESTAMP '{VAL_END}'"
#: The error of repeating the week before, over the validation week.
_NAIVE_ERROR = DEMAND + f""", w AS MATERIALIZED (
      SELECT timestamp_hour, pickup_community_area, trip_count,
        lag(trip_count, 168) OVER (PARTITION BY pickup_community_area ORDER BY timestamp_hour) AS before FROM demand),
    v AS MATERIALIZED (SELECT * FROM w WHERE {_WEEK})"""


def _naive_error(spark, sf_dir):
    past = seasonal_naive(demand(spark, sf_dir), name="before")
    week = split_by_date(past, TRAIN_END, VAL_END).where("split = 'validation'")
    return rmse(week, "trip_count", "before").select("rmse").scalar()


@register(
    "train_model",
    _NAIVE_ERROR
    + f""" SELECT timestamp_hour, pickup_community_area, {r6("(SELECT sqrt(avg(power(trip_count - before, 2))) FROM v)")} AS naive_rmse, TRUE AS beats_naive FROM v""",
)
def train_model(spark, sf_dir):
    """A fit with the defaults: its error over the validation week against that of repeating the week before."""
    sides = split_by_date(_rows(spark, sf_dir), TRAIN_END, VAL_END)
    made = _model(spark, sf_dir, **training.DEFAULTS).transform(sides.where("split = 'validation'"))
    naive = _naive_error(spark, sf_dir)
    error = rmse(made, "trip_count").select("rmse").scalar()
    return out(made.select(_TIME, _ID, naive.alias("naive_rmse"), (error < naive).alias("beats_naive")))


@register(
    "batch_forecast",
    DEMAND
    + f""", steps AS (SELECT unnest(generate_series(TIMESTAMP '{FORECAST_START}', TIMESTAMP '{FORECAST_START}' + INTERVAL {HORIZON - 1} HOUR, INTERVAL 1 HOUR)) AS timestamp_hour)
    SELECT timestamp_hour, pickup_community_area, TRUE AS in_range FROM steps CROSS JOIN areas""",
)
def batch_forecast(spark, sf_dir):
    """A forecast for every id and step, none below zero or far above the largest count."""
    most = demand(spark, sf_dir).select(F.max("trip_count")).scalar()
    made = _forecast(spark, sf_dir)
    return out(made.select(_TIME, _ID, F.col("prediction").between(0, 1.25 * most).alias("in_range")))


@register(
    "forecast_accuracy",
    NAIVE
    + f""" SELECT count(*) AS n, {r6("sqrt(avg(power(actual - prediction, 2)))")} AS naive_rmse, TRUE AS beats_naive FROM pairs""",
)
def forecast_accuracy(spark, sf_dir):
    """The model's error against that of repeating the week before."""
    table = demand(spark, sf_dir)
    naive = evaluate(naive_forecast(spark, sf_dir), table).select("rmse").scalar()
    scored = evaluate(_forecast(spark, sf_dir, **training.DEFAULTS), table)
    return out(scored.select("n", naive.alias("naive_rmse"), (F.col("rmse") < naive).alias("beats_naive")))


@register("better_than_mean", "SELECT TRUE AS better_than_mean")
def better_than_mean(spark, sf_dir):
    """On its training rows the model has a smaller error than their mean."""
    rows = split_by_date(_rows(spark, sf_dir), TRAIN_END, VAL_END).where("split = 'train'")
    made = _model(spark, sf_dir).transform(rows).select("trip_count", "prediction")
    error = rmse(made, "trip_count").select("rmse").scalar()
    return made.agg((error < F.stddev_pop("trip_count")).alias("better_than_mean"))


_FEATURES = ["target_lag_168", *[f"target_rollmean_{k}" for k in ROLLING_WINDOWS], "hour_sin", "hour_cos", "dow_sin", "dow_cos"]


@register(
    "feature_importance",
    DEMAND
    + " SELECT unnest(["
    + ", ".join(f"'{f}'" for f in [*_FEATURES, "area="])
    + """]) AS feature, 1e0 AS total, TRUE AS in_range, TRUE AS past_counts
    UNION ALL SELECT DISTINCT 'area=' || pickup_community_area, 1e0, TRUE, TRUE FROM demand""",
)
def feature_importance(spark, sf_dir):
    """One share per feature and id; together they are 1, and past counts have a part of it."""
    found = training.feature_importance(_model(spark, sf_dir), _rows(spark, sf_dir), per_value=True)
    sums = found.agg(
        F.struct(F.sum("importance").alias("all"), F.sum(F.when(F.col("feature").startswith("target_"), F.col("importance"))).alias("past")).alias("s")
    ).scalar()
    return out(
        found.select(
            "feature", sums.getField("all").alias("total"), F.col("importance").between(0, 1).alias("in_range"),
            (sums.getField("past") > 0).alias("past_counts"),
        )
    )


@register("saved_model", DEMAND + f" SELECT count(*) AS n_rows, 0 AS n_different FROM demand WHERE timestamp_hour >= TIMESTAMP '{TRAIN_END}' AND timestamp_hour < TIMESTAMP '{VAL_END}'")
def saved_model(spark, sf_dir):
    """A model read back predicts what the saved one does."""
    folder = shared_folder(spark, "model")
    model = _model(spark, sf_dir)
    training.save_model(model, folder)
    rows = split_by_date(_rows(spark, sf_dir), TRAIN_END, VAL_END).where("split = 'validation'")
    first = training.predict(model, rows)
    again = training.predict(training.load_model(folder), rows).withColumnRenamed("prediction", "again")
    both = first.join(again, [_TIME, _ID])
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(F.col("prediction") - F.col("again")) > 1e-9).cast("int").alias("n_different")
    )


@register(
    "hyperparameter_search",
    "SELECT CAST(i AS VARCHAR) AS trial_id, 'SUCCEEDED' AS state, TRUE AS in_range, 1 AS n_best, TRUE AS none_better FROM range(1, 11) t(i)",
)
def hyperparameter_search(spark, sf_dir):
    """Ten random trials, and the best of them: its error is the smallest of all rows."""
    trials = training.sample_trials(spark)
    done = training.run_trials(_rows(spark, sf_dir), trials, TRAIN_END, VAL_END, parallel=2)
    best = training.best_trial(done).select(F.struct("trial_id", "rmse").alias("best")).scalar()
    inside = F.lit(True)
    for name, (low, high, _) in training.SEARCH_RANGES.items():
        inside = inside & F.col(name).between(low, high)
    n_best = done.agg(F.count_if(F.col("trial_id") == best.getField("trial_id")).cast("int")).scalar()
    none_better = (F.col("rmse") >= best.getField("rmse")).alias("none_better")
    return out(done.select("trial_id", "state", inside.alias("in_range"), n_best.alias("n_best"), none_better))


@register("model_with_roles", _NAIVE_ERROR + f""" SELECT count(*) AS n, {r6("sqrt(avg(power(trip_count - before, 2)))")} AS naive_rmse, TRUE AS beats_naive FROM v""")
def model_with_roles(spark, sf_dir):
    """Training on declared column roles instead of the lag features, against repeating the week before."""
    table = demand(spark, sf_dir)
    numeric = ["hour", "day_of_week", "month", "year", "day_of_year", "hour_sin", "hour_cos"]
    roles = training.feature_roles(table, _TIME, "trip_count", _ID, [*numeric, _ID], ["is_weekend"])
    model = training.train(table, TRAIN_END, VAL_END, {"n_estimators": TREES}, roles=roles)
    week = model.transform(split_by_date(table, TRAIN_END, VAL_END).where("split = 'validation'"))
    error = F.sqrt(F.avg((F.col("trip_count") - F.col("prediction")) ** 2))
    naive = _naive_error(spark, sf_dir)
    return out(week.agg(F.count(F.lit(1)).alias("n"), naive.alias("naive_rmse"), (error < naive).alias("beats_naive")))


@register(
    "forecasting_run",
    NAIVE
    + f""" SELECT count(*) AS n, {r6("sqrt(avg(power(actual - prediction, 2)))")} AS naive_rmse, TRUE AS beats_naive FROM pairs""",
)
def forecasting_run(spark, sf_dir):
    """The whole run: prepare, search with ten trials, train, forecast, score and record, from raw trips in a folder."""
    folder = shared_folder(use_utc(spark), "run")
    trips(spark, sf_dir).select("trip_start_timestamp", "pickup_community_area").write.parquet(f"{folder}/trips")
    settings = Settings(
        end_date=END_DATE, max_points=MAX_POINTS, train_end=TRAIN_END, val_end=VAL_END, horizon=HORIZON, search=True
    )
    scored = run_forecasting(spark, f"{folder}/trips", f"{folder}/out", settings).select("n", "rmse")
    naive = evaluate(naive_forecast(spark, sf_dir), read_table(spark, f"{folder}/out/demand")).select("rmse").scalar()
    return out(scored.select("n", naive.alias("naive_rmse"), (F.col("rmse") < naive).alias("beats_naive")))


@register(
    "run_record",
    "SELECT 'demand-model' AS display_name, max(ts) AS create_time, '' AS model_path, 168 AS forecast_horizon, 720 AS window_size FROM events",
)
def run_record(spark, sf_dir):
    """A record dated by the newest event."""
    newest = read(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
    return out(
        training.run_record(spark, shared_folder(spark, "runs"), "demand-model", str(newest), HORIZON, 720)
    )
