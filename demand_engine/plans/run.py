"""The jobs in order: prepare, train (or search), forecast, score, record."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from demand_engine.operators.features import add_cyclic
from demand_engine.plans import training
from demand_engine.plans.forecast import evaluate, future_target_features
from demand_engine.plans.preparation import prepare_demand
from demand_engine.sources.tables import read_csv, write_csv, write_table

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("pickup_community_area", T.LongType()),
        T.StructField("timestamp_hour", T.TimestampType()),
        T.StructField("prediction", T.DoubleType()),
    ]
)


@dataclass
class Settings:
    """The defaults of a run. An empty ``forecast_start`` means ``val_end``."""

    end_date: str = "2023-11-22"
    max_points: int = 2950
    train_end: str = "2023-10-01T00:00:00"
    val_end: str = "2023-11-22T00:00:00"
    forecast_start: str = ""
    horizon: int = 168
    search: bool = False
    max_trials: int = 10
    parallel_trials: int = 2
    params: dict | None = None
    ranges: dict | None = None


def run_forecasting(spark: SparkSession, source: str, out: str, settings: Settings, **columns: str) -> DataFrame:
    """Runs every step, leaves ``demand``, ``model``, ``predictions`` and ``runs`` below ``out`` and
    returns the accuracy over the forecast steps that have an actual."""
    s = settings
    demand = prepare_demand(spark, source, f"{out}/demand", s.end_date, s.max_points, **columns)
    rows = training.model_rows(demand, s.horizon)
    with training.kept(rows):
        params = s.params
        if s.search:
            trials = training.sample_trials(spark, s.ranges or training.SEARCH_RANGES, s.max_trials)
            done = training.run_trials(rows, trials, s.train_end, s.val_end, s.parallel_trials)
            write_table(done, f"{out}/trials")
            best = training.best_trial(done).first().asDict()
            params = {k: best[k] for k in training.DEFAULTS if k in best}
        model = training.train(rows, s.train_end, s.val_end, params)
    training.save_model(model, f"{out}/model")

    start = s.forecast_start or s.val_end
    future = add_cyclic(future_target_features(demand, start, s.horizon))
    write_csv(training.predict(training.load_model(f"{out}/model"), future), f"{out}/predictions")
    predictions = read_csv(spark, f"{out}/predictions", PREDICTION_SCHEMA, "timestamp_hour")
    now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    training.run_record(spark, f"{out}/runs", f"demand-model-{now}", now, s.horizon, s.max_points, f"{out}/model")
    return evaluate(predictions, demand)
