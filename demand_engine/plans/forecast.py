"""Whole jobs: future features, forecasts, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.functions.calendar import step_interval, timestamp_literal
from demand_engine.operators.clean import canonical
from demand_engine.operators.demand import future_grid
from demand_engine.operators.features import add_cyclic, add_target_features, horizon_lags, one_hot
from demand_engine.operators.score import accuracy, join_actuals, restrict_to_range
from demand_engine.operators.series import ROLLING_WINDOWS


def future_target_features(
    history: DataFrame,
    start,
    horizon: int,
    id: str = "pickup_community_area",
    time: str = "timestamp_hour",
    target: str = "trip_count",
    step: str = "hour",
) -> DataFrame:
    """Future grid with the lags and rolling means known at ``start``.

    They are computed on the history and the grid together, so training and forecast rows go through
    the same windows. Only the steps the windows reach are read from the history, which has to be
    gap-free up to ``start``.
    """
    lags = horizon_lags(horizon)
    first = timestamp_literal(start)
    reach = max(max(lags), horizon + max(ROLLING_WINDOWS) - 1)
    known = history.where(F.col(id).isNotNull() & (F.col(time) < first)).select(time, id, target)
    recent = known.where(F.col(time) >= first - step_interval(step, reach))
    future = future_grid(known, start, horizon, id, time, step).withColumn(
        target, F.lit(None).cast(history.schema[target].dataType)
    )
    both = add_target_features(recent.unionByName(future), horizon, lags, None, id, time, target, step=step)
    return both.where(F.col(time) >= first).drop(target)


def future_features(
    history: DataFrame,
    start,
    horizon: int,
    ids: list,
    with_target_features: bool = True,
    id: str = "pickup_community_area",
    time: str = "timestamp_hour",
    target: str = "trip_count",
) -> DataFrame:
    """Feature table of the horizon: id, time, then the features in alphabetical order.

    ``with_target_features=False`` leaves lags and rolling means out.
    """
    if with_target_features:
        rows = future_target_features(history, start, horizon, id, time, target)
    else:
        rows = future_grid(history, start, horizon, id, time)
    made = one_hot(add_cyclic(rows, time), ids, id)
    return made.select(id, time, *sorted(c for c in made.columns if c not in (id, time)))


def evaluate(
    pred: DataFrame,
    act: DataFrame,
    by: list[str] = (),
    extra: bool = False,
    id: str = "pickup_community_area",
    time: str = "timestamp_hour",
    target: str = "trip_count",
    prediction: str = "prediction",
) -> DataFrame:
    """Accuracy of a prediction table against the demand table."""
    p = canonical(pred, time, id, prediction, "prediction")
    a = restrict_to_range(canonical(act, time, id, target, "actual"), p)
    return accuracy(join_actuals(p, a), by, extra)
