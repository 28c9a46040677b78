"""Model features: cyclic, one-hot, lags and rolling means, and their selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.functions.calendar import cyclic, dow_mon0, flag
from demand_engine.operators.demand import distinct_ids
from demand_engine.operators.series import LAGS, ROLLING_WINDOWS, add_lags, add_rolling_means
from demand_engine.sources.tables import require

CYCLIC = ["hour_sin", "hour_cos", "dow_sin", "dow_cos"]
PREFIXES = ["area_", "target_lag_", "target_rollmean_"]


def add_cyclic(df: DataFrame, time: str = "timestamp_hour") -> DataFrame:
    """Hour (period 24) and weekday (period 7, Monday 0) on the unit circle."""
    hour_sin, hour_cos = cyclic(F.hour(time), 24)
    dow_sin, dow_cos = cyclic(dow_mon0(time), 7)
    return df.withColumns({"hour_sin": hour_sin, "hour_cos": hour_cos, "dow_sin": dow_sin, "dow_cos": dow_cos})


def one_hot(
    df: DataFrame, ids: list, id: str = "pickup_community_area", prefix: str = "area_"
) -> DataFrame:
    """One 0/1 column per id of the dictionary; a null id is 0 in all of them."""
    series = F.col(id)
    return df.withColumns({f"{prefix}{v}": flag(series == v) for v in ids})


def feature_columns(df: DataFrame) -> list[str]:
    """Feature names in model order: one-hot, lags, rolling means, cyclic."""
    chosen = [c for prefix in PREFIXES for c in df.columns if c.startswith(prefix)]
    return chosen + [c for c in CYCLIC if c in df.columns]


def horizon_lags(horizon: int, lags: list[int] = LAGS) -> list[int]:
    """The lags already known ``horizon`` steps ahead."""
    usable = [k for k in lags if k >= horizon]
    if not usable:
        raise ValueError(f"no lag reaches back {horizon} steps")
    return usable


def add_target_features(
    df: DataFrame,
    horizon: int = 1,
    lags: list[int] | None = None,
    windows: list[int] | None = None,
    id: str = "pickup_community_area",
    time: str = "timestamp_hour",
    target: str = "trip_count",
    chunk: int | None = None,
    step: str = "hour",
) -> DataFrame:
    """Lags and rolling means that are known ``horizon`` steps ahead; horizon 1 keeps all of them."""
    lagged = add_lags(df, lags or horizon_lags(horizon), id, time, target, chunk, step)
    return add_rolling_means(lagged, windows or ROLLING_WINDOWS, id, time, target, horizon, chunk, step)


def finalize_features(
    df: DataFrame, keys: list[str], target: str | None = None, train: bool = True, check: bool = False
) -> DataFrame:
    """Keys, features and target. For training, rows with a missing feature are dropped; with
    ``check`` an empty result raises (that runs a job)."""
    wanted = feature_columns(df)
    if train and target is not None:
        wanted = [*wanted, target]
    out = df.select(*keys, *wanted)
    if not train:
        return out
    out = out.dropna(subset=wanted)
    if check and out.isEmpty():
        raise ValueError("no rows left after dropping those with missing features")
    return out


def features(
    df: DataFrame,
    ids: list,
    train: bool = True,
    horizon: int = 1,
    id: str = "pickup_community_area",
    time: str = "timestamp_hour",
    target: str = "trip_count",
    chunk: int | None = None,
) -> DataFrame:
    """The whole training feature step: lags, rolling means, cyclic, one-hot, incomplete rows dropped."""
    require(df, [time, id] + ([target] if train else []))
    out = df
    if target in df.columns:
        out = add_target_features(df, horizon, id=id, time=time, target=target, chunk=chunk)
    out = one_hot(add_cyclic(out, time), ids, id)
    return finalize_features(out, [time, id], target if train else None, train)


def align_features(df: DataFrame, model_cols: list[str], keys: list[str]) -> DataFrame:
    """Keys and the model's features in its order. A missing one raises, an extra one is left out."""
    have = [c for c in df.columns if c not in keys]
    missing = [c for c in model_cols if c not in have]
    if missing:
        extra = sorted(set(have) - set(model_cols))
        raise ValueError(f"the model reads {missing}, which the table lacks; the table also has {extra}")
    return df.select(*keys, *model_cols)
