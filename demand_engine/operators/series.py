"""Per-series window features on gap-free series, and chronological splits.

A prepared series has one row per step and its length is the length of the time axis, so by default
one window partition is one series: that is the partitioning ``fill_gaps`` leaves behind, and no
shuffle is added. For very long or very few series pass ``chunk``: the axis is cut into pieces of that
many steps, each with the neighbouring steps its windows reach into, and a series is worked on by as
many tasks as it has pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from demand_engine.functions.calendar import timestamp_literal
from demand_engine.operators.ordering import key_at

# The lags and rolling windows of the demand model, in steps.
LAGS = [1, 2, 3, 24, 48, 168]
ROLLING_WINDOWS = [3, 6, 12, 24]

STEP_SECONDS = {"hour": 3600, "day": 86400}


def with_series_columns(
    df: DataFrame,
    columns: Callable[[WindowSpec], dict[str, Column]],
    id: str,
    time: str,
    back: int,
    ahead: int = 0,
    chunk: int | None = None,
    step: str = "hour",
) -> DataFrame:
    """Adds window columns that reach ``back`` rows back and ``ahead`` rows ahead in their series."""
    if chunk is None:
        return df.withColumns(columns(Window.partitionBy(id).orderBy(time)))
    if max(back, ahead) > chunk:
        raise ValueError("chunk must be at least as long as the reach of the windows")
    position = F.floor(F.unix_timestamp(time) / STEP_SECONDS[step])
    own = F.floor(position / chunk)
    inside = F.pmod(position, F.lit(chunk))
    copies = F.array(
        own,
        F.when(inside >= chunk - back, own + 1),
        F.when(inside < ahead, own - 1),
    )
    pieces = df.withColumn("_own", own).withColumn(
        "_piece", F.explode(F.filter(copies, lambda c: c.isNotNull()))
    )
    made = pieces.withColumns(columns(Window.partitionBy(id, "_piece").orderBy(time)))
    return made.where(F.col("_own") == F.col("_piece")).drop("_own", "_piece")


def add_lags(
    df: DataFrame,
    lags: list[int] = LAGS,
    id: str = "pickup_community_area",
    time: str = "timestamp_hour",
    target: str = "trip_count",
    chunk: int | None = None,
    step: str = "hour",
) -> DataFrame:
    def columns(series: WindowSpec) -> dict[str, Column]:
        return {f"target_lag_{k}": F.lag(target, k).over(series) for k in lags}

    return with_series_columns(df, columns, id, time, back=max(lags), chunk=chunk, step=step)


def add_rolling_means(
    df: DataFrame,
    windows: list[int] = ROLLING_WINDOWS,
    id: str = "pickup_community_area",
    time: str = "timestamp_hour",
    target: str = "trip_count",
    horizon: int = 1,
    chunk: int | None = None,
    step: str = "hour",
) -> DataFrame:
    """Means of the last k known steps; the newest known step lies ``horizon`` steps back."""

    def columns(series: WindowSpec) -> dict[str, Column]:
        return {
            f"target_rollmean_{k}": F.avg(target).over(series.rowsBetween(-(horizon + k - 1), -horizon))
            for k in windows
        }

    return with_series_columns(
        df, columns, id, time, back=horizon + max(windows) - 1, chunk=chunk, step=step
    )


def seasonal_naive(
    df: DataFrame,
    season: int = 168,
    id: str = "pickup_community_area",
    time: str = "timestamp_hour",
    target: str = "trip_count",
    name: str = "prediction",
    chunk: int | None = None,
    step: str = "hour",
) -> DataFrame:
    """The value one season earlier as forecast; null in the first season."""

    def columns(series: WindowSpec) -> dict[str, Column]:
        return {name: F.lag(target, season).over(series).cast("double")}

    return with_series_columns(df, columns, id, time, back=season, chunk=chunk, step=step)


def context_windows(
    df: DataFrame,
    context: int = 168,
    horizon: int = 24,
    id: str = "pickup_community_area",
    time: str = "timestamp_hour",
    target: str = "trip_count",
    chunk: int | None = None,
    step: str = "hour",
) -> DataFrame:
    """Per (series, t) the last ``context`` values up to t and the next ``horizon``; full ones only."""

    def columns(series: WindowSpec) -> dict[str, Column]:
        return {
            "context": F.collect_list(target).over(series.rowsBetween(-(context - 1), 0)),
            "future": F.collect_list(target).over(series.rowsBetween(1, horizon)),
        }

    made = with_series_columns(
        df.select(id, time, target), columns, id, time, back=context - 1, ahead=horizon, chunk=chunk, step=step
    )
    full = (F.size("context") == context) & (F.size("future") == horizon)
    return made.where(full).select(id, time, "context", "future")


def split_by_fraction(
    df: DataFrame, train: float = 0.8, validation: float = 0.1, time: str = "timestamp_hour"
) -> DataFrame:
    """Labels rows train, validation or test by the position of their time among the distinct times."""
    cuts = key_at(
        df.select(time).distinct(),
        time,
        {
            "train": lambda total: F.ceil(total * F.lit(train)),
            "validation": lambda total: F.ceil(total * F.lit(train + validation)),
        },
    )
    before_cut = {name: F.coalesce(F.col(time) < cut, F.lit(True)) for name, cut in cuts.items()}
    label = F.when(before_cut["train"], "train").when(before_cut["validation"], "validation").otherwise("test")
    return df.withColumn("split", label)


def split_by_date(
    df: DataFrame, train_end, val_end, time: str = "timestamp_hour", check: bool = False
) -> DataFrame:
    """Labels rows before ``train_end`` train and those before ``val_end`` validation; drops the rest.

    With ``check`` an empty side raises; that runs a count.
    """
    at_train, at_val = timestamp_literal(train_end), timestamp_literal(val_end)
    label = F.when(F.col(time) < at_train, "train").otherwise("validation")
    out = df.where(F.col(time) < at_val).withColumn("split", label)
    if check:
        sides = out.agg(
            F.count_if(F.col("split") == "train"), F.count_if(F.col("split") == "validation")
        ).first()
        if not all(sides):
            raise ValueError("train or validation set is empty after splitting: check the dates")
    return out


def sample_series(df: DataFrame, id: str = "series_id") -> DataFrame:
    """All rows of one series: the one with the smallest id."""
    return df.where(F.col(id) == df.select(F.min(id)).scalar())
