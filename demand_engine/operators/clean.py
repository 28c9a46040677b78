"""Filters, casts, naming and clipping of raw rows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from demand_engine.functions.calendar import timestamp_literal
from demand_engine.operators.ordering import exact_quantiles
from demand_engine.sources.committed import CommittedTable
from demand_engine.sources.tables import require

def window_bounds(end_date: str, n: int) -> tuple[datetime, datetime]:
    """First and last moment of an n-point hourly window that ends with ``end_date``.

    The start is cut to its day, so the window holds up to 47 hours more than n.
    """
    day = datetime.strptime(end_date, "%Y-%m-%d")
    first = day - timedelta(hours=n - 1)
    return first.replace(hour=0, minute=0, second=0), day.replace(hour=23, minute=59, second=59)


def filter_window(
    df: DataFrame, start, end, time: str, not_null: list[str] | None = None, closed: str = "both"
) -> DataFrame:
    """Rows inside the range; ``closed='left'`` leaves the end out. Reaches the Parquet scan."""
    low, high = timestamp_literal(start), timestamp_literal(end)
    if closed not in ("both", "left"):
        raise ValueError("closed must be 'both' or 'left'")
    upper = F.col(time) <= high if closed == "both" else F.col(time) < high
    keep = (F.col(time) >= low) & upper
    for c in not_null or []:
        keep = keep & F.col(c).isNotNull()
    return df.where(keep)


def _lenient(c: str, kind: str) -> Column:
    return F.try_to_timestamp(F.col(c)) if kind == "timestamp" else F.col(c).try_cast("double")


def coerce(df: DataFrame, ts_cols: list[str] = (), num_cols: list[str] = ()) -> DataFrame:
    """Text to timestamps and doubles; what cannot be read becomes null."""
    casts = {c: _lenient(c, "timestamp") for c in ts_cols}
    casts.update({c: _lenient(c, "double") for c in num_cols})
    return df.withColumns(casts)


def _coercion_counts(kinds: dict[str, str]) -> list[Column]:
    counts = []
    for i, (c, kind) in enumerate(kinds.items()):
        counts += [
            F.count_if(F.col(c).isNull()).alias(f"before_{i}"),
            F.count_if(_lenient(c, kind).isNull()).alias(f"after_{i}"),
        ]
    return counts


def coercion_report(df: DataFrame, ts_cols: list[str] = (), num_cols: list[str] = ()) -> DataFrame:
    """Per column: nulls before and after the lenient cast, and how many the cast made."""
    kinds = {**{c: "timestamp" for c in ts_cols}, **{c: "double" for c in num_cols}}
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"before_{i}").alias("nulls_before"),
            F.col(f"after_{i}").alias("nulls_after"),
            (F.col(f"after_{i}") - F.col(f"before_{i}")).alias("nulls_coerced"),
        )
        for i, c in enumerate(kinds)
    ]
    return df.agg(*_coercion_counts(kinds)).select(F.inline(F.array(*rows)))


def coerce_into(table: CommittedTable, df: DataFrame, ts_cols: list[str] = (), num_cols: list[str] = ()) -> DataFrame:
    """Replaces the table by the coerced rows; the report of ``coercion_report``, counted while they are written, so the
    source is read once."""
    kinds = {**{c: "timestamp" for c in ts_cols}, **{c: "double" for c in num_cols}}
    counts = {f"_seen_{i}": c for i, c in enumerate(_coercion_counts(kinds))}
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in counts.items()])
    table.replace(coerce(watched, ts_cols, num_cols))
    found = seen.get
    rows = []
    for i, c in enumerate(kinds):
        before, after = found[f"_seen_{2 * i}"], found[f"_seen_{2 * i + 1}"]
        rows.append((c, before, after, after - before))
    return df.sparkSession.createDataFrame(rows, "column_name string, nulls_before bigint, nulls_after bigint, nulls_coerced bigint")


def drop_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return require(df, cols).dropna(subset=cols)


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def order_columns(df: DataFrame, id: str = "pickup_community_area", time: str = "timestamp_hour") -> DataFrame:
    rest = sorted(c for c in df.columns if c not in (id, time))
    return df.select(id, time, *rest)


def with_aliases(df: DataFrame, time: str = "timestamp_hour", target: str = "trip_count") -> DataFrame:
    return df.select("*", F.col(time).alias("timestamp"), F.col(target).alias("target"))


def canonical(df: DataFrame, time: str, id: str, value: str, role: str) -> DataFrame:
    """Only (timestamp, series_id, prediction | actual), under those names."""
    if role not in ("prediction", "actual"):
        raise ValueError("role must be 'prediction' or 'actual'")
    names = {time: "timestamp", id: "series_id", value: role}
    return require(df, list(names)).withColumnsRenamed(names).select("timestamp", "series_id", role)


def keep_ids(df: DataFrame, ids: list, id: str = "pickup_community_area") -> DataFrame:
    return df.where(F.col(id).isin(list(ids)))


def clip(df: DataFrame, col: str, lower=None, upper=None, name: str | None = None) -> DataFrame:
    """Bounds a column; null stays null."""
    value = F.col(col)
    if lower is not None:
        value = F.when(value < lower, F.lit(lower)).otherwise(value)
    if upper is not None:
        value = F.when(value > upper, F.lit(upper)).otherwise(value)
    return df.withColumn(name or col, value.cast(df.schema[col].dataType))


def iqr_bounds(df: DataFrame, col: str) -> DataFrame:
    """One row: the lower bound, not below zero, and the upper bound of the IQR rule."""
    q = exact_quantiles(df, [], col, {"q1": 0.25, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return q.select(
        F.greatest(F.lit(0.0), F.col("q1") - reach).alias("lower_bound"),
        (F.col("q3") + reach).alias("upper_bound"),
    )


def iqr_clip(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Clips to the IQR bounds of the whole column, read as one scalar subquery."""
    bounds = iqr_bounds(df, col).select(F.struct("lower_bound", "upper_bound").alias("b")).scalar()
    low, high = bounds.getField("lower_bound"), bounds.getField("upper_bound")
    value = F.col(col).cast("double")
    clipped = F.when(value.isNotNull(), F.least(F.greatest(value, low), high))
    return df.withColumn(name or f"{col}_iqr_capped", clipped)


def flatten_predictions(
    df: DataFrame, struct: str = "predicted_trip_count", id: str = "pickup_community_area", id_type: str = "int"
) -> DataFrame:
    """Takes ``value`` out of the nested prediction column and casts value and id."""
    return df.withColumns(
        {struct: F.col(f"{struct}.value").cast("double"), id: F.col(id).cast(id_type)}
    )
