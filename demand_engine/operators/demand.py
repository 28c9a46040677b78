"""Counts per step and series, made gap-free."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demand_engine.functions.calendar import calendar_parts, hour_of, step_interval, timestamp_literal, zero_if_null
from demand_engine.operators.clean import filter_window


def hourly_demand(
    df: DataFrame,
    time: str = "trip_start_timestamp",
    id: str = "pickup_community_area",
    step: str = "hour",
    out_time: str = "timestamp_hour",
    target: str = "trip_count",
) -> DataFrame:
    """Rows per (step, series). Counted before the shuffle, so a hot series moves one row per step
    and task."""
    return df.groupBy(hour_of(time, step).alias(out_time), F.col(id)).agg(F.count(F.lit(1)).alias(target))


def demand_by_lookup(
    df: DataFrame,
    dimension: DataFrame,
    key: str,
    dimension_key: str,
    id: str,
    time: str,
    step: str = "hour",
    out_time: str = "timestamp_hour",
    target: str = "trip_count",
) -> DataFrame:
    """Rows per (step, series) where the series id is an attribute of the row's key.

    Counted per key first, so the join sees a key at most once per step, however many rows it has.
    """
    per_key = hourly_demand(df.select(time, key), time, key, step, out_time, target)
    looked_up = per_key.join(
        dimension.select(dimension_key, id), per_key[key] == dimension[dimension_key], "inner"
    )
    return looked_up.where(F.col(id).isNotNull()).groupBy(out_time, id).agg(F.sum(target).alias(target))


def distinct_ids(df: DataFrame, id: str = "pickup_community_area") -> DataFrame:
    return df.select(id).where(F.col(id).isNotNull()).distinct()


def observed_range(df: DataFrame, time: str = "timestamp_hour") -> DataFrame:
    return df.agg(F.min(time).alias("min_time"), F.max(time).alias("max_time"))


def observed_bounds(counts: DataFrame, time: str, target: str) -> tuple[Column, Column]:
    """First and last counted step as scalars of one one-row aggregate. It also reads the counts, so that
    it needs the same columns as their other reader and both share one exchange."""
    row = counts.agg(F.struct(F.min(time).alias("low"), F.max(time).alias("high"), F.sum(target).alias("n")).alias("seen")).scalar()
    return row.getField("low"), row.getField("high")


def spread_by(df: DataFrame, id: str) -> DataFrame:
    """Partitioned by series over all cores, whatever the size: for rows that are few themselves but
    unfold to many, which adaptive execution would otherwise put into a few tasks."""
    spark = df.sparkSession
    wide = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(wide, id)


def grid(
    ids: DataFrame, start: Column, end: Column, id: str, step: str = "hour", out_time: str = "timestamp_hour"
) -> DataFrame:
    """Every step from start to end for every id.

    Each id row unfolds its own time axis: no join.
    """
    steps = F.explode(F.sequence(start, end, step_interval(step)))
    return spread_by(distinct_ids(ids, id), id).select(steps.alias(out_time), F.col(id))


def full_grid(
    df: DataFrame,
    start,
    end,
    id: str = "pickup_community_area",
    step: str = "hour",
    out_time: str = "timestamp_hour",
) -> DataFrame:
    """All steps of the window for all ids seen in the (filtered) rows."""
    return grid(df, timestamp_literal(start), timestamp_literal(end), id, step, out_time)


def fill_counts(
    cells: DataFrame,
    counts: DataFrame,
    time: str = "timestamp_hour",
    id: str = "pickup_community_area",
    target: str = "trip_count",
) -> DataFrame:
    """The cells of a given grid with their counts, 0 where there is none."""
    filled = cells.join(counts.select(time, id, target), [time, id], "left")
    return filled.withColumn(target, zero_if_null(target).cast("bigint"))


def fill_gaps(
    counts: DataFrame,
    start: Column,
    end: Column,
    time: str = "timestamp_hour",
    id: str = "pickup_community_area",
    target: str = "trip_count",
    step: str = "hour",
    chunk: int | None = None,
) -> DataFrame:
    """Grid and counts in one step: every counted row also unfolds the empty steps up to the next
    counted row of its series (the first one those since ``start``, the last one those up to ``end``).

    Equal to ``fill_counts(full_grid(...), counts)``, but only counted cells are shuffled; the zeros
    appear where they are needed. Counts outside the axis are left out. A series holds at most one row per
    step of the axis; with ``chunk`` it is cut into pieces of that many steps, so a few long series use all
    cores. Without, the result stays partitioned by series, which the window features reuse.
    """
    one = step_interval(step)
    low, high = F.date_trunc(step, start), F.date_trunc(step, end)
    inside = counts.where((F.col(time) >= low) & (F.col(time) <= high))
    if chunk is None:
        spread, series, piece_low, piece_high = spread_by(inside, id), Window.partitionBy(id), low, high
    else:
        spread, piece_low, piece_high = _pieces(inside, low, high, chunk, time, id, target, step)
        series = Window.partitionBy(id, "_piece")
    series = series.orderBy(time)
    first = F.when(F.lag(time).over(series).isNull(), piece_low).otherwise(F.col(time))
    last = F.coalesce(F.lead(time).over(series) - one, piece_high)
    spans = spread.select(time, id, target, first.alias("_first"), last.alias("_last"))
    steps = spans.withColumn("_step", F.explode(F.sequence("_first", "_last", one)))
    value = F.when(F.col("_step") == F.col(time), F.col(target)).otherwise(F.lit(0).cast("bigint"))
    return steps.select(F.col("_step").alias(time), F.col(id), value.alias(target))


def _pieces(counts: DataFrame, low: Column, high: Column, chunk: int, time: str, id: str, target: str, step: str):
    """The counts and, at the start of every piece of the axis, a 0 for every series; with the bounds of a
    row's piece."""
    span, one = step_interval(step, chunk), step_interval(step)
    starts = distinct_ids(counts, id).select(F.explode(F.sequence(low, high, span)).alias(time), F.col(id))
    # Steps of a fixed length from the first one on: the piece of a time.
    seconds = F.unix_timestamp(low + span) - F.unix_timestamp(low)
    piece = F.floor((F.unix_timestamp(time) - F.unix_timestamp(low)) / seconds).alias("_piece")
    both = counts.select(time, id, target).unionByName(starts.withColumn(target, F.lit(0).cast("bigint")))
    summed = both.groupBy(time, id).agg(F.sum(target).alias(target)).select("*", piece)
    begins = F.timestamp_seconds(F.unix_timestamp(low) + F.col("_piece") * seconds)
    spread = summed.repartition(F.col(id), F.col("_piece"))
    return spread, begins, F.least(begins + span - one, high)


def demand_table(
    df: DataFrame,
    start,
    end,
    bounds: str = "window",
    time: str = "trip_start_timestamp",
    id: str = "pickup_community_area",
    step: str = "hour",
    out_time: str = "timestamp_hour",
    target: str = "trip_count",
) -> DataFrame:
    """The prepared demand table: filter, count, fill, calendar features; one lazy plan.

    ``bounds='window'`` spans start..end, ``'observed'`` the first to the last counted step.
    The weekday is Sunday 1 .. Saturday 7. Sorting is left to the caller: ``sort_table`` for reading,
    ``sorted_for_storage`` for files.
    """
    rows = filter_window(df.select(time, id), start, end, time, not_null=[id])
    counts = hourly_demand(rows, time, id, step, out_time, target)
    if bounds == "window":
        low, high = timestamp_literal(start), timestamp_literal(end)
    elif bounds == "observed":
        low, high = observed_bounds(counts, out_time, target)
    else:
        raise ValueError("bounds must be 'window' or 'observed'")
    return calendar_parts(fill_gaps(counts, low, high, out_time, id, target, step), out_time)


def series_length(
    df: DataFrame, cap: int = 3000, id: str = "pickup_community_area"
) -> DataFrame:
    """Points per series and whether they exceed the cap."""
    lengths = df.groupBy(id).agg(F.count(F.lit(1)).alias("n_points"))
    return lengths.withColumn("over_cap", F.col("n_points") > cap)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def wide_series(
    df: DataFrame,
    ids: list,
    id: str = "pickup_community_area",
    time: str = "timestamp_hour",
    target: str = "trip_count",
) -> DataFrame:
    """One row per time and one column per chosen id, named by the id."""
    return df.groupBy(time).pivot(id, list(ids)).agg(F.first(target))


def future_grid(
    df: DataFrame,
    start,
    horizon: int,
    id: str = "pickup_community_area",
    out_time: str = "timestamp_hour",
    step: str = "hour",
) -> DataFrame:
    """All known ids times ``horizon`` steps from ``start`` on."""
    if horizon < 1:
        raise ValueError("horizon must be at least 1")
    if distinct_ids(df, id).isEmpty():
        raise ValueError("no series id is known: there is nothing to forecast")
    first = timestamp_literal(start)
    return grid(df, first, first + step_interval(step, horizon - 1), id, step, out_time)
