"""Exploration aggregates: counts, rankings, quality slices, distributions, pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demand_engine.functions.calendar import WEEKDAY_NAMES, day_name, dow_mon0, sun1_to_mon0
from demand_engine.operators.ordering import (
    bucket_of,
    exact_quantiles,
    holds_rank,
    moments,
    quantile_ranks,
    rank_buckets,
    top_k,
    values_at,
)

HEATMAP_DAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

AGGREGATES = {
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "std": F.stddev_samp,
}

PARTS = {
    "hour": F.hour,
    "day": F.to_date,
    "month": F.month,
    "year": F.year,
}


def agg_by(
    df: DataFrame, keys: list[str], col: str, fn: str | list[str] = "mean", top_n: int | None = None, name: str | None = None
) -> DataFrame:
    """Aggregates per key: one under ``name``, or a list of them, each under its own name, from one pass
    (a median takes its own). With ``top_n`` only the largest of the first, ties to the smaller key."""
    fns = [fn] if isinstance(fn, str) else list(fn)
    names = [name or col] if isinstance(fn, str) else fns
    if unknown := sorted({*fns} - {*AGGREGATES, "median"}):
        raise ValueError(f"unknown aggregate {unknown}, one of {sorted([*AGGREGATES, 'median'])}")
    plain = [AGGREGATES[f](col).alias(n) for f, n in zip(fns, names) if f != "median"]
    out = df.dropna(subset=keys).groupBy(*keys).agg(*plain) if plain else None
    for f, n in zip(fns, names):
        if f == "median":
            made = median_by(df, keys, col, n)
            out = made if out is None else out.join(made, keys, "left")
    out = out.select(*keys, *names)
    return out if top_n is None else out.orderBy(F.desc(names[0]), *keys).limit(top_n)


def median_by(df: DataFrame, keys: list[str], col: str, name: str = "median", bounded_keys: bool = False) -> DataFrame:
    """Exact median per key; a key that has only nulls keeps a row with a null. ``bounded_keys``: see ``values_at``."""
    return exact_quantiles(df, keys, col, {name: 0.5}, bounded_keys, keep_empty=bool(keys))


def count_by_part(df: DataFrame, time: str = "trip_start_timestamp", part: str = "hour") -> DataFrame:
    return df.groupBy(PARTS[part](F.col(time)).alias(part)).agg(F.count(F.lit(1)).alias("n"))


def count_by_weekday(df: DataFrame, time: str = "trip_start_timestamp") -> DataFrame:
    """Rows per weekday name; ``position`` orders them from Monday."""
    per_day = df.where(F.col(time).isNotNull()).groupBy(dow_mon0(time).alias("position")).agg(
        F.count(F.lit(1)).alias("n")
    )
    names = F.array(*[F.lit(d) for d in WEEKDAY_NAMES])
    return per_day.select("position", F.element_at(names, F.col("position") + 1).alias("day_name"), "n")


def top_counts(df: DataFrame, col: str, k: int = 15) -> DataFrame:
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return top_k(counts, "n", col, k)


def top_counts_by_side(
    df: DataFrame, sides: dict[str, str], k: int = 15
) -> DataFrame:
    """Top-k counts of several columns under each other; ``sides`` maps a label to a column."""
    parts = [
        top_counts(df, col, k).select(F.lit(label).alias("side"), F.col(col).alias("area"), "n")
        for label, col in sides.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def top_zones(
    df: DataFrame, k: int = 5, agg: str = "sum", id: str = "pickup_community_area", target: str = "trip_count"
) -> DataFrame:
    return agg_by(df, [id], target, agg, top_n=k, name="total")


def keep_top_ids(
    df: DataFrame, k: int = 5, id: str = "pickup_community_area", target: str = "trip_count"
) -> DataFrame:
    """All rows of the k series with the largest totals. The k ids are broadcast."""
    return df.join(F.broadcast(top_zones(df, k, "sum", id, target).select(id)), id, "left_semi")


def daily_demand(
    df: DataFrame,
    ids: list | None = None,
    id: str = "pickup_community_area",
    time: str = "timestamp_hour",
    target: str = "trip_count",
) -> DataFrame:
    rows = df if ids is None else df.where(F.col(id).isin(list(ids)))
    return rows.groupBy(F.to_date(time).alias("date"), F.col(id)).agg(F.sum(target).alias(target))


def weekly_pattern(
    df: DataFrame,
    series=None,
    id: str = "pickup_community_area",
    time: str = "timestamp_hour",
    target: str = "trip_count",
) -> DataFrame:
    """Mean per (weekday, hour) of one series, by default the busiest; Monday is 0."""
    rows = keep_top_ids(df, 1, id, target) if series is None else df.where(F.col(id) == series)
    return rows.groupBy(dow_mon0(time).alias("day_of_week"), F.hour(time).alias("hour")).agg(
        F.avg(target).alias(target)
    )


def normalize_dow(df: DataFrame, col: str, dow_base: str = "auto") -> DataFrame:
    """Weekday numbers as Monday 0 .. Sunday 6.

    ``dow_base`` is ``sun1``, ``mon0`` or ``auto`` (1..7 is taken as ``sun1``). Values outside 0..6
    afterwards raise when the rows are read: no chart can be made from them.
    """
    if dow_base not in ("auto", "sun1", "mon0"):
        raise ValueError("dow_base must be 'auto', 'sun1' or 'mon0'")
    if dow_base == "auto":
        seen = df.agg(F.struct(F.min(col).alias("low"), F.max(col).alias("high")).alias("seen")).scalar()
        sunday_first = (seen.getField("low") == 1) & (seen.getField("high") == 7)
    else:
        sunday_first = F.lit(dow_base == "sun1")
    lowest, highest = F.when(sunday_first, 1).otherwise(0), F.when(sunday_first, 7).otherwise(6)
    kind = df.schema[col].dataType
    bad = F.raise_error(F.concat(F.lit(f"weekday value in {col!r} out of range: "), F.col(col).cast("string"))).cast(kind)
    shifted = F.when(sunday_first, sun1_to_mon0(col)).otherwise(F.col(col)).cast(kind)
    return df.withColumn(col, F.when((F.col(col) < lowest) | (F.col(col) > highest), bad).otherwise(shifted))


def heatmap(df: DataFrame, day: str, hour: str, value: str, fn: str = "mean") -> DataFrame:
    """Hours as rows and Mon..Sun as columns; a missing cell is null. Days are Monday 0 .. Sunday 6."""
    cells = agg_by(df, [day, hour], value, fn, name="_cell")
    wide = cells.groupBy(hour).pivot(day, list(range(7))).agg(F.first("_cell"))
    return wide.toDF(hour, *HEATMAP_DAYS)


def prediction_patterns(
    df: DataFrame,
    kind: str,
    value: str = "prediction",
    id: str = "pickup_community_area",
    time: str = "timestamp_hour",
    top_n: int | None = None,
) -> DataFrame:
    """Mean prediction per ``hour``, per ``zone`` or per ``weekend`` (hour and weekend flag)."""
    hour = F.hour(time).alias("hour")
    keys = {
        "hour": [hour],
        "zone": [F.col(id)],
        "weekend": [hour, (dow_mon0(time) >= 5).cast("int").alias("is_weekend")],
    }[kind]
    out = df.groupBy(*keys).agg(F.avg(value).alias("mean_prediction"))
    return top_k(out, "mean_prediction", id, top_n) if kind == "zone" and top_n else out


def missing_pct(df: DataFrame) -> DataFrame:
    """Percentage of nulls per column, only where there are any; one pass over the table."""
    shares = df.agg(*[(F.count_if(F.col(c).isNull()) * 100 / F.count(F.lit(1))).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing_pct")) for c in df.columns])
    return shares.select(F.inline(pairs)).where("missing_pct > 0").orderBy(F.desc("missing_pct"), "column_name")


def _unpivot(df: DataFrame, cols: list[str], dtype: str, ids: list[str] = (), name: str = "column_name") -> DataFrame:
    cast = df.select(*ids, *[F.col(c).cast(dtype).alias(c) for c in cols])
    return cast.unpivot(list(ids), cols, name, "value")


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
MOMENTS = ["count", "mean", "std", "min", "max"]


def _all_columns(df: DataFrame, columns: list[str], found: DataFrame) -> DataFrame:
    """``found`` with a row for each of the columns; one without values counts 0."""
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return F.broadcast(names).join(found, "column_name", "left").withColumn("count", F.coalesce("count", F.lit(0)))


def describe_numbers(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: count, mean, sample deviation, min, quartiles, max. All columns together in two scans."""
    found = describe_table(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    return found.select("column_name", "count", "mean", "std", "min", *QUARTILES, "max")


def describe_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: count, distinct values, the most frequent one (ties to the smaller) and its count."""
    values = _unpivot(df, cols, "string").where("value is not null")
    freq = values.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("value")))
    return freq.groupBy("column_name").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        best.getField("value").alias("top"),
        (-best.getField("n")).alias("freq"),
    )


def describe_table(df: DataFrame) -> DataFrame:
    """Both kinds under each other, one row per column; what does not apply is null.

    Two scans whatever the number of columns: one counts the histograms of all numeric columns with their moments; the
    other counts the values in the buckets that hold a quartile, and all texts. Both are counted map-side."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    shape = ["column_name", "count", "unique", "top", "freq", "mean", "std", "min", *QUARTILES, "max"]
    ranks, interpolate = quantile_ranks(QUARTILES)
    if numbers:
        carry = moments({m: m for m in MOMENTS})
        hits = F.broadcast(rank_buckets(_unpivot(df, numbers, "double"), ["column_name"], "value", ranks, carry))
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"), F.lit(None).cast("string").alias("text")) for c in numbers]
    cells += [F.struct(F.lit(c).alias("column_name"), F.lit(None).cast("double").alias("value"), F.col(c).alias("text")) for c in text]
    rows = df.select(F.inline(F.array(*cells))).where("value is not null or text is not null")
    if numbers:
        rows = rows.withColumn("_bucket", bucket_of(rows, "value")).join(hits, ["column_name", "_bucket"], "left")
        rows = rows.where("text is not null or _start is not null")
        own = ["_bucket", "_start", "total", *MOMENTS]
    else:
        own = []
    counted = rows.groupBy("column_name", *own, "value", "text").agg(F.count(F.lit(1)).alias("_n"))
    stats = []
    if numbers:
        # Texts have one bucket, which is dealt out: their order doesn't matter.
        part = F.when(F.col("text").isNotNull(), F.pmod(F.xxhash64("text"), F.lit(256))).otherwise(0)
        earlier = Window.partitionBy("column_name", "_bucket", "_part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("_part", part).withColumn(
            "_before", F.col("_start") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
        )
        stats += [F.max("total").alias("total"), *[F.max(m).alias(f"_{m}") for m in MOMENTS]]
        stats += [F.max(F.when(holds_rank(rank(F.col("total"))), F.col("value"))).alias(name) for name, rank in ranks.items()]
    is_text = F.col("text").isNotNull()
    best = F.min(F.when(is_text, F.struct((-F.col("_n")).alias("n"), F.col("text"))))
    texts = [F.sum(F.when(is_text, F.col("_n"))).alias("_texts"), F.count("text").alias("_unique"), best.alias("_best")]
    found = counted.groupBy("column_name").agg(*stats, *texts)
    nothing = F.lit(None)
    out = {
        "count": F.coalesce("_count", "_texts") if numbers else F.col("_texts"),
        "unique": F.when(F.col("_unique") > 0, F.col("_unique")),
        "top": F.col("_best.text"),
        "freq": -F.col("_best.n"),
        **{m: F.col(f"_{m}") if numbers else nothing for m in MOMENTS[1:]},
        **{p: interpolate(p) if numbers else nothing for p in QUARTILES},
    }
    made = found.select("column_name", *[c.alias(name) for name, c in out.items()])
    return _all_columns(df, [*numbers, *text], made).select(*shape)


def describe_by(df: DataFrame, id: str = "pickup_community_area", col: str = "trip_count") -> DataFrame:
    """The same numbers per series, from the same two scans."""
    found = exact_quantiles(df, [id], col, QUARTILES, describe={m: m for m in MOMENTS}, keep_empty=True)
    return found.select(id, "count", "mean", "std", "min", *QUARTILES, "max")


def unique_values(df: DataFrame, id: str = "pickup_community_area", col: str = "prediction") -> DataFrame:
    """Distinct values per series, one row each."""
    return df.select(id, col).distinct()


def unique_value_lists(
    df: DataFrame, id: str = "pickup_community_area", col: str = "prediction"
) -> DataFrame:
    """The same as one sorted array per series, for forecasts: their series hold at most one row per
    step of the horizon."""
    return unique_values(df, id, col).groupBy(id).agg(F.array_sort(F.collect_list(col)).alias("values"))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over the range of the column, empty ones included; the last is closed."""
    value = F.col(col).cast("double")
    rows = df.select(value.alias("v")).where(value.isNotNull())
    low = rows.select(F.min("v")).scalar()
    high = rows.select(F.max("v")).scalar()
    width = (high - low) / F.lit(float(bins))
    at = F.when(width > 0, F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = rows.groupBy(at.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    axis = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return axis.join(counts, "bin", "left").select(
        F.col("bin").cast("int").alias("bin"),
        (low + F.col("bin") * width).alias("lower_edge"),
        (low + (F.col("bin") + 1) * width).alias("upper_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def point_density(df: DataFrame, lat: str, lon: str, cell: float = 0.01) -> DataFrame:
    """Rows per square cell of ``cell`` degrees, all rows with both coordinates."""
    size = F.lit(float(cell))
    points = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    return points.groupBy(
        F.floor(F.col(lat) / size).alias("lat_cell"), F.floor(F.col(lon) / size).alias("lon_cell")
    ).agg(F.count(F.lit(1)).alias("n"))


#: Levels of ``density_pyramid`` go up to this one: cells of about 5 m.
MAX_ZOOM = 23


def _turned(x: Column, bits: int) -> Column:
    """The lowest ``bits`` bits of x, each followed by a zero bit."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        if bits > shift:
            x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def cell_code(lat: Column, lon: Column, zoom: int) -> Column:
    """The cell of a point at a zoom level as one number: the world is halved ``zoom`` times in either direction, and the
    bits of row and column alternate. So a cell's code, shifted right by two bits, is that of the cell around it."""
    size = F.lit(float(1 << zoom))
    row = F.least(F.floor((lat + 90.0) / 180.0 * size), F.lit((1 << zoom) - 1))
    column = F.least(F.floor((lon + 180.0) / 360.0 * size), F.lit((1 << zoom) - 1))
    return F.shiftleft(_turned(row, zoom), 1).bitwiseOR(_turned(column, zoom))


def density_pyramid(df: DataFrame, lat: str, lon: str, zooms: list[int]) -> DataFrame:
    """``zoom, cell, n``: rows per cell (``cell_code``) at every zoom level, of all rows with coordinates on the globe.

    Rows are counted once, map-side, at the finest level; a coarser level sums the counts of the one below it, whose
    cells its own contain. So the levels beyond the first cost what they return, not what the table holds."""
    order = sorted(set(zooms), reverse=True)
    if not order or order[0] > MAX_ZOOM or order[-1] < 0:
        raise ValueError(f"zoom levels lie between 0 and {MAX_ZOOM}")
    on_globe = F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180)
    cell = cell_code(F.col(lat).cast("double"), F.col(lon).cast("double"), order[0])
    finest = df.where(on_globe).groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    # Every finest cell gives one row a level, summed up before and after one shuffle of counted rows.
    levels = F.array(*[F.struct(F.lit(z).alias("zoom"), F.shiftright("cell", 2 * (order[0] - z)).alias("cell")) for z in order])
    return finest.select("n", F.inline(levels)).groupBy("zoom", "cell").agg(F.sum("n").alias("n"))


def cell_bounds(cells: DataFrame, zoom: str = "zoom", cell: str = "cell") -> DataFrame:
    """The cells with ``lat_low, lat_high, lon_low, lon_high``, the box they stand for."""

    def gathered(x: Column) -> Column:
        x = x.bitwiseAND(F.lit(0x5555555555555555))
        for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
            x = x.bitwiseOR(F.shiftright(x, shift)).bitwiseAND(F.lit(mask))
        return x

    size = F.pow(F.lit(2.0), F.col(zoom))
    row, column = gathered(F.shiftright(cell, 1)), gathered(F.col(cell))
    return cells.withColumns(
        {
            "lat_low": row / size * 180.0 - 90.0, "lat_high": (row + 1) / size * 180.0 - 90.0,
            "lon_low": column / size * 360.0 - 180.0, "lon_high": (column + 1) / size * 360.0 - 180.0,
        }
    )


# Quality slices of raw trips and the measures reported for them.
QUALITY_SLICES = {
    "duration_not_positive": "trip_minutes <= 0",
    "distance_not_positive": "trip_miles <= 0",
    "fare_not_positive": "fare <= 0",
    "distance_very_low": "trip_miles > 0 and trip_miles < 0.1",
}
QUALITY_MEASURES = ["trip_minutes", "trip_miles", "fare", "trip_total"]


def _by_slice(df: DataFrame) -> DataFrame:
    """Every row once per slice it is in."""
    names = F.array(*[F.when(F.expr(rule), F.lit(name)) for name, rule in QUALITY_SLICES.items()])
    return df.withColumn("slice", F.explode(F.filter(names, lambda n: n.isNotNull())))


def quality_report(df: DataFrame) -> DataFrame:
    """Per slice: rows and the medians of four measures; a slice without rows reports 0. Two scans."""
    measures = _unpivot(_by_slice(df.select(*QUALITY_MEASURES)), QUALITY_MEASURES, "double", ["slice"], "measure")
    ranks, interpolate = quantile_ranks({"median": 0.5})
    # Every row of a slice counts, also those without the measure.
    carry = {"_rows": lambda _: F.count(F.lit(1))}, lambda h, keys: h.withColumn("rows", F.sum("_rows").over(Window.partitionBy(*keys)))
    found = values_at(
        measures, ["slice", "measure"], "value", ranks, bounded_keys=True, carry=carry, carried=["rows"], keep_empty=True
    ).withColumn("median", interpolate("median"))
    wide = found.groupBy("slice").agg(
        F.max("rows").alias("n"), *[F.max(F.when(F.col("measure") == m, F.col("median"))).alias(f"med_{m}") for m in QUALITY_MEASURES]
    )
    slices = df.sparkSession.createDataFrame([(s,) for s in QUALITY_SLICES], "slice string")
    return F.broadcast(slices).join(wide, "slice", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def quality_top(df: DataFrame, k: int = 5, col: str = "payment_type") -> DataFrame:
    """Per slice the most frequent values (``slice, col, n``), ties to the smaller one; one pass."""
    measures = ["trip_minutes", "trip_miles", "fare"]
    counts = _by_slice(df.select(*measures, col)).where(F.col(col).isNotNull()).groupBy("slice", col).agg(F.count(F.lit(1)).alias("n"))
    ranked = Window.partitionBy("slice").orderBy(F.desc("n"), col)
    return counts.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= k).drop("_rank")


def pct_where(df: DataFrame, condition: Column, given: Column, name: str = "pct") -> DataFrame:
    """Percentage of the rows under ``given`` that also meet ``condition``; null counts as not met."""
    met = F.coalesce(condition, F.lit(False)).cast("int")
    return df.where(given).agg((100 * F.avg(met)).alias(name))


def demand_correlation(df: DataFrame, features: list[str], target: str = "trip_count") -> DataFrame:
    """Pearson correlation of the target with each feature, one row each."""
    corrs = df.agg(*[F.corr(target, f).alias(f) for f in features])
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("correlation")) for f in features])
    return corrs.select(F.inline(pairs))


def latest_by_prefix(runs: DataFrame, prefix: str, name: str = "display_name", created: str = "create_time") -> DataFrame:
    """The newest row whose name starts with the prefix; ties go to the smaller name."""
    return runs.where(F.col(name).startswith(prefix)).orderBy(F.desc(created), name).limit(1)
