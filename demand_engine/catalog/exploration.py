"""Registered queries: exploration aggregates over raw trips, demand and predictions."""

from pyspark.sql import functions as F

from demand_engine.catalog.common import (
    DEMAND,
    NAIVE,
    SAMPLE_AREAS,
    TRIPS,
    demand,
    naive_forecast,
    out,
    r6,
    register,
    trips,
)
from demand_engine.fixtures import read
from demand_engine.functions import calendar, trip
from demand_engine.operators import clean, explore


def measured(spark, sf_dir):
    """Trips with minutes and speed."""
    return trip.add_speed(trip.add_trip_minutes(trips(spark, sf_dir)))


for _part, _sql in {
    "hour": "CAST(hour(trip_start_timestamp) AS INT)",
    "day": "strftime(trip_start_timestamp, '%Y-%m-%d')",
    "month": "CAST(month(trip_start_timestamp) AS INT)",
    "year": "CAST(year(trip_start_timestamp) AS INT)",
}.items():

    @register(f"count_by_{_part}", TRIPS + f" SELECT {_sql} AS {_part}, count(*) AS n FROM trips GROUP BY 1")
    def count_by_part(spark, sf_dir, part=_part):
        return out(explore.count_by_part(trips(spark, sf_dir), part=part))


@register(
    "count_by_weekday",
    TRIPS
    + """ SELECT CAST(isodow(trip_start_timestamp) - 1 AS INT) AS position, dayname(trip_start_timestamp) AS day_name, count(*) AS n
    FROM trips GROUP BY 1, 2 ORDER BY 1""",
)
def count_by_weekday(spark, sf_dir):
    return out(explore.count_by_weekday(trips(spark, sf_dir)).orderBy("position"))


@register(
    "trip_start_parts",
    TRIPS
    + """ SELECT trip_id, CAST(hour(trip_start_timestamp) AS INT) AS start_hour, CAST(isodow(trip_start_timestamp) - 1 AS INT) AS day_of_week,
      dayname(trip_start_timestamp) AS day_name, CAST(month(trip_start_timestamp) AS INT) AS month,
      CASE WHEN isodow(trip_start_timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM trips""",
)
def trip_start_parts(spark, sf_dir):
    rows = trips(spark, sf_dir).select("trip_id", "trip_start_timestamp")
    return out(calendar.start_parts(rows).drop("trip_start_timestamp"))


for _name, _col in {"speed": "average_speed_mph", "duration": "trip_minutes"}.items():

    @register(
        f"median_{_name}_by_hour",
        TRIPS
        + f" SELECT CAST(hour(trip_start_timestamp) AS INT) AS start_hour, {r6(f'median({_col})')} AS median FROM trips GROUP BY 1",
    )
    def median_by_hour(spark, sf_dir, col=_col):
        rows = measured(spark, sf_dir).select(F.hour("trip_start_timestamp").alias("start_hour"), col)
        return out(explore.median_by(rows, ["start_hour"], col, bounded_keys=True))


_TOP = """SELECT '{side}' AS side, {side}_community_area AS area, count(*) AS n FROM trips
  WHERE {side}_community_area IS NOT NULL GROUP BY 2 ORDER BY n DESC, area LIMIT 15"""


@register("top_pickup_areas", TRIPS + " SELECT area AS pickup_community_area, n FROM (" + _TOP.format(side="pickup") + ")")
def top_pickup_areas(spark, sf_dir):
    return out(explore.top_counts(trips(spark, sf_dir), "pickup_community_area", 15))


@register(
    "top_areas_by_side",
    TRIPS + f" (SELECT * FROM ({_TOP.format(side='pickup')})) UNION ALL (SELECT * FROM ({_TOP.format(side='dropoff')}))",
)
def top_areas_by_side(spark, sf_dir):
    sides = {"pickup": "pickup_community_area", "dropoff": "dropoff_community_area"}
    return out(explore.top_counts_by_side(trips(spark, sf_dir), sides, 15))


@register(
    "top_zones",
    DEMAND
    + """ SELECT pickup_community_area, CAST(sum(trip_count) AS BIGINT) AS total FROM demand GROUP BY 1
    ORDER BY total DESC, pickup_community_area LIMIT 5""",
)
def top_zones(spark, sf_dir):
    return out(explore.top_zones(demand(spark, sf_dir)))


_AGGS = {
    "mean": "avg(trip_total)",
    "sum": "sum(trip_total)",
    "min": "min(trip_total)",
    "max": "max(trip_total)",
    "median": "median(trip_total)",
    "count": "count(trip_total)",
    "std": "stddev_samp(trip_total)",
}


@register(
    "agg_by",
    TRIPS
    + " SELECT payment_type, "
    + ", ".join(f"{r6(f'CAST({sql} AS DOUBLE)')} AS {fn}" for fn, sql in _AGGS.items())
    + " FROM trips GROUP BY 1",
)
def agg_by(spark, sf_dir):
    made = explore.agg_by(trips(spark, sf_dir), ["payment_type"], "trip_total", list(_AGGS))
    return out(made.select("payment_type", *[F.col(fn).cast("double") for fn in _AGGS]))


@register(
    "top_zones_by_mean",
    DEMAND
    + f""" SELECT pickup_community_area, {r6("avg(trip_count)")} AS trip_count FROM demand GROUP BY 1
    ORDER BY avg(trip_count) DESC, 1 LIMIT 15""",
)
def top_zones_by_mean(spark, sf_dir):
    return out(explore.agg_by(demand(spark, sf_dir), ["pickup_community_area"], "trip_count", "mean", top_n=15))


@register(
    "hourly_pattern",
    DEMAND + f" SELECT hour, {r6('avg(trip_count)')} AS trip_count FROM demand GROUP BY 1",
)
def hourly_pattern(spark, sf_dir):
    return out(explore.agg_by(demand(spark, sf_dir), ["hour"], "trip_count", "mean"))


_TOP_AREAS = """, totals AS (SELECT pickup_community_area, sum(trip_count) AS total FROM demand GROUP BY 1),
  top_areas AS (SELECT pickup_community_area FROM totals ORDER BY total DESC, pickup_community_area LIMIT {k})"""


@register(
    "keep_top_ids",
    DEMAND + _TOP_AREAS.format(k=5) + " SELECT * FROM demand WHERE pickup_community_area IN (SELECT * FROM top_areas)",
)
def keep_top_ids(spark, sf_dir):
    return out(explore.keep_top_ids(demand(spark, sf_dir), 5))


@register(
    "daily_demand",
    DEMAND
    + _TOP_AREAS.format(k=5)
    + """ SELECT strftime(timestamp_hour, '%Y-%m-%d') AS date, pickup_community_area, CAST(sum(trip_count) AS BIGINT) AS trip_count
    FROM demand WHERE pickup_community_area IN (SELECT * FROM top_areas) GROUP BY 1, 2""",
)
def daily_demand(spark, sf_dir):
    return out(explore.daily_demand(explore.keep_top_ids(demand(spark, sf_dir), 5)))


@register(
    "weekly_pattern",
    DEMAND
    + _TOP_AREAS.format(k=1)
    + f""" SELECT CAST(isodow(timestamp_hour) - 1 AS INT) AS day_of_week, CAST(hour AS INT) AS hour, {r6("avg(trip_count)")} AS trip_count
    FROM demand WHERE pickup_community_area IN (SELECT * FROM top_areas) GROUP BY 1, 2""",
)
def weekly_pattern(spark, sf_dir):
    return out(explore.weekly_pattern(demand(spark, sf_dir)))


_HEATMAP = ", ".join(
    f"{r6(f'avg({{value}}) FILTER (WHERE isodow(timestamp_hour) = {i + 1})')} AS {d}" for i, d in enumerate(explore.HEATMAP_DAYS)
)


@register("heatmap", DEMAND + f" SELECT hour, {_HEATMAP.format(value='trip_count')} FROM demand GROUP BY 1")
def heatmap(spark, sf_dir):
    days = explore.normalize_dow(demand(spark, sf_dir), "day_of_week")
    return out(explore.heatmap(days, "day_of_week", "hour", "trip_count"))


@register(
    "prediction_heatmap",
    NAIVE + f" SELECT CAST(hour(timestamp_hour) AS INT) AS hour, {_HEATMAP.format(value='prediction')} FROM naive GROUP BY 1",
)
def prediction_heatmap(spark, sf_dir):
    rows = naive_forecast(spark, sf_dir).withColumns(
        {"hour": F.hour("timestamp_hour"), "day": calendar.dow_mon0("timestamp_hour")}
    )
    return out(explore.heatmap(rows, "day", "hour", "prediction"))


@register(
    "normalize_dow",
    DEMAND
    + """ SELECT timestamp_hour, pickup_community_area, CAST(isodow(timestamp_hour) - 1 AS BIGINT) AS day_of_week FROM demand""",
)
def normalize_dow(spark, sf_dir):
    rows = demand(spark, sf_dir).select("timestamp_hour", "pickup_community_area", "day_of_week")
    return out(explore.normalize_dow(rows, "day_of_week", "sun1"))


@register(
    "mean_prediction_by_hour",
    NAIVE + f" SELECT CAST(hour(timestamp_hour) AS INT) AS hour, {r6('avg(prediction)')} AS mean_prediction FROM naive GROUP BY 1",
)
def mean_prediction_by_hour(spark, sf_dir):
    return out(explore.prediction_patterns(naive_forecast(spark, sf_dir), "hour"))


@register(
    "mean_prediction_by_zone",
    NAIVE
    + f""" SELECT pickup_community_area, {r6("avg(prediction)")} AS mean_prediction FROM naive GROUP BY 1
    ORDER BY avg(prediction) DESC, 1 LIMIT 15""",
)
def mean_prediction_by_zone(spark, sf_dir):
    return out(explore.prediction_patterns(naive_forecast(spark, sf_dir), "zone", top_n=15))


@register(
    "mean_prediction_by_weekend",
    NAIVE
    + f""" SELECT CAST(hour(timestamp_hour) AS INT) AS hour, CASE WHEN isodow(timestamp_hour) >= 6 THEN 1 ELSE 0 END AS is_weekend,
      {r6("avg(prediction)")} AS mean_prediction FROM naive GROUP BY 1, 2""",
)
def mean_prediction_by_weekend(spark, sf_dir):
    return out(explore.prediction_patterns(naive_forecast(spark, sf_dir), "weekend"))


@register(
    "predictions_of_top_zones",
    NAIVE
    + _TOP_AREAS.format(k=3)
    + """ SELECT timestamp_hour, pickup_community_area, prediction, CASE WHEN isodow(timestamp_hour) >= 6 THEN 1 ELSE 0 END AS is_weekend
    FROM naive WHERE pickup_community_area IN (SELECT * FROM top_areas)""",
)
def predictions_of_top_zones(spark, sf_dir):
    top = explore.top_zones(demand(spark, sf_dir), 3).select("pickup_community_area")
    rows = naive_forecast(spark, sf_dir).join(F.broadcast(top), "pickup_community_area", "left_semi")
    return out(rows.withColumn("is_weekend", calendar.is_weekend("timestamp_hour")))


_NULLABLE = ["pickup_community_area", "dropoff_community_area", "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"]


@register(
    "missing_pct",
    TRIPS
    + " SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {r6(f'100e0 * count(*) FILTER (WHERE {c} IS NULL) / count(*)')} AS missing_pct FROM trips"
        for c in [*_NULLABLE, "trip_miles", "fare", "payment_type", "trip_start_timestamp"]
    )
    + ") WHERE missing_pct > 0",
)
def missing_pct(spark, sf_dir):
    return out(explore.missing_pct(trips(spark, sf_dir)))


_NUMBERS = [
    "trip_id", "trip_seconds", "trip_miles", "fare", "tips", "tolls", "extras", *_NULLABLE, "trip_total",
]
_TEXTS = ["payment_type", "raw_number", "raw_time"]


def _describe_number(c: str) -> str:
    stats = ", ".join(
        f"{r6(f'CAST({sql} AS DOUBLE)')} AS {name}"
        for name, sql in {
            "mean": f"avg({c})",
            "std": f"stddev_samp({c})",
            "min": f"min({c})",
            "p25": f"quantile_cont({c}, 0.25)",
            "p50": f"quantile_cont({c}, 0.5)",
            "p75": f"quantile_cont({c}, 0.75)",
            "max": f"max({c})",
        }.items()
    )
    return (
        f"SELECT '{c}' AS column_name, count({c}) AS count, CAST(NULL AS BIGINT) AS \"unique\", "
        f"CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, {stats} FROM trips"
    )


def _describe_text(c: str) -> str:
    empty = ", ".join(f"CAST(NULL AS DOUBLE) AS {s}" for s in ("mean", "std", "min", "p25", "p50", "p75", "max"))
    return (
        f"SELECT '{c}', count({c}), count(DISTINCT {c}), "
        f"(SELECT {c} FROM trips GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), "
        f"(SELECT count(*) FROM trips GROUP BY {c} ORDER BY 1 DESC LIMIT 1), {empty} FROM trips"
    )


@register(
    "describe_table",
    TRIPS + " " + " UNION ALL ".join([_describe_number(c) for c in _NUMBERS] + [_describe_text(c) for c in _TEXTS]),
)
def describe_table(spark, sf_dir):
    return out(explore.describe_table(trips(spark, sf_dir)))


_DESCRIBE = ", ".join(
    f"{r6(f'CAST({sql} AS DOUBLE)')} AS {name}"
    for name, sql in {
        "mean": "avg({c})",
        "std": "stddev_samp({c})",
        "min": "min({c})",
        "p25": "quantile_cont({c}, 0.25)",
        "p50": "quantile_cont({c}, 0.5)",
        "p75": "quantile_cont({c}, 0.75)",
        "max": "max({c})",
    }.items()
)


@register(
    "describe_by_area",
    DEMAND + f" SELECT pickup_community_area, count(trip_count) AS count, {_DESCRIBE.format(c='trip_count')} FROM demand GROUP BY 1",
)
def describe_by_area(spark, sf_dir):
    return out(explore.describe_by(demand(spark, sf_dir)))


@register(
    "describe_sample_areas",
    NAIVE
    + f""" SELECT pickup_community_area, count(prediction) AS count, {_DESCRIBE.format(c="prediction")} FROM naive
    WHERE pickup_community_area IN (8, 28, 32, 56, 76) GROUP BY 1""",
)
def describe_sample_areas(spark, sf_dir):
    rows = clean.keep_ids(naive_forecast(spark, sf_dir), SAMPLE_AREAS)
    return out(explore.describe_by(rows, col="prediction"))


@register("unique_values", NAIVE + " SELECT DISTINCT pickup_community_area, prediction FROM naive")
def unique_values(spark, sf_dir):
    return out(explore.unique_values(naive_forecast(spark, sf_dir)))


@register(
    "unique_value_lists",
    NAIVE
    + """ SELECT pickup_community_area, string_agg(CAST(CAST(prediction AS BIGINT) AS VARCHAR), ',' ORDER BY prediction) AS values
    FROM (SELECT DISTINCT pickup_community_area, prediction FROM naive) GROUP BY 1""",
)
def unique_value_lists(spark, sf_dir):
    lists = explore.unique_value_lists(naive_forecast(spark, sf_dir))
    text = F.array_join(F.transform("values", lambda v: v.cast("bigint").cast("string")), ",")
    return out(lists.withColumn("values", text))


def _histogram(source: str, value: str, bins: int) -> str:
    return f""", v AS (SELECT {value} AS v FROM {source} WHERE {value} IS NOT NULL),
  r AS (SELECT min(v) AS lo, (max(v) - min(v)) / {bins}e0 AS w FROM v),
  b AS (SELECT CASE WHEN w > 0 THEN least(floor((v - lo) / w), {bins - 1}) ELSE 0 END AS bin, count(*) AS n FROM v, r GROUP BY 1)
  SELECT CAST(a.bin AS INT) AS bin, {r6("lo + a.bin * w")} AS lower_edge, {r6("lo + (a.bin + 1) * w")} AS upper_edge, coalesce(n, 0) AS n
  FROM (SELECT unnest(range({bins})) AS bin) a CROSS JOIN r LEFT JOIN b ON b.bin = a.bin"""


@register("speed_histogram", TRIPS + _histogram("trips", "least(average_speed_mph, CASE WHEN average_speed_mph IS NULL THEN NULL ELSE 100e0 END)", 50))
def speed_histogram(spark, sf_dir):
    rows = clean.clip(measured(spark, sf_dir), "average_speed_mph", upper=100.0)
    return out(explore.histogram(rows, "average_speed_mph", 50))


@register(
    "distance_histogram",
    TRIPS
    + """, q AS (SELECT quantile_cont(trip_miles, 0.25) AS q1, quantile_cont(trip_miles, 0.75) AS q3 FROM trips),
    capped AS (SELECT least(greatest(trip_miles, greatest(0e0, q1 - 1.5e0 * (q3 - q1))), q3 + 1.5e0 * (q3 - q1)) AS miles FROM trips, q)"""
    + _histogram("capped", "miles", 60),
)
def distance_histogram(spark, sf_dir):
    rows = clean.iqr_clip(trips(spark, sf_dir).select("trip_miles"), "trip_miles")
    return out(explore.histogram(rows, "trip_miles_iqr_capped", 60))


@register(
    "prediction_histogram",
    NAIVE + ", means AS (SELECT avg(prediction) AS m FROM naive GROUP BY pickup_community_area)" + _histogram("means", "m", 30),
)
def prediction_histogram(spark, sf_dir):
    means = explore.prediction_patterns(naive_forecast(spark, sf_dir), "zone")
    return out(explore.histogram(means, "mean_prediction", 30))


for _side in ("pickup", "dropoff"):

    @register(
        f"{_side}_density",
        TRIPS
        + f""" SELECT CAST(floor({_side}_latitude / 0.01e0) AS BIGINT) AS lat_cell, CAST(floor({_side}_longitude / 0.01e0) AS BIGINT) AS lon_cell,
        count(*) AS n FROM trips WHERE {_side}_latitude IS NOT NULL AND {_side}_longitude IS NOT NULL GROUP BY 1, 2""",
    )
    def point_density(spark, sf_dir, side=_side):
        return out(explore.point_density(trips(spark, sf_dir), f"{side}_latitude", f"{side}_longitude"))


_ZOOMS = [4, 9, 14]


@register(
    "pickup_density_pyramid",
    TRIPS
    + f""", p AS (SELECT pickup_latitude::DOUBLE AS lat, pickup_longitude::DOUBLE AS lon FROM trips WHERE pickup_latitude IS NOT NULL AND pickup_longitude IS NOT NULL),
    z AS (SELECT unnest({_ZOOMS}) AS zoom),
    c AS (SELECT zoom, CAST(floor((lat + 90) / 180 * (1 << zoom)) AS BIGINT) AS r, CAST(floor((lon + 180) / 360 * (1 << zoom)) AS BIGINT) AS c FROM p, z),
    n AS (SELECT zoom, r, c, count(*) AS n FROM c GROUP BY ALL)
    SELECT CAST(zoom AS INT) AS zoom, n,
      CAST(list_sum(list_transform(range(zoom), lambda k: ((((r >> k) & 1) << (2 * k + 1)) + (((c >> k) & 1) << (2 * k))))) AS BIGINT) AS cell,
      {r6("r * 180 / (1 << zoom)::DOUBLE - 90")} AS lat_low, {r6("(r + 1) * 180 / (1 << zoom)::DOUBLE - 90")} AS lat_high,
      {r6("c * 360 / (1 << zoom)::DOUBLE - 180")} AS lon_low, {r6("(c + 1) * 360 / (1 << zoom)::DOUBLE - 180")} AS lon_high FROM n""",
)
def pickup_density_pyramid(spark, sf_dir):
    """Pickups per cell at three zoom levels, counted once."""
    cells = explore.density_pyramid(trips(spark, sf_dir), "pickup_latitude", "pickup_longitude", _ZOOMS)
    return out(explore.cell_bounds(cells))


@register(
    "demand_correlation",
    DEMAND
    + ", f AS (SELECT *, CASE WHEN strftime(timestamp_hour, '%m-%d') IN ('01-01', '07-04', '12-25') THEN 1 ELSE 0 END AS is_holiday FROM demand) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r6(f'corr(trip_count, {c})')} AS correlation FROM f"
        for c in ("hour", "day_of_week", "month", "is_weekend", "is_holiday")
    ),
)
def demand_correlation(spark, sf_dir):
    rows = demand(spark, sf_dir).withColumn("is_holiday", calendar.is_holiday("timestamp_hour"))
    return out(explore.demand_correlation(rows, ["hour", "day_of_week", "month", "is_weekend", "is_holiday"]))


_SLICES_SQL = {
    "duration_not_positive": "trip_minutes <= 0",
    "distance_not_positive": "trip_miles <= 0",
    "fare_not_positive": "fare <= 0",
    "distance_very_low": "trip_miles > 0 AND trip_miles < 0.1e0",
}


@register(
    "quality_report",
    TRIPS
    + " "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS slice, count(*) AS n, "
        + ", ".join(f"{r6(f'CAST(median({m}) AS DOUBLE)')} AS med_{m}" for m in explore.QUALITY_MEASURES)
        + f" FROM trips WHERE {rule}"
        for name, rule in _SLICES_SQL.items()
    ),
)
def quality_report(spark, sf_dir):
    return out(explore.quality_report(trip.add_trip_minutes(trips(spark, sf_dir))))


@register(
    "quality_top",
    TRIPS
    + " "
    + " UNION ALL ".join(
        f"(SELECT '{name}' AS slice, payment_type, count(*) AS n FROM trips WHERE {rule} GROUP BY 2 ORDER BY n DESC, payment_type LIMIT 3)"
        for name, rule in _SLICES_SQL.items()
    ),
)
def quality_top(spark, sf_dir):
    return out(explore.quality_top(trip.add_trip_minutes(trips(spark, sf_dir)), 3))


@register(
    "pct_where",
    TRIPS + f" SELECT {r6('100 * avg(CASE WHEN trip_total > 0 THEN 1 ELSE 0 END)')} AS pct FROM trips WHERE fare <= 0",
)
def pct_where(spark, sf_dir):
    return out(explore.pct_where(trips(spark, sf_dir), F.col("trip_total") > 0, F.col("fare") <= 0))


@register(
    "latest_by_prefix",
    """SELECT event_type || '-' || user_id AS display_name, ts AS create_time FROM events
    WHERE event_type || '-' || user_id LIKE 'purchase%' ORDER BY create_time DESC, display_name LIMIT 1""",
)
def latest_by_prefix(spark, sf_dir):
    runs = read(spark, sf_dir, "events").select(
        F.concat_ws("-", "event_type", "user_id").alias("display_name"), F.col("ts").alias("create_time")
    )
    return out(explore.latest_by_prefix(runs, "purchase"))
