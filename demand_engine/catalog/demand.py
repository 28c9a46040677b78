"""Registered queries: grids, counts, calendar columns, holidays, second and third subject."""

from pyspark.sql import functions as F

from demand_engine.catalog.common import (
    COUNTS,
    DEMAND,
    END,
    OBSERVED_DEMAND,
    START,
    TRIPS,
    demand,
    out,
    r6,
    register,
    trips,
    window_trips,
)
from demand_engine.fixtures import read
from demand_engine.functions import calendar
from demand_engine.operators import demand as ops
from demand_engine.operators import holidays


@register("full_grid", DEMAND + " SELECT timestamp_hour, pickup_community_area FROM filled")
def full_grid(spark, sf_dir):
    return out(ops.full_grid(window_trips(spark, sf_dir), START, END))


@register("fill_counts", DEMAND + " SELECT timestamp_hour, pickup_community_area, trip_count FROM filled")
def fill_counts(spark, sf_dir):
    rows = window_trips(spark, sf_dir)
    return out(ops.fill_counts(ops.full_grid(rows, START, END), ops.hourly_demand(rows)))


@register("hourly_demand", COUNTS + " SELECT timestamp_hour, pickup_community_area, trip_count FROM counts")
def hourly_demand(spark, sf_dir):
    return out(ops.hourly_demand(window_trips(spark, sf_dir)))


@register("distinct_ids", COUNTS + " SELECT pickup_community_area FROM areas ORDER BY 1")
def distinct_ids(spark, sf_dir):
    return out(ops.distinct_ids(window_trips(spark, sf_dir)).orderBy("pickup_community_area"))


@register("observed_range", COUNTS + " SELECT min(timestamp_hour) AS min_time, max(timestamp_hour) AS max_time FROM counts")
def observed_range(spark, sf_dir):
    return out(ops.observed_range(ops.hourly_demand(window_trips(spark, sf_dir))))


@register("demand_table", DEMAND + " SELECT * FROM demand")
def demand_table(spark, sf_dir):
    return out(demand(spark, sf_dir))


@register("demand_table_observed", OBSERVED_DEMAND + " SELECT * FROM demand")
def demand_table_observed(spark, sf_dir):
    return out(demand(spark, sf_dir, "observed"))


@register(
    "series_length",
    DEMAND + " SELECT pickup_community_area, count(*) AS n_points, count(*) > 3000 AS over_cap FROM demand GROUP BY 1",
)
def series_length(spark, sf_dir):
    return out(ops.series_length(demand(spark, sf_dir)))


@register(
    "duplicate_keys",
    DEMAND
    + """ SELECT timestamp_hour, pickup_community_area, count(*) AS n FROM demand GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_keys(spark, sf_dir):
    return out(ops.duplicate_keys(demand(spark, sf_dir), ["timestamp_hour", "pickup_community_area"]))


@register(
    "repeated_trip_starts",
    TRIPS
    + """ SELECT payment_type, pickup_community_area, count(*) AS n FROM trips GROUP BY 1, 2 HAVING count(*) > 1""",
)
def repeated_trip_starts(spark, sf_dir):
    return out(ops.duplicate_keys(trips(spark, sf_dir), ["payment_type", "pickup_community_area"]))


_WIDE = ", ".join(f'max(trip_count) FILTER (WHERE pickup_community_area = {a}) AS "{a}"' for a in (8, 28, 32, 56, 76))


@register("wide_series", DEMAND + f" SELECT timestamp_hour, {_WIDE} FROM demand GROUP BY 1")
def wide_series(spark, sf_dir):
    return out(ops.wide_series(demand(spark, sf_dir), [8, 28, 32, 56, 76]))


@register(
    "future_grid",
    COUNTS
    + f""", steps AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-31', TIMESTAMP '2024-01-31' + INTERVAL 167 HOUR, INTERVAL 1 HOUR)) AS timestamp_hour)
    SELECT timestamp_hour, pickup_community_area, hour(timestamp_hour) AS hour, CAST(isodow(timestamp_hour) - 1 AS INT) AS day_of_week,
      month(timestamp_hour) AS month, dayofyear(timestamp_hour) AS day_of_year,
      CASE WHEN isodow(timestamp_hour) >= 6 THEN 1 ELSE 0 END AS is_weekend, 0 AS is_holiday
    FROM steps CROSS JOIN areas""",
)
def future_grid(spark, sf_dir):
    cells = ops.future_grid(demand(spark, sf_dir), "2024-01-31T00:00:00", 168)
    t = F.col("timestamp_hour")
    made = cells.withColumns(
        {
            "hour": F.hour(t).cast("bigint"),
            "day_of_week": calendar.dow_mon0(t),
            "month": F.month(t).cast("bigint"),
            "day_of_year": F.dayofyear(t).cast("bigint"),
            "is_weekend": calendar.is_weekend(t),
        }
    )
    return out(holidays.add_holidays(made, holidays.federal_holidays(spark, 2024, 2024)))


_NTH = [(1, 1, 3, 1986), (2, 1, 3, 1971), (9, 1, 1, 1894), (10, 1, 2, 1971), (11, 4, 4, 1942)]
_SAME = [(1, 1, 1871), (6, 19, 2021), (7, 4, 1871), (11, 11, 1978), (12, 25, 1871)]
_FEDERAL = (
    "WITH years AS (SELECT unnest(generate_series(min(year(o_orderdate)), max(year(o_orderdate)) + 1)) AS y FROM orders), "
    "same AS ("
    + " UNION ALL ".join(f"SELECT make_date(y, {m}, {d}) AS d FROM years WHERE y >= {since}" for m, d, since in _SAME)
    + "), days AS (SELECT d FROM same UNION SELECT d - 1 FROM same WHERE isodow(d) = 6 UNION SELECT d + 1 FROM same WHERE isodow(d) = 7"
    + "".join(
        f" UNION SELECT make_date(y, {m}, 1) + CAST(({w} - isodow(make_date(y, {m}, 1)) + 7) % 7 + {7 * (n - 1)} AS INT) FROM years WHERE y >= {since}"
        for m, w, n, since in _NTH
    )
    + " UNION SELECT make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INT) FROM years WHERE y >= 1971)"
)


@register(
    "orders_on_holidays",
    _FEDERAL
    + """ SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) IN (SELECT CAST(d AS DATE) FROM days) THEN 1 ELSE 0 END AS is_holiday
    FROM orders""",
)
def orders_on_holidays(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return out(holidays.add_holidays(orders, time="o_orderdate").select("o_orderkey", "is_holiday"))


@register(
    "holiday_rules",
    DEMAND
    + """ SELECT timestamp_hour, pickup_community_area,
      CASE WHEN isodow(timestamp_hour) = 7 THEN 1 ELSE 0 END AS sunday_rule,
      CASE WHEN strftime(timestamp_hour, '%m-%d') IN ('01-01', '07-04', '12-25') THEN 1 ELSE 0 END AS fixed_rule,
      CASE WHEN CAST(timestamp_hour AS DATE) IN (DATE '2024-01-01', DATE '2024-01-15') THEN 1 ELSE 0 END AS federal_rule
    FROM filled""",
)
def holiday_rules(spark, sf_dir):
    t = "timestamp_hour"
    rows = demand(spark, sf_dir).select(t, "pickup_community_area")
    rows = rows.withColumns({"sunday_rule": calendar.is_holiday(t, "sunday"), "fixed_rule": calendar.is_holiday(t)})
    return out(holidays.add_holidays(rows, holidays.federal_holidays(spark, 2023, 2024), t, "federal_rule"))


@register(
    "calendar_parts",
    TRIPS
    + f""" SELECT trip_id, date_trunc('hour', trip_start_timestamp) AS start_hour_of, hour(trip_start_timestamp) AS hour,
      dayofweek(trip_start_timestamp) + 1 AS day_of_week, month(trip_start_timestamp) AS month,
      year(trip_start_timestamp) AS year, dayofyear(trip_start_timestamp) AS day_of_year, week(trip_start_timestamp) AS week_of_year,
      CAST(CASE WHEN isodow(trip_start_timestamp) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
      {r6("sin(2 * pi() * hour(trip_start_timestamp) / 24)")} AS hour_sin,
      {r6("cos(2 * pi() * hour(trip_start_timestamp) / 24)")} AS hour_cos FROM trips""",
)
def calendar_parts(spark, sf_dir):
    t = "trip_start_timestamp"
    rows = trips(spark, sf_dir).select("trip_id", t, calendar.hour_of(t).alias("start_hour_of"))
    return out(calendar.calendar_parts(rows, t).drop(t))


@register(
    "order_calendar",
    """SELECT o_orderkey, dayofweek(o_orderdate) + 1 AS sunday_first, CAST(isodow(o_orderdate) - 1 AS INT) AS monday_first,
      week(o_orderdate) AS iso_week, dayname(o_orderdate) AS day_name, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders""",
)
def order_calendar(spark, sf_dir):
    t = "o_orderdate"
    return out(
        read(spark, sf_dir, "orders").select(
            "o_orderkey",
            calendar.dow_sun1(t).cast("bigint").alias("sunday_first"),
            calendar.dow_mon0(t).alias("monday_first"),
            calendar.iso_week(t).cast("bigint").alias("iso_week"),
            calendar.day_name(t).alias("day_name"),
            calendar.day_of(t).alias("date"),
        )
    )


@register(
    "temporal_features",
    TRIPS
    + f""" SELECT trip_id, CAST(hour(trip_start_timestamp) AS INT) AS hour, CAST(isodow(trip_start_timestamp) - 1 AS INT) AS dayofweek,
      CAST(month(trip_start_timestamp) AS INT) AS month,
      {r6("sin(2 * pi() * hour(trip_start_timestamp) / 24)")} AS trip_start_timestamp_hour_sin,
      {r6("cos(2 * pi() * hour(trip_start_timestamp) / 24)")} AS trip_start_timestamp_hour_cos FROM trips""",
)
def temporal_features(spark, sf_dir):
    t = "trip_start_timestamp"
    return out(calendar.temporal_features(trips(spark, sf_dir).select("trip_id", t), t).drop(t))


@register(
    "temporal_record",
    TRIPS
    + """ SELECT trip_id, CAST(hour(trip_start_timestamp) AS INT) AS hour, CAST(isodow(trip_start_timestamp) - 1 AS INT) AS day_of_week,
      CAST(month(trip_start_timestamp) AS INT) AS month, CAST(day(trip_start_timestamp) AS INT) AS day_of_month,
      CASE WHEN isodow(trip_start_timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend,
      CASE WHEN isodow(trip_start_timestamp) = 7 THEN 1 ELSE 0 END AS is_holiday FROM trips""",
)
def temporal_record(spark, sf_dir):
    t = "trip_start_timestamp"
    return out(calendar.temporal_record(trips(spark, sf_dir).select("trip_id", t), t).drop(t))


@register(
    "cyclic_weekday",
    DEMAND
    + f""" SELECT timestamp_hour, pickup_community_area, {r6("sin(2 * pi() * (isodow(timestamp_hour) - 1) / 7)")} AS dow_sin,
      {r6("cos(2 * pi() * (isodow(timestamp_hour) - 1) / 7)")} AS dow_cos FROM filled""",
)
def cyclic_weekday(spark, sf_dir):
    dow_sin, dow_cos = calendar.cyclic(calendar.dow_mon0("timestamp_hour"), 7)
    rows = demand(spark, sf_dir).select("timestamp_hour", "pickup_community_area")
    return out(rows.withColumns({"dow_sin": dow_sin, "dow_cos": dow_cos}))


def _daily(source: str, low: str, high: str, id: str) -> str:
    return f"""WITH counts AS ({source}), days AS (SELECT unnest(generate_series({low}, {high}, INTERVAL 1 DAY)) AS day)
    SELECT d.day, i.{id}, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM days d CROSS JOIN (SELECT DISTINCT {id} FROM counts) i
    LEFT JOIN counts c ON c.day = d.day AND c.{id} = i.{id}"""


@register(
    "daily_orders_per_nation",
    _daily(
        "SELECT date_trunc('day', o_orderdate) AS day, c_nationkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2",
        "(SELECT min(day) FROM counts)",
        "(SELECT max(day) FROM counts)",
        "c_nationkey",
    ),
)
def daily_orders_per_nation(spark, sf_dir):
    orders, customers = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    counts = ops.demand_by_lookup(
        orders, customers, "o_custkey", "c_custkey", "c_nationkey", "o_orderdate", "day", "day", "n"
    )
    low, high = ops.observed_bounds(counts, "day", "n")
    return out(ops.fill_gaps(counts, low, high, "day", "c_nationkey", "n", "day"))


@register(
    "daily_shipments_per_supplier",
    _daily(
        "SELECT date_trunc('day', l_shipdate) AS day, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2",
        "(SELECT min(day) FROM counts)",
        "(SELECT max(day) FROM counts)",
        "l_suppkey",
    ),
)
def daily_shipments_per_supplier(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("timestamp").alias("l_shipdate"), "l_suppkey")
    counts = ops.hourly_demand(rows, "l_shipdate", "l_suppkey", "day", "day", "n")
    low, high = ops.observed_bounds(counts, "day", "n")
    return out(ops.fill_gaps(counts, low, high, "day", "l_suppkey", "n", "day"))
