import datetime as dt

import pytest
from pyspark.sql import functions as F

from demand_engine.operators import demand as ops
from demand_engine.sources.tables import DEMAND_SCHEMA, enforce_schema

TRIPS = [
    ("2023-01-01 00:15:00", 8.0, 1),
    ("2023-01-01 00:45:00", 8.0, 2),
    ("2023-01-01 01:10:00", 76.0, 3),
    ("2023-01-01 00:20:00", 8.0, 4),
    ("2023-01-02 03:00:00", 8.0, 5),
    ("2023-01-01 05:00:00", None, 6),
]
SCHEMA = "trip_start_timestamp timestamp, pickup_community_area double, other_col int"
DAY = ("2023-01-01 00:00:00", "2023-01-01 23:59:59")


def test_whole_window(rows):
    table = enforce_schema(ops.demand_table(rows(TRIPS, SCHEMA), *DAY), DEMAND_SCHEMA)
    assert table.columns == DEMAND_SCHEMA.names
    got = {(r.timestamp_hour.hour, r.pickup_community_area): r.trip_count for r in table.collect()}
    assert len(got) == 24 * 2 and sum(got.values()) == 4
    assert got[(0, 8)] == 3 and got[(1, 76)] == 1 and got[(1, 8)] == 0


def test_observed_window(rows):
    table = ops.demand_table(rows(TRIPS, SCHEMA), *DAY, bounds="observed")
    assert table.count() == 2 * 2
    with pytest.raises(ValueError):
        ops.demand_table(rows(TRIPS, SCHEMA), *DAY, bounds="all")


def test_no_rows_give_no_grid(rows):
    assert ops.demand_table(rows(TRIPS, SCHEMA), "2020-01-01", "2020-01-02").count() == 0


def test_gap_filling_equals_grid_join(rows):
    df = rows(TRIPS, SCHEMA).where("pickup_community_area is not null")
    counts = ops.hourly_demand(df)
    joined = ops.fill_counts(ops.full_grid(df, "2023-01-01 00:00:00", "2023-01-03 23:59:59"), counts)
    low, high = F.lit("2023-01-01").cast("timestamp"), F.lit("2023-01-03 23:59:59").cast("timestamp")
    filled = ops.fill_gaps(counts, low, high)
    assert filled.exceptAll(joined).count() == 0 and joined.exceptAll(filled).count() == 0
    assert filled.count() == 72 * 2


@pytest.mark.parametrize("chunk", [None, 5, 24, 1000])
def test_gap_filling_leaves_out_what_is_outside(rows, chunk):
    data = [("2020-01-01 00:00:00", 1, 9), ("2022-12-31 23:00:00", 1, 5), ("2023-01-01 02:00:00", 1, 3), ("2023-01-02 04:00:00", 1, 7), ("2023-01-01 00:00:00", 2, 1), ("2030-01-01 00:00:00", 2, 8)]
    counts = rows(data, "timestamp_hour timestamp, pickup_community_area int, trip_count bigint")
    low, high = F.lit("2023-01-01").cast("timestamp"), F.lit("2023-01-01 23:59:59").cast("timestamp")
    got = {(r.timestamp_hour.hour, r.pickup_community_area): r.trip_count for r in ops.fill_gaps(counts, low, high, chunk=chunk).collect()}
    assert got == {(h, a): {(2, 1): 3, (0, 2): 1}.get((h, a), 0) for h in range(24) for a in (1, 2)}


def scans(df, table):
    """How often the final plan reads the table."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("FileScan" in line and table in line for line in plan.split("+- == Initial Plan ==")[0].splitlines())


@pytest.mark.parametrize("query, table", [("demand_table_observed", "events"), ("daily_shipments_per_supplier", "lineitem"), ("accuracy", "events"), ("quality_top", "events")])
def test_raw_table_is_read_once(spark, query, table):
    from demand_engine.catalog import QUERIES

    assert scans(QUERIES[query](spark, "/root/testdata/sf0.001"), f"{table}.parquet") <= 1


def test_hot_series_moves_one_row_per_hour_and_task(spark):
    """A third of the rows in one series: what is shuffled is bounded by hours, not by rows."""
    n = 30_000
    hot = spark.range(n).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id") % 48)).alias("trip_start_timestamp"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(2 + F.col("id") % 200).alias("pickup_community_area"),
    )
    table = ops.demand_table(hot, "2024-01-01", "2024-01-02 23:59:59")
    per_series = {r[0]: (r[1], r[2]) for r in table.groupBy("pickup_community_area").agg(F.count("*"), F.sum("trip_count")).collect()}
    assert all(hours == 48 for hours, _ in per_series.values())
    assert per_series[1][1] == n // 3 and sum(t for _, t in per_series.values()) == n


def test_future_grid(rows):
    ids = rows([(2,), (1,), (None,), (1,)], "pickup_community_area int")
    grid = ops.future_grid(ids, "2024-01-01T00:00:00Z", 2)
    assert sorted(tuple(r) for r in grid.collect()) == [
        (dt.datetime(2024, 1, 1, h), a) for h in (0, 1) for a in (1, 2)
    ]
    assert ops.duplicate_keys(grid, ["timestamp_hour", "pickup_community_area"]).isEmpty()
    with pytest.raises(ValueError):
        ops.future_grid(ids, "2024-01-01", 0)
    with pytest.raises(ValueError, match="no series id"):
        ops.future_grid(ids.where("pickup_community_area is null"), "2024-01-01", 2)


def test_lookup_counts(rows):
    orders = rows([("2024-01-01", 1), ("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-02", 3)], "t timestamp, c int")
    customers = rows([(1, 10), (2, 10), (3, None)], "ck int, nation int")
    got = ops.demand_by_lookup(orders, customers, "c", "ck", "nation", "t", "day", "day", "n").collect()
    assert [(r.nation, r.n) for r in got] == [(10, 3)]


def test_wide_series_and_length(rows):
    df = rows([("2024-01-01 00:00:00", 1, 5), ("2024-01-01 00:00:00", 2, 7), ("2024-01-01 01:00:00", 1, 6)], "timestamp_hour timestamp, pickup_community_area int, trip_count bigint")
    wide = ops.wide_series(df, [2, 1, 9]).orderBy("timestamp_hour").collect()
    assert [tuple(r)[1:] for r in wide] == [(7, 5, None), (None, 6, None)]
    assert {r[0]: (r[1], r[2]) for r in ops.series_length(df, cap=1).collect()} == {1: (2, True), 2: (1, False)}
