import pytest
from pyspark.sql import functions as F

from demand_engine.operators import explore


def test_heatmap_has_all_days(rows):
    df = rows([(0, 5, 2.0), (0, 5, 4.0), (6, 7, 1.0)], "d int, h int, v double")
    made = explore.heatmap(df, "d", "h", "v")
    assert made.columns == ["h", *explore.HEATMAP_DAYS]
    assert sorted(tuple(r) for r in made.collect()) == [(5, 3.0, *[None] * 6), (7, *[None] * 6, 1.0)]


def test_weekday_base(rows):
    sunday_first = rows([(d,) for d in range(1, 8)], "d int")
    assert [r.d for r in explore.normalize_dow(sunday_first, "d").collect()] == [6, 0, 1, 2, 3, 4, 5]
    monday_first = rows([(0,), (6,)], "d int")
    assert [r.d for r in explore.normalize_dow(monday_first, "d").collect()] == [0, 6]
    for bad, base in (([(0,), (8,)], "auto"), ([(0,), (7,)], "mon0")):
        with pytest.raises(Exception, match="out of range"):
            explore.normalize_dow(rows(bad, "d int"), "d", base).collect()


def test_named_aggregates(rows):
    df = rows([("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 9.0)], "k string, v double")
    assert {r.k: r.v for r in explore.agg_by(df, ["k"], "v", "median").collect()} == {"a": 2.0, "b": 5.0}
    assert [r.k for r in explore.agg_by(df, ["k"], "v", "sum", top_n=1).collect()] == ["b"]
    with pytest.raises(ValueError):
        explore.agg_by(df, ["k"], "v", "mode")


def test_median_keeps_keys_without_values(rows):
    df = rows([(1, None), (2, 4.0)], "h int, v double")
    assert {r.h: r.m for r in explore.median_by(df, ["h"], "v", "m").collect()} == {1: None, 2: 4.0}


def test_histogram_edges(rows):
    df = rows([(float(v),) for v in [0, 1, 2, 3, 4]] + [(None,)], "v double")
    assert [r.n for r in explore.histogram(df, "v", 4).orderBy("bin").collect()] == [1, 1, 1, 2]
    same = rows([(2.0,), (2.0,)], "v double")
    assert sum(r.n for r in explore.histogram(same, "v", 3).collect()) == 2


def test_quality_report_without_bad_rows(rows):
    df = rows([(10.0, 2.0, 5.0, 6.0)], "trip_minutes double, trip_miles double, fare double, trip_total double")
    assert {r.n for r in explore.quality_report(df).collect()} == {0}


def test_missing(rows):
    df = rows([(1, None), (2, None), (3, 1), (4, 1)], "a int, b int")
    assert [tuple(r) for r in explore.missing_pct(df).collect()] == [("b", 50.0)]


def test_describe(rows):
    df = rows([(1, "x"), (2, "y"), (3, "y"), (None, None)], "n int, s string")
    made = {r.column_name: r for r in explore.describe_table(df).collect()}
    assert (made["n"]["count"], made["n"]["mean"], made["n"]["p50"], made["n"]["std"]) == (3, 2.0, 2.0, 1.0)
    assert (made["s"]["count"], made["s"]["unique"], made["s"]["top"], made["s"]["freq"]) == (3, 2, "y", 2)


def test_pct(rows):
    df = rows([(0.0, 1.0), (0.0, None), (5.0, 9.0)], "fare double, total double")
    assert explore.pct_where(df, F.col("total") > 0, F.col("fare") <= 0).first().pct == 50.0


def test_unique_lists(rows):
    df = rows([(1, 3.0), (1, 1.0), (1, 3.0), (2, 2.0)], "pickup_community_area int, prediction double")
    assert {r[0]: r["values"] for r in explore.unique_value_lists(df).collect()} == {1: [1.0, 3.0], 2: [2.0]}


@pytest.mark.parametrize("name", ["median_speed_by_hour", "quality_report", "describe_table", "describe_by_area", "iqr_clip"])
def test_quantile_queries_scan_twice(spark, name):
    """The given table once for the histogram and once for the values around the ranks; iqr_clip once more, to clip."""
    from demand_engine.catalog import QUERIES

    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan") <= (3 if name == "iqr_clip" else 2)


def test_describe_table_of_odd_columns(spark):
    df = spark.createDataFrame(
        [(1, None, "a", None, 1.5), (2, None, "b", None, float("nan")), (2, None, "b", None, None)],
        "n int, empty double, t string, none string, x double",
    )
    got = {r.column_name: r for r in explore.describe_table(df).collect()}
    assert set(got) == set(df.columns)
    assert (got["n"]["count"], got["n"].mean, got["n"].p50, got["n"].unique) == (3, 5 / 3, 2.0, None)
    assert (got["empty"]["count"], got["empty"].mean, got["none"]["count"], got["none"].top) == (0, None, 0, None)
    assert (got["t"]["count"], got["t"].unique, got["t"].top, got["t"].freq, got["t"].p25) == (3, 2, "b", 2, None)
    assert (got["x"]["count"], got["x"].mean, got["x"]["max"]) == (1, 1.5, 1.5)
    assert [r.column_name for r in explore.describe_table(df.select("t")).collect()] == ["t"]
    assert explore.describe_table(df.limit(0)).count() == 5


def test_density_at_every_zoom_by_brute_force(spark):
    import random
    from collections import Counter

    rng = random.Random(1)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)] + [(41.88, -87.63)] * 50
    points += [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (91.0, 0.0), (None, 1.0), (1.0, None), (float("nan"), 0.0)]
    df = spark.createDataFrame(points, "lat double, lon double")
    zooms = [0, 1, 7, 17, explore.MAX_ZOOM]
    want = Counter()
    for lat, lon in points:
        if lat is None or lon is None or not -90 <= lat <= 90:
            continue
        for z in zooms:
            r, c = (min(int((x + half) / (2 * half) * 2**z), 2**z - 1) for x, half in ((lat, 90), (lon, 180)))
            want[z, sum((r >> k & 1) << 2 * k + 1 | (c >> k & 1) << 2 * k for k in range(z))] += 1
    cells = explore.density_pyramid(df, "lat", "lon", zooms)
    assert {(r.zoom, r.cell): r.n for r in cells.collect()} == want
    boxes = explore.cell_bounds(cells.where("zoom = 17")).collect()
    assert sum(r.n for r in boxes if r.lat_low <= 41.88 < r.lat_high and r.lon_low <= -87.63 < r.lon_high) == 50
    with pytest.raises(ValueError):
        explore.density_pyramid(df, "lat", "lon", [])
