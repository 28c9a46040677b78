import datetime as dt

import pytest
from pyspark.sql import functions as F

from demand_engine.operators import clean
from demand_engine.sources.tables import require


def test_window_bounds():
    start, end = clean.window_bounds("2023-11-22", 2950)
    assert (start, end) == (dt.datetime(2023, 7, 22), dt.datetime(2023, 11, 22, 23, 59, 59))
    assert clean.window_bounds("2023-11-22", 9999)[0] < clean.window_bounds("2023-11-22", 3000)[0]
    with pytest.raises(ValueError):
        clean.window_bounds("22/11/2023", 10)


def test_window_ends(rows):
    df = rows([("2024-01-01 00:00:00", 1), ("2024-01-02 00:00:00", 1), ("2024-01-01 12:00:00", None)], "t timestamp, a int")
    closed = clean.filter_window(df, "2024-01-01", "2024-01-02", "t", ["a"])
    assert closed.count() == 2
    assert clean.filter_window(df, "2024-01-01", "2024-01-02", "t", ["a"], closed="left").count() == 1
    with pytest.raises(ValueError):
        clean.filter_window(df, "2024-01-01", "2024-01-02", "t", closed="right")


def test_filter_reaches_the_scan(spark, capsys):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("ts").cast("timestamp").alias("t"), "user_id")
    clean.filter_window(df, "2024-01-02", "2024-01-03", "t").explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(ts," in plan and "LessThanOrEqual(ts," in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_coerce_and_report(rows):
    df = rows([("1.5", "2024-01-01 00:00:00"), ("x", "never"), (None, None)], "n string, t string")
    made = clean.coerce(df, ["t"], ["n"]).collect()
    assert sorted(str(r.n) for r in made) == ["1.5", "None", "None"]
    report = {r.column_name: tuple(r)[1:] for r in clean.coercion_report(df, ["t"], ["n"]).collect()}
    assert report == {"t": (1, 2, 1), "n": (1, 2, 1)}


def test_names_and_order(rows):
    df = rows([(1, 2, 3)], "a int, b int, c int").toDF(" Trip ID", "Fare ", "pickup Area")
    assert clean.normalize_columns(df).columns == ["trip_id", "fare", "pickup_area"]
    shuffled = rows([(1, 2, 3, 4)], "z int, t int, a int, id int")
    assert clean.order_columns(shuffled, "id", "t").columns == ["id", "t", "a", "z"]


def test_required_columns(rows):
    df = rows([(1,)], "a int")
    assert require(df, ["a"]) is df
    with pytest.raises(ValueError, match="b"):
        require(df, ["a", "b"])
    with pytest.raises(ValueError):
        clean.canonical(df, "t", "a", "p", "prediction")


def test_iqr_clip_keeps_nulls(rows):
    df = rows([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "v double")
    got = sorted((r.v_iqr_capped for r in clean.iqr_clip(df, "v").collect()), key=lambda x: (x is None, x))
    assert got == [1.0, 2.0, 3.0, 4.0, 7.0, None]


def test_iqr_lower_bound_is_not_negative(rows):
    df = rows([(float(v),) for v in [-50, 1, 2, 3, 4]], "v double")
    assert clean.iqr_bounds(df, "v").first().lower_bound == 0.0


def test_clip(rows):
    df = rows([(-1.0,), (0.5,), (None,), (9.0,)], "v double")
    assert [r.v for r in clean.clip(df, "v", lower=0, upper=2).collect()] == [0.0, 0.5, None, 2.0]


def test_flatten(rows):
    df = rows([("8", 1.5)], "pickup_community_area string, v double").select(
        "pickup_community_area", F.struct(F.col("v").alias("value")).alias("predicted_trip_count")
    )
    assert tuple(clean.flatten_predictions(df).first()) == (8, 1.5)


def test_coercion_is_reported_by_the_write(spark, rows, tmp_path):
    from demand_engine.sources.committed import CommittedTable

    df = rows([("1.5", "2024-01-01 00:00:00", 1), ("x", "never", 2), (None, None, 3)], "n string, t string, _rows int")
    table = CommittedTable(spark, str(tmp_path / "t"))
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    report = {r.column_name: tuple(r)[1:] for r in clean.coerce_into(table, df, ["t"], ["n"]).collect()}
    assert report == {"t": (1, 2, 1), "n": (1, 2, 1)}
    # One job writes; the other reads the report.
    assert len(tracker.getJobIdsForGroup(None)) - before <= 2
    assert sorted(map(str, table.read().collect())) == sorted(map(str, clean.coerce(df, ["t"], ["n"]).collect()))
    empty = clean.coerce_into(table, df.limit(0), ["t"], ["n"]).collect()
    assert [tuple(r)[1:] for r in empty] == [(0, 0, 0)] * 2 and table.read().count() == 0
