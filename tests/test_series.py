import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from demand_engine.operators import features as feats
from demand_engine.operators import series
from demand_engine.plans.forecast import future_features

T, ID = "timestamp_hour", "pickup_community_area"


@pytest.fixture
def demand(spark):
    """Two gap-free series of 400 hours that start in the middle of a piece."""
    hours = F.lit("2024-01-03 05:00:00").cast("timestamp") + F.make_dt_interval(hours=F.col("id") % 400)
    return spark.range(800).select(
        hours.alias(T), (F.col("id") / 400).cast("int").alias(ID), F.abs(F.hash("id") % 50).cast("bigint").alias("trip_count")
    )


def same(a, b):
    return a.exceptAll(b.select(a.columns)).isEmpty() and b.select(a.columns).exceptAll(a).isEmpty()


@pytest.mark.parametrize("chunk", [168, 191, 1000])
def test_pieces_equal_whole_series(demand, chunk):
    assert same(series.add_lags(demand), series.add_lags(demand, chunk=chunk))
    assert same(series.add_rolling_means(demand), series.add_rolling_means(demand, chunk=chunk))
    assert same(series.context_windows(demand, 100, 24), series.context_windows(demand, 100, 24, chunk=chunk))


def test_piece_shorter_than_reach(demand):
    with pytest.raises(ValueError):
        series.add_lags(demand, chunk=24)


def test_rolling_means_stay_in_their_series(rows):
    df = rows(
        [("2024-01-01 00:00:00", 1, 1), ("2024-01-01 01:00:00", 1, 2), ("2024-01-01 02:00:00", 1, 6), ("2024-01-01 00:00:00", 2, 10), ("2024-01-01 01:00:00", 2, 20)],
        f"{T} timestamp, {ID} int, trip_count bigint",
    )
    got = {(r[ID], r[T].hour): r.target_rollmean_3 for r in series.add_rolling_means(df, [3]).collect()}
    assert got == {(1, 0): None, (1, 1): 1.0, (1, 2): 1.5, (2, 0): None, (2, 1): 10.0}


def test_windows_share_one_shuffle(demand, capsys):
    made = feats.add_target_features(demand)
    made.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1


def test_preparation_and_features_shuffle_twice(spark, capsys):
    """Once for the counts, once for the series; gap filling and all windows share the second."""
    table = queries()["demand_table"](spark, "/root/testdata/sf0.001")
    feats.add_target_features(table.withColumn(T, F.col(T).cast("timestamp"))).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange ") == 2 and "Join" not in plan
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan


def test_split_by_fraction(demand):
    sizes = {r.split: r["count"] for r in series.split_by_fraction(demand).groupBy("split").count().collect()}
    assert sizes == {"train": 640, "validation": 80, "test": 80}


def test_split_by_date(demand):
    made = series.split_by_date(demand, "2024-01-04", "2024-01-05", check=True)
    assert {r.split: r["count"] for r in made.groupBy("split").count().collect()} == {"train": 2 * 19, "validation": 2 * 24}
    with pytest.raises(ValueError):
        series.split_by_date(demand, "2020-01-04", "2020-01-05", check=True)


def test_sample_series(demand):
    assert [r[0] for r in series.sample_series(demand, ID).select(ID).distinct().collect()] == [0]


def test_training_features(demand):
    made = feats.features(demand, [0, 1])
    assert made.count() == 2 * (400 - 168)
    assert feats.feature_columns(made) == (
        ["area_0", "area_1"]
        + [f"target_lag_{k}" for k in series.LAGS]
        + [f"target_rollmean_{k}" for k in series.ROLLING_WINDOWS]
        + feats.CYCLIC
    )
    short = demand.where(f"{T} < timestamp'2024-01-05'")
    with pytest.raises(ValueError):
        feats.finalize_features(feats.add_cyclic(feats.add_target_features(short)), [T, ID], check=True)


def test_future_has_the_columns_of_training(demand):
    start = "2024-01-17"
    future = future_features(demand, start, 24, [0, 1])
    train = feats.features(demand, [0, 1], horizon=24)
    assert set(future.columns) == set(train.columns) - {"trip_count"}
    assert future.count() == 2 * 24
    shown = feats.align_features(future, feats.feature_columns(train), [T, ID])
    actual = train.where(f"{T} >= timestamp'{start}' and {T} < timestamp'2024-01-18'").drop("trip_count")
    assert same(shown, actual)
    with pytest.raises(ValueError, match="target_lag_1"):
        feats.align_features(future, ["target_lag_1"], [T, ID])


def test_horizon_lags():
    assert feats.horizon_lags(168) == [168]
    assert feats.horizon_lags(24) == [24, 48, 168]
    with pytest.raises(ValueError):
        feats.horizon_lags(169)


def test_one_hot_and_ids(rows):
    df = rows([(1,), (2,), (None,)], f"{ID} int")
    assert [tuple(r)[1:] for r in feats.one_hot(df, [1, 2]).collect()] == [(1, 0), (0, 1), (0, 0)]
