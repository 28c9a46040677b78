import pytest
from pyspark.sql import functions as F

from demand_engine.operators import series
from demand_engine.sources import series as stored


@pytest.fixture
def demand(spark):
    t = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 300 * 3600)
    return spark.range(3000).select(
        t.alias("timestamp_hour"), F.floor(F.col("id") / 300).cast("int").alias("pickup_community_area"), (F.col("id") * 7 % 13).alias("trip_count")
    ).repartition(5)


def rows(df):
    return sorted(map(str, df.collect()))


def test_windows_over_stored_series_need_no_exchange(spark, demand, tmp_path):
    folder = str(tmp_path / "s")
    table = stored.write_series(demand, folder)
    assert rows(table) == rows(demand)
    made = {
        "lags": series.add_lags, "rolling": series.add_rolling_means, "naive": series.seasonal_naive,
        "context": lambda df: series.context_windows(df, 10, 5),
    }
    for fn in made.values():
        df = fn(stored.read_series(spark, folder))
        got = rows(df)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        assert got == rows(fn(demand))


def test_another_session_reads_the_layout(spark, demand, tmp_path):
    folder = str(tmp_path / "s")
    stored.write_series(demand, folder, buckets=3)
    spark.sql(f"DROP TABLE {stored._name(folder)}")
    table = stored.read_series(spark, folder)
    assert rows(table) == rows(demand)
    plan = series.add_lags(table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount: 3 out of 3" in plan
    with pytest.raises(ValueError):
        stored.write_series(demand, folder)


def test_number_of_buckets():
    assert stored.buckets_for(10**9, 77) == 77 and stored.buckets_for(10**9, 10**6) == 200
    assert stored.buckets_for(10, 15) == 1 and stored.buckets_for(0, 0) == 1


def test_empty_and_null_ids(spark, demand, tmp_path):
    assert stored.write_series(demand.limit(0), str(tmp_path / "e")).count() == 0
    with_null = demand.withColumn("pickup_community_area", F.when(F.col("pickup_community_area") > 0, F.col("pickup_community_area")))
    assert rows(stored.write_series(with_null, str(tmp_path / "n"))) == rows(with_null)
