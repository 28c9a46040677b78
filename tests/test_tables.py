import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demand_engine.sources import tables


def test_pruned_scan(spark, capsys):
    tables.scan_events(spark, "/root/testdata/sf0.001/events.parquet", ["ts", "user_id"]).explain("formatted")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in capsys.readouterr().out


def test_scan_maps_nan_to_null(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double").write.parquet(str(tmp_path / "v"))
    got = tables.scan_events(spark, str(tmp_path / "v"), ["v"])
    assert got.where("v is null").count() == 2 and got.where("v = 1").count() == 1
    with pytest.raises(ValueError):
        tables.scan_events(spark, str(tmp_path / "v"), ["w"])


def test_sample_is_a_subset_and_repeatable(spark):
    df = spark.range(2000).withColumn("v", F.when(F.col("id") % 10 > 0, F.col("id")))
    one = {r.id for r in tables.sample_rows(df.repartition(3), ["v"], 30, 42, "id").collect()}
    two = {r.id for r in tables.sample_rows(df.repartition(9), ["v"], 30, 42, "id").collect()}
    other = {r.id for r in tables.sample_rows(df, ["v"], 30, 43, "id").collect()}
    assert one == two != other and len(one) == 30 and all(i % 10 for i in one)
    assert tables.sample_rows(df, ["v"], 99_999, 42, "id").count() == 1800


def test_range_ends_at_midnight(rows):
    df = rows([(1, "2023-01-07 00:00:00"), (2, "2023-01-07 00:00:01"), (3, "2023-01-01 00:00:00")], "id int, trip_start_timestamp timestamp")
    got = tables.sample_range(df, "2023-01-01", "2023-01-07", 100, "id")
    assert sorted(r.id for r in got.collect()) == [1, 3]
    assert [r.id for r in tables.sample_range(df, "2023-01-01", "2023-01-07", 1, "id").collect()] == [1]


def test_csv(spark, rows, tmp_path):
    df = rows([("2024-01-01 05:00:00", 8, 1.5)], "t timestamp, id int, p double")
    path = str(tmp_path / "csv")
    tables.write_csv(df, path)
    schema = T.StructType([T.StructField("t", T.TimestampType()), T.StructField("id", T.IntegerType()), T.StructField("p", T.DoubleType())])
    assert tables.read_csv(spark, path, schema, "t").collect() == df.collect()
    swapped = T.StructType([schema["id"], schema["t"], schema["p"]])
    with pytest.raises(Exception, match="header"):
        tables.read_csv(spark, path, swapped, "t").collect()


def test_replace_folder_and_table(spark, tmp_path):
    for target in (str(tmp_path / "t"), "replaced_table"):
        for n in (5, 3):
            tables.write_table(spark.range(n), target, T.StructType([T.StructField("id", T.IntegerType())]))
        back = tables.read_table(spark, target)
        assert back.count() == 3 and back.dtypes == [("id", "int")]


def test_narrow_numbers(rows):
    df = rows([(1, 8.0, 8.0, 1.5, "x"), (2, 76.0, None, 2.0, "y")], "i int, whole double, holes double, half float, s string")
    assert tables.narrow_numbers(df).dtypes == [("i", "bigint"), ("whole", "bigint"), ("holes", "double"), ("half", "double"), ("s", "string")]


def test_append_missing_twice(spark):
    src = spark.range(10)
    once = tables.append_missing(src, spark.range(4), ["id"])
    assert sorted(r.id for r in tables.append_missing(src, once, ["id"]).collect()) == list(range(10))


def test_schema_refuses_fractions(rows):
    from pyspark.sql import types as T

    from demand_engine.sources.tables import enforce_schema

    whole = T.StructType([T.StructField("n", T.LongType())])
    assert [r.n for r in enforce_schema(rows([(2.0,), (None,)], "n double"), whole).collect()] == [2, None]
    with pytest.raises(Exception, match="fraction"):
        enforce_schema(rows([(2.7,)], "n double"), whole).collect()
