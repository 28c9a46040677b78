"""Reading and writing tables: pruned scans, bounded samples, CSV, schema enforcement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demand_engine.functions.calendar import timestamp_literal
from demand_engine.operators.ordering import first_rows
from demand_engine.sources.committed import CommittedTable

# The prepared demand table, names and types in order.
DEMAND_SCHEMA = T.StructType(
    [
        T.StructField("timestamp_hour", T.TimestampType()),
        T.StructField("pickup_community_area", T.LongType()),
        T.StructField("trip_count", T.LongType()),
        T.StructField("hour", T.LongType()),
        T.StructField("day_of_week", T.LongType()),
        T.StructField("month", T.LongType()),
        T.StructField("year", T.LongType()),
        T.StructField("day_of_year", T.LongType()),
        T.StructField("week_of_year", T.LongType()),
        T.StructField("is_weekend", T.LongType()),
        T.StructField("hour_sin", T.DoubleType()),
        T.StructField("hour_cos", T.DoubleType()),
    ]
)


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    """The frame itself, or a ValueError naming the columns it lacks. Starts no job."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def scan_events(spark: SparkSession, path: str, cols: list[str]) -> DataFrame:
    """Only the listed columns reach the scan; zone-less timestamps become UTC timestamps and NaN
    becomes null, which the aggregates leave out."""
    df = require(spark.read.parquet(path), cols).select(*cols)
    nan = F.lit(float("nan"))
    made = {c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"}
    made.update({c: F.nullif(F.col(c), nan.cast(t)) for c, t in df.dtypes if t in ("double", "float")})
    return df.withColumns(made) if made else df


def sample_range(
    df: DataFrame, lo, hi, n: int, key: str, time: str = "trip_start_timestamp"
) -> DataFrame:
    """The first n rows by unique key between two dates; the last day counts at midnight only."""
    inside = F.col(time).between(timestamp_literal(lo), timestamp_literal(hi))
    return first_rows(df.where(inside), key, n)


def sample_rows(df: DataFrame, cols: list[str], n: int, seed: int, key: str) -> DataFrame:
    """n rows chosen by a seeded hash of the unique key, rows with nulls dropped first.

    The same seed gives the same rows however the table is partitioned. The hash is even, so counting
    its first four digits tells which rows can be among the n; only those are sorted.
    """
    rows = df.dropna(subset=cols).select(key, *cols)
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    digits = F.substring("_place", 1, 4)
    placed = rows.withColumn("_place", place)
    counts = placed.groupBy(digits.alias("_digits")).agg(F.count(F.lit(1)).alias("_n"))
    so_far = F.sum("_n").over(Window.orderBy("_digits"))
    cut = counts.withColumn("_so_far", so_far).where(F.col("_so_far") >= n).select(F.min("_digits")).scalar()
    possible = placed.where(F.coalesce(digits <= cut, F.lit(True)))
    return possible.orderBy("_place", key).limit(n).drop("_place")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, time: str | None = None) -> DataFrame:
    """CSV whose header has to match the declared schema; ``time`` arrives as text and is parsed here."""
    declared = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == time else f.dataType) for f in schema]
    )
    rows = spark.read.schema(declared).csv(path, header=True, enforceSchema=False)
    return rows if time is None else rows.withColumn(time, F.to_timestamp(time))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_table(df: DataFrame, path_or_name: str, schema: T.StructType | None = None) -> None:
    """Replaces a table, cast to the schema if one is given. A folder (anything with a slash) is switched to the new
    rows once they are all there (``CommittedTable``); ``read_table`` reads it. Else it is a catalog table."""
    rows = df if schema is None else enforce_schema(df, schema)
    if "/" in path_or_name:
        CommittedTable(df.sparkSession, path_or_name).replace(rows)
    else:
        rows.write.mode("overwrite").saveAsTable(path_or_name)


def read_table(spark: SparkSession, path_or_name: str) -> DataFrame:
    """What ``write_table`` left there."""
    return CommittedTable(spark, path_or_name).read() if "/" in path_or_name else spark.table(path_or_name)


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The listed columns that exist, in schema order and type. A number with a fraction raises where the
    schema has an integer, when the rows are read."""
    return df.select(*[_as(df, f).alias(f.name) for f in schema if f.name in df.columns])


def _as(df: DataFrame, field: T.StructField):
    value, have = F.col(field.name), df.schema[field.name].dataType
    if isinstance(field.dataType, T.IntegralType) and isinstance(have, (T.FloatType, T.DoubleType, T.DecimalType)):
        broken = F.raise_error(F.concat(F.lit(f"{field.name} holds a fraction: "), value.cast("string")))
        return F.when(value != F.round(value), broken.cast(field.dataType)).otherwise(value.cast(field.dataType))
    return value.cast(field.dataType)


def narrow_numbers(df: DataFrame) -> DataFrame:
    """Floating columns that hold whole numbers and no null become 64-bit integers, the other
    numbers stay (or become) doubles. One pass decides for all columns at once."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType))]
    integral = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]
    whole = {}
    if floating:
        checks = [
            F.bool_and(F.coalesce(F.col(c) == F.round(F.col(c)), F.lit(False))).alias(c) for c in floating
        ]
        whole = df.agg(*checks).first().asDict()
    target = {c: "bigint" if whole[c] else "double" for c in floating}
    target.update({c: "bigint" for c in integral})
    return df.select(*[F.col(c).cast(target[c]) if c in target else F.col(c) for c in df.columns])


def append_missing(src: DataFrame, dst: DataFrame, key: list[str]) -> DataFrame:
    """The destination plus the source rows whose key it lacks, as one frame; ``CommittedTable.append_missing`` writes
    only the rows that are new."""
    return dst.unionByName(src.join(dst.select(*key), key, "left_anti").select(*dst.columns))
