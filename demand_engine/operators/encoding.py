"""Exact encoding of any number of ids: a distributed dictionary, and sparse one-hot vectors over it."""

from __future__ import annotations

import re

from pyspark.ml.feature import OneHotEncoder, SQLTransformer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demand_engine.session import cut_lineage

#: Pieces that the values are numbered in, each by itself.
PIECES = 4096


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """``value, slot``, as a written table: every distinct value as text and a number of its own, 0 to n - 1 without a
    gap. Nulls have none.

    Values are dealt into pieces by a hash and numbered in order within their piece; the pieces' sizes, PIECES numbers at
    most, give where each begins. So no value reaches the driver and no task sorts more than its pieces."""
    values = df.select(F.col(f"`{column}`").cast("string").alias("value")).where("value is not null").distinct()
    placed = values.withColumn("_piece", F.pmod(F.xxhash64("value"), F.lit(PIECES)))
    sizes = placed.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("_piece").alias("_of"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    ordered = Window.partitionBy("_piece").orderBy("value")
    # At most a row per piece.
    met = placed.withColumn("_at", F.row_number().over(ordered) - 1).join(F.broadcast(starts), F.col("_piece") == F.col("_of"))
    return cut_lineage(met.select("value", (F.col("_start") + F.col("_at")).cast("bigint").alias("slot")), "dictionary")


def slots(df: DataFrame, column: str, known: DataFrame, name: str) -> DataFrame:
    """``df`` with the slot of the column's value as ``name``; null where the dictionary doesn't have it."""
    renamed = known.select(F.col("value").alias("_value"), F.col("slot").alias(name))
    return df.join(renamed, F.col(f"`{column}`").cast("string") == F.col("_value"), "left").drop("_value")


_LOOK_UP = "SELECT t.*, coalesce(d.slot, {n}) AS `{slot}` FROM __THIS__ t LEFT JOIN parquet.`{path}` d ON CAST(t.`{column}` AS STRING) = d.value"
_PARTS = re.compile(r"coalesce\(d\.slot, (\d+)\) AS `(.*?)` FROM __THIS__ t LEFT JOIN parquet\.`(.*?)` d ON CAST\(t\.`(.*?)` AS")


def look_up_stage(column: str, slot: str, path: str, n: int) -> SQLTransformer:
    """A stage of a model that joins the dictionary at ``path``, of ``n`` values. Unknown values get the slot n."""
    return SQLTransformer(statement=_LOOK_UP.format(n=n, slot=slot, path=path, column=column))


def look_up_parts(stage: SQLTransformer) -> tuple[str, str, str, int]:
    """``column, slot, path, n`` of a stage of ``look_up_stage``."""
    n, slot, path, column = _PARTS.search(stage.getStatement()).groups()
    return column, slot, path, int(n)


def one_hot_stages(df: DataFrame, column: str) -> list:
    """Stages that turn a column into a sparse vector ``<column>_hot`` with a slot for each of its values in ``df`` and
    one for all others."""
    known = dictionary(df, column)
    n, spark = known.count(), df.sparkSession
    path, slot = known.inputFiles()[0].rpartition("/")[0] if n else None, f"{column}_slot"
    if path is None:
        raise ValueError(f"{column} has no value")
    # The encoder learns the number of slots from the largest one, and nothing else.
    largest = spark.range(n, n + 1).select(F.col("id").cast("double").alias(slot))
    encoder = OneHotEncoder(inputCol=slot, outputCol=f"{column}_hot", dropLast=False, handleInvalid="error")
    return [look_up_stage(column, slot, path, n), encoder.fit(largest)]


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, slot bigint").parquet(path)
