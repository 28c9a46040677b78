"""Demand stored by series: bucketed by the series id and sorted by time, so that readers need no shuffle.

The table is a folder of Parquet files, one or more per bucket, and a line that says how it is laid out. ``read_series``
registers it in the session under a name made from the folder, as only a catalog table has buckets; every later window
over a series, or join and group by its id, then runs on the partitioning that the files have.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows that a bucket should hold.
BUCKET_ROWS = 5_000_000


def _file(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_layout.json")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _name(folder: str) -> str:
    return f"series_{hashlib.md5(folder.rstrip('/').encode()).hexdigest()}"


def buckets_for(rows: int, ids: int, rows_per_bucket: int = BUCKET_ROWS) -> int:
    """As many as the rows need, and no more than there are series."""
    return max(1, min(ids, -(-rows // rows_per_bucket)))


def write_series(
    df: DataFrame,
    folder: str,
    id: str = "pickup_community_area",
    time: str = "timestamp_hour",
    buckets: int | None = None,
) -> DataFrame:
    """Writes the rows to a new folder and returns the stored table. Without ``buckets`` one count decides: enough for the
    rows, at most one per series, so that a few series don't make hundreds of empty tasks."""
    spark, (layout, files) = df.sparkSession, _file(df.sparkSession, folder)
    if files.exists(layout):
        raise ValueError(f"{folder} holds a table already")
    if buckets is None:
        rows, ids = df.agg(F.count(F.lit(1)), F.approx_count_distinct(id)).first()
        cores = spark.sparkContext.defaultParallelism
        buckets = max(buckets_for(rows, ids), min(ids, cores), 1)
    spread = df.repartition(buckets, id).sortWithinPartitions(id, time)
    spread.write.format("parquet").bucketBy(buckets, id).sortBy(id, time).option("path", folder).saveAsTable(_name(folder))
    stream = files.create(layout, False)
    try:
        stream.write(bytearray(json.dumps({"id": id, "time": time, "buckets": buckets, "schema": df.schema.json()}).encode()))
    finally:
        stream.close()
    return spark.table(_name(folder))


def read_series(spark: SparkSession, folder: str) -> DataFrame:
    """The stored table with its layout, in any session."""
    if not spark.catalog.tableExists(_name(folder)):
        path, files = _file(spark, folder)
        stream = files.open(path)
        try:
            layout = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(layout["schema"])))
        spark.sql(
            f"CREATE TABLE {_name(folder)} ({columns}) USING parquet CLUSTERED BY (`{layout['id']}`) "
            f"SORTED BY (`{layout['id']}`, `{layout['time']}`) INTO {layout['buckets']} BUCKETS LOCATION '{folder}'"
        )
    return spark.table(_name(folder))
