"""Event-time demand: hourly counts as a stream, and their zero-filled table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from demand_engine.functions.calendar import step_interval, timestamp_literal
from demand_engine.operators.demand import distinct_ids, fill_counts, grid
from demand_engine.sources.committed import CommitConflict, CommittedTable


def stream_hourly_demand(
    sdf: DataFrame,
    watermark: str = "2 hours",
    time: str = "trip_start_timestamp",
    id: str = "pickup_community_area",
    step: str = "hour",
    out_time: str = "timestamp_hour",
    target: str = "trip_count",
) -> DataFrame:
    """Rows per tumbling step and series. In append mode a step is emitted once, when the watermark
    has passed its end; the state holds open steps only."""
    counted = (
        sdf.where(F.col(id).isNotNull())
        .withColumn(time, F.col(time).cast("timestamp"))
        .withWatermark(time, watermark)
        .groupBy(F.window(time, f"1 {step}"), F.col(id))
        .agg(F.count(F.lit(1)).alias(target))
    )
    return counted.select(F.col("window.start").alias(out_time), id, target)


def write_closed_steps(counts: DataFrame, path: str, checkpoint: str) -> None:
    """Appends every closed step to a Parquet table, exactly once."""
    (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def write_running_counts(counts: DataFrame, path: str, checkpoint: str) -> None:
    """Writes the counts each batch changed, open steps included. One folder per batch, so a repeated
    batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_folder(path, batch_id))

    (
        counts.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def read_running_counts(
    spark: SparkSession, path: str, id: str = "pickup_community_area", out_time: str = "timestamp_hour",
    target: str = "trip_count",
) -> DataFrame:
    """The newest count per (step, series)."""
    rows = _read_batches(spark, *_live_batches(spark, path))
    return rows.groupBy(out_time, id).agg(F.max_by(target, "batch_id").alias(target))


def compact_running_counts(
    spark: SparkSession, path: str, id: str = "pickup_community_area", out_time: str = "timestamp_hour",
    target: str = "trip_count",
) -> None:
    """Puts the newest counts of all batches but the last into one folder, from which later reads start, so
    a read costs the number of steps and series, not the age of the stream. Call it between runs. The old
    folders may be deleted afterwards; nothing reads them any more."""
    compact, batches = _live_batches(spark, path)
    if len(batches) < 2:
        return
    upto = batches[-2][0]
    rows = _read_batches(spark, compact, batches[:-1])
    newest = rows.groupBy(out_time, id).agg(F.max_by(target, "batch_id").alias(target))
    newest.write.mode("overwrite").parquet(f"{path}/{_COMPACT}/batch_id={upto}")


_COMPACT = "_compact"


def _folders(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and path of the finished batch folders below a path, in order."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    found = []
    for status in files.listStatus(root):
        folder = status.getPath()
        name = folder.getName()
        if name.startswith("batch_id=") and files.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
            found.append((int(name.removeprefix("batch_id=")), folder.toString()))
    return sorted(found)


def _live_batches(spark: SparkSession, path: str) -> tuple[list[tuple[int, str]], list[tuple[int, str]]]:
    """The newest compacted folder, if there is one, and the batches after it."""
    compact = _folders(spark, f"{path}/{_COMPACT}")[-1:]
    start = compact[0][0] if compact else -1
    return compact, [(n, folder) for n, folder in _folders(spark, path) if n > start]


def _read_batches(spark: SparkSession, compact: list[tuple[int, str]], batches: list[tuple[int, str]]) -> DataFrame:
    """The rows of the folders with the number of their batch."""
    parts = [
        spark.read.option("basePath", folder.rpartition("/")[0]).parquet(*[f for _, f in found])
        for found in (compact, batches)
        if found
        for _, folder in found[:1]
    ]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def stream_filled_demand(
    counts: DataFrame,
    ids: DataFrame,
    path: str,
    checkpoint: str,
    id: str = "pickup_community_area",
    step: str = "hour",
    out_time: str = "timestamp_hour",
    target: str = "trip_count",
) -> None:
    """Writes every closed step for all known ids, 0 where nothing happened.

    Known are the given ids, those of the last written batch and those of the batch itself, so an id that
    first appears in the stream has rows from then on. Each batch covers the steps after the last one
    written up to its own last closed step, so hours without any event are filled too. Both are read from
    the newest earlier folder, whatever the age of the stream. A repeated batch finds the same one, because
    only earlier batches count, and replaces its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            first, last = batch.agg(F.min(out_time), F.max(out_time)).first()
            if last is None:
                return
            known = ids.select(id).union(batch.select(id))
            low = F.lit(first)
            earlier = [folder for n, folder in _folders(spark, path) if n < batch_id]
            if earlier:
                newest = spark.read.parquet(earlier[-1])
                known = known.union(newest.select(id))
                low = F.lit(newest.agg(F.max(out_time)).first()[0]) + step_interval(step)
            cells = grid(known, low.cast("timestamp"), F.lit(last).cast("timestamp"), id, step, out_time)
            filled = fill_counts(cells, batch, out_time, id, target)
            filled.write.mode("overwrite").parquet(_batch_folder(path, batch_id))
        finally:
            batch.unpersist()

    (
        counts.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def close_steps(
    spark: SparkSession,
    path: str,
    table: CommittedTable,
    now: datetime | str,
    delay: str = "2 hours",
    id: str = "pickup_community_area",
    step: str = "hour",
    out_time: str = "timestamp_hour",
    target: str = "trip_count",
) -> int:
    """Closes by the clock: appends to ``table`` every step that ended ``delay`` before ``now`` and isn't there yet, for all
    ids in the running counts at ``path`` (``write_running_counts``), 0 where nothing happened; how many steps.

    No later event is needed, and nothing but counted rows is read. A range of steps is one commit together with its
    last step, so a repeated or broken call closes each step exactly once. What is counted into a step after it was closed
    isn't added any more."""
    counts = read_running_counts(spark, path, id, out_time, target)
    mark = table.state()["mark"]
    start = counts.agg(F.min(out_time)) if mark is None else spark.range(1).select(timestamp_literal(mark) + step_interval(step))
    end = F.date_trunc(step, timestamp_literal(str(now)) - F.expr(f"interval {delay}")) - step_interval(step)
    first, last = start.toDF("first").select("first", end.alias("last")).select(F.date_format("first", _TIME), F.date_format("last", _TIME)).first()
    if first is None or first > last:
        return 0
    low, high = timestamp_literal(first), timestamp_literal(last)
    cells = grid(distinct_ids(counts, id), low, high, id, step, out_time)
    inside = counts.where(F.col(out_time).between(low, high))
    try:
        table.append(fill_counts(cells, inside, out_time, id, target), f"until {last}", mark=last)
    except CommitConflict:
        return 0  # another clock has closed them
    return spark.range(1).select(F.size(F.sequence(low, high, step_interval(step)))).first()[0]


_TIME = "yyyy-MM-dd HH:mm:ss"


def close_on_clock(
    spark: SparkSession, path: str, table: CommittedTable, checkpoint: str, every: str = "1 minute", delay: str = "2 hours", **columns: str
) -> StreamingQuery:
    """A stream of ticks of the clock that calls ``close_steps``: idle series close while no event comes. Stop the query
    to end it."""

    def tick(batch: DataFrame, batch_id: int) -> None:
        now = batch.agg(F.date_format(F.max("timestamp"), _TIME)).first()[0]
        if now is not None:
            close_steps(batch.sparkSession, path, table, now, delay, **columns)

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.writeStream.foreachBatch(tick).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
