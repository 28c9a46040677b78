"""Resumable incremental copy of a growing Parquet table."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession


class _EnoughBatches(Exception):
    """Ends a run before the next batch writes anything."""


def incremental_copy(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    files_per_batch: int = 100,
    max_batches: int | None = None,
) -> int:
    """Copies the files of ``src`` (a folder or a path pattern) not copied yet, some per batch, and
    returns the number of batches written.

    A batch is a folder of ``dst`` with the batch's number, so a repeated batch replaces itself. The
    checkpoint knows what was copied: a second call copies only what is new, and a broken run goes on
    where it stopped, without losing or repeating rows. ``max_batches`` stops the call after exactly that
    many; the next one is refused before it writes and is the first of the next call.
    """
    written: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if max_batches is not None and len(written) >= max_batches:
            raise _EnoughBatches
        batch.write.mode("overwrite").parquet(f"{dst}/batch_id={batch_id}")
        written.append(batch_id)

    query = (
        spark.readStream.schema(spark.read.parquet(src).schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(src)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except StreamingQueryException as error:
        if _EnoughBatches.__name__ not in str(error):
            raise
    return len(written)


def read_copy(spark: SparkSession, dst: str) -> DataFrame:
    """The copied rows, without the number of their batch."""
    return spark.read.parquet(dst).drop("batch_id")
