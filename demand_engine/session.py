"""Session settings and the shared folder that written intermediate tables go to."""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """All timestamps are UTC; only this runtime setting is needed."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where that is unset, a folder below the
    session's warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return configured.rstrip("/")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared root, one per call."""
    return f"{shared_root(spark)}/demand_engine/{purpose}-{uuid.uuid4().hex}"


class Folders:
    """Folders of written intermediate tables."""

    def __init__(self):
        self.paths: list[str] = []

    def delete(self, spark: SparkSession) -> None:
        """Deletes them through the shared folder's file system. No table that reads them may be in use any more."""
        for path in self.paths:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
        self.paths.clear()


_made: contextvars.ContextVar[Folders | None] = contextvars.ContextVar("made", default=None)


@contextlib.contextmanager
def scratch() -> Iterator[Folders]:
    """Records the folders that ``cut_lineage`` writes inside, so that they can be deleted together later."""
    folders = Folders()
    before = _made.set(folders)
    try:
        yield folders
    finally:
        _made.reset(before)


def cut_lineage(df: DataFrame, purpose: str = "pieces") -> DataFrame:
    """The same rows as a table in the shared folder: lost executors cost nothing upstream, and all
    later readers see the same rows."""
    folder = shared_folder(df.sparkSession, purpose)
    if (made := _made.get()) is not None:
        made.paths.append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
