"""What several operators share: batch size of Python stages, column helpers, digests as SQL columns."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a Python stage gets at a time; long texts make larger rows, so this stays small.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_ROWS rows from now on; the size of a batch is what bounds a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else. For pure ASCII that is what lower() does, at a fraction of the time."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names the operator uses: extra columns, whatever their names,
    never reach its joins."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of df is called that."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
