"""Exact duplicates by progressive refinement: length, then a hash of the first characters, then a hash
of the whole text, which is compared only where length and beginning have company.

Built-in Spark expressions only. One scan counts lengths and beginnings, map-side; what more than one row has goes on.
Texts are never shuffled: ``duplicate_groups`` hashes the whole text of a row only if its length and beginning are among
those, and ``mark_duplicates``, which returns every text's hash, takes it once per row where the text is read. Later steps
move a few numbers and a hash per document. A group of equal texts, however large, is counted map-side, and the join
that brings a group's result back to its rows is the last step, so that adaptive execution can split it.

Defined results: a null text counts as empty; texts are equal when identical after lower-casing A-Z;
the row with the largest id of a group stays, and of rows that repeat that id one; a null id is smaller
than any other; very long texts are read whole; an empty table gives an empty result; columns other than id and text are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demand_engine.llm.common import lower_ascii, pick
from demand_engine.session import cut_lineage

PREFIX_CHARS = 64
#: Crowded lengths and beginnings up to this many are broadcast, after counting them.
BROADCAST_KEYS = 500_000


def normalised(text: Column) -> Column:
    return lower_ascii(F.coalesce(text, F.lit("")))


def full_hash(text: Column) -> Column:
    return F.sha2(F.encode(normalised(text), "UTF-8"), 256)


def _keyed(documents: DataFrame, prefix_chars: int) -> DataFrame:
    """``doc_id, text, n_bytes, prefix_hash``."""
    text = F.coalesce("text", F.lit(""))
    prefix = F.xxhash64(lower_ascii(F.substring(text, 1, prefix_chars)))
    return pick(documents, doc_id="doc_id", text="text").select(
        "doc_id", "text", F.octet_length(text).alias("n_bytes"), prefix.alias("prefix_hash")
    )


def crowded(documents: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """``n_bytes, prefix_hash`` of lengths and beginnings that more than one row has, as a written table. Lengths of one
    row go first; both counts come from one scan, and a hot key moves one row a task."""
    counts = _keyed(documents, prefix_chars).groupBy("n_bytes", "prefix_hash").agg(F.count(F.lit(1)).alias("_n"))
    by_length = counts.groupBy("n_bytes").agg(F.sum("_n").alias("_all")).where("_all > 1").select("n_bytes")
    # Beginnings are compared within lengths that more than one row has.
    return cut_lineage(counts.join(by_length, "n_bytes", "left_semi").where("_n > 1").drop("_n"), "crowded")


def _survivors(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose length and beginning are crowded."""
    small = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    return rows.join(small, ["n_bytes", "prefix_hash"], "left_semi")


def candidates(documents: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """``doc_id, n_bytes, prefix_hash`` of the rows whose length and beginning another row has too."""
    rows = _keyed(documents, prefix_chars).select("doc_id", "n_bytes", "prefix_hash")
    return _survivors(rows, crowded(documents, prefix_chars))


def _groups(hashed: DataFrame) -> DataFrame:
    """One row per group of at least two rows with one hash: ``text_sha256, keep`` (the largest of the rows' structs),
    ``group_size``."""
    groups = hashed.groupBy("text_sha256").agg(F.max("at").alias("keep"), F.count(F.lit(1)).alias("group_size"))
    return groups.where("group_size > 1")


def duplicate_groups(documents: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per group of at least two equal texts: ``text_sha256, keep_id`` (the largest id),
    ``group_size``. The whole text is read and hashed for candidates only."""
    survivors = _survivors(_keyed(documents, prefix_chars), crowded(documents, prefix_chars))
    hashed = survivors.select(F.struct("doc_id").alias("at"), full_hash(F.col("text")).alias("text_sha256"))
    return _groups(hashed).select("text_sha256", F.col("keep.doc_id").alias("keep_id"), "group_size")


def mark_duplicates(documents: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Per row ``doc_id, keep_id, group_size, kept, text_sha256``. Two scans: one for lengths and beginnings, one for the
    hash of every text, which the result has; hashes are compared within crowded lengths and beginnings only."""
    keys = crowded(documents, prefix_chars)
    slim = _keyed(documents, prefix_chars).select(
        "doc_id", "n_bytes", "prefix_hash", full_hash(F.col("text")).alias("text_sha256"), F.monotonically_increasing_id().alias("row")
    )
    rows = cut_lineage(slim, "hashed")
    hashed = _survivors(rows, keys).select(F.struct("doc_id", "row").alias("at"), "text_sha256")
    found = _groups(hashed).withColumnRenamed("text_sha256", "_hash")
    alone = F.col("group_size").isNull()
    return rows.join(found, F.col("text_sha256") == F.col("_hash"), "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep.row"))).alias("kept"),
        "text_sha256",
    )
