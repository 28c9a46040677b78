"""Token counts per source, language and tokenizer version, kept current by signed deltas.

A batch of changes has rows ``doc_id, source, lang, tokenizer, op, tokens, seq`` with op insert, revise or delete.
Against the ledger (what each document counts for now) a change becomes signed rows: an insert adds, a delete takes
back what was added, a revision does both, also when source or language change. The rollup gets the batch's sums
of them, so totals are sums over committed batches, and a reader never counts documents again.

The ledger of a batch lies in folders by a hash of the document's id, in a power of two of them that follows its rows,
so a later batch reads only the folders that its own ids can lie in: a small batch reads a small part of a long
history. ``compact`` replaces the committed batches by one and starts a new generation of commits; readers list only
the newest generation.

Commits are idempotent. A batch's ledger and rollup folders carry its id and are overwritten by a repeated
attempt; its commit file is written last, and only committed batches are read. A batch that is delivered again, also
one that a compaction has replaced, changes nothing. One writer at a time.

Inserting a document that is there already revises it; deleting or revising an unknown one: nothing, or an insert.

Everything is distributed: counts are made where the text is read, text is never shuffled, sums are pre-aggregated,
so a source with a third of all rows is no hot key. The driver reads the commits since the last compaction and the
numbers of the folders that a batch touches (MOST_BUCKETS at most).

Defined results: a null text has no tokens and counts as a document; source and language may be null; of several
changes to a document in one batch the last by ``seq`` holds, then the one with the most tokens; each insert without
a document id is a document of its own, while a deletion or revision without one names no document and changes
nothing; an empty batch commits and changes nothing; other columns are ignored.
"""

from __future__ import annotations

import base64
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demand_engine.llm.common import pick, small_batches
from demand_engine.session import Folders

#: Where the tokenizer's vocabulary lies on every executor, as ranks; and what cuts texts into pieces for it.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
VERSION = "byte_bpe_50k"
#: Fixed value: the pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEYS = ["source", "lang", "tokenizer"]
CHANGE = "doc_id bigint, source string, lang string, tokenizer string, op string, tokens bigint, seq bigint"
LEDGER = "doc_id bigint, source string, lang string, tokenizer string, docs bigint, tokens bigint, bucket int"
ROLLUP = "source string, lang string, tokenizer string, docs bigint, tokens bigint"
#: Rows of a batch's ledger that share a folder, and the most folders a batch has; a power of two.
ROWS_PER_BUCKET = 1_000_000
MOST_BUCKETS = 4096


def _counter(vocabulary: str, pattern: str):
    def run(batches):
        import tiktoken

        with open(vocabulary) as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, lines)}
        encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        at = None
        for batch in batches:
            at = at if at is not None else batch.schema.get_field_index("text")
            n = [len(encoding.encode_ordinary(t.as_py() or "")) for t in batch.column(at)]
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [f for i, f in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64())], names=[*names, "tokens"])

    return run


def count_tokens(documents: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Per row ``doc_id, source, lang, tokens``: the tokens of the whole text."""
    small_batches(documents.sparkSession)
    rows = pick(documents, doc_id="doc_id", source="source", lang="lang", text="text")
    return rows.withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(
        _counter(vocabulary, pattern), "doc_id bigint, source string, lang string, tokens bigint"
    )


class Rollup:
    """The ledger, rollup and commits below one folder."""

    def __init__(self, spark: SparkSession, folder: str, rows_per_bucket: int = ROWS_PER_BUCKET):
        self.spark, self.folder, self.rows_per_bucket = spark, folder.rstrip("/"), rows_per_bucket

    def _hadoop(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def _exists(self, path: str) -> bool:
        files, hadoop = self._hadoop(path)
        return files.exists(hadoop)

    def _generations(self) -> list[int]:
        """Numbers of the generations of commits, the newest last. All but the first begin with a compaction, and
        count once that is committed."""
        files, hadoop = self._hadoop(f"{self.folder}/commits")
        if not files.exists(hadoop):
            return []
        numbers = sorted(int(f.getPath().getName()) for f in files.listStatus(hadoop))
        return [g for g in numbers if g == 0 or self._exists(f"{self._commits(g)}/{_compacted(g)}/_SUCCESS")]

    def _commits(self, generation: int) -> str:
        return f"{self.folder}/commits/{generation}"

    def _current(self) -> dict[str, int]:
        """The committed batches that no compaction has replaced, and how many folders the ledger of each has."""
        generations = self._generations()
        if not generations:
            return {}
        rows = self.spark.read.schema("batch string, buckets int").parquet(f"{self._commits(generations[-1])}/*").collect()
        return {r.batch: r.buckets for r in sorted(rows)}

    def committed(self) -> list[str]:
        """Ids of committed batches that no compaction has replaced."""
        return list(self._current())

    def _was_committed(self, batch: str) -> bool:
        return batch in self._current() or any(
            self._exists(f"{self._commits(g)}/{batch}/_SUCCESS") for g in self._generations()
        )

    def _ledger_rows(self, touched: list[int] | None = None) -> DataFrame:
        """The signed rows of the committed batches; with ``touched``, numbers of folders out of MOST_BUCKETS, only
        from the folders that these ids can lie in."""
        by_buckets: dict[int, list[str]] = {}
        for batch, buckets in self._current().items():
            by_buckets.setdefault(buckets, []).append(self._ledger_path(batch))
        parts = []
        for buckets, paths in sorted(by_buckets.items()):
            part = self._read_ledger(*paths)
            if touched is not None:
                part = part.where(F.col("bucket").isin(sorted({t % buckets for t in touched})))
            parts.append(part)
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], LEDGER)

    def _ledger_path(self, batch: str) -> str:
        return f"{self.folder}/ledger/batch={batch}"

    def _read_ledger(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(LEDGER).option("basePath", f"{self.folder}/ledger").parquet(*paths).drop("batch")

    def ledger(self, touched: list[int] | None = None) -> DataFrame:
        """What each document counts for: ``doc_id, source, lang, tokenizer, docs, tokens``; ``docs`` is 1, but for
        the documents without id, which are one row for each group."""
        return (
            self._ledger_rows(touched)
            .groupBy("doc_id", *KEYS)
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .where("docs > 0")
        )

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens``; groups without a document are left out."""
        paths = [f"{self.folder}/rollup/{b}" for b in self.committed()]
        rows = self.spark.read.schema(ROLLUP).parquet(*paths) if paths else self.spark.createDataFrame([], ROLLUP)
        return (
            rows.groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens")).where("n_docs <> 0")
        )

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commits a batch of changes; False if it was committed before."""
        if self._was_committed(batch):
            return False
        wanted, n, touched = self._staged(batch, changes)
        nameless = (
            wanted.where("doc_id is null")
            .groupBy("doc_id", *KEYS)
            .agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
        )
        now = self.ledger(touched).where("doc_id is not null").select(
            F.col("doc_id").alias("_doc"), F.col("tokenizer").alias("_tokenizer"), F.col("source").alias("_source"),
            F.col("lang").alias("_lang"), F.col("tokens").alias("_tokens"),
        )
        met = wanted.where("doc_id is not null").join(
            now, (F.col("doc_id") == F.col("_doc")) & F.col("tokenizer").eqNullSafe(F.col("_tokenizer")), "left"
        )
        there, stays = F.col("_tokens").isNotNull(), F.col("op") != "delete"
        tokens = F.coalesce("tokens", F.lit(0).cast("bigint"))
        minus = _signed("_source", "_lang", -1, -F.col("_tokens"))
        plus = _signed("source", "lang", 1, tokens)
        moved = _signed("source", "lang", 0, tokens - F.col("_tokens"))
        same = there & stays & F.col("source").eqNullSafe(F.col("_source")) & F.col("lang").eqNullSafe(F.col("_lang"))
        signed = F.when(same, F.array(moved)).otherwise(
            F.filter(F.array(F.when(there, minus), F.when(stays, plus)), lambda x: x.isNotNull())
        )
        rows = (
            met.select("doc_id", "tokenizer", F.explode(signed).alias("d"))
            .select("doc_id", "tokenizer", "d.*")
            .where("docs <> 0 or tokens <> 0")
        )
        self._commit(max(self._generations(), default=0), batch, rows.unionByName(nameless), n)
        self._staging(batch).delete(self.spark)
        return True

    def _staging(self, batch: str) -> Folders:
        folders = Folders()
        folders.paths.append(f"{self.folder}/staged/{batch}")
        return folders

    def _staged(self, batch: str, changes: DataFrame) -> tuple[DataFrame, int, list[int]]:
        """The changes that hold, written; how many they are; and the folders, out of MOST_BUCKETS, of their ids."""
        rows = changes.select(*[F.col(f"`{f}`") for f in ("doc_id", *KEYS, "op", "tokens", "seq")])
        last = Window.partitionBy("doc_id", "tokenizer").orderBy(
            F.desc("seq"), F.desc_nulls_last("tokens"), "op", "source", "lang"
        )
        named = rows.where("doc_id is not null").withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
        path = self._staging(batch).paths[0]
        named.unionByName(rows.where("doc_id is null and op = 'insert'")).write.mode("overwrite").parquet(path)
        wanted = self.spark.read.schema(CHANGE).parquet(path)
        found = wanted.agg(
            F.count("doc_id").alias("n"), F.collect_set(F.when(F.col("doc_id").isNotNull(), _bucket(MOST_BUCKETS))).alias("touched")
        ).first()
        return wanted, found.n, found.touched

    def _commit(self, generation: int, batch: str, rows: DataFrame, n: int) -> None:
        """Writes the ledger of about ``n`` rows by folder, its sums, and last the commit."""
        buckets = 1
        while buckets < MOST_BUCKETS and buckets * self.rows_per_bucket < n:
            buckets *= 2
        path = self._ledger_path(batch)
        rows.withColumn("bucket", _bucket(buckets)).repartition(buckets, "bucket").sortWithinPartitions(
            "bucket", "doc_id"
        ).write.mode("overwrite").partitionBy("bucket").parquet(path)
        sums = self._read_ledger(path).groupBy(*KEYS).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        )
        sums.write.mode("overwrite").parquet(f"{self.folder}/rollup/{batch}")
        self.spark.createDataFrame([(batch, buckets)], "batch string, buckets int").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self._commits(generation)}/{batch}")

    def compact(self) -> str | None:
        """Replaces the committed batches by one with the same totals. Their ids stay known, so a batch that is
        delivered again still changes nothing."""
        if len(self.committed()) < 2:
            return None
        generation = self._generations()[-1] + 1
        batch = _compacted(generation)
        n = self.totals().agg(F.sum("n_docs").alias("n")).first().n or 0
        self._commit(generation, batch, self.ledger(), n)
        return batch


def _compacted(generation: int) -> str:
    return f"compacted-{generation}"


def _bucket(n: int):
    """The folder of an id out of n. For powers of two the folder out of fewer is the remainder of this one."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int")


def _signed(source: str, lang: str, docs: int, tokens):
    return F.struct(
        F.col(source).alias("source"), F.col(lang).alias("lang"), F.lit(docs).cast("bigint").alias("docs"), tokens.alias("tokens")
    )
