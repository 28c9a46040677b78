"""A corpus from raw documents: language, recurring lines, near copies, benchmark passages, source weights.

Each stage takes the documents that the one before kept and returns their columns; the last adds what the mix
takes of each. ``run`` writes every stage as Parquet to the shared folder and reads it again, so a lost
executor costs one stage at most; what a stage wrote on the way is deleted once its result is written.

Texts move as little as a stage's decision allows: language ID judges a row where it is read, decontamination and the
join drop the few rows that go by their keys, broadcast where a count says that they are few.

Defined results: a stage decides about rows. Rows that repeat an id are judged each by its own text in language
ID, line dedup, decontamination and the mix, and are one document in the join of near copies, which keeps one of
them; rows without an id are judged like others, except that the join keeps them as they are. A null text has no
language and goes in the first stage; texts are judged whole, however long; other columns, whatever their names, are
kept as they are up to the last stage, which returns its own; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demand_engine.llm import decontaminate, jaccard_join, langid, line_dedup, mixing
from demand_engine.llm.common import table, unused
from demand_engine.session import cut_lineage, scratch

#: Keys up to this many are broadcast, after counting them: some tens of MB.
BROADCAST_KEYS = 500_000


def _few(keys: DataFrame, purpose: str) -> DataFrame:
    """``keys`` as a written table, to be broadcast if it is small."""
    written = cut_lineage(keys, purpose)
    return F.broadcast(written) if written.count() <= BROADCAST_KEYS else written


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or that no learned language fits, go."""
    model = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))
    lang, score = unused(docs, "lang_pred", "score")
    judged = langid.judged(docs, model, lang, score)
    return judged.where((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= langid.MIN_SCORE)).drop(lang, score)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose template recurs across documents go; ``n_chars`` follows the text."""
    clashing = [c for c in docs.columns if c.lower() in ("n_lines", "n_dropped")]
    own = dict(zip(clashing, unused(docs, *(f"own_{c}" for c in clashing))))
    cleaned = line_dedup.drop_recurring_lines(docs.withColumnsRenamed(own)).drop("n_lines", "n_dropped")
    cleaned = cleaned.withColumnsRenamed({v: k for k, v in own.items()})
    return cleaned.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, the one with the smallest id stays, by one row; rows without id stay."""
    (key,) = unused(docs, "key")
    ids = docs.select(F.col("doc_id").alias(key)).where(F.col(key).isNotNull())
    classes = jaccard_join.similarity_classes(docs)
    gone = _few(classes.where("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct(), "similar")
    stay = docs.join(gone, F.col("doc_id") == F.col(key), "left_anti")
    repeated = _few(ids.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key), "repeated")
    if repeated.isEmpty():
        return stay
    # Of rows with one id the one that a hash of the text puts first.
    (rank,) = unused(docs, "rank")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    several = stay.join(repeated, F.col("doc_id") == F.col(key), "left_semi").withColumn(rank, F.row_number().over(first))
    single = stay.join(repeated, F.col("doc_id") == F.col(key), "left_anti")
    return single.unionByName(several.where(F.col(rank) == 1).drop(rank))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go. What is decided is a text, known by its MD5."""
    (key,) = unused(docs, "key")
    texts = docs.select(F.md5(F.col("text").cast("binary")).alias("doc_id"), "text")
    found = decontaminate.contamination(texts, table(spark, sf_dir, "benchmark"), id_type="string")
    gone = _few(found.where("contaminated").select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return docs.join(gone, F.md5(F.col("text").cast("binary")) == F.col(key), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document of the mix, how often it occurs whole, how many words of it once more, and how many that is."""
    mixed = mixing.mix(docs, table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "epochs", "part", "taken")


STAGES = [
    ("language_id", keep_known_language),
    ("line_dedup", drop_recurring_lines),
    ("ngram_jaccard_join", keep_one_of_similar),
    ("decontamination", keep_uncontaminated),
    ("mixing", mix_sources),
]

#: The first stage's decision is a learned model's, which SQL can't state; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch() as made:
            result = stage(spark, docs, sf_dir)
        with scratch() as kept:
            docs = cut_lineage(result, f"pipeline-{name}")
        made.delete(spark)
        if before is not None:
            before.delete(spark)
        before = kept
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
