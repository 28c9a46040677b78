"""The pipeline against a brute-force version of its stages, and the decisions of each stage."""

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from demand_engine.llm import langid, mixing, queries
from tests.llm.conftest import SF_DIR
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_jaccard_join import brute as brute_classes


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    stage = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard_join", "decontamination", "mixing"]

    known = stage["language_id"](spark, docs, SF_DIR)
    assert known.columns == docs.columns
    assert known.count() >= 0.99 * docs.count()
    model = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))
    judged = langid.predict(docs, model).collect()
    assert {r.doc_id for r in known.collect()} == {r.doc_id for r in judged if r.lang_pred != "und" and r.score >= langid.MIN_SCORE}
    lines = stage["line_dedup"](spark, known, SF_DIR)
    assert lines.columns == docs.columns
    want = by_sql(known, queries.LINE_DEDUP_SQL, "doc_id", "text")
    assert sorted((r.doc_id, r.text) for r in lines.collect()) == want
    assert lines.where("n_chars <> char_length(text)").count() == 0

    before = [(r.doc_id, r.text) for r in lines.collect()]
    one = stage["ngram_jaccard_join"](spark, lines, SF_DIR)
    kept = {k for k, (_, c) in brute_classes(before).items() if k == c}
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == kept

    clean = stage["decontamination"](spark, one, SF_DIR)
    hits = brute_hits([x for x in before if x[0] in kept], items)
    final = {k for k in kept if not hits[k][1]}
    assert {r.doc_id for r in clean.collect()} == final and final < kept

    mixed = stage["mixing"](spark, clean, SF_DIR).collect()
    assert {r.doc_id for r in mixed} == final
    assert all(r.epochs <= mixing.MAX_EPOCHS for r in mixed)
    assert sorted((r.doc_id, r.size, r.taken) for r in mixed) == by_sql(clean, queries.MIXING_SQL, "doc_id", "size", "taken")


def by_sql(documents, sql, *columns):
    """Rows of an operator's SQL over these documents instead of the given ones."""
    con = duckdb.connect()
    con.register("documents", documents.toArrow())
    con.sql(f"CREATE VIEW labels AS SELECT * FROM read_parquet('{SF_DIR}/labels.parquet')")
    return sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall())


def test_rejects_what_has_no_language(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(-1, "1234 !!", "en", "s", 7), (-2, None, None, None, None), (-3, "", "en", "s", 0)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.keep_known_language(spark, docs.union(odd), SF_DIR).collect()}
    assert not kept & {-1, -2, -3}
    assert langid.MIN_SCORE < 0.5


def test_stages_of_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0


def test_run(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.count() > 100 and {"doc_id", "taken"} <= set(got.columns)


def test_rows_without_id_and_with_one_id(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    clean = next(r for r in docs.orderBy("doc_id").collect() if len(r.text) > 500 and "1" not in r.text)
    item = max((r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()), key=len)

    def row(k, text):
        return (k, text, clean.lang, clean.source, len(text))

    def texts(stage, rows):
        got = dict(corpus_pipeline.STAGES)[stage](spark, spark.createDataFrame(rows, docs.schema), SF_DIR)
        assert got.columns == docs.columns
        return sorted((r.doc_id or 0, r.text) for r in got.collect())

    extra = [row(None, clean.text), row(-1, clean.text), row(-1, "1234 !!"), row(None, "1234 !!")]
    known = corpus_pipeline.keep_known_language(spark, docs.union(spark.createDataFrame(extra, docs.schema)), SF_DIR)
    got = [(r.doc_id, r.text) for r in known.where("doc_id is null or doc_id < 0").collect()]
    assert sorted(got, key=str) == sorted([(None, clean.text), (-1, clean.text)], key=str)

    rows = [row(5, clean.text), row(5, item), row(None, clean.text), row(None, item), row(6, item)]
    assert texts("decontamination", rows) == sorted([(5, clean.text), (0, clean.text)])

    rows = [row(5, clean.text), row(5, clean.text), row(6, clean.text), row(None, clean.text), row(None, clean.text)]
    assert texts("ngram_jaccard_join", rows) == [(0, clean.text), (0, clean.text), (5, clean.text)]


def test_intermediate_tables_are_deleted(spark):
    from demand_engine.session import shared_root

    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/demand_engine")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def there():
        return {s.getPath().getName() for s in files.listStatus(path)} if files.exists(path) else set()

    before = there()
    got = corpus_pipeline.run(spark, SF_DIR)
    left = {name.rsplit("-", 1)[0] for name in there() - before}
    assert left == {"pipeline-mixing"} and got.count() > 100


def test_clashing_columns_and_very_long_texts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40)
    names = ["key", "rank", "row", "n_lines", "n_dropped", "lang_pred", "score", "_own_n_lines"]
    long = docs.limit(1).select(F.lit(-5).cast("bigint").alias("doc_id"), F.expr("repeat('this is a very long text of plain words ', 20000)").alias("text"), "lang", "source", "n_chars")
    wide = docs.unionByName(long).withColumns({n: F.lit(n) for n in names})
    for name, stage in corpus_pipeline.STAGES[:4]:
        plain, out = stage(spark, docs.unionByName(long), SF_DIR), stage(spark, wide, SF_DIR)
        assert out.columns == wide.columns
        rows = out.collect()
        assert {(r.doc_id, r.text) for r in rows} == {(r.doc_id, r.text) for r in plain.collect()}
        assert all(r[n] == n for r in rows for n in names)
