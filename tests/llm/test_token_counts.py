import base64
import random
import re
from collections import defaultdict

import pytest
import tiktoken

from pyspark.sql import functions as F

from demand_engine.llm import token_counts
from demand_engine.llm.token_counts import CHANGE, Rollup
from demand_engine.session import shared_folder


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}


@pytest.mark.parametrize("rows_per_bucket", [20, 1000])
def test_batches_equal_a_replayed_log(spark, rows_per_bucket):
    rng = random.Random(0)
    rollup, state = Rollup(spark, shared_folder(spark, "test-rollup"), rows_per_bucket=rows_per_bucket), {}
    for b in range(4):
        rows = []
        for seq in range(60):
            doc, op = rng.randrange(40), rng.choice(["insert", "insert", "revise", "delete"])
            source, lang, tokenizer = rng.choice(["a", "b", None]), rng.choice(["en", None]), rng.choice(["t1", "t2"])
            tokens = rng.randint(0, 50)
            rows.append((doc, source, lang, tokenizer, op, tokens, seq))
            state.pop((doc, tokenizer), None)
            if op != "delete":
                state[doc, tokenizer] = (source, lang, tokenizer, tokens)
        df = spark.createDataFrame(rows, CHANGE)
        assert rollup.apply(f"b{b}", df)
        assert not rollup.apply(f"b{b}", df)
        want = defaultdict(lambda: [0, 0])
        for source, lang, tokenizer, tokens in state.values():
            want[source, lang, tokenizer][0] += 1
            want[source, lang, tokenizer][1] += tokens
        assert totals(rollup) == {k: tuple(v) for k, v in want.items()}
        if b == 2:
            before = totals(rollup)
            rollup.compact()
            assert totals(rollup) == before and len(rollup.committed()) == 1
            assert not rollup.apply("b0", df)
    assert sum(t[0] for t in totals(rollup).values()) == rollup.ledger().count()


def test_a_small_batch_reads_few_folders_of_the_ledger(spark):
    rollup = Rollup(spark, shared_folder(spark, "test-rollup"), rows_per_bucket=10)
    many = [(k, "a", "en", "t", "insert", 1, 0) for k in range(320)]
    rollup.apply("many", spark.createDataFrame(many, CHANGE))
    rollup.apply("few", spark.createDataFrame([(k, "a", "en", "t", "insert", 1, 0) for k in range(320, 323)], CHANGE))
    one = spark.createDataFrame([(7, "b", "en", "t", "revise", 5, 0)], CHANGE)
    _, n, touched = rollup._staged("one", one)
    assert (n, len(touched)) == (1, 1)
    assert rollup._ledger_rows().select(F.input_file_name()).distinct().count() > 25
    some = rollup._ledger_rows(touched).select(F.input_file_name())
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", some._jdf.queryExecution().toString())
    assert some.distinct().count() <= 2
    assert rollup.ledger(touched).where("doc_id = 7").count() == 1
    rollup.apply("one", one)
    assert totals(rollup) == {("a", "en", "t"): (322, 322), ("b", "en", "t"): (1, 5)}
    assert not rollup._exists(f"{rollup.folder}/staged/one")


def test_generations_of_commits(spark):
    rollup = Rollup(spark, shared_folder(spark, "test-rollup"))
    for k in range(3):
        rollup.apply(f"b{k}", spark.createDataFrame([(k, "a", "en", "t", "insert", k, 0)], CHANGE))
    assert rollup.compact() == "compacted-1" and rollup.committed() == ["compacted-1"]
    assert rollup.compact() is None
    rollup.apply("b3", spark.createDataFrame([(0, "a", "en", "t", "delete", None, 0)], CHANGE))
    assert rollup.compact() == "compacted-2" and rollup.committed() == ["compacted-2"]
    again = spark.createDataFrame([(0, "a", "en", "t", "insert", 9, 0)], CHANGE)
    assert not any(rollup.apply(f"b{k}", again) for k in range(4))
    # A compaction that broke before its commit isn't read.
    rollup.ledger().withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{rollup.folder}/ledger/batch=compacted-3")
    spark.range(0).write.parquet(f"{rollup.folder}/commits/3/b9")
    assert totals(rollup) == {("a", "en", "t"): (2, 3)}


def test_an_attempt_without_commit_is_not_read(spark):
    rollup = Rollup(spark, shared_folder(spark, "test-rollup"))
    one = spark.createDataFrame([(1, "a", "en", "t", "insert", 5, 0)], CHANGE)
    rollup.apply("b0", one)
    one.selectExpr("doc_id", "source", "lang", "tokenizer", "1L as docs", "tokens", "0 as bucket").write.partitionBy("bucket").parquet(f"{rollup.folder}/ledger/batch=b1")
    assert totals(rollup) == {("a", "en", "t"): (1, 5)}
    two = spark.createDataFrame([(2, "a", "en", "t", "insert", 7, 0)], CHANGE)
    assert rollup.apply("b1", two)
    assert totals(rollup) == {("a", "en", "t"): (2, 12)}


def test_edge_rows(spark):
    rollup = Rollup(spark, shared_folder(spark, "test-rollup"))
    assert rollup.apply("empty", spark.createDataFrame([], CHANGE))
    assert totals(rollup) == {}
    rows = [(None, None, None, "t", "insert", 3, 0), (None, None, None, "t", "insert", 3, 0), (1, "a", None, None, "insert", None, 0), (9, "a", "en", "t", "delete", 4, 0), (8, "a", "en", "t", "revise", 4, 0)]
    df = spark.createDataFrame(rows, CHANGE).selectExpr("*", "'x' as docs", "1 as _doc2")
    rollup.apply("b", df)
    nameless = [(None, None, None, "t", "delete", 3, 1), (None, None, None, "t", "revise", 3, 1), (None, None, None, "t", "insert", None, 0)]
    want = {(None, None, "t"): (2, 6), ("a", None, None): (1, 0), ("a", "en", "t"): (1, 4)}
    assert totals(rollup) == want
    rollup.apply("nameless", spark.createDataFrame(nameless, CHANGE))
    rollup.compact()
    assert totals(rollup) == want | {(None, None, "t"): (3, 6)}


def test_counts_equal_the_tokenizer(spark):
    with open(token_counts.VOCABULARY) as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, lines)}
    encoding = tiktoken.Encoding("t", pat_str=token_counts.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [None, "", "Hello, world!", "<|endoftext|>", "é" * 5000, "word " * 50_000]
    rows = [(k, t, "s", None, "clash") for k, t in enumerate(texts)] + [(None, "x", None, "en", "c")]
    got = token_counts.count_tokens(spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, tokens string")).collect()
    assert {r.doc_id: r.tokens for r in got} == {r[0]: len(encoding.encode_ordinary(r[1] or "")) for r in rows}
