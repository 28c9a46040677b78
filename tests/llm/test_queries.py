"""Queries without SQL against their brute-force versions, on whole tables."""

import base64
from collections import defaultdict

import numpy as np
import pytest
import tiktoken

from demand_engine.llm import queries, token_counts
from tests.llm.conftest import SF_DIR
from tests.oracle import compare, connect


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))


def test_token_counts_over_the_whole_table(spark):
    with open(token_counts.VOCABULARY) as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, lines)}
    encoding = tiktoken.Encoding("t", pat_str=token_counts.PATTERN, mergeable_ranks=ranks, special_tokens={})
    first, want = {}, defaultdict(lambda: [0, 0])
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    for r in rows:
        first[r.text] = min(r.doc_id, first.get(r.text, r.doc_id))
    for r in rows:
        if first[r.text] == r.doc_id:
            want[r.source, r.lang][0] += 1
            want[r.source, r.lang][1] += len(encoding.encode_ordinary(r.text))
    got = queries.QUERIES["op3_token_counts"](spark, SF_DIR).collect()
    assert {(r.source, r.lang): [r.n_docs, r.n_tokens] for r in got} == dict(want)


def test_held_out_toxicity(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    got = queries.QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1").where("held_out").collect()
    known = [(r.predicted, labels[r.doc_id]) for r in got if r.doc_id in labels]
    assert np.mean([p == t for p, t in known]) > 0.95
    assert np.mean([p for p, t in known if t]) > 0.9


@pytest.mark.parametrize("name", ["op7_line_dedup", "op10_mixing"])
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_sql_states_the_rule_at_every_size(spark, name, size):
    sf_dir = f"/root/testdata/{size}"
    assert compare(connect(sf_dir), queries.QUERIES[name](spark, sf_dir), queries.ORACLES[name]) == ""
