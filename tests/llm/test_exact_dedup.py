import hashlib
import random
from collections import Counter, defaultdict

import pytest

from demand_engine.llm import exact_dedup
from demand_engine.llm.exact_dedup import candidates, duplicate_groups, mark_duplicates

SCHEMA = "doc_id bigint, text string, n_bytes string, text_sha256 string"


def test_groups_by_lower_ascii_text(spark):
    long = "x" * 200
    rows = [
        (1, "Abc", None, None),
        (5, "aBC", None, None),
        (2, "abd", None, None),
        (3, None, "a", "b"),
        (4, "", "a", "b"),
        (6, long + "a", None, None),
        (7, long + "b", None, None),
        (8, "É", None, None),
        (9, "é", None, None),
    ]
    got = {r.doc_id: r for r in mark_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    assert {k: (r.keep_id, r.group_size, r.kept) for k, r in got.items()} == {
        1: (5, 2, False), 5: (5, 2, True), 2: (2, 1, True), 3: (4, 2, False), 4: (4, 2, True),
        6: (6, 1, True), 7: (7, 1, True), 8: (8, 1, True), 9: (9, 1, True),
    }
    assert got[1].text_sha256 == hashlib.sha256(b"abc").hexdigest()
    assert got[3].text_sha256 == hashlib.sha256(b"").hexdigest()


def test_full_text_is_read_for_candidates_only(spark):
    rows = [(1, "same start, one"), (2, "same start, two"), (3, "longer than the others"), (4, "other start one")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id for r in candidates(df, prefix_chars=4).collect()} == {1, 2}


def test_repeated_rows_keep_one(spark):
    df = spark.createDataFrame([(1, "a")] * 3 + [(None, "a"), (None, "z")], "doc_id bigint, text string")
    got = mark_duplicates(df).collect()
    assert sorted((r.doc_id or 0, r.kept, r.group_size) for r in got) == [
        (0, False, 4), (0, True, 1), (1, False, 4), (1, False, 4), (1, True, 4),
    ]


def test_empty(spark):
    assert mark_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_a_text_on_a_third_of_the_rows_and_very_long_texts(spark, monkeypatch, broadcast):
    """Against brute force, with the crowded keys broadcast and joined."""
    monkeypatch.setattr(exact_dedup, "BROADCAST_KEYS", broadcast)
    rng = random.Random(4)
    long = "Long " * 200_000
    texts = ["Hot text"] * 200 + [rng.choice("ab") * rng.randint(1, 40) for _ in range(300)] + [long, long.upper(), long + "x", long + "y"] * 2
    rng.shuffle(texts)
    rows = [(rng.randint(0, 400), t) for t in texts]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    groups = defaultdict(list)
    for i, t in rows:
        groups[t.lower()].append(i)
    got = mark_duplicates(df).collect()
    want = Counter((i, max(groups[t.lower()]), len(groups[t.lower()]), hashlib.sha256(t.lower().encode()).hexdigest()) for i, t in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    several = {r.text_sha256: (r.keep_id, r.group_size) for r in duplicate_groups(df).collect()}
    assert several == {hashlib.sha256(t.encode()).hexdigest(): (max(ids), len(ids)) for t, ids in groups.items() if len(ids) > 1}


def test_documents_are_scanned_twice_and_texts_not_shuffled(spark, capsys):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    mark_duplicates(documents).explain()
    plan = capsys.readouterr().out
    assert "documents.parquet" not in plan and "Window" not in plan
