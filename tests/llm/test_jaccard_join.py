import random
import re
import string

import pytest

from demand_engine.llm import jaccard_join
from demand_engine.llm.components import components
from demand_engine.llm.jaccard_join import similarity_classes

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingle_set(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows):
    sets = [(k, shingle_set(t)) for k, t in rows]
    root = {k: k for k, _ in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if both and 100 * both >= 80 * (len(x) + len(y) - both):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {k: (len(s), find(k)) for k, s in sets}


def corpus(seed, n_base=40):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(400)]
    passage = " ".join(rng.choices(words, k=40))
    rows, doc = [], 0
    for _ in range(n_base):
        base = rng.choices(words, k=rng.choice([1, 3, 5, 7, 9, 11, 12, 13, 30, 60, 140, 400]))
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                i = rng.randrange(len(copy))
                if rng.random() < 0.5:
                    copy[i] = rng.choice(words)
                else:
                    del copy[i]
                    copy = copy or [rng.choice(words)]
            text = rng.choice([" ", "\n", "\t "]).join(copy)
            rows.append((doc, text.upper() if rng.random() < 0.2 else f"{passage} {text}" if rng.random() < 0.2 else text))
            doc += 1
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    got = similarity_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_coarse_bands_are_refined(spark, monkeypatch):
    # With one segment a document has one signature, too few from eight shingles on.
    real = jaccard_join.segments
    monkeypatch.setattr(jaccard_join, "segments", lambda band, level, per_cent: 1 if level == 0 else real(band, level, per_cent))
    rows = corpus(5, 20)
    got = similarity_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_large_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for k in range(300):
        copy = list(base)
        copy[rng.randrange(100)] = f"x{k}"
        rows.append((k, " ".join(copy)))
    seen = []
    real = jaccard_join.verified

    def counted(pairs, *a, **b):
        seen.append(pairs.count())
        return real(pairs, *a, **b)

    monkeypatch.setattr(jaccard_join, "verified", counted)
    got = similarity_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.component_id for r in got} == {0}
    assert sum(seen) < 10 * len(rows)


def test_edge_rows_and_clashing_columns(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (1, None, "x", 1, "c"), (2, "", "x", 1, "c"), (3, " \n\t", "x", 1, "c"), (4, "One two", "x", 1, "c"),
        (5, "one  TWO", "x", 1, "c"), (6, long, "x", 1, "c"), (7, long + " more", None, None, None),
        (8, "a b c d e f", "x", 1, "c"), (8, "a b c d e f", "x", 1, "c"), (9, "p q r s t", "x", 1, "c"),
        (9, "a b c d e f", "x", 1, "c"), (None, "a b c d e f", "x", 1, "c"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, sig string, s int, rep string")
    found = similarity_classes(df).collect()
    assert [(r.component_id, r.n_shingles) for r in found if r.doc_id is None] == [(None, 2)]
    got = sorted((r.doc_id, r.component_id, r.n_shingles) for r in found if r.doc_id is not None)
    assert [g[:2] for g in got] == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (7, 6), (8, 8), (8, 8), (9, 8), (9, 8)]
    assert [g[2] for g in got[:5]] == [0, 0, 0, 1, 1]
    assert similarity_classes(df.limit(0)).collect() == []


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(0, 60)] + [(100, 101), (5, 5)], "a bigint, b bigint")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}
