import random
from collections import Counter

import numpy as np
import pytest

from demand_engine.llm import spelling


def near(a, b):
    """By the definition: every single edit of a, compared with b."""
    if a == b:
        return False
    cut = lambda w: {w[:i] + w[i + 1 :] for i in range(len(w))}
    return b in cut(a) or a in cut(b) or len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1


def expected(counts, factor=spelling.FACTOR):
    form, out = {}, {}
    for w, n in counts.items():
        around = [x for x in counts if near(w, x)]
        best = min(around, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= factor * n else None
        out[w] = (n, len(around))
    roots = {}
    for w in counts:
        end = w
        while form[end] is not None:
            end = form[end]
        roots[w] = end
    return {w: (form[w], roots[w], *out[w], counts[form[w]] if form[w] else None) for w in counts}


def words_of(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choice("aeinrtxyzéßþ×") for _ in range(rng.randint(6, 9))) for _ in range(n)]
    found = Counter()
    for w in base:
        found[w] += rng.choice([1, 3, 40, 900])
        for _ in range(4):
            i = rng.randrange(len(w))
            v = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("aeé") + w[i:], w[:i] + rng.choice("tz") + w[i + 1 :]])
            found[v] += rng.choice([1, 2, 5, 40])
    return dict(found)


@pytest.mark.parametrize("shard_words,block_words", [(spelling.SHARD_WORDS, spelling.BLOCK_WORDS), (40, 90)])
def test_against_brute_force(spark, shard_words, block_words):
    counts = words_of(1, 60)
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = spelling.group_variants(df, shard_words=shard_words, block_words=block_words).collect()
    assert len(got) == len(counts)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == expected(counts)


def test_shards_are_bounded_and_hold_each_word_once(spark):
    counts = words_of(2, 40)
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    members, searchers = spelling.shards(words, 30)
    rows = members.collect()
    assert Counter(r.word for r in rows) == Counter(counts.keys())
    sizes = Counter(tuple(r.node) for r in rows)
    assert len({len(node) for node in sizes}) > 1
    assert all(n <= 30 for node, n in sizes.items() if len(node) < len(spelling.LEVELS))
    own = {r.word: tuple(r.node) for r in rows}
    reached = {(r.word, tuple(r.node)) for r in searchers.collect()}
    assert all((a, own[b]) in reached for a in counts for b in counts if a == b or near(a, b))


def test_same_vector_beyond_the_last_level(spark):
    """Anagrams can't be told apart by counts: they stay together in a shard above its size."""
    words = ["".join(p) for p in ("abcdefg", "abcdegf", "bacdefg", "gfedcba", "abcdefh")]
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n bigint")
    got = {r.word: r.n_near for r in spelling.group_variants(df, shard_words=1).collect()}
    assert got == {"abcdefg": 1, "abcdegf": 0, "bacdefg": 0, "gfedcba": 0, "abcdefh": 1}


def test_levels_cover_the_alphabet():
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]
    assert sorted("".join(spelling.LEVELS)) == letters


def test_trie_finds_all_within_budget():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 3, (400, len(spelling.LEVELS)))
    counts[:, 6:] = 0
    found = Counter()
    for q, m in spelling.Trie(counts).search(counts):
        found.update(zip(q.tolist(), m.tolist()))
    apart = counts[None] - counts[:, None]
    want = (np.maximum(apart, 0).sum(2) <= 1) & (np.minimum(apart, 0).sum(2) >= -1)
    assert found == Counter(zip(*(x.tolist() for x in np.nonzero(want))))


def test_one_of_two_near_words_searches(spark):
    """Half the searchers, every pair from one side, and the trie agrees with the shards about which."""
    counts = words_of(4, 60)
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    both = {(r.word, tuple(r.node)) for r in spelling.shards(words, 30)[1].collect()}
    members, searchers = (rows.collect() for rows in spelling.shards(words, 30, one_way=True))
    once = {(r.word, tuple(r.node)) for r in searchers}
    assert once < both and len(once) < 0.7 * len(both)
    own = {r.word: tuple(r.node) for r in members}
    names = sorted(counts)
    vectors = spelling._vectors([w.encode("latin-1") for w in names])
    found = Counter()
    for q, m in spelling.Trie(vectors).search(vectors, one_way=True):
        found.update((names[a], names[b]) for a, b in zip(q.tolist(), m.tolist()))
    assert max(found.values()) == 1 and all((a, own[b]) in once for a, b in found)
    vector = {w: v.tolist() for w, v in zip(names, vectors)}
    pairs = [(a, b) for a in names for b in names if a < b and near(a, b)]
    assert len(pairs) > 50
    for a, b in pairs:
        assert found[a, b] + found[b, a] == (2 if vector[a] == vector[b] else 1)


def test_runs_and_odd_inputs(spark):
    long = "z" * 5000
    rows = [
        (1, "Straße ÉCLAIRS x1234567 Qwertyuiop-asdfghj", "a"), (None, "qwertyuiop", "b"), (1, None, "c"), (2, "", "d"),
        (2, "", "d"), (3, long + " " + long, "e"), (4, long + "z" + " " + long + "z", "f"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, word string")
    found = spelling.runs(df)
    short = sorted((r.doc_id, r.run) for r in found.collect() if len(r.run) < 100)
    assert short == [("", "qwertyuiop"), ("1", "asdfghj"), ("1", "qwertyuiop"), ("1", "Éclairs")]
    words = spelling.vocabulary(found.withColumnRenamed("run", "word"))
    got = {r.word: (r.n, r.n_near, r.form) for r in spelling.group_variants(words).collect()}
    assert got == {"qwertyuiop": (2, 0, None), long: (2, 1, None), long + "z": (2, 1, None)}


def test_ties_go_to_the_smaller_word(spark):
    df = spark.createDataFrame([("abcdefg", 2), ("xbcdefg", 20), ("éabcdefg", 20), ("bbcdefg", 20)], "word string, n bigint")
    got = {r.word: (r.form, r.root, r.form_n) for r in spelling.group_variants(df).collect()}
    assert got["abcdefg"] == ("bbcdefg", "bbcdefg", 20)


def test_empty(spark):
    assert spelling.group_variants(spark.createDataFrame([], "word string, n bigint")).collect() == []
