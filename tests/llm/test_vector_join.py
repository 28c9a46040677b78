from collections import Counter, defaultdict

import numpy as np
import pytest

from demand_engine.llm import vector_join

SCHEMA = "vec_id bigint, embedding array<float>, n int, component_id string"


def brute(rows, min_cosine=vector_join.MIN_COSINE):
    """``vec_id, n_links, component_id, kept`` per row, from all pairs; rows are told apart by their position."""
    length = Counter(len(v) for _, v in rows if usable(v))
    d = max(length, key=lambda k: (length[k], k), default=None)
    able = [k for k, (_, v) in enumerate(rows) if usable(v) and len(v) == d]
    near = defaultdict(set)
    if able:
        m = np.array([rows[k][1] for k in able], dtype=np.float32).astype(float)
        m /= np.abs(m).max(axis=1, keepdims=True)
        lengths = np.sqrt((m * m).sum(1))
        for a, b in zip(*np.nonzero((m @ m.T) / np.outer(lengths, lengths) >= min_cosine)):
            if a != b:
                near[able[a]].add(able[b])
    out = Counter()
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        least = min((rows[x][0] for x in seen if rows[x][0] is not None), default=None)
        out[(i, len(near[k]), least, i == least)] += 1
    return out


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def run(spark, rows, **parameters):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    return Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_join.near_duplicates(df, **parameters).collect())


def groups(seed, n, d, spread):
    """Random vectors, a group of near copies of one, chains, and exact copies."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, d))
    near = base[0] + spread * rng.standard_normal((n // 2, d))
    chain = [base[1]]
    for _ in range(n // 5):
        chain.append(chain[-1] + 0.9 * spread * rng.standard_normal(d))
    rows = [*base, *near, *chain, *np.repeat(base[2:4], n // 6, axis=0)]
    order = rng.permutation(len(rows))
    return [(int(i), [float(x) for x in rows[k]]) for i, k in enumerate(order)]


@pytest.mark.parametrize("d,leaf,piece", [(64, 12_000, 16_000), (32, 25, 16_000), (24, 20, 15)])
def test_against_brute_force(spark, monkeypatch, d, leaf, piece):
    monkeypatch.setattr(vector_join, "LEAST_SAMPLED", 4)
    rows = groups(d, 120, d, 0.25)
    want = brute(rows)
    assert sum(n > 0 for _, n, _, _ in want) > 60 and max(n for _, n, _, _ in want) > 20
    assert run(spark, rows, leaf=leaf, piece=piece) == want


def test_other_threshold(spark, monkeypatch):
    monkeypatch.setattr(vector_join, "LEAST_SAMPLED", 4)
    rows = groups(5, 100, 16, 0.3)
    assert run(spark, rows, min_cosine=0.8, block_dimensions=4, leaf=30, piece=40) == brute(rows, 0.8)


def test_odd_inputs(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1e-30, 0.0, 0.0]), (3, [1e30, -0.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]),
        (7, [nan, 1.0, 0.0]), (8, [inf, 1.0, 0.0]), (9, [None, 1.0, 0.0]), (10, [1.0, 0.0]), (None, [0.0, 1.0, 0.0]), (None, [0.0, 1.0, 0.0]),
        (None, [1.0, 0.1, 0.0]), (11, [0.0, 0.0, -1.0]), (11, [0.0, 0.0, -1.0]), (None, None), (12, [19.0, 39.0**0.5, 0.0]),
    ]
    assert run(spark, rows) == brute(rows)


def test_no_share_reaches_all_links():
    """Every pair within the distance is within the share of a block."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((500, 20))
    y = x + 0.3 * rng.standard_normal((500, 20)) * (rng.random((500, 20)) < 0.3)
    turn, bounds = vector_join.rotation(20), vector_join.block_bounds(20, 6)
    a, b = vector_join.rotated(x, turn), vector_join.rotated(y, turn)
    assert np.allclose(turn @ turn.T, np.eye(20))
    linked = (a * b).sum(1) >= 0.95
    budget = 2 * 0.05
    found = np.zeros(500, dtype=bool)
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        found |= ((a[:, lo:hi] - b[:, lo:hi]) ** 2).sum(1) <= budget * (hi - lo) / 20 + vector_join.SLACK
    assert linked.sum() > 100 and found[linked].all()


def test_leaves_hold_all_within_reach():
    rng = np.random.default_rng(4)
    points = rng.standard_normal((300, 6)) * 0.2
    tree, reach = vector_join.Tree(points, 4), 0.02
    member, who, leaf = tree.leaves(points, reach)
    searched = set(zip(who.tolist(), leaf.tolist()))
    assert len(searched) == len(who) and len(set(member.tolist())) == 16
    assert all((k, m) in searched for k, m in enumerate(member.tolist()))
    near = ((points[:, None] - points[None]) ** 2).sum(2) <= reach
    for a, b in zip(*np.nonzero(near)):
        lo, hi = sorted((a, b), key=lambda k: member[k])
        assert (lo, member[hi]) in searched


def test_forest():
    forest = vector_join.Forest(7)
    forest.link(np.array([5, 1]), np.array([6, 2]))
    forest.link(np.array([2, 6]), np.array([3, 3]))
    assert forest.label.tolist() == [0, 1, 1, 1, 4, 1, 1]


def test_empty(spark):
    assert run(spark, []) == Counter()
    assert run(spark, [(1, None), (2, [0.0])]) == Counter({(1, 0, 1, True): 1, (2, 0, 2, True): 1})
