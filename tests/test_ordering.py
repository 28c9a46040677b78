import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demand_engine.operators import ordering


def test_quantiles_equal_brute_force_with_a_hot_key(spark):
    rng = random.Random(7)
    data = []
    for _ in range(6000):
        key = "hot" if rng.random() < 0.6 else rng.choice("abcdefgh")
        value = rng.choice([None, 1.5, rng.gauss(0, 1), rng.expovariate(0.01), float(rng.randint(0, 5))])
        data.append((key, value))
    data += [("one", 3.0), ("void", None), (None, 1.0)]
    probs = {"low": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "high": 1.0}
    df = spark.createDataFrame(data, "k string, v double").repartition(7)
    got = {r.k: tuple(r)[1:] for r in ordering.exact_quantiles(df, ["k"], "v", probs).collect()}
    assert "void" not in got and None not in got
    for key in got:
        values = [v for k, v in data if k == key and v is not None]
        assert got[key] == pytest.approx(tuple(np.quantile(values, list(probs.values()))))


def test_quantiles_without_key_ignore_nan(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(float("nan"),), (None,)], "v double")
    assert tuple(ordering.exact_quantiles(df, [], "v", {"a": 0.5, "b": 0.255}).first()) == pytest.approx((50.0, 25.5))


def test_ranks_sort_their_neighbourhood_only(spark):
    """A key with all the rows: no job and no file while the plan is made, and the last window sees few rows."""
    df = spark.range(80_000).select(F.lit("hot").alias("k"), F.xxhash64("id").cast("double").alias("v"))
    ranks = {"first": lambda t: F.lit(0), "mid": lambda t: F.floor(t / 2), "last": lambda t: t - 1, "none": lambda t: t}
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    made = ordering.values_at(df, ["k"], "v", ranks)
    assert len(tracker.getJobIdsForGroup(None)) == before
    values = sorted(r.v for r in df.select("v").collect())
    assert tuple(made.first()) == ("hot", 80_000, values[0], values[40_000], values[-1], None)
    fine = df.groupBy(ordering._bucket(F.col("v"), 24)).count().agg(F.max("count")).first()[0]
    assert fine < 100


def test_buckets_rise_with_the_value(spark):
    values = sorted([0.0, -0.0, 5e-324, -5e-324, 1e-300, 0.1, 0.3, 1, 2, 3, 7.999999999999999, 8, 1e15, 1e15 + 1, 1.7e308, float("inf"), float("-inf"), -1e15, -2, -1.9999999999999998, *[2.0**k for k in range(-1074, 1024, 7)], *[-(2.0**k) * (1 - 2**-53) for k in range(-1000, 1024, 7)]])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for bits in (8, 24):
        got = [r.b for r in df.select(ordering._bucket(F.col("v"), bits).alias("b")).collect()]
        assert got == sorted(got)


def test_pages_of_other_kinds_of_keys(spark):
    texts = sorted({f"{a}{b}é{a * 3}" for a in "abÄz" for b in range(30)}, key=lambda t: t.encode())
    df = spark.createDataFrame([(t,) for t in texts[::-1]], "k string")
    assert sorted((r.k for r in ordering.page(df, "k", 7, 5).collect()), key=lambda t: t.encode()) == texts[7:12]
    times = spark.range(500).select(F.timestamp_micros(F.col("id") * 7 + 1_700_000_000_000_000).alias("t"))
    assert [r.t for r in ordering.page(times, "t", 100, 3).orderBy("t").collect()] == [r.t for r in times.orderBy("t").collect()][100:103]


@pytest.mark.parametrize("offset, n", [(0, 10), (95, 10), (100, 5), (40, 20)])
def test_page(spark, offset, n):
    df = spark.range(100).select((99 - F.col("id")).alias("id")).repartition(5)
    assert sorted(r.id for r in ordering.page(df, "id", offset, n).collect()) == list(range(100))[offset : offset + n]


def test_first_rows(spark):
    df = spark.range(50).repartition(6)
    assert sorted(r.id for r in ordering.first_rows(df, "id", 7).collect()) == list(range(7))
    assert ordering.first_rows(df, "id", 500).count() == 50


def test_top_k_ties_by_key(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), ("d", 1)], "k string, n int")
    assert [r.k for r in ordering.top_k(df, "n", "k", 2).collect()] == ["c", "a"]


def test_storage_order(spark):
    df = ordering.sorted_for_storage(spark.range(1000).repartition(4), "id")
    parts = df.rdd.mapPartitions(lambda it: [[r.id for r in it]]).collect()
    assert [i for p in parts for i in p] == list(range(1000))


def test_text_keys_with_a_common_beginning_are_ranked_by_descent(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SORTED_ROWS", 20)
    texts = sorted((f"https://www.example.org/{a}/{'x' * (b % 3)}{b}" for a in ("item", "itemé", "zone") for b in range(70)), key=lambda t: t.encode())
    texts = ["", "http", *texts]
    df = spark.createDataFrame([(t,) for t in texts[::-1]] + [(None,)], "k string")
    asked = []
    order_by = type(df).orderBy
    monkeypatch.setattr(type(df), "orderBy", lambda self, *a: (asked.append(self.count()), order_by(self, *a))[1])
    assert sorted((r.k for r in ordering.page(df, "k", 101, 4).collect()), key=lambda t: t.encode()) == texts[101:105]
    assert asked and max(asked) <= 20
    assert sorted(r.k for r in ordering.first_rows(df, "k", 3).collect()) == texts[:3]
    assert ordering.page(df, "k", len(texts), 5).count() == 0
    assert ordering.page(df.limit(0), "k", 0, 5).count() == 0


def test_histogram_merges_by_adding_up(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.choice([None, float("nan"), rng.gauss(0, 3)])) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, v double")
    parts = [ordering.value_histogram(df.where(F.col("k") == k).repartition(3), ["k"], "v") for k in "ab"]
    assert sorted(map(tuple, parts[0].union(parts[1]).collect())) == sorted(map(tuple, ordering.value_histogram(df, ["k"], "v").collect()))


def test_moments_come_with_the_quantiles(spark):
    rng = random.Random(6)
    rows = [(rng.choice("abc"), rng.choice([None, 1e9 + rng.random(), rng.gauss(1e9, 2)])) for _ in range(900)] + [("one", 2.0), ("void", None), ("void", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    names = {m: m for m in ("count", "mean", "std", "min", "max")}
    got = {r.k: r for r in ordering.exact_quantiles(df, ["k"], "v", {"p50": 0.5}, describe=names, keep_empty=True).collect()}
    assert set(got) == {"a", "b", "c", "one", "void"}
    for k in "abc":
        v = np.array([x for y, x in rows if y == k and x is not None])
        want = (len(v), v.mean(), v.std(ddof=1), v.min(), v.max(), np.median(v))
        assert tuple(got[k])[1:] == pytest.approx(want, rel=1e-12, abs=1e-6)
    assert tuple(got["one"])[1:] == (1, 2.0, None, 2.0, 2.0, 2.0)
    assert tuple(got["void"])[1:] == (0, None, None, None, None, None)
