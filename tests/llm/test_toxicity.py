import itertools
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from demand_engine.llm import queries, toxicity
from demand_engine.llm.langid import held_out
from demand_engine.llm.toxicity import Field


def brute_marginals(field, emission):
    n = len(emission)
    total, toxic = 0.0, np.zeros(n)
    for labels in itertools.product((0, 1), repeat=n):
        w = field.first[labels[0]] + sum(field.moves[a, b] for a, b in zip(labels, labels[1:]))
        w = np.exp(w + sum(e for e, label in zip(emission, labels) if label))
        total += w
        toxic += w * np.array(labels)
    return toxic / total


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    field = Field()
    field.moves, field.first = rng.normal(size=(2, 2)), rng.normal(size=2)
    lengths = [1, 3, 8, 1, 10, 2] * 8
    emission = rng.normal(size=sum(lengths)) * 2
    begins = np.zeros(len(emission), dtype=bool)
    begins[np.concatenate(([0], np.cumsum(lengths)[:-1]))] = True
    got = field.marginals(emission, begins)
    at = 0
    for n in lengths:
        assert np.allclose(got[at : at + n], brute_marginals(field, emission[at : at + n]))
        at += n


def synthetic(spark, n=600, seed=0):
    rng = random.Random(seed)
    words = ["".join(rng.choices("bcdfgaeiou", k=rng.randint(2, 7))) for _ in range(3000)]
    bad = ["zwonker", "qualtish", "vrexen", "vrexel", "vrexum", "vrexor"]
    docs, labels = [], []
    for k in range(n):
        ws = rng.choices(words, k=rng.randint(5, 120))
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.randint(1, 3)):
                ws.insert(rng.randrange(len(ws) + 1), rng.choice(bad))
        docs.append((k, " ".join(ws)))
        labels.append((k, int(toxic)))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_learns_words_and_beginnings_and_finds_their_place(spark):
    docs, labels = synthetic(spark)
    test = held_out(F.col("doc_id"))
    field = toxicity.learn(docs, labels.where(~test))
    got = toxicity.score(docs, field).join(labels, "doc_id").join(docs, "doc_id").where(test).collect()
    assert np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in got]) > 0.97
    for r in got:
        for s in r.spans:
            assert s.probability >= 0.5
            assert r.toxic == 0 or r.text[s.start : s.end].split()[0][:4] in ("zwon", "qual", "vrex")


def test_a_copied_text_teaches_nothing(spark):
    docs, labels = synthetic(spark)
    copy = "entirely harmless words that stand in one text only however often it was copied"
    more = spark.createDataFrame([(1000 + k, f"{copy} zwonker t{k}") for k in range(60)], "doc_id bigint, text string")
    tagged = labels.union(more.select("doc_id", F.lit(1).alias("toxic")))
    field = toxicity.learn(docs.union(more), tagged)
    clean = spark.createDataFrame([(1, copy), (2, f"{copy} zwonker")], "doc_id bigint, text string")
    assert [r.score >= 0.5 for r in toxicity.score(clean, field).orderBy("doc_id").collect()] == [False, True]


def test_edge_rows_and_clashing_columns(spark):
    docs, labels = synthetic(spark, 300)
    field = toxicity.learn(docs, labels)
    long = "harmless " * 60_000 + "zwonker"
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 !!", None), (4, long, "x"), (4, long, "x"), (None, "a ZWONKER é Zwonker", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, score string").withColumn("spans", F.lit(1))
    got = toxicity.score(df, field).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[k].score for k in (1, 2, 3)] == [0, 0, 0]
    assert by[4].score > 0.5 and [(s.start, s.end) for s in by[4].spans] == [(540_000, 540_007)]
    assert [(s.start, s.end) for s in by[None].spans] == [(2, 9), (12, 19)]
    assert toxicity.score(df.limit(0), field).collect() == []
    unlabelled = toxicity.learn(docs, labels.where("toxic = 0"))
    assert all(r.score == 0 for r in toxicity.score(df, unlabelled).collect())
    assert toxicity.learn(docs.limit(0), labels).weights.any() == False  # noqa: E712
    odd = labels.union(spark.createDataFrame([(None, 1), (3, None), (5, 1), (5, 0)], "doc_id bigint, toxic int"))
    assert toxicity.learn(docs, odd).weights.any()


def test_toxic_segments_over_the_bound_are_drawn_from_all_texts(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(toxicity, "MOST_SEGMENTS", 60)
    monkeypatch.setattr(Field, "fit", lambda self, places, labels, masks: fitted.append((places, labels)))
    rng = random.Random(0)

    def text(letters, bad=None):
        words = ["".join(rng.choices(letters, k=5)) for _ in range(30)]
        return " ".join([*words[:9], bad, *words[9:]] if bad else words)

    latin, other = "abcdefgh", "абвгдежз"
    rows = [(k, text(latin, "zlurg"), 1) for k in range(80)] + [(100 + k, text(other, "жлург"), 1) for k in range(80)]
    rows += [(200 + k, text(latin if k % 2 else other), 0) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    toxicity.learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    ((places, labels),) = fitted
    drawn = places[labels.astype(bool)]
    assert len({p.tobytes() for p in drawn.reshape(len(drawn), -1)[:, :1]}) == 2


def plain_scores(field, text, emissions):
    """Largest marginal and toxic spans of one text, token by token; a word's features come from the word alone."""
    words = list(re.finditer(r"[A-Za-z\u0080-\U0010ffff]+", text or ""))
    if not words:
        return 0.0, []
    psi = []
    for word in words:
        if word.group() not in emissions:
            data = np.frombuffer(word.group().encode(), dtype=np.uint8)
            emissions[word.group()] = float(field.emission(toxicity.tokens(data, np.array([0, len(data)]))[3])[0])
        psi.append((1.0, math.exp(min(30, max(-30, emissions[word.group()])))))
    moves = [[math.exp(field.moves[a, b]) for b in (0, 1)] for a in (0, 1)]

    def scaled(pair):
        return pair[0] / sum(pair), pair[1] / sum(pair)

    ahead = [scaled([math.exp(field.first[b]) * psi[0][b] for b in (0, 1)])]
    for here in psi[1:]:
        ahead.append(scaled([sum(ahead[-1][a] * moves[a][b] for a in (0, 1)) * here[b] for b in (0, 1)]))
    behind = [(1.0, 1.0)]
    for after in psi[:0:-1]:
        behind.append(scaled([sum(moves[a][b] * after[b] * behind[-1][b] for b in (0, 1)) for a in (0, 1)]))
    p = [scaled((x[0] * y[0], x[1] * y[1]))[1] for x, y in zip(ahead, reversed(behind))]
    spans = []
    for t, word in enumerate(words):
        if p[t] >= 0.5:
            if t and p[t - 1] >= 0.5:
                spans[-1] = (spans[-1][0], word.end())
            else:
                spans.append((word.start(), word.end()))
    return max(p), spans


def test_query_equals_brute_force(spark):
    """Every score and every span of the query, over the whole table, against token-by-token passes."""
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    field = toxicity.learn(docs, labels.where(~held_out(F.col("doc_id"))))
    assert field.weights.any()
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = queries.QUERIES["op5_toxicity"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    emissions, n_spans = {}, 0
    for r in got:
        score, spans = plain_scores(field, texts[r.doc_id], emissions)
        assert abs(r.score - score) < 1e-3 and r.predicted == (r.score >= 0.5)
        assert [(x.start, x.end) for x in r.spans] == spans
        n_spans += len(spans)
    assert n_spans > 0
