import math
import random
import zlib

import numpy as np
import regex
from pyspark.sql import functions as F

from demand_engine.llm import langid, queries, shingles, svm
from tests.llm.conftest import SF_DIR


def test_svm_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5)).astype(np.float32)
    y = x @ np.array([1, -2, 0, 0.5, 1], dtype=np.float32) + 0.3 > 0
    x = np.hstack([x, np.ones((200, 1), dtype=np.float32)])
    w = svm.fit(x, np.arange(100), y[:100])
    assert ((x @ w > 0) == y).mean() > 0.95


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    test = langid.held_out(F.col("doc_id"))
    model = langid.learn(docs.where(~test))
    assert model.names == ["germanic", "romance"]
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(test).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_held_out_rule(spark):
    got = spark.range(200).select("id", langid.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_whole_text_counts(spark):
    """A prediction equals the one from brute-force n-gram counts of the whole text."""
    rng = random.Random(0)
    texts = [" ".join("".join(rng.choices("abcdé", k=4)) for _ in range(rng.randint(1, 4000))) for _ in range(6)]
    rng_np = np.random.default_rng(1)
    model = langid.Model(["de", "en"])
    model.weights = rng_np.normal(size=(langid.DIMENSIONS + 1, 1)).astype(np.float32)
    model.weights[-1] = 0
    model.bias = np.zeros(1, dtype=np.float32)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in langid.predict(df, model).collect()}
    for k, text in enumerate(texts):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        places, at = langid._grams(data, np.array([0, len(data)]))
        counts = np.bincount(np.concatenate(places), minlength=langid.DIMENSIONS + 1)
        counts[-1] = 0
        margin = (counts @ model.weights[:, 0]) / counts.sum()
        sure = 1 / (1 + np.exp(-2 * margin))
        assert abs(got[k] - max(sure, 1 - sure)) < 1e-4


def plain_prediction(model, text):
    """Language and score of one text, n-gram by n-gram and machine by machine."""
    if text is None or not regex.search(r"\p{L}", text):
        return "und", 0.0
    kept = bytearray()
    for byte in text.lower().encode():
        letter = 97 <= byte <= 122 or byte >= 128
        if letter or not kept or kept[-1] != 32:
            kept.append(byte if letter else 32)
    odd, full = 2654435761, 1 << 32
    total, n = [0.0] * model.weights.shape[1], 0
    for order in (2, 3, 4):
        for start in range(len(kept) - order + 1):
            value = order * 977
            for byte in kept[start : start + order]:
                value = (value * 257 + byte) * odd % full
            place = ((value ^ (value >> 15)) * odd % full) >> 20
            total = [t + float(w) for t, w in zip(total, model.weights[place])]
            n += 1
    margins = [t / max(n, 1) + float(b) for t, b in zip(total, model.bias)]
    chance = [1 / (1 + math.exp(-2 * min(30, max(-30, m)))) for m in margins]
    many = len(model.names) > 1
    best = max(range(len(model.names)), key=lambda f: margins[f]) if many else 0
    codes, first = model.families[model.names[best]], len(model.names) * many
    votes, weakest = dict.fromkeys(codes, 0.0), dict.fromkeys(codes, 1.0)
    for k, (a, b) in enumerate(model.pairs):
        if a in codes:
            p = chance[first + k]
            votes[a if p >= 0.5 else b] += 1
            votes[a], votes[b] = votes[a] + p / 1000, votes[b] + (1 - p) / 1000
            weakest[a], weakest[b] = min(weakest[a], p), min(weakest[b], 1 - p)
    won = max(codes, key=lambda c: votes[c])
    return won, (chance[best] if many else 1.0) * weakest[won]


def test_query_equals_brute_force(spark):
    """Every row of the query, over the whole table, against a plain reading of the method."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = queries.QUERIES["op1_language_id"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        lang, score = plain_prediction(model, texts[r.doc_id])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-4


def test_edge_rows_and_clashing_columns(spark):
    rows = [
        (1, "the cat sat on the mat and then the dog ran", "en", "x"), (2, "der hund und die katze sind nicht hier", "de", "x"),
        (3, None, "en", "x"), (4, "", None, None), (5, "123 !?", "de", "x"), (None, "the end of the story", None, "x"),
        (1, "the cat sat on the mat and then the dog ran", "en", "x"), (6, "le chat " * 30_000, "fr", "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    model = langid.learn(df)
    got = langid.predict(df, model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert [by[k][0] for k in (1, 2, 6)] == ["en", "de", "fr"]
    assert by[3] == by[4] == by[5] == ("und", 0.0)
    assert by[None][0] in ("en", "de", "fr")
    empty = df.limit(0)
    assert langid.predict(empty, langid.learn(empty)).collect() == []
    assert {r.lang_pred for r in langid.predict(df, langid.learn(empty)).collect()} == {"und"}
    one = langid.learn(df.where("lang = 'en'"))
    assert {r.lang_pred for r in langid.predict(df.where("doc_id in (1, 2)"), one).collect()} == {"en"}


def test_words_of_a_batch():
    import pyarrow as pa

    texts = pa.array(["Ab c", None, "", " x\tAB ", "ab"])
    (found,) = list(shingles.blocks(texts))
    _, data, offsets = found
    starts, ends, hashes, per_doc = shingles.words(data, offsets, shingles.NOT_SPACE)
    assert np.diff(per_doc).tolist() == [2, 0, 0, 2, 1]
    assert hashes[0] == hashes[3] == hashes[4] and len(set(hashes.tolist())) == 3
