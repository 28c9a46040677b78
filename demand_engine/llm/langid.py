"""Language of a text by hierarchical discrimination: the language family first, then one-versus-one linear
support vector machines between the languages of that family.

Features are relative frequencies of hashed byte 2- to 4-grams of the lower-cased text, with everything that
isn't a letter or non-ASCII read as a space. The machines are fitted on the driver on a bounded sample
(SAMPLE_PER_LANGUAGE documents a language, of which whole text and one short excerpt are rows, so short texts
are known too); what the sample brings there is sparse feature counts. Prediction reads every whole text in one
pass without a shuffle: the weights are a table of fixed size, and a text's score is a mean over its n-grams.

Defined results: ``und`` with score 0 for a null text, an empty one or one without a letter, and for every text
if nothing was learned; one known language is predicted with score 1; ties go to the smaller family and code;
rows that repeat an id are rows of their own; a null id is allowed and never learned from; null labels aren't
learned; an empty table gives an empty result; columns other than id, text and label are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from demand_engine.llm import shingles, svm
from demand_engine.llm.common import pick, small_batches

UNKNOWN = "und"
SAMPLE_PER_LANGUAGE = 400
DIMENSIONS = 4096
ORDERS = (2, 3, 4)
EXCERPT_BYTES = 80
#: Below this score the pipeline rejects a document.
MIN_SCORE = 0.25

#: Families of languages by ISO 639-1 code; a code that isn't listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nl no nb nn sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indic": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "austronesian": "id jv mg ms tl",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_LETTERS = np.full(256, 32, dtype=np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_ODD = np.uint32(2654435761)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def held_out(doc_id: Column) -> Column:
    """One row in five, by a checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _grams(data: np.ndarray, offsets: np.ndarray):
    """Runs of other bytes become one space; ``places`` of each order's n-grams in the weight table, one row per
    byte, DIMENSIONS for those that a text's end cuts; and the new offsets."""
    low = _LETTERS[shingles.LOWER[data]]
    keep = np.ones(len(low), dtype=bool)
    keep[1:] = (low[1:] != 32) | (low[:-1] != 32)
    at = np.concatenate(([0], np.cumsum(keep)))[offsets]
    low = low[keep].astype(np.uint32)
    n = len(low)
    ends = np.repeat(at[1:], np.diff(at))
    places = []
    for order in ORDERS:
        value = np.full(n, np.uint32(order * 977), dtype=np.uint32)
        for k in range(order):
            shifted = np.zeros(n, dtype=np.uint32)
            shifted[: n - k] = low[k:]
            value = (value * np.uint32(257) + shifted) * _ODD
        place = ((value ^ (value >> np.uint32(15))) * _ODD >> np.uint32(20)).astype(np.int64)
        place[np.arange(n) + order > ends] = DIMENSIONS
        places.append(place)
    return places, at


def _count_features(batches):
    schema = pa.schema([("lang", pa.string()), ("places", pa.binary()), ("values", pa.binary())])
    for batch in batches:
        langs, rows = batch.column("lang").to_pylist(), []
        for first, data, offsets in shingles.blocks(batch.column("text")):
            places, at = _grams(data, offsets)
            for k in range(len(offsets) - 1):
                a, b = int(at[k]), int(at[k + 1])
                middle = max(a, (a + b - EXCERPT_BYTES) // 2)
                for lo, hi in ((a, b), (middle, min(b, middle + EXCERPT_BYTES))):
                    if hi > lo:
                        counts = sum(np.bincount(p[lo:hi], minlength=DIMENSIONS + 1)[:DIMENSIONS] for p in places)
                        used = np.flatnonzero(counts)
                        if len(used):
                            share = (counts[used] / counts.sum()).astype(np.float32)
                            rows.append((langs[first + k], used.astype(np.uint16).tobytes(), share.tobytes()))
        columns = list(zip(*rows)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class Model:
    """Families, their languages, and a weight table with a column per machine: families one against the rest
    (for more than one family), then the pairs of languages within each family. The last column of ``x`` is 1."""

    def __init__(self, languages: list[str], x: np.ndarray | None = None, labels: np.ndarray | None = None):
        self.families: dict[str, list[str]] = {}
        for code in sorted(languages):
            self.families.setdefault(FAMILY_OF.get(code, code), []).append(code)
        self.names = sorted(self.families)
        self.pairs = [p for name in self.names for p in combinations(self.families[name], 2)]
        many = len(self.names) > 1
        n_machines = len(self.names) * many + len(self.pairs)
        self.weights = np.zeros((DIMENSIONS + 1, n_machines), dtype=np.float32)
        self.bias = np.zeros(n_machines, dtype=np.float32)
        if x is None:
            return
        family = np.array([FAMILY_OF.get(c, c) for c in labels])
        machines = [(np.arange(len(x)), family == name) for name in self.names] if many else []
        for a, b in self.pairs:
            rows = np.flatnonzero((labels == a) | (labels == b))
            machines.append((rows, labels[rows] == a))
        for k, (rows, positive) in enumerate(machines):
            w = svm.fit(x, rows, positive)
            self.weights[:DIMENSIONS, k], self.bias[k] = w[:-1] * SCALE, w[-1]

    def decide(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each row of margins."""
        n = len(margins)
        lang, score = np.full(n, UNKNOWN, dtype=object), np.zeros(n)
        if not self.names:
            return lang, score
        sure = 1 / (1 + np.exp(-2 * np.clip(margins, -30, 30)))
        many = len(self.names) > 1
        best = margins[:, : len(self.names)].argmax(1) if many else np.zeros(n, dtype=int)
        chance = sure[np.arange(n), best] if many else np.ones(n)
        first = len(self.names) if many else 0
        for f, name in enumerate(self.names):
            rows = np.flatnonzero(best == f)
            codes = self.families[name]
            votes = np.zeros((len(rows), len(codes)))
            against = np.ones((len(rows), len(codes)))
            for k, (a, b) in enumerate(self.pairs):
                if a in codes:
                    i, j, p = codes.index(a), codes.index(b), sure[rows, first + k]
                    votes[:, i] += (p >= 0.5) + p / 1000
                    votes[:, j] += (p < 0.5) + (1 - p) / 1000
                    against[:, i] = np.minimum(against[:, i], p)
                    against[:, j] = np.minimum(against[:, j], 1 - p)
            won = votes.argmax(1)
            lang[rows] = np.array(codes, dtype=object)[won]
            score[rows] = chance[rows] * against[np.arange(len(rows)), won]
        return lang, score


#: Relative frequencies are small; the machines see them times this.
SCALE = 20.0


def learn(documents: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model from rows ``doc_id, text, lang``; about ``per_language`` rows of each language are drawn by a
    hash of the id, at a rate from its count."""
    small_batches(documents.sparkSession)
    rows = pick(documents, doc_id="doc_id", text="text", lang="lang").where("lang is not null and doc_id is not null")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if len(counts) < 2:
        return Model(list(counts))
    rate = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, per_language / n))])
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.where((draw < rate[F.col("lang")]) & has_letter(F.col("text"))).select("lang", F.lower("text").alias("text"))
    found = sample.mapInArrow(_count_features, "lang string, places binary, values binary").collect()
    known = sorted({r.lang for r in found})
    if len(known) < 2:
        return Model(known)
    found.sort(key=lambda r: (r.lang, bytes(r.places), bytes(r["values"])))
    x = np.zeros((len(found), DIMENSIONS + 1), dtype=np.float32)
    x[:, DIMENSIONS] = 1
    for i, r in enumerate(found):
        x[i, np.frombuffer(bytes(r.places), dtype=np.uint16)] = np.frombuffer(bytes(r["values"]), dtype=np.float32) * SCALE
    return Model(known, x, np.array([r.lang for r in found], dtype=object))


def _score(model: Model, carried: int, schema: pa.Schema):
    """The first ``carried`` columns as they are, then language and score of the text after them."""

    def run(batches):
        for batch in batches:
            langs, scores = [np.zeros(0, dtype=object)], [np.zeros(0)]
            for _, data, offsets in shingles.blocks(batch.column(carried)):
                places, at = _grams(data, offsets)
                n = len(at) - 1
                total, counts = np.zeros((n, model.weights.shape[1])), np.zeros(n)
                full = np.flatnonzero(np.diff(at) > 0)
                if len(full):
                    for place in places:
                        total[full] += np.add.reduceat(model.weights[place], at[full], axis=0)
                        counts[full] += np.add.reduceat(place < DIMENSIONS, at[full], dtype=np.int64)
                lang, score = model.decide(total / np.maximum(counts, 1)[:, None] + model.bias)
                langs.append(lang)
                scores.append(score)
            known = np.asarray(batch.column(carried + 1).to_pylist(), dtype=bool)
            lang = np.where(known, np.concatenate(langs), UNKNOWN) if len(known) else []
            score = np.where(known, np.concatenate(scores), 0.0) if len(known) else []
            found = [pa.array(list(lang), pa.string()), pa.array(score, pa.float64())]
            kept = [c.cast(f.type) for c, f in zip(batch.columns[:carried], schema)]
            yield pa.RecordBatch.from_arrays([*kept, *found], schema=schema)

    return run


def judged(documents: DataFrame, model: Model, lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """The rows with all their columns, and language and score of their text under these names."""
    small_batches(documents.sparkSession)
    rows = documents.select(
        "*", F.lower(F.coalesce(F.col("text"), F.lit(""))), F.coalesce(has_letter(F.col("text")), F.lit(False))
    )
    out = StructType([*documents.schema, StructField(lang_pred, StringType()), StructField(score, DoubleType())])
    return rows.mapInArrow(_score(model, len(documents.columns), to_arrow_schema(out)), out)


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """Per row ``doc_id, lang_pred, score``, from the text alone."""
    small_batches(documents.sparkSession)
    rows = pick(documents, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("bigint"), F.lower(F.coalesce("text", F.lit(""))).alias("text"), has_letter(F.col("text")).alias("letter")
    )
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    return rows.mapInArrow(_score(model, 1, schema), "doc_id bigint, lang_pred string, score double")
