"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are known per document only. For training, tokens of toxic documents are labelled from the sample: a
form (the word, or one of its beginnings) that toxic documents have and others practically don't, by a
likelihood ratio that counts it once per word before and after it (so copies of one text count once), marks its tokens
toxic; all else is not. The field has two labels, hashed features of the
token (word, beginnings, ending) and a transition table; it is fitted on the driver by gradient steps on
segments of a bounded sample (TOXIC_SAMPLE and CLEAN_SAMPLE labelled documents of at most SAMPLE_BYTES).

Scoring reads every whole text in one pass without a shuffle. Forward and backward run over all texts of a
block at once, as scans of 2x2 matrices in which a text's first token forgets what was before. A document's
score is its largest marginal; spans are runs of tokens whose marginal is at least 0.5, with character offsets.

With few labelled documents, forms of rare languages are not learned: from 45 toxic ones recall is about 0.7 (held out,
scale factor 0.01), from those of scale factor 0.1 it is 0.94.

Defined results: a null or empty text, or one without letters, has score 0 and no span, as has every text if
either label is missing from the sample; a document labelled twice counts as toxic if one label says so; null
labels and ids aren't learned; rows that repeat an id are scored each; an empty table gives an empty result;
letters are a-z, after lower-casing A-Z and the Latin-1 capitals, and everything else beyond ASCII.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.llm import shingles
from demand_engine.llm.common import pick, small_batches

TOXIC_SAMPLE = 700
CLEAN_SAMPLE = 2100
SAMPLE_BYTES = 65_536
DIMENSIONS = 1 << 20
BEGINNINGS = (4, 5, 6, 7)
ENDING = 3
SEGMENT = 20
STEPS = 60
#: Segments without a toxic token, for each one with.
CLEAN_SEGMENTS = 8
MOST_SEGMENTS = 15_000
#: Segments whose gradient is computed at a time.
CHUNK = 3000
#: A form marks toxic tokens if its likelihood ratio is beyond what chance gives one of all forms with this
#: many documents, and its frequency this many times that in other documents.
TESTABLE = 4
MIN_LIFT = 20.0

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z and the capitals of Latin-1 in lower case, byte for byte."""
    low = shingles.LOWER[data]
    after = np.zeros(len(low), dtype=bool)
    after[1:] = low[:-1] == 0xC3
    capital = after & (low >= 0x80) & (low <= 0x9E) & (low != 0x97)
    return np.where(capital, low + 32, low).astype(np.uint8)


def tokens(data: np.ndarray, offsets: np.ndarray):
    """``starts, ends, per_doc, forms``: forms has a row of 64-bit hashes per token, of the word, its beginnings
    (0 where the word is no longer than that) and its ending."""
    low = lowered(data)
    starts, ends, words, per_doc = shingles.words(low, offsets, _LETTER)
    sums = shingles.running(low)
    length = ends - starts
    forms = [words]
    for k in BEGINNINGS:
        long = length > k
        h = shingles.range_hashes(sums, starts, np.minimum(starts + k, ends)) + np.uint64(k)
        forms.append(np.where(long, h, np.uint64(0)))
    forms.append(shingles.range_hashes(sums, np.maximum(ends - ENDING, starts), ends) ^ np.uint64(0x5A5A5A5A5A))
    return starts, ends, per_doc, np.stack(forms, axis=1)


def _places(forms: np.ndarray) -> np.ndarray:
    """Where the features of tokens have their weights: DIMENSIONS for none, DIMENSIONS + 1, in the last column,
    for what all tokens have in common."""
    places = np.where(forms == 0, DIMENSIONS, (forms >> np.uint64(20)) % np.uint64(DIMENSIONS)).astype(np.int32)
    return np.hstack([places, np.full((len(forms), 1), DIMENSIONS + 1, dtype=np.int32)])


def _ratio(t: np.ndarray, c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Likelihood ratio of t of n[1] toxic and c of n[0] other documents against one rate for both."""
    expected_t, expected_c = (t + c) * n[1] / n.sum(), (t + c) * n[0] / n.sum()
    return 2 * (t * np.log(np.maximum(t, 1) / expected_t) + c * np.log(np.maximum(c, 1) / expected_c))


def telling_forms(per_doc: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Sorted hashes of the forms that tell toxic documents from others, each one's number of other documents, the
    numbers of both kinds, and the ratio needed; ``per_doc`` has each document's distinct forms."""
    n = np.array([(~toxic).sum(), toxic.sum()], dtype=float)
    both = [np.concatenate([per_doc[i] for i in np.flatnonzero(toxic == side)]) for side in (False, True)]
    (clean, n_clean), (bad, n_bad) = (np.unique(x, return_counts=True) for x in both)
    c = np.zeros(len(bad))
    if len(clean):
        at = np.minimum(np.searchsorted(clean, bad), len(clean) - 1)
        c = np.where(clean[at] == bad, n_clean[at], 0).astype(float)
    t = n_bad.astype(float)
    lift = (t / n[1]) / ((c + 0.1) / n[0])
    # A ratio r has the chance exp(-r / 2), about.
    needed = 2 * np.log(max(100, (n_clean >= TESTABLE).sum() + (n_bad >= TESTABLE).sum()))
    kept = (_ratio(t, c, n) >= needed) & (lift >= MIN_LIFT) & (bad != 0)
    return bad[kept], c[kept], n, needed


def spread_forms(telling: np.ndarray, c: np.ndarray, n: np.ndarray, needed: float, around: list[np.ndarray]) -> np.ndarray:
    """Those that still tell if an occurrence counts once per word before it, and once per word after it: what is
    only in copies of one text stands between the same words. ``around`` has, for either side, rows (index into
    telling, hash of that word)."""
    places = np.full(len(telling), n[1])
    for pairs in around:
        index, count = np.unique(np.unique(pairs, axis=0)[:, 0].astype(np.int64), return_counts=True)
        side = np.zeros(len(telling))
        side[index] = count
        places = np.minimum(places, side)
    return telling[_ratio(places, c, n) >= needed]


class Field:
    """Weights of the toxic label's features, transitions [from, to] and first labels, in logarithms."""

    def __init__(self):
        self.weights = np.zeros(DIMENSIONS + 2, dtype=np.float32)
        self.moves = np.zeros((2, 2))
        self.first = np.zeros(2)

    def emission(self, forms: np.ndarray) -> np.ndarray:
        return self.weights[_places(forms)].sum(1)

    def fit(self, places: np.ndarray, labels: np.ndarray, mask: np.ndarray, steps: int = STEPS) -> None:
        """Gradient steps (Adam) on the conditional likelihood of segments: ``places`` is segment x token x
        feature, ``labels`` and ``mask`` segment x token. The first token of a segment is always there."""
        state = [np.zeros(DIMENSIONS + 2), np.zeros((2, 2)), np.zeros(2)]
        first, second = [np.zeros_like(p) for p in state], [np.zeros_like(p) for p in state]
        for step in range(1, steps + 1):
            slope = [0.05 * state[0], state[1].copy(), state[2].copy()]
            for lo in range(0, len(labels), CHUNK):
                part = slice(lo, lo + CHUNK)
                for total, more in zip(slope, self._slope(state, places[part], labels[part], mask[part])):
                    total += more
            for k, (p, g) in enumerate(zip(state, slope)):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                p -= 0.3 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            state[0][DIMENSIONS] = 0
        self.weights, self.moves, self.first = state[0].astype(np.float32), state[1], state[2]

    @staticmethod
    def _slope(state, places, labels, mask):
        """What some segments add to the slope of the negative logarithm of the likelihood."""
        w, moves, start = state
        n_seg, length = labels.shape
        emission = w[places].sum(2)
        psi = np.stack([np.ones_like(emission), np.exp(np.clip(emission, -30, 30))], axis=2)
        m = np.exp(moves)
        alpha, beta = np.zeros((n_seg, length, 2)), np.ones((n_seg, length, 2))
        alpha[:, 0] = np.exp(start) * psi[:, 0]
        alpha[:, 0] /= alpha[:, 0].sum(1, keepdims=True)
        for t in range(1, length):
            a = (alpha[:, t - 1] @ m) * psi[:, t]
            alpha[:, t] = np.where(mask[:, t, None], a / a.sum(1, keepdims=True), alpha[:, t - 1])
        for t in range(length - 1, 0, -1):
            b = (beta[:, t] * psi[:, t]) @ m.T
            beta[:, t - 1] = np.where(mask[:, t, None], b / b.sum(1, keepdims=True), beta[:, t])
        marginal = alpha * beta
        marginal /= marginal.sum(2, keepdims=True)
        off = (marginal[:, :, 1] - labels) * mask
        g_w = np.bincount(places.reshape(-1), weights=np.repeat(off.reshape(-1), places.shape[2]), minlength=DIMENSIONS + 2)
        g_w[DIMENSIONS] = 0
        pair = alpha[:, :-1, :, None] * m * (psi * beta)[:, 1:, None, :]
        pair /= pair.sum((2, 3), keepdims=True)
        seen = np.zeros((2, 2))
        real = mask[:, 1:]
        np.add.at(seen, (labels[:, :-1][real], labels[:, 1:][real]), 1)
        g_m = (pair * real[:, :, None, None]).sum((0, 1)) - seen
        return g_w, g_m, marginal[:, 0].sum(0) - np.bincount(labels[:, 0], minlength=2)

    def marginals(self, emission: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Each token's probability of the toxic label; ``begins`` marks the first tokens of texts."""
        n = len(emission)
        if not n:
            return np.zeros(0)
        psi = np.stack([np.ones(n), np.exp(np.clip(emission.astype(np.float64), -30, 30))], axis=1)
        steps = np.exp(self.moves)[None] * psi[:, None, :]
        steps[begins] = (np.exp(self.first) * psi[begins])[:, None, :]
        alpha = _chain(steps, np.ones(2))
        back = np.ones((n, 2))
        back[:-1] = _chain(np.ascontiguousarray(steps[1:][::-1].transpose(0, 2, 1)), np.ones(2))[::-1]
        both = alpha * back
        return both[:, 1] / both.sum(1)


def _chain(steps: np.ndarray, start: np.ndarray, run: int = 64) -> np.ndarray:
    """Row vectors start * steps[0] * ... * steps[t] for each t, each scaled to sum 1: products within runs of
    matrices for all runs at once, then the same over the runs' products."""
    n = len(steps)
    if n <= run:
        out, v = np.empty((n, 2)), start
        for t in range(n):
            v = v @ steps[t]
            v = v / v.sum()
            out[t] = v
        return out
    runs = -(-n // run)
    padded = np.broadcast_to(np.eye(2), (runs * run, 2, 2)).copy()
    padded[:n] = steps
    padded = padded.reshape(runs, run, 2, 2)
    done = np.empty_like(padded)
    p = padded[:, 0]
    done[:, 0] = p
    for t in range(1, run):
        p = p @ padded[:, t]
        p = p / p.sum((1, 2), keepdims=True)
        done[:, t] = p
    before = np.vstack([start[None], _chain(np.ascontiguousarray(done[:, -1]), start, run)[:-1]])
    out = np.einsum("bi,blij->blj", before, done).reshape(-1, 2)[:n]
    return out / out.sum(1, keepdims=True)


def _segments(places: np.ndarray, labels: np.ndarray, per_doc: np.ndarray):
    """The texts in segments of SEGMENT tokens: ``places`` and ``labels`` by segment and token, and which are there."""
    cut = [
        (lo, min(lo + SEGMENT, int(per_doc[k + 1])))
        for k in range(len(per_doc) - 1)
        for lo in range(int(per_doc[k]), int(per_doc[k + 1]), SEGMENT)
    ]
    out_p = np.full((len(cut), SEGMENT, places.shape[1]), DIMENSIONS, dtype=np.int32)
    out_l = np.zeros((len(cut), SEGMENT), dtype=np.int8)
    mask = np.zeros((len(cut), SEGMENT), dtype=bool)
    for i, (a, b) in enumerate(cut):
        out_p[i, : b - a], out_l[i, : b - a], mask[i, : b - a] = places[a:b], labels[a:b], True
    return out_p, out_l, mask


def learn(documents: DataFrame, labels: DataFrame, toxic_sample: int = TOXIC_SAMPLE, clean_sample: int = CLEAN_SAMPLE) -> Field:
    """A field from ``documents`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``). The sample is drawn by a
    hash of the id, at a rate from each label's count; of equal texts one is used."""
    marks = (
        pick(labels, _id="doc_id", toxic="toxic")
        .where("_id is not null and toxic is not null")
        .groupBy("_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
    )
    docs = pick(documents, doc_id="doc_id", text="text").where("text is not null")
    counts = {r.toxic: r["count"] for r in marks.groupBy("toxic").count().collect()}
    field = Field()
    if len(counts) < 2:
        return field
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "_id"), F.lit(1 << 20)) / float(1 << 20)
    rate = F.when(F.col("toxic"), min(1.0, toxic_sample / counts[True])).otherwise(min(1.0, clean_sample / counts[False]))
    # About toxic_sample + clean_sample ids, whatever the data: broadcast, so that no text is shuffled for the join.
    drawn = F.broadcast(marks.where(draw < rate))
    rows = (
        docs.where(F.octet_length("text") <= SAMPLE_BYTES)
        .join(drawn, F.col("doc_id") == F.col("_id"))
        .select("toxic", "text")
        .groupBy("text")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy("text")
        .collect()
    )
    toxic = np.array([r.toxic for r in rows], dtype=bool)
    if not toxic.any() or toxic.all():
        return field
    texts = pa.array([r.text for r in rows], pa.string())
    del rows
    forms_of = []
    for _, data, offsets in shingles.blocks(texts):
        _, _, per_doc, forms = tokens(data, offsets)
        forms_of += [np.unique(forms[per_doc[k] : per_doc[k + 1], :-1]) for k in range(len(offsets) - 1)]
    telling, c, n, needed = telling_forms(forms_of, toxic)
    del forms_of
    if not len(telling):
        return field
    around = [[np.zeros((0, 2), dtype=np.uint64)], [np.zeros((0, 2), dtype=np.uint64)]]
    for first, data, offsets in shingles.blocks(texts):
        _, _, per_doc, forms = tokens(data, offsets)
        before, after = np.zeros((2, len(forms)), dtype=np.uint64)
        before[1:], after[:-1] = forms[:-1, 0], forms[1:, 0]
        full = np.diff(per_doc) > 0
        before[per_doc[:-1][full]], after[per_doc[1:][full] - 1] = 0, 0
        at = np.minimum(np.searchsorted(telling, forms[:, :-1]), len(telling) - 1)
        hit = (telling[at] == forms[:, :-1]) & np.repeat(toxic[first : first + len(offsets) - 1], np.diff(per_doc))[:, None]
        row, _ = np.nonzero(hit)
        for side, word in zip(around, (before, after)):
            side.append(np.unique(np.stack([at[hit].astype(np.uint64), word[row]], axis=1), axis=0))
    telling = spread_forms(telling, c, n, needed, [np.concatenate(side) for side in around])
    with_toxic, without = [], []
    # Enough segments for the draw below, without holding all of them.
    share = min(1.0, 2 * MOST_SEGMENTS * SEGMENT * 6 / max(1, texts.nbytes))
    rng = np.random.default_rng(0)
    for first, data, offsets in shingles.blocks(texts):
        _, _, per_doc, forms = tokens(data, offsets)
        of_toxic = np.repeat(toxic[first : first + len(offsets) - 1], np.diff(per_doc))
        marked = np.isin(forms[:, :-1], telling).any(1) & of_toxic
        # A toxic document in which nothing tells is no example of either label.
        known = np.add.reduceat(np.append(marked, False).astype(int), per_doc[:-1]) > 0 if len(marked) else np.zeros(0, bool)
        p, l, m = _segments(_places(forms), marked, per_doc)
        owner = np.repeat(np.arange(len(offsets) - 1), -(-np.diff(per_doc) // SEGMENT))
        bad = l.any(1)
        usable = ~toxic[first + owner] | known[owner]
        with_toxic.append((p[bad], l[bad], m[bad]))
        drawn = ~bad & usable & (rng.random(len(bad)) < share)
        without.append((p[drawn], l[drawn], m[drawn]))
    bad = [np.concatenate(x) for x in zip(*with_toxic)] if with_toxic else []
    if not bad or not len(bad[0]):
        return field
    # A draw: the texts are in order, so a cut would leave out whole scripts.
    if len(bad[0]) > MOST_SEGMENTS:
        drawn = np.sort(rng.permutation(len(bad[0]))[:MOST_SEGMENTS])
        bad = [x[drawn] for x in bad]
    other = [np.concatenate(x) for x in zip(*without)]
    keep = rng.permutation(len(other[0]))[: min(MOST_SEGMENTS, max(2000, CLEAN_SEGMENTS * len(bad[0])))]
    field.fit(*[np.concatenate([b, o[keep]]) for b, o in zip(bad, other)])
    return field


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))


def _score(field: Field):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("spans", _SPANS)])
    trained = bool(field.weights.any())

    def run(batches):
        for batch in batches:
            scores, spans = [np.zeros(0)], []
            for _, data, offsets in shingles.blocks(batch.column("text")):
                starts, ends, per_doc, forms = tokens(data, offsets)
                n = len(offsets) - 1
                score = np.zeros(n)
                found: list[list] = [[] for _ in range(n)]
                if len(starts) and trained:
                    full = np.flatnonzero(np.diff(per_doc) > 0)
                    begins = np.zeros(len(starts), dtype=bool)
                    begins[per_doc[full]] = True
                    p = field.marginals(field.emission(forms), begins)
                    score[full] = np.maximum.reduceat(p, per_doc[full])
                    hot = np.flatnonzero(p >= 0.5)
                    if len(hot):
                        chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                        doc = np.searchsorted(per_doc, hot, side="right") - 1
                        new = np.concatenate(([True], (np.diff(hot) > 1) | (np.diff(doc) > 0)))
                        for run_ in np.split(np.arange(len(hot)), np.flatnonzero(new)[1:]):
                            a, b, d = hot[run_[0]], hot[run_[-1]], doc[run_[0]]
                            zero = chars[offsets[d]]
                            found[d].append(
                                {"start": int(chars[starts[a]] - zero), "end": int(chars[ends[b]] - zero), "probability": float(p[a : b + 1].max())}
                            )
                scores.append(score)
                spans += found
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.clip(np.concatenate(scores), 0, 1)), pa.array(spans, _SPANS)], schema=schema
            )

    return run


def score(documents: DataFrame, field: Field) -> DataFrame:
    """Per row ``doc_id, score, spans``, from the text alone."""
    small_batches(documents.sparkSession)
    rows = pick(documents, doc_id="doc_id", text="text").select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(
        _score(field), "doc_id bigint, score double, spans array<struct<start: int, end: int, probability: double>>"
    )
