"""Alignment of two tokenizers' tokens over the same bytes, by lockstep vectorised merging.

Both tokenizers cut the bytes of a text (with a space before it) into tokens. Where a token of A and one of B end at the
same byte they are linked, and that byte is a cut: cuts divide the tokens into groups that cover the same bytes.

**Lockstep.** The texts of a batch are cut into lanes of ``LANE_BYTES`` bytes, so that a very long text is as many lanes
instead of one long one. One state vector holds the A and B pointers of all lanes. Each step compares the ends under all
pointers at once, emits links and cuts where they are equal, advances what is behind, and drops finished lanes from the
vector. The steps of a batch are bounded by the bytes of a lane.

**Counts.** How often a pair of ids is linked is counted over the whole corpus, pre-aggregated per text and per task.
Pairs with at least a 1/HOT_PAIRS share of all links, of which there can't be more than HOT_PAIRS, are broadcast; the
others are rare and go back to the texts by a shuffle, so no pair, however common, lands in one task.

The tokenizers are read from files that exist on every executor. A's merges are applied as ranks of its own vocabulary;
B's words are encoded once per task and remembered (at most CACHED of them), which is the same as encoding whole texts as
long as none of its pieces reaches over a space; otherwise whole texts are encoded.

Defined results: a text that is null or empty, or whose tokens don't give its bytes back, has no tokens: zeros and an
empty text of groups; rows that repeat an id, or have none, are rows of their own; an empty table gives an empty result;
other columns are ignored. A batch holds about ``BLOCK_BYTES`` of text, a longer text is a batch of its own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.llm.common import pick, small_batches
from demand_engine.llm.shingles import blocks
from demand_engine.session import cut_lineage

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: Fixed value: the pattern that belongs to A's vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LANE_BYTES = 1024
BLOCK_BYTES = 4_000_000
CACHED = 500_000
HOT_PAIRS = 500_000
#: Stands for a space in B's pieces.
SPACE = "▁"


class ByteTokens:
    """A: byte-level tokens of a vocabulary file."""

    def __init__(self, file: str):
        import json

        import tiktoken

        # Byte-level spelling: printable Latin-1 characters stand for themselves, the other bytes follow from U+0100 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte_of = {chr(b): b for b in plain}
        byte_of |= {chr(0x100 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
        with open(file, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items()}
        self.encoding = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.n = max(ranks.values()) + 1
        self.bytes = [b""] * self.n
        for token, i in ranks.items():
            self.bytes[i] = token

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self.encoding.encode_ordinary(" " + t), dtype=np.int64) for t in texts]


class PieceTokens:
    """B: pieces of a SentencePiece model, which puts a space before the text itself."""

    def __init__(self, file: str):
        import re

        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=file)
        self.n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.n)]
        as_byte = re.compile("<0x([0-9A-F]{2})>")
        self.bytes = [
            bytes([int(m[1], 16)]) if (m := as_byte.fullmatch(p)) else p.replace(SPACE, " ").encode() for p in pieces
        ]
        self.by_words = not any(SPACE in p.lstrip(SPACE) for p in pieces) and SPACE in pieces
        self.words = re.compile(" *[^ ]+| +")
        self.known: dict[str, np.ndarray] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_words:
            return [np.array(ids, dtype=np.int64) for ids in self.model.encode(texts, num_threads=1)]
        if len(self.known) > CACHED:
            self.known.clear()
        known, cut = self.known, []
        for t in texts:
            # A text that holds the sign for a space itself isn't given back anyway.
            cut.append(self.words.findall(" " + t) if SPACE not in t else None)
        new = list({w for ws in cut if ws for w in ws if w not in known})
        # The model puts the first space before each word; alone, it would be dropped.
        for w, ids in zip(new, self.model.encode([w[1:] for w in new], num_threads=1)):
            known[w] = np.array(ids if w != " " else [self.model.piece_to_id(SPACE)], dtype=np.int64)
        out = []
        for t, ws in zip(texts, cut):
            out.append(np.concatenate([known[w] for w in ws]) if ws else np.array(self.model.encode(t), dtype=np.int64))
        return out


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``a_ends`` and ``b_ends`` (ascending byte offsets) of equal ends, in order. ``cuts`` are the ascending
    bounds of the lanes: a lane takes the ends over its lower bound, up to its upper one."""
    i, j = np.searchsorted(a_ends, cuts, side="right"), np.searchsorted(b_ends, cuts, side="right")
    i, last_i, j, last_j = i[:-1], i[1:], j[:-1], j[1:]
    out_a, out_b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    while len(i):
        going = (i < last_i) & (j < last_j)
        if not going.all():
            i, last_i, j, last_j = i[going], last_i[going], j[going], last_j[going]
            if not len(i):
                break
        x, y = a_ends[i], b_ends[j]
        same = x == y
        out_a.append(i[same])
        out_b.append(j[same])
        i, j = i + (x <= y), j + (y <= x)
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    order = np.argsort(a)
    return a[order], b[order]


def _flat(rows: list[np.ndarray], lengths: np.ndarray):
    """All ids, their numbers per text, and their ends as offsets over all texts."""
    ids = np.concatenate([np.zeros(0, dtype=np.int64), *rows])
    return ids, np.array([len(x) for x in rows], dtype=np.int64), np.cumsum(lengths[ids])


def merged(texts: list[str], a, b, lane_bytes: int = LANE_BYTES):
    """The texts' tokens and links: ``(a_ids, a_n, b_ids, b_n, link_a, link_b)``, all texts after each other; a text that
    the tokens don't give back has none. ``a`` and ``b`` have ``encode(texts)`` and ``bytes``, by id."""
    whole = [(" " + t).encode() for t in texts]
    tokens = []
    for tokenizer in (a, b):
        spelled, rows = tokenizer.bytes, tokenizer.encode(texts)
        tokens.append([ids if b"".join([spelled[i] for i in ids.tolist()]) == w else None for ids, w in zip(rows, whole)])
    empty = np.zeros(0, dtype=np.int64)
    both = [(x, y) if x is not None and y is not None and t else (empty, empty) for x, y, t in zip(*tokens, texts)]
    sizes = [np.array([len(x) for x in t.bytes], dtype=np.int64) for t in (a, b)]
    a_ids, a_n, a_ends = _flat([x for x, _ in both], sizes[0])
    b_ids, b_n, b_ends = _flat([y for _, y in both], sizes[1])
    # Lanes begin with each text that has tokens and every so many bytes within it.
    ends = np.append(0, a_ends[np.cumsum(a_n)[a_n > 0] - 1])
    lanes = -(-np.diff(ends) // lane_bytes)
    inside = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    cuts = np.append(np.repeat(ends[:-1], lanes) + inside * lane_bytes, ends[-1])
    return a_ids, a_n, b_ids, b_n, *lockstep(a_ends, b_ends, cuts)


def group_texts(a_ids, a_n, b_ids, b_n, link_a, link_b, names_a: np.ndarray, names_b: np.ndarray) -> list[str]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3``. ``names``: decimal ids followed by a comma, then by the other sign."""
    a_cut, b_cut = np.zeros(len(a_ids), dtype=np.int64), np.zeros(len(b_ids), dtype=np.int64)
    a_cut[link_a], b_cut[link_b] = 1, 1
    a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
    # A group's A tokens stand after all tokens of earlier groups, its B tokens after them.
    b_before = np.searchsorted(b_group, a_group)
    a_before = np.searchsorted(a_group, b_group, side="right")
    signs = np.empty(len(a_ids) + len(b_ids), dtype=object)
    signs[np.arange(len(a_ids)) + b_before] = names_a[a_ids + a_cut * (len(names_a) // 2)]
    signs[np.arange(len(b_ids)) + a_before] = names_b[b_ids + b_cut * (len(names_b) // 2)]
    at = np.append(0, np.cumsum(a_n + b_n))
    return ["".join(signs[x:y].tolist())[:-1] for x, y in zip(at[:-1], at[1:])]


def _names(n: int, sign: str) -> np.ndarray:
    return np.array([f"{i}," for i in range(n)] + [f"{i}{sign}" for i in range(n)], dtype=object)


_LINK = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())])
_SCHEMA = pa.schema(
    [
        ("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
        ("n_links", pa.int64()), ("groups", pa.string()), ("links", pa.list_(_LINK)),
    ]
)
_DDL = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "links array<struct<a: int, b: int, n: int>>"
)


def _align(a_file: str, b_file: str, digest: bool):
    def run(batches):
        a, b = ByteTokens(a_file), PieceTokens(b_file)
        names_a, names_b = _names(a.n, "|"), _names(b.n, ";")
        for batch in batches:
            column = batch.column("text")
            for first, _, offsets in blocks(column, BLOCK_BYTES):
                n = len(offsets) - 1
                texts = [t or "" for t in column.slice(first, n).to_pylist()]
                a_ids, a_n, b_ids, b_n, link_a, link_b = merged(texts, a, b)
                groups = group_texts(a_ids, a_n, b_ids, b_n, link_a, link_b, names_a, names_b)
                if digest:
                    groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                # Links of one pair in one text are one entry.
                text_of = np.repeat(np.arange(n), a_n)[link_a]
                pair = a_ids[link_a] * b.n + b_ids[link_b]
                order = np.lexsort((pair, text_of))
                text_of, pair = text_of[order], pair[order]
                n_links = np.bincount(text_of, minlength=n)
                begins = np.ones(len(pair), dtype=bool)
                begins[1:] = (pair[1:] != pair[:-1]) | (text_of[1:] != text_of[:-1])
                begins = np.flatnonzero(begins)
                times, pair = np.diff(np.append(begins, len(pair))), pair[begins]
                per_text = np.append(0, np.cumsum(np.bincount(text_of[begins], minlength=n)))
                links = pa.StructArray.from_arrays(
                    [pa.array((pair // b.n).astype(np.int32)), pa.array((pair % b.n).astype(np.int32)), pa.array(times.astype(np.int32))],
                    fields=list(_LINK),
                )
                rows = [batch.column(k).slice(first, n) for k in ("row", "doc_id")]
                counts = [pa.array(x, pa.int64()) for x in (a_n, b_n, n_links, n_links)]
                lists = pa.ListArray.from_arrays(pa.array(per_text.astype(np.int32)), links)
                yield pa.RecordBatch.from_arrays([*rows, *counts, pa.array(groups, pa.string()), lists], schema=_SCHEMA)

    return run


def aligned(documents: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, digest: bool = False) -> DataFrame:
    """Per row, as a written table: ``row`` (its number), ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``groups`` (``a1,a2|b1;a3|b2,b3``, or the SHA-256 of that) and ``links``: the linked id pairs ``a, b`` with how
    often, ``n``. Every link is the end of a group, as no token is empty."""
    small_batches(documents.sparkSession)
    rows = pick(documents, doc_id="doc_id", text="text").select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint"), "text"
    )
    return cut_lineage(rows.mapInArrow(_align(a_file, b_file, digest), _DDL), "aligned")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``a, b, n, best`` over all ``rows`` (``aligned``): links of an id pair, and whether no pair of that b has more."""
    found = rows.select(F.explode("links").alias("l")).groupBy("l.a", "l.b").agg(F.sum("l.n").alias("n"))
    counted = cut_lineage(found, "pair-counts")
    # At most one row per id of B's vocabulary.
    most = counted.groupBy(F.col("b").alias("_b")).agg(F.max("n").alias("_most"))
    return counted.join(F.broadcast(most), F.col("b") == F.col("_b")).select("a", "b", "n", (F.col("n") == F.col("_most")).alias("best"))


def support(rows: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``row, n_best, count_sum`` of the ``rows`` (``aligned``) with links."""
    counts = cut_lineage(pair_counts(rows), "pair-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") * hot_pairs >= total)
    rare = counts.where(F.col("n") * hot_pairs < total)
    links = rows.select("row", F.explode("links").alias("l")).select("row", "l.a", "l.b", F.col("l.n").alias("times"))
    key = ["a", "b"]
    with_hot = links.join(F.broadcast(hot), key)
    with_rare = links.join(F.broadcast(hot.select(*key)), key, "left_anti").join(rare, key)
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    parts = [x.groupBy("row").agg(*sums) for x in (with_hot, with_rare)]
    return parts[0].union(parts[1]).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def with_support(rows: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``rows`` (``aligned``) without their links and numbers, with ``n_best``, how many links are their B id's most common,
    and ``count_sum``, the sum of their pairs' corpus-wide counts."""
    found = support(rows, hot_pairs).withColumnRenamed("row", "_row")
    zero = F.lit(0).cast("bigint")
    return (
        rows.drop("links")
        .join(found, F.col("row") == F.col("_row"), "left")
        .withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")})
        .drop("row", "_row")
    )
