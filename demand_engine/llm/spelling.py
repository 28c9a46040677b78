"""Spelling variants: words that differ by one inserted, deleted or replaced code point, found by a trie of letter counts.

A word's frequency vector counts its code points by letter group, one level of the trie after the other (LEVELS).
One edit adds a code point to one group, takes one from another, or both, so a near word's vector is reached with a
surplus and a deficit of one each. Every word goes down the trie depth first with that budget, and the words of the
leaves it reaches are verified letter by letter.

**Distribution.** The trie is cut below the shallowest nodes that hold ``shard_words`` words or fewer: a node with more
is opened one level further, so a shard is bounded however large the vocabulary. Words go down the upper levels as joins
with the nodes of a level, and inside a shard on a sorted table of its nodes. The words that search a shard are dealt
into blocks, each with the shard's words, as a small shard may lie next to large ones. A block returns one row per
searching word, its number of near words and the best of them, never pairs.

**One way.** Of two near words with different vectors only one searches for the other: that for which the first group
they differ in is a surplus. So a deficit is spent only after the surplus, half as many nodes are reached, and a block
credits the pair to both words. Words with the same vector search for each other.

Counts are pre-aggregated per task, so a word that a third of all texts consist of moves one row a task.

Defined results: a null or empty text has no runs; words are compared by code points within A-Z, a-z and U+00C0 to
U+00FF, of which only A-Z are lower-cased; rows that repeat an id or a text count each; a null id is the empty string in
``runs``; ties between near words of one count go to the smaller word; very long runs are words like others; an empty
table gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demand_engine.llm.common import lower_ascii, pick
from demand_engine.session import cut_lineage

MIN_CHARS = 7
MIN_COUNT = 2
#: How many times a word's count its form has at least.
FACTOR = 10
#: Letter groups by level: frequent letters alone, rarer ones together, then what lies beyond ASCII.
LEVELS = (
    *"eainrtosludcmpg", "hj", "bq", "fv", "kwx", "yz",
    "".join(map(chr, range(0xC0, 0xE0))), "".join(map(chr, range(0xE0, 0xF0))), "".join(map(chr, range(0xF0, 0x100))),
)
#: Levels that every shard spans; words a shard holds at most, where more levels can tell them apart; searching words
#: a block holds on average at most.
FIRST_LEVELS = 3
SHARD_WORDS = 20_000
BLOCK_WORDS = 60_000
#: Words below which a node is verified as it is, and entries of the search handled at a time.
LEAF_WORDS = 8
CHUNK = 16_384
#: Words up to this long are compared many at a time.
WIDTH = 32

_LEVEL_OF = np.zeros(256, dtype=np.int64)
for _level, _letters in enumerate(LEVELS):
    for _letter in _letters:
        _LEVEL_OF[ord(_letter)] = _level


def runs(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id`` (as text), ``run``: every maximal run of letters of at least ``min_chars``, lower-cased."""
    found = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(f"[a-z\\u00C0-\\u00FF]{{{min_chars},}}"), F.lit(0))
    rows = pick(documents, doc_id="doc_id", text="text")
    return rows.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(found).alias("run"))


def vocabulary(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words (``word``, one row per occurrence) long and frequent enough."""
    counted = words.where(F.char_length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def frequency(level: int) -> Column:
    """How many letters of the level's group ``word`` has."""
    if len(LEVELS[level]) == 1 and LEVELS[level].isascii():
        return F.octet_length("word") - F.octet_length(F.replace("word", F.lit(LEVELS[level]), F.lit("")))
    return F.char_length("word") - F.char_length(F.translate("word", LEVELS[level], ""))


def _one_level(entries: DataFrame, level: int, one_way: bool) -> DataFrame:
    """``entries`` (``node, more, less`` besides the word) one level further down: as many of that letter group, one
    more against the surplus, one fewer against the deficit. ``one_way``: the surplus, once spent, allows the deficit."""
    c, node = F.col("c"), F.col("node")

    def child(count, more, less):
        return F.struct(F.concat(node, F.array(count)).alias("node"), more.alias("more"), less.alias("less"))

    ways = F.array(
        child(c, F.col("more"), F.col("less")),
        F.when(F.col("more") > 0, child(c + 1, F.col("more") - 1, F.lit(1) if one_way else F.col("less"))),
        F.when((F.col("less") > 0) & (c > 0), child(c - 1, F.col("more"), F.col("less") - 1)),
    )
    counted = entries.withColumn("c", frequency(level))
    return counted.withColumn("way", F.explode(F.array_compact(ways))).select("word", "n", "way.*")


class Trie:
    """The frequency vectors of some words as sorted tables of nodes, one per level."""

    def __init__(self, counts: np.ndarray):
        self.order = np.lexsort(counts.T[::-1])
        self.counts = counts[self.order]
        node = np.zeros(len(counts), dtype=np.int64)
        self.keys, self.first, self.last = [None], [np.zeros(1, dtype=np.int64)], [np.array([len(counts)])]
        for level in range(counts.shape[1]):
            key = (node << 32) | self.counts[:, level].astype(np.int64)
            begins = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            self.keys.append(key[begins])
            self.first.append(begins)
            self.last.append(np.append(begins[1:], len(key)))
            node = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(key))))

    def _child(self, level: int, node: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Numbers of the children with these counts, -1 where there is none."""
        keys = self.keys[level + 1]
        key = (node << 32) | count
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, at, -1)

    def search(self, queries: np.ndarray, one_way: bool = False):
        """``query, word`` numbers of all words within a surplus and a deficit of one, chunk by chunk, depth first;
        with ``one_way`` those without a difference and those whose first difference is the surplus."""
        n_levels = self.counts.shape[1]
        for begin in range(0, len(queries), CHUNK):
            q = np.arange(begin, min(begin + CHUNK, len(queries)))
            one = np.ones(len(q), dtype=np.int8)
            stack = [(0, q, np.zeros(len(q), dtype=np.int64), one, np.zeros_like(one) if one_way else one)]
            while stack:
                level, q, node, more, less = stack.pop()
                if len(q) > CHUNK:
                    half = len(q) // 2
                    stack += [(level, *(x[:half] for x in (q, node, more, less))), (level, *(x[half:] for x in (q, node, more, less)))]
                    continue
                first, last = self.first[level][node], self.last[level][node]
                leaf = (last - first <= LEAF_WORDS) | (level == n_levels)
                if leaf.any():
                    yield from self._within(queries, q[leaf], first[leaf], last[leaf], one_way)
                    q, node, more, less = (x[~leaf] for x in (q, node, more, less))
                if not len(q):
                    continue
                c = queries[q, level]
                found = []
                for rows, step in ((np.arange(len(q)), 0), (np.flatnonzero(more > 0), 1), (np.flatnonzero((less > 0) & (c > 0)), -1)):
                    child = self._child(level, node[rows], c[rows] + step)
                    rows, child = rows[child >= 0], child[child >= 0]
                    left = np.ones_like(less[rows]) if one_way and step > 0 else less[rows] - (step < 0)
                    found.append((q[rows], child, more[rows] - (step > 0), left))
                stack.append((level + 1, *(np.concatenate(x) for x in zip(*found))))

    def _within(self, queries, q, first, last, one_way):
        """Pairs of the queries with the words of their nodes whose whole vectors keep to the budget."""
        size = last - first
        each = max(1, CHUNK // max(1, int(size.max())))
        for k in range(0, len(q), each):
            n = size[k : k + each]
            who = np.repeat(q[k : k + each], n)
            word = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[k : k + each], n)
            apart = self.counts[word] - queries[who]
            fits = np.flatnonzero((np.maximum(apart, 0).sum(1) <= 1) & (np.minimum(apart, 0).sum(1) >= -1))
            if one_way:
                begins = np.argmax(apart[fits] != 0, axis=1)
                fits = fits[apart[fits, begins] >= 0]
            yield who[fits], self.order[word[fits]]


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether exactly one inserted, deleted or replaced byte (a code point of Latin-1) leads from a to b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i, n = 0, len(a)
    while i < n and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


class Letters:
    """Words as rows of bytes, from the left and from the right, for comparing many pairs at a time."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.lengths = np.array([len(w) for w in words], dtype=np.int64)
        short = [w if len(w) <= WIDTH else b"" for w in words]
        self.left, self.right = (
            np.array(x, dtype=f"S{WIDTH}").view(np.uint8).reshape(len(x), WIDTH) for x in (short, [w[::-1] for w in short])
        )

    def one_edit(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which of the pairs of word numbers are one edit apart."""
        long, short = self.lengths[x], self.lengths[y]
        width = min(WIDTH, int(max(long.max(initial=1), short.max(initial=1))))
        apart = self.left[x, :width] != self.left[y, :width]
        out = (long == short) & (apart.sum(1) == 1)
        # With a length apart by one, beginning and end in common have to cover the shorter word.
        lines = np.flatnonzero(np.abs(long - short) == 1)
        end = self.right[x[lines], :width] != self.right[y[lines], :width]
        covered = np.argmax(apart[lines], axis=1) + np.argmax(end, axis=1)
        out[lines] = covered >= np.minimum(long[lines], short[lines])
        for k in np.flatnonzero(np.maximum(long, short) > WIDTH):
            out[k] = one_edit(self.words[x[k]], self.words[y[k]])
        return out


def _vectors(words: list[bytes]) -> np.ndarray:
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    level = _LEVEL_OF[np.frombuffer(b"".join(words), dtype=np.uint8)]
    flat = np.repeat(np.arange(len(words)), lengths) * len(LEVELS) + level
    return np.bincount(flat, minlength=len(words) * len(LEVELS)).reshape(len(words), len(LEVELS)).astype(np.int32)


def _search_block(table: pa.Table) -> pa.Table:
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
    words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    counts, inside = np.asarray(table.column("n")), np.asarray(table.column("inside"))
    # Both in the order of preference, so that the best near word is the one with the smallest number.
    members, queries = (
        rows[sorted(range(len(rows)), key=lambda k: (-counts[rows[k]], words[rows[k]]))]
        for rows in (np.flatnonzero(inside), np.flatnonzero(~inside))
    )
    out = []
    if len(members) and len(queries):
        vectors, letters = _vectors(words), Letters(words)
        of_query, of_member = ((np.zeros(len(x), dtype=np.int64), np.full(len(x), len(y))) for x, y in ((queries, members), (members, queries)))
        for who, word in Trie(vectors[members]).search(vectors[queries], one_way=True):
            near = letters.one_edit(queries[who], members[word])
            who, word = who[near], word[near]
            back = (vectors[queries[who]] != vectors[members[word]]).any(axis=1)
            for (n_near, first), x, y in ((of_query, who, word), (of_member, word[back], who[back])):
                np.add.at(n_near, x, 1)
                np.minimum.at(first, x, y)
        for (n_near, first), x, y in ((of_query, queries, members), (of_member, members, queries)):
            found = np.flatnonzero(n_near)
            out.append((x[found], n_near[found], y[first[found]]))
    word, n_near, best = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, dtype=np.int64),) * 3
    column = table.column("word")
    return pa.Table.from_arrays(
        [column.take(pa.array(word)), pa.array(n_near), pa.array(counts[best], pa.int64()), column.take(pa.array(best))],
        schema=schema,
    )


def shards(words: DataFrame, shard_words: int = SHARD_WORDS, one_way: bool = False) -> tuple[DataFrame, DataFrame]:
    """Members and searchers of the shards: ``node, word, n`` each. ``words`` has ``word, n``. Every word searches the
    shards of all that may be near it; with ``one_way`` only one of two such words does, as ``Trie.search`` has it."""
    depth = FIRST_LEVELS
    inside = words.select("word", "n", F.array(*map(frequency, range(depth))).alias("node"))
    searching = words.select(
        "word", "n", F.array().cast("array<int>").alias("node"), F.lit(1).alias("more"), F.lit(0 if one_way else 1).alias("less")
    )
    for level in range(depth):
        searching = _one_level(searching, level, one_way)
    members, searchers = [], []
    while True:
        sizes = cut_lineage(inside.groupBy("node").agg(F.count(F.lit(1)).alias("size")), "spelling-nodes")
        fits = (F.col("size") <= shard_words) | F.lit(depth == len(LEVELS))
        closed, open_nodes = sizes.where(fits).select("node"), sizes.where(~fits).select("node")
        members.append(inside.join(closed, "node", "left_semi").select("node", "word", "n"))
        searchers.append(searching.join(closed, "node", "left_semi").select("node", "word", "n"))
        if open_nodes.isEmpty():
            break
        deeper = inside.join(open_nodes, "node", "left_semi").withColumn("node", F.concat("node", F.array(frequency(depth))))
        further = _one_level(searching.join(open_nodes, "node", "left_semi"), depth, one_way)
        inside, searching = cut_lineage(deeper, "spelling-inside"), cut_lineage(further, "spelling-searching")
        depth += 1
    for rows in (members, searchers):
        while len(rows) > 1:
            rows.append(rows.pop().union(rows.pop()))
    return members[0], searchers[0]


def near_words(vocabulary: DataFrame, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, n_near, best, best_n`` of the words of ``word, n`` that have near words; best is the most frequent."""
    members, searchers = shards(vocabulary, shard_words, one_way=True)
    searchers = cut_lineage(searchers, "spelling-searchers")
    blocks = searchers.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / block_words).cast("int").alias("blocks"))
    blocks = cut_lineage(blocks, "spelling-blocks")
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    dealt = searchers.join(blocks, "node").select("node", block.alias("block"), "word", "n", F.lit(False).alias("inside"))
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    copied = members.join(blocks, "node").select("node", each.alias("block"), "word", "n", F.lit(True).alias("inside"))
    found = dealt.union(copied).groupBy("node", "block").applyInArrow(
        _search_block, "word string, n_near bigint, best_n bigint, best string"
    )
    best = F.min(F.struct((-F.col("best_n")).alias("minus_n"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("b.best").alias("best"), (-F.col("b.minus_n")).alias("best_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the end of the chain of forms, by pointer jumping. A form is more frequent
    by a factor, so chains end and have few links; each round halves them and the driver reads one flag a round."""
    ups = cut_lineage(forms.select("word", F.col("form").alias("up")), "spelling-roots")
    while True:
        further = ups.select(F.col("word").alias("_at"), F.col("up").alias("_further"))
        jumped = ups.join(further, F.col("up") == F.col("_at"), "left")
        found = cut_lineage(
            jumped.select("word", F.coalesce("_further", "up").alias("up"), F.col("_further").isNotNull().alias("moved")),
            "spelling-roots",
        )
        ups = found.select("word", "up")
        if found.where("moved").isEmpty():
            return ups.withColumnRenamed("up", "root")


def group_variants(
    vocabulary: DataFrame, factor: int = FACTOR, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Per word of ``word, n``: ``word, form, root, n, n_near, form_n``. The form is the most frequent near word, if it
    is ``factor`` times as frequent; the root is where following forms ends."""
    counted = cut_lineage(vocabulary.select("word", F.col("n").cast("bigint")), "spelling-vocabulary")
    near = near_words(counted, shard_words, block_words).withColumnRenamed("word", "_word")
    has_form = F.col("best_n") >= factor * F.col("n")
    placed = cut_lineage(
        counted.join(near, F.col("word") == F.col("_word"), "left").select(
            "word",
            F.when(has_form, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(has_form, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(placed.where("form is not null").select("word", "form")).withColumnRenamed("word", "_word")
    return placed.join(ends, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
