"""Near-duplicate vectors: an exact self-join at a cosine threshold, by rotated subspaces and pigeonhole.

Unit vectors with a cosine of at least c lie within a squared distance of 2 (1 - c). They are rotated by one fixed random
rotation, so no block of coordinates is special, and split into blocks of about BLOCK_DIMENSIONS. Of two linked vectors at
least one block lies within its share of the squared distance, which is in proportion to its dimensions. So the links are
found by range joins in the blocks, and the union of what these find is verified by the cosine in double precision.

**Range join of a block.** A tree of median splits, fitted on a sample of TREE_SAMPLE vectors at most, divides a block's
space into leaves. Every vector is a member of one leaf and searches that one and, of the leaves further on, those within
reach; so a pair meets once in a block. Leaves with more than ``piece`` members or searchers are dealt into pieces, every
piece of one against every piece of the other: the sample only decides how evenly leaves are filled, never what is found.
A pair is counted in the first block that has it within its share, which is decided by the same sums, in the same order,
wherever the pair meets.

**Groups.** Equal vectors are one vector with a multiplicity. A task sums the links of each vector and keeps a spanning
forest of the links it found, so it returns no more rows than it read, however many pairs a group of near copies has.

Defined results: vectors that are null, zero, or hold null or a non-finite number link with nothing, and so do those of
another length than the most frequent one (of several, the longest); rows that repeat an id are vectors of their own; a
row without an id has links, and a null component if no row of it has an id; ties of the threshold are links; an empty
table gives an empty result; columns other than id and embedding are ignored. Equal vectors are told by 128 bits of hash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.llm.common import pick, small_batches
from demand_engine.llm.components import components
from demand_engine.session import cut_lineage

MIN_COSINE = 0.95
BLOCK_DIMENSIONS = 16
TREE_SAMPLE = 8192
#: Vectors a leaf should hold; sampled ones it holds at least; members or searchers of a piece at most, on average.
LEAF = 12_000
LEAST_SAMPLED = 32
PIECE = 16_000
SEED = 12
#: Searchers compared at a time, and pairs verified at a time.
ROWS, PAIRS = 256, 50_000
#: What rounding may add to a squared distance between unit vectors.
SLACK = 1e-5


def rotation(d: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def block_bounds(d: int, block_dimensions: int = BLOCK_DIMENSIONS) -> np.ndarray:
    n = max(1, round(d / block_dimensions))
    return np.round(np.linspace(0, d, n + 1)).astype(int)


def rotated(raw: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Unit vectors, rotated. Sums go coordinate by coordinate, so a vector gives the same numbers in any batch."""
    squares = np.zeros(len(raw))
    for j in range(raw.shape[1]):
        squares += raw[:, j] * raw[:, j]
    unit = raw / np.sqrt(squares)[:, None]
    out = np.zeros_like(unit)
    for j in range(raw.shape[1]):
        out += unit[:, j, None] * turn[j]
    return out


class Tree:
    """Median splits of points, ``axis, value`` per inner node; node i has the children 2i + 1 and 2i + 2."""

    def __init__(self, points: np.ndarray, levels: int):
        self.levels = levels
        self.axis = np.zeros(2**levels - 1, dtype=np.int64)
        self.value = np.zeros(2**levels - 1)
        inside = {0: points}
        for node in range(len(self.axis)):
            at = inside.pop(node)
            if len(at):
                self.axis[node] = axis = int(at.var(axis=0).argmax())
                self.value[node] = np.median(at[:, axis])
            left = at[:, self.axis[node]] < self.value[node]
            if node < len(self.axis) // 2:
                inside[2 * node + 1], inside[2 * node + 2] = at[left], at[~left]

    def leaves(self, points: np.ndarray, reach: float):
        """``member``: each point's leaf; ``who, leaf``: the leaves from that one on within a squared distance."""
        first = 2**self.levels - 1
        member = np.zeros(len(points), dtype=np.int64)
        who, node = np.arange(len(points)), np.zeros(len(points), dtype=np.int64)
        # What separates a point from a node, by coordinate: the farthest split crossed on the way.
        apart = np.zeros(points.shape)
        for _ in range(self.levels):
            x = points[np.arange(len(points)), self.axis[member]]
            member = 2 * member + 1 + (x >= self.value[member])
            axis = self.axis[node]
            gap = points[who, axis] - self.value[node]
            own = 2 * node + 1 + (gap >= 0)
            across = apart.copy()
            lines = np.arange(len(who))
            across[lines, axis] = np.maximum(across[lines, axis], np.abs(gap))
            near = (across * across).sum(1) <= reach + SLACK
            node = np.concatenate((own, (4 * node + 3 - own)[near]))
            who, apart = np.concatenate((who, who[near])), np.concatenate((apart, across[near]))
        on = node >= member[who]
        return member - first, who[on], node[on] - first


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Vectors from their bytes, each times a power of two that brings its largest number to about 1."""
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, d)
    return np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1, keepdims=True))[1]) if len(raw) else raw


#: What a row is to a leaf: its member, the same vector searching its own leaf, or one searching from an earlier leaf.
MEMBER, OWN, OTHER = 0, 1, 2
_ROUTED_DDL = "block int, leaf int, role int, rep bigint, times bigint, raw binary"


def _route(d: int, turn: np.ndarray, bounds: np.ndarray, trees: list[Tree], budget: float):
    schema = pa.schema(
        [("block", pa.int32()), ("leaf", pa.int32()), ("role", pa.int32()), ("rep", pa.int64()), ("times", pa.int64()), ("raw", pa.binary())]
    )

    def run(batches):
        for batch in batches:
            at = rotated(_matrix(batch.column("raw"), d), turn)
            for b, tree in enumerate(trees):
                lo, hi = bounds[b], bounds[b + 1]
                member, who, leaf = tree.leaves(at[:, lo:hi], budget * (hi - lo) / d)
                n, take = len(member) + len(who), pa.array(np.concatenate((np.arange(len(member)), who)))
                role = np.concatenate((np.full(len(member), MEMBER), np.where(leaf == member[who], OWN, OTHER)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, b, dtype=np.int32)),
                        pa.array(np.concatenate((member, leaf)).astype(np.int32)),
                        pa.array(role.astype(np.int32)),
                        *(batch.column(c).take(take) for c in ("rep", "times", "raw")),
                    ],
                    schema=schema,
                )

    return run


class Forest:
    """Labels of numbered nodes under links that come in parts: the smallest number of each component."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[i], label[j]
            apart = x != y
            if not apart.any():
                return
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                further = label[label]
                if (further == label).all():
                    break
                label[:] = further


def _search(d: int, turn: np.ndarray, bounds: np.ndarray, budget: float, min_cosine: float):
    schema = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("up", pa.int64())])

    def squared(x, y, b):
        total = np.zeros(len(x))
        for k in range(bounds[b], bounds[b + 1]):
            total += (x[:, k] - y[:, k]) ** 2
        return total

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        b = key[0].as_py()
        role = np.asarray(table.column("role"))
        rep, times = np.asarray(table.column("rep")), np.asarray(table.column("times"))
        raw = _matrix(table.column("raw"), d)
        at = rotated(raw, turn)
        lengths = np.sqrt(np.einsum("ij,ij->i", raw, raw))
        shares = [budget * (bounds[k + 1] - bounds[k]) / d + SLACK for k in range(b + 1)]
        members, searchers = np.flatnonzero(role == MEMBER), np.flatnonzero(role != MEMBER)
        # A vector may be here as a member and as a searcher: one node.
        nodes, node = np.unique(rep, return_inverse=True)
        n_links, forest = np.zeros(len(nodes), dtype=np.int64), Forest(len(nodes))
        near = at[:, bounds[b] : bounds[b + 1]].astype(np.float32)
        size = np.einsum("ij,ij->i", near, near)
        for begin in range(0, len(searchers), ROWS):
            q = searchers[begin : begin + ROWS]
            apart = size[q][:, None] + size[members] - 2 * (near[q] @ near[members].T)
            x, y = np.nonzero(apart <= shares[b] + 10 * SLACK)
            x, y = q[x], members[y]
            for part in range(0, len(x), PAIRS):
                i, j = x[part : part + PAIRS], y[part : part + PAIRS]
                # Within one leaf two vectors meet twice, either as member and as searcher.
                keep = (squared(at[i], at[j], b) <= shares[b]) & ((role[i] == OTHER) | (rep[i] < rep[j]))
                i, j = i[keep], j[keep]
                for earlier in range(b):
                    later = squared(at[i], at[j], earlier) > shares[earlier]
                    i, j = i[later], j[later]
                cosine = np.einsum("ij,ij->i", raw[i], raw[j]) / (lengths[i] * lengths[j])
                i, j = i[cosine >= min_cosine], j[cosine >= min_cosine]
                np.add.at(n_links, node[i], times[j])
                np.add.at(n_links, node[j], times[i])
                forest.link(node[i], node[j])
        found = np.flatnonzero(n_links)
        return pa.Table.from_arrays([pa.array(nodes[found]), pa.array(n_links[found]), pa.array(nodes[forest.label[found]])], schema=schema)

    return run


def vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, key, raw``, a row per vector: a hash of 128 bits and its numbers as doubles, both null where it links
    with nothing. As a written table."""
    small_batches(embeddings.sparkSession)
    rows = pick(embeddings, vec_id="vec_id", v="embedding").select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("v").cast("array<double>").alias("v")
    )
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    sizes = rows.where(usable).groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    usable = F.coalesce(usable & (F.size("v") == (most.d if most else 0)), F.lit(False))
    # Adding 0.0 makes -0.0 and 0.0 one number.
    v = F.when(usable, F.transform("v", lambda x: x + F.lit(0.0)))
    key = F.when(v.isNotNull(), F.struct(F.xxhash64(v).alias("h"), F.xxhash64(F.lit(1), v).alias("h2")))
    keyed = rows.select("vec_id", key.alias("key"), v.alias("v"))

    def pack(batches):
        schema = pa.schema([("vec_id", pa.int64()), ("h", pa.int64()), ("h2", pa.int64()), ("raw", pa.binary())])
        for batch in batches:
            raw = [None if x is None else np.array(x).tobytes() for x in batch.column("v").to_pylist()]
            columns = [batch.column(c) for c in ("vec_id", "h", "h2")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(raw, pa.binary())], schema=schema)

    flat = keyed.select("vec_id", "key.h", "key.h2", "v").mapInArrow(pack, "vec_id bigint, h bigint, h2 bigint, raw binary")
    return cut_lineage(flat, "vectors")


def _pieces(routed: DataFrame, counts: DataFrame, piece: int) -> DataFrame:
    """``routed`` with ``pm, pq``: the pieces of members and of searchers of their leaf that a row goes to."""
    sizes = counts.select(
        F.col("block").alias("_block"), F.col("leaf").alias("_leaf"), *[F.greatest(F.lit(1), F.ceil(F.col(c) / piece)).cast("int").alias(c) for c in ("nm", "nq")]
    )
    met = routed.join(F.broadcast(sizes), (F.col("block") == F.col("_block")) & (F.col("leaf") == F.col("_leaf")))
    member = F.col("role") == MEMBER
    drawn = F.pmod(F.xxhash64("rep"), F.when(member, F.col("nm")).otherwise(F.col("nq"))).cast("int")
    over = F.explode(F.sequence(F.lit(0), F.when(member, F.col("nq")).otherwise(F.col("nm")) - 1)).alias("over")
    dealt = met.select("block", "leaf", "role", "rep", "times", "raw", drawn.alias("drawn"), over)
    pm, pq = (F.when(x, F.col("drawn")).otherwise(F.col("over")) for x in (member, ~member))
    return dealt.select("block", "leaf", pm.alias("pm"), pq.alias("pq"), "role", "rep", "times", "raw")


def links(
    distinct: DataFrame, min_cosine: float = MIN_COSINE, block_dimensions: int = BLOCK_DIMENSIONS, leaf: int = LEAF, piece: int = PIECE
) -> DataFrame:
    """``rep, n, up`` of the vectors with links, several rows a vector: how many vectors it links with, copies counted, and
    one it is connected with. ``distinct`` is a written table of different vectors, ``rep, times, raw``."""
    sample = distinct.orderBy(F.xxhash64("rep"), "rep").limit(TREE_SAMPLE).collect()
    if not sample:
        return distinct.sparkSession.createDataFrame([], "rep bigint, n bigint, up bigint")
    d = len(sample[0].raw) // 8
    turn, bounds = rotation(d), block_bounds(d, block_dimensions)
    budget = max(0.0, 2 * (1 - min_cosine))
    wanted = max(0, math.ceil(math.log2(max(1, distinct.count() / leaf))))
    levels = min(wanted, int(math.log2(max(1, len(sample) / LEAST_SAMPLED))))
    at = rotated(_matrix(pa.array([bytes(r.raw) for r in sample]), d), turn)
    trees = [Tree(at[:, lo:hi], levels) for lo, hi in zip(bounds[:-1], bounds[1:])]
    routed = distinct.mapInArrow(_route(d, turn, bounds, trees, budget), _ROUTED_DDL)
    member = F.col("role") == MEMBER
    counts = routed.groupBy("block", "leaf").agg(F.count_if(member).alias("nm"), F.count_if(~member).alias("nq"))
    # A row per leaf of trees that a bounded sample was fitted to.
    dealt = _pieces(routed, cut_lineage(counts, "vector-leaves"), piece)
    return dealt.groupBy("block", "leaf", "pm", "pq").applyInArrow(
        _search(d, turn, bounds, budget, min_cosine), "rep bigint, n bigint, up bigint"
    )


def near_duplicates(
    embeddings: DataFrame, min_cosine: float = MIN_COSINE, block_dimensions: int = BLOCK_DIMENSIONS, leaf: int = LEAF, piece: int = PIECE
) -> DataFrame:
    """Per row ``vec_id, n_links, component_id, kept``: how many other vectors it links with, the smallest id reachable
    over links, and whether that is its own."""
    rows = vectors(embeddings)
    groups = rows.where("raw is not null").groupBy("h", "h2").agg(
        F.count(F.lit(1)).alias("times"), F.min("vec_id").alias("least"), F.first("raw").alias("raw")
    )
    distinct = cut_lineage(groups.withColumn("rep", F.monotonically_increasing_id()), "distinct-vectors")
    found = cut_lineage(links(distinct.select("rep", "times", "raw"), min_cosine, block_dimensions, leaf, piece), "vector-links")
    labels = components(found.select(F.col("rep").alias("a"), F.col("up").alias("b")))
    sums = found.groupBy("rep").agg(F.sum("n").alias("n"))
    placed = (
        distinct.drop("raw")
        .join(sums.withColumnRenamed("rep", "_rep"), F.col("rep") == F.col("_rep"), "left")
        .join(labels, F.col("rep") == F.col("id"), "left")
        .select("h", "h2", "least", F.coalesce("component", "rep").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n"))
    )
    placed = cut_lineage(placed, "vector-components")
    least = placed.groupBy(F.col("component").alias("_component")).agg(F.min("least").alias("component_id"))
    known = placed.join(least, F.col("component") == F.col("_component")).select(
        F.col("h").alias("_h"), F.col("h2").alias("_h2"), "n", "component_id"
    )
    alone = F.col("h").isNull()
    return (
        rows.drop("raw")
        .join(known, (F.col("h") == F.col("_h")) & (F.col("h2") == F.col("_h2")), "left")
        .select(
            "vec_id",
            F.coalesce("n", F.lit(0).cast("bigint")).alias("n_links"),
            F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
