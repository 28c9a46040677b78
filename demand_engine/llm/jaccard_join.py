"""Exact set join of documents on word shingles at a Jaccard threshold, by universe partition and pigeonhole.

**Partition.** Shingle hashes are the universe. A size band [L, 2L) cuts it into m segments by value; a
document's subset of one segment is hashed to a signature. Documents whose smallest partner falls into the
band below sign there too, so every pair that can link shares a band. Two linked sets of sizes s and t differ
in at most D = (s + t)(1 - j) / (1 + j) shingles, hence in at most D segments.

**Cost-based allocation.** Of the signatures of a document only the D + 1 with the fewest owners over the
whole corpus are indexed (ties by value). One order holds for all documents, so if two sets agree on all but
D of their non-empty segments, the chosen signatures of both share one: segments that many documents share,
of a passage or a license line, are left out wherever rarer ones suffice, and a document with more than D
signatures of its own needs none at all. A document with too few non-empty segments for the argument makes its
whole band sign with finer segments, down to single shingles; that is looked up after signing, not assumed.

**One-deletion neighbourhoods.** Sets of under 8 shingles differ by one shingle at most. They are one segment,
indexed whole and with each shingle left out.

**No pair explosion.** Signatures link documents to the smallest owner first. Verified links give components,
and only owners of one signature that are still in different components are compared with each other, after
the size bound and a bound from 512-bit parity sketches (each differing bit is a differing shingle).

**Verification** compares the shingle sets of the texts. Sets are held as 64-bit hashes.

A signature's owners meet in one task only to be counted, as a spillable window over rows of a few numbers;
copies of one text are left out of that per task, and reduced to one document before anything is compared.

Defined results: a null text or one without words has no shingles and links with nothing; fewer words than a
shingle make one shingle of them all; rows that repeat an id are one document that links by any of its texts,
and each row is returned with its own ``n_shingles``; rows without an id link with nothing and have a null
component; an empty table gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demand_engine.llm import shingles
from demand_engine.llm.common import pick, small_batches
from demand_engine.llm.components import components
from demand_engine.session import cut_lineage

SHINGLE = 5
#: The threshold as a fraction: 100 * intersection >= 80 * union.
PER_CENT = 80
TINY = 8
SKETCH_LONGS = 8
#: Ids of this many candidates or fewer are broadcast when their texts are fetched; more are shuffled.
BROADCAST_IDS = 1_000_000


def most_different(s: int, t: int, per_cent: int) -> int:
    """The largest symmetric difference of linked sets of sizes s and t."""
    return (s + t) * (100 - per_cent) // (100 + per_cent)


def segments(band: int, level: int, per_cent: int) -> int:
    """How many segments the band [band, 2 * band) has at a level of refinement; 0: one per shingle."""
    if level >= 3:
        return 0
    upper = 2 * band
    needed = most_different(upper, upper * 100 // per_cent, per_cent) + 1
    return (4 * upper if upper <= 128 else int(1.3 * needed) + 1) * 4**level


def document_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a document with these word hashes."""
    if not len(hashes):
        return np.zeros(0, dtype=np.uint64)
    if len(hashes) < size:
        return shingles.mix(shingles.shingle_hashes(hashes, len(hashes)) + np.uint64(len(hashes)))
    return np.unique(shingles.shingle_hashes(hashes, size))


def signatures(values: np.ndarray, band: int, m: int) -> np.ndarray:
    """A signature for each non-empty segment of sorted ``values``; m = 0: for each value."""
    tag = np.uint64(band * 1_000_003 + m)
    if m == 0:
        return shingles.mix(values + shingles.mix(np.array([tag]))[0])
    segment = ((values >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
    return shingles.mix(np.add.reduceat(shingles.mix(values), first) + shingles.mix(segment[first] * _SPREAD + tag))


_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def neighbourhood(values: np.ndarray) -> np.ndarray:
    """Signatures of a set and of the set without each one of its values."""
    scrambled = shingles.mix(values)
    total = np.add.reduce(scrambled)
    parts = np.concatenate(([total], total - scrambled)) if len(values) > 1 else np.array([total])
    return shingles.mix(parts + np.uint64(7))


def bands_of(s: int, per_cent: int):
    """``band, own, needed``: the bands a set of size s signs in, and how many signatures decide there."""
    if s < TINY:
        yield 0, True, None
        return
    band = 1 << (s.bit_length() - 1)
    yield band, True, most_different(s, s * 100 // per_cent, per_cent) + 1
    if s * per_cent <= 100 * (band - 1):
        below = band // 2 if band > TINY else 0
        yield below, False, most_different(s, band - 1, per_cent) + 1 if below else None


def sketch(values: np.ndarray) -> np.ndarray:
    bits = np.bincount((values & np.uint64(64 * SKETCH_LONGS - 1)).astype(np.int64), minlength=64 * SKETCH_LONGS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


_INFO = pa.struct(
    [
        ("s", pa.int32()),
        ("digest", pa.int64()),
        ("digest2", pa.int64()),
        ("needed", pa.int32()),
        ("made", pa.int32()),
        ("band", pa.int32()),
        ("sketch", pa.list_(pa.int64())),
    ]
)
_SIGNED = pa.schema([("sig", pa.int64()), ("doc_id", pa.int64()), ("own", pa.bool_()), ("info", _INFO)])
_SIGNED_DDL = (
    "sig bigint, doc_id bigint, own boolean, info struct<s: int, digest: bigint, digest2: bigint, needed: int, "
    "made: int, band: int, sketch: array<bigint>>"
)


def _sign(levels: dict[int, int], size: int, per_cent: int):
    """Rows of signatures, and one row with ``info`` per document and band."""

    def run(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, data, offsets in shingles.blocks(batch.column("text")):
                _, _, hashes, per_doc = shingles.words(data, offsets, shingles.NOT_SPACE)
                sigs, counts, docs, own, info = [], [], [], [], []
                for k in range(len(offsets) - 1):
                    words = hashes[per_doc[k] : per_doc[k + 1]]
                    values = document_set(words, size)
                    s = len(values)
                    # The sequence of words, in order, as two numbers: equal documents.
                    order = np.arange(1, len(words) + 1, dtype=np.uint64)
                    digest = int(np.add.reduce(shingles.mix(words + order * _SPREAD)).astype(np.int64))
                    digest2 = int(np.add.reduce(shingles.mix(words ^ (order << np.uint64(17)))).astype(np.int64))
                    known = (digest, digest2) in seen
                    seen.add((digest, digest2))
                    for band, is_own, needed in bands_of(s, per_cent) if s else ((-1, True, 0),):
                        if not s:
                            made = sigs_here = np.zeros(0, dtype=np.uint64)
                        elif band == 0:
                            made = neighbourhood(values)
                            needed = len(made)
                            sigs_here = made
                        else:
                            made = signatures(values, band, segments(band, levels.get(band, 0), per_cent))
                            sigs_here = made
                        if known:
                            sigs_here = sigs_here[:0]
                        row_key = shingles.mix(np.array([digest ^ int(ids[first + k]), 0], dtype=np.int64).astype(np.uint64))[:1]
                        sigs.append(row_key)
                        sigs.append(sigs_here)
                        counts.append(len(sigs_here))
                        docs.append(ids[first + k])
                        own.append(is_own)
                        info.append(
                            {
                                "s": s,
                                "digest": digest,
                                "digest2": digest2,
                                "needed": needed,
                                "made": len(made),
                                "band": band,
                                "sketch": sketch(values) if is_own else None,
                            }
                        )
                counts = np.array(counts, dtype=np.int64) + 1
                at = np.concatenate(([0], np.cumsum(counts)[:-1]))
                total = int(counts.sum())
                take = np.full(total, -1, dtype=np.int64)
                take[at] = np.arange(len(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(sigs).view(np.int64)),
                        pa.array(np.repeat(np.array(docs, dtype=np.int64), counts)),
                        pa.array(np.repeat(np.array(own, dtype=bool), counts)),
                        pa.array(info, _INFO).take(pa.array(take, mask=take < 0)),
                    ],
                    schema=_SIGNED,
                )

    return run


def _signed(docs: DataFrame, size: int, per_cent: int) -> DataFrame:
    """``sig, doc_id, own, info, n`` of all info rows and of signatures with two owners or more, as a written
    table; bands with a document that has too few signatures are refined until none has."""
    levels: dict[int, int] = {}
    while True:
        rows = docs.mapInArrow(_sign(levels, size, per_cent), _SIGNED_DDL)
        counted = rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("sig")))
        written = cut_lineage(counted.where("n > 1 or info is not null"), "signatures")
        short = written.where("info.made < info.needed").select("info.band").distinct().collect()
        if not short:
            return written
        for (band,) in short:
            levels[band] = levels.get(band, 0) + 1


def _verify(size: int, per_cent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def sets(column):
        out = []
        for _, data, offsets in shingles.blocks(column):
            _, _, hashes, per_doc = shingles.words(data, offsets, shingles.NOT_SPACE)
            out += [document_set(hashes[per_doc[k] : per_doc[k + 1]], size) for k in range(len(offsets) - 1)]
        return out

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(sets(batch.column("text_a")), sets(batch.column("text_b"))):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= per_cent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], schema=schema).filter(pa.array(keep, pa.bool_()))

    return run


def verified(pairs: DataFrame, texts: DataFrame, size: int = SHINGLE, per_cent: int = PER_CENT) -> DataFrame:
    """Those of the pairs ``a, b`` whose texts (``doc_id, text``) reach the threshold, as a written table."""
    ids = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "candidates")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    wanted = texts.join(ids, "doc_id", "left_semi")
    with_texts = (
        pairs.join(wanted.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(wanted.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    return cut_lineage(with_texts.mapInArrow(_verify(size, per_cent), "a bigint, b bigint").distinct(), "links")


def _may_link(per_cent: int) -> Column:
    """Size bound and sketch bound on the columns of owners x and y."""
    s, t = F.col("x.s"), F.col("y.s")
    size_bound = F.least(s, t) * 100 >= F.greatest(s, t) * per_cent
    differing = sum(
        (F.bit_count(F.col("x.sketch")[k].bitwiseXOR(F.col("y.sketch")[k])) for k in range(SKETCH_LONGS)), F.lit(0)
    )
    # Null, for an id with several texts, decides nothing.
    return F.coalesce(size_bound & (differing * (100 + per_cent) <= (s + t) * (100 - per_cent)), F.lit(True))


def links(documents: DataFrame, size: int = SHINGLE, per_cent: int = PER_CENT) -> tuple[DataFrame, DataFrame]:
    """``documents`` as ``doc_id, n_shingles, rep``, rep being the smallest id with the same words in the same
    order, and links ``a, b`` between different reps that span all components."""
    small_batches(documents.sparkSession)
    docs = pick(documents, doc_id="doc_id", text="text").where("doc_id is not null")
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    signed = _signed(docs, size, per_cent)

    info = signed.where("info is not null").select("doc_id", "own", "info.*")
    reps = info.where("own").groupBy("digest", "digest2").agg(F.min("doc_id").alias("rep"))
    nodes = info.where("own").join(reps, ["digest", "digest2"]).select("doc_id", "s", "rep")

    # The chosen signatures of each rep: the rarest, as many as decide.
    shared = signed.where("info is null").select("doc_id", "own", "sig", "n")
    per_doc = info.join(reps, ["digest", "digest2"]).select("doc_id", "own", "rep", "s", "needed", "made")
    owners = (
        shared.join(per_doc, ["doc_id", "own"])
        .groupBy("rep", "own", "s", "needed", "made")
        .agg(F.array_sort(F.collect_set(F.struct("n", "sig"))).alias("sigs"))
        .withColumn("take", F.col("needed") - (F.col("made") - F.size("sigs")))
        .where("take > 0")
        .select("rep", "s", F.explode(F.expr("slice(sigs, 1, take)")).alias("e"))
        .select("e.sig", "rep", "s")
        .distinct()
    )
    owners = cut_lineage(owners, "owners")
    several = owners.groupBy("sig").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    hubs = (
        several.select("sig", "a")
        .join(owners, "sig")
        .where("a <> rep")
        .select("a", F.col("rep").alias("b"))
        .distinct()
    )
    one_text = F.min("digest") == F.max("digest")
    sketches = info.where("own").groupBy("doc_id").agg(
        F.when(one_text, F.first("s")).alias("s"), F.when(one_text, F.first("sketch")).alias("sketch")
    )

    def plausible(pairs: DataFrame) -> DataFrame:
        one = sketches.select(F.col("doc_id").alias("a"), F.struct("s", "sketch").alias("x"))
        two = sketches.select(F.col("doc_id").alias("b"), F.struct("s", "sketch").alias("y"))
        return pairs.join(one, "a").join(two, "b").where(_may_link(per_cent)).select("a", "b")

    first_pairs = cut_lineage(plausible(hubs), "pairs")
    first = verified(first_pairs, docs, size, per_cent)

    # Owners of one signature that are still apart.
    labels = components(first)
    placed = owners.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    apart = placed.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    left = cut_lineage(
        placed.join(apart.select("sig"), "sig", "left_semi")
        .drop("s")
        .join(sketches.withColumnRenamed("doc_id", "rep"), "rep")
        .select("sig", "rep", "component", "s", "sketch"),
        "apart",
    )
    second_pairs = (
        left.alias("x")
        .join(left.alias("y"), (F.col("x.sig") == F.col("y.sig")) & (F.col("x.rep") < F.col("y.rep"))
              & (F.col("x.component") != F.col("y.component")) & _may_link(per_cent))
        .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
        .distinct()
        .join(first_pairs, ["a", "b"], "left_anti")
    )
    second = verified(cut_lineage(second_pairs, "pairs"), docs, size, per_cent)
    return nodes, first.union(second)


def similarity_classes(documents: DataFrame, size: int = SHINGLE, per_cent: int = PER_CENT) -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id``: the smallest id reachable over links."""
    nodes, found = links(documents, size, per_cent)
    nameless = (
        pick(documents, doc_id="doc_id", text="text")
        .where("doc_id is null")
        .select(F.lit(0).cast("bigint").alias("doc_id"), "text")
        .mapInArrow(_sign({}, size, per_cent), _SIGNED_DDL)
        .where("info is not null and own")
        .select(F.lit(None).cast("bigint").alias("doc_id"), F.col("info.s").cast("bigint").alias("n_shingles"), F.lit(None).cast("bigint").alias("component_id"))
    )
    # An id with several texts ties their reps together.
    nodes = cut_lineage(nodes, "nodes")
    own = nodes.where("s > 0").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).where("a <> b")
    labels = components(found.union(own))
    placed = (
        nodes.join(labels, nodes["doc_id"] == labels["id"], "left")
        .select("doc_id", F.col("s").cast("bigint").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    )
    return placed.union(nameless)
