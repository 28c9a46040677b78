"""Benchmark passages in documents, by a prefix-filtered set join on word shingles.

An item's text is cut into windows of WINDOW consecutive words (all of them, if there are fewer). A window is
the set of its shingles of SHINGLE words, and it occurs in a document only if all of them do. So in any fixed
order one shingle, the first, is a long enough prefix for the join; with the order by rarity in the corpus
that is the window's rarest one. Steps:

1. One pass over the documents counts words and keeps the positions whose shingle may belong to an item, with
   the words around. The test is a Bloom filter of fixed size, so what is sent to the executors doesn't grow
   with the benchmark: a larger benchmark lets more positions pass, and the join drops them.
2. The kept positions give each item shingle's frequency over all documents; each window's rarest shingle
   becomes its anchor, and windows with a shingle that no document has are dropped.
3. Positions and anchors are joined on the shingle; the window must fit into the document (length and
   position), and its words must equal the document's, word for word.

A shingle that a third of all documents share is one row per occurrence in step 3, joined with its few
distinct windows; the skew join of adaptive execution can split it, and there is no group to gather.

Defined results: words are runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z; null has none;
items without words have no windows; rows that repeat a document id are documents of their own, those that
repeat an item id are one item; a null item id counts for hits and is left out of item lists; empty tables
give documents without hits, or no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demand_engine.llm import shingles
from demand_engine.llm.common import pick, small_batches
from demand_engine.session import cut_lineage

WINDOW = 10
SHINGLE = 5
#: 2^23 bits, 1 MB.
FILTER_BITS = 23
BITMAP_BITS = 32768

_WINDOWS = "item_id string, window string, n int, shingles array<bigint>"
_SCANNED = "doc_id {}, n_words bigint, hits array<struct<at: bigint, shingle: bigint, before: int, around: string>>"
_HITS = pa.list_(
    pa.struct([("at", pa.int64()), ("shingle", pa.int64()), ("before", pa.int32()), ("around", pa.string())])
)


def _lower(data: np.ndarray) -> bytes:
    return shingles.LOWER[data].tobytes()


def _item_windows(window: int, size: int):
    schema = pa.schema(
        [("item_id", pa.string()), ("window", pa.string()), ("n", pa.int32()), ("shingles", pa.list_(pa.int64()))]
    )

    def run(batches):
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            out: list[tuple] = []
            for first, data, offsets in shingles.blocks(batch.column("text")):
                starts, ends, hashes, per_doc = shingles.words(data, offsets, shingles.ALPHANUMERIC)
                low = _lower(data)
                for k in range(len(offsets) - 1):
                    a, b = per_doc[k], per_doc[k + 1]
                    words = [low[s:e].decode("utf-8", "replace") for s, e in zip(starts[a:b], ends[a:b])]
                    n = min(window, len(words))
                    if not n:
                        continue
                    marks = shingles.shingle_hashes(hashes[a:b], min(size, n)).view(np.int64)
                    per = n - min(size, n) + 1
                    for at in range(len(words) - n + 1):
                        out.append((ids[first + k], " ".join(words[at : at + n]), n, marks[at : at + per].tolist()))
            columns = list(zip(*out)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _bits(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a hash in the filter."""
    x = x.view(np.uint64)
    return (x >> np.uint64(64 - FILTER_BITS)).astype(np.int64), (x & np.uint64(2**FILTER_BITS - 1)).astype(np.int64)


def shingle_filter(windows: DataFrame) -> np.ndarray:
    """The Bloom filter over all item shingles: at most 2^FILTER_BITS bits reach the driver, whatever the
    benchmark's size."""
    marks = windows.select(F.explode("shingles").alias("h"))
    places = F.explode(
        F.array(F.shiftrightunsigned("h", 64 - FILTER_BITS), F.col("h").bitwiseAND(2**FILTER_BITS - 1))
    )
    maps = (
        marks.select(places.alias("p"))
        .groupBy((F.col("p") / BITMAP_BITS).cast("int").alias("b"))
        .agg(F.bitmap_construct_agg((F.col("p") % BITMAP_BITS).cast("bigint")).alias("m"))
        .collect()
    )
    out = np.zeros(2**FILTER_BITS // 8, dtype=np.uint8)
    for b, m in maps:
        part = np.frombuffer(bytes(m), dtype=np.uint8)
        out[b * BITMAP_BITS // 8 : b * BITMAP_BITS // 8 + len(part)] = part
    return out


def _scan(bits: np.ndarray, sizes: list[int], window: int, id_type: pa.DataType):
    schema = pa.schema([("doc_id", id_type), ("n_words", pa.int64()), ("hits", _HITS)])

    def has(places: np.ndarray) -> np.ndarray:
        return (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 > 0

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").cast(id_type)
            counts, per_row = [], []
            for first, data, offsets in shingles.blocks(batch.column("text")):
                starts, ends, hashes, per_doc = shingles.words(data, offsets, shingles.ALPHANUMERIC)
                n_docs = len(offsets) - 1
                counts.append(np.diff(per_doc))
                found: list[list] = [[] for _ in range(n_docs)]
                low = None
                for size in sizes:
                    marks = shingles.shingle_hashes(hashes, size)
                    one, two = _bits(marks)
                    at = np.flatnonzero(has(one))
                    at = at[has(two[at])]
                    doc = np.searchsorted(per_doc, at, side="right") - 1
                    inside = at + size <= per_doc[doc + 1]
                    at, doc = at[inside], doc[inside]
                    if len(at) and low is None:
                        low = _lower(data)
                    for i, d in zip(at.tolist(), doc.tolist()):
                        lo, hi = max(per_doc[d], i - window + 1), min(per_doc[d + 1], i + window)
                        around = " ".join(low[s:e].decode("utf-8", "replace") for s, e in zip(starts[lo:hi], ends[lo:hi]))
                        found[d].append(
                            {"at": i - int(per_doc[d]), "shingle": int(marks[i].astype(np.int64)), "before": int(i - lo), "around": around}
                        )
                per_row += found
            n = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(per_row, _HITS)], schema=schema)

    return run


def scan(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, size: int = SHINGLE, id_type: str = "bigint"):
    """``rows`` (``row_id, doc_id, n_words``), ``spans`` (``row_id, at, n, window``: each occurrence of a window)
    and ``windows`` (``item_id, window, n, shingles``)."""
    spark = documents.sparkSession
    small_batches(spark)
    items = pick(benchmark, item_id="item_id", text="text").select(F.col("item_id").cast("string"), "text")
    windows = cut_lineage(items.mapInArrow(_item_windows(window, size), _WINDOWS), "windows")
    sizes = sorted(r.k for r in windows.select(F.least("n", F.lit(size)).alias("k")).distinct().collect())
    docs = pick(documents, doc_id="doc_id", text="text").select(F.col("doc_id").cast(id_type), "text")
    arrow_type = pa.string() if id_type == "string" else pa.int64()
    scanned = cut_lineage(
        docs.mapInArrow(_scan(shingle_filter(windows), sizes, window, arrow_type), _SCANNED.format(id_type)).withColumn(
            "row_id", F.monotonically_increasing_id()
        ),
        "scanned",
    )
    hits = scanned.where(F.size("hits") > 0).select("row_id", F.explode("hits").alias("h")).select("row_id", "h.*")

    frequency = hits.groupBy("shingle").agg(F.count(F.lit(1)).alias("f"))
    distinct = windows.groupBy("window", "n").agg(F.first("shingles").alias("shingles"))
    anchors = (
        distinct.select("window", "n", F.size("shingles").alias("all"), F.posexplode("shingles").alias("offset", "shingle"))
        .join(frequency, "shingle")
        .groupBy("window", "n", "all")
        .agg(F.min(F.struct("f", "offset", "shingle")).alias("rarest"), F.count(F.lit(1)).alias("there"))
        .where(F.col("there") == F.col("all"))
        .select("window", "n", "rarest.offset", "rarest.shingle")
    )
    spans = (
        hits.join(anchors, "shingle")
        .where("at >= offset and before >= offset")
        .withColumn("words", F.expr("slice(split(around, ' '), before - offset + 1, n)"))
        .where((F.size("words") == F.col("n")) & (F.array_join("words", " ") == F.col("window")))
        .select("row_id", (F.col("at") - F.col("offset")).alias("at"), "n", "window")
        .distinct()
    )
    return scanned.select("row_id", "doc_id", "n_words"), spans, windows


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, size: int = SHINGLE, id_type: str = "bigint"
) -> DataFrame:
    """Per document ``doc_id, n_words, n_hit, n_items, items, contaminated``: words inside any occurrence of a
    window, and the ids (as text, sorted) of the items whose windows occur. ``id_type`` is bigint or string."""
    rows, spans, windows = scan(documents, benchmark, window, size, id_type)
    spans = cut_lineage(spans, "spans")
    before = Window.partitionBy("row_id").orderBy("at", "n").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        spans.select("row_id", "at", "n")
        .distinct()
        .withColumn("_end", F.max(F.col("at") + F.col("n")).over(before))
        .groupBy("row_id")
        .agg(F.sum(F.greatest(F.lit(0), F.col("at") + F.col("n") - F.greatest("at", F.coalesce("_end", "at")))).alias("n_hit"))
    )
    items = (
        spans.select("row_id", "window")
        .join(windows.select("window", "item_id").distinct(), "window")
        .groupBy("row_id")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    return (
        rows.join(covered, "row_id", "left")
        .join(items, "row_id", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )
