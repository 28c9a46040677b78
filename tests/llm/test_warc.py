import base64
import hashlib

import zstandard
from pyspark.sql import functions as F

from demand_engine.llm import warc
from tests.llm.conftest import SF_DIR


def expected(rows, min_bytes=0):
    payload = {k: (html or "").encode() for k, html in rows}
    last = {}
    for k, p in payload.items():
        last[p] = max(k, last.get(p, k))
    out = {}
    for k, p in payload.items():
        keep = last[p] if len(p) >= min_bytes else k
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out[k] = (len(p), digest, "response" if keep == k else "revisit", None if keep == k else keep)
    return out


def read(spark, index):
    return warc.read_bundles(spark, index).collect()


def test_round_trip_with_revisits(spark):
    rows = [(k, f"<p>page {k % 7} é</p>" * (k % 5)) for k in range(60)] + [(60, None), (61, "x")]
    df = spark.createDataFrame(rows, "page_id bigint, html string").withColumn("url", F.lit("http://a.example/ ü\n"))
    for min_bytes in (0, 20):
        index = warc.write_bundles(df, min_bytes=min_bytes, frame_bytes=700, bundle_bytes=900)
        assert index.select("bundle").distinct().count() > 1 and index.where("frame > 0").count() > 0
        got = read(spark, index)
        assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == expected(rows, min_bytes)
        texts = dict(rows)
        assert all(r.payload.decode() == (texts[r.page_id] or "") for r in got if r.record_type == "response")
        assert all(r.payload is None for r in got if r.record_type == "revisit")


def test_frames_are_independent_and_the_file_is_plain_zstd(spark):
    df = spark.read.parquet(f"{SF_DIR}/pages.parquet").repartition(1)
    index = warc.write_bundles(df, frame_bytes=20_000)
    row = index.where("frame = 1").orderBy("offset").collect()[-1]
    reader = warc.BundleReader(row.bundle)
    data = reader.frame(1)
    assert warc.parse(data[row.offset : row.offset + row.length])["warc-record-id"] == f"<{row.record_id}>"
    whole = reader.file.read_at(reader.file.size(), 0)
    plain = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(whole)
    assert plain == b"".join(reader.frame(k) for k in range(len(reader.places)))
    assert plain.count(b"WARC/1.1\r\n") == 50


def test_edge_rows_and_clashing_columns(spark):
    big = "z" * 3_000_000
    rows = [(1, None, None, "a"), (2, None, "", "a"), (3, "u", big, None), (3, "u", big, "a"), (None, "u", big, "a"), (4, "u", "q", "a")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, sha1 string").withColumn("copy", F.lit(9)).withColumn("shared", F.lit("s"))
    got = read(spark, warc.write_bundles(df))
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes) for r in got) == [
        (0, "revisit", 3, 3_000_000), (1, "revisit", 2, 0), (2, "response", 0, 0), (3, "response", 0, 3_000_000),
        (3, "revisit", 3, 3_000_000), (4, "response", 0, 1),
    ]
    assert {r.url for r in got if r.page_id in (1, 2)} == {"about:blank"}
    assert read(spark, warc.write_bundles(df.limit(0))) == []
