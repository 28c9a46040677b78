import pytest
from pyspark.sql import functions as F

from demand_engine.operators.demand import hourly_demand
from demand_engine.streaming import hourly
from demand_engine.streaming.copy import incremental_copy, read_copy

SCHEMA = "trip_start_timestamp timestamp, pickup_community_area int"


@pytest.fixture
def land(rows, tmp_path):
    """Writes one file of events and returns the folder; files are read in the order they land."""
    folder = tmp_path / "landing"

    def put(*events):
        rows([(f"2024-01-01 {t}", a) for t, a in events], SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
        return str(folder)

    return put


def read_stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def table(df):
    return {(r.timestamp_hour.hour, r.pickup_community_area): r.trip_count for r in df.collect()}


def test_closed_hours_are_written_once(spark, land, tmp_path):
    folder, out, ckpt = land(("00:10:00", 1), ("00:50:00", 1), ("01:10:00", 2)), str(tmp_path / "o"), str(tmp_path / "c")
    land(("00:20:00", 1), ("05:00:00", 2))

    def run():
        hourly.write_closed_steps(hourly.stream_hourly_demand(read_stream(spark, folder)), out, ckpt)

    run()
    assert table(spark.read.parquet(out)) == {(0, 1): 3, (1, 2): 1}
    land(("00:30:00", 1), ("05:30:00", 2), ("09:00:00", 3))  # the first comes too late
    run()
    run()
    assert table(spark.read.parquet(out)) == {(0, 1): 3, (1, 2): 1, (5, 2): 2}
    assert spark.read.parquet(out).count() == 3


def test_running_counts_equal_batch(spark, land, tmp_path):
    folder = land(("00:10:00", 1), ("01:10:00", 2))
    land(("01:50:00", 2), ("01:20:00", None), ("02:10:00", 1))
    out = str(tmp_path / "o")
    hourly.write_running_counts(hourly.stream_hourly_demand(read_stream(spark, folder)), out, str(tmp_path / "c"))
    batch = hourly_demand(spark.read.parquet(folder).where("pickup_community_area is not null"))
    assert table(hourly.read_running_counts(spark, out)) == table(batch) == {(0, 1): 1, (1, 2): 2, (2, 1): 1}


def test_filled_hours(spark, land, tmp_path):
    folder, out, ckpt = land(("00:10:00", 1), ("01:10:00", 2)), str(tmp_path / "o"), str(tmp_path / "c")
    land(("06:00:00", 1))
    ids = spark.createDataFrame([(1,), (2,), (3,)], "pickup_community_area int")

    def run():
        hourly.stream_filled_demand(hourly.stream_hourly_demand(read_stream(spark, folder)), ids, out, ckpt)

    run()
    first = table(spark.read.parquet(out))
    assert first == {(h, a): int((h, a) in {(0, 1), (1, 2)}) for h in (0, 1) for a in (1, 2, 3)}
    land(("12:00:00", 2))
    run()
    filled = spark.read.parquet(out)
    got = table(filled)
    assert set(got) == {(h, a) for h in range(7) for a in (1, 2, 3)}
    assert filled.count() == len(got) and sum(got.values()) == 3 and got[(6, 1)] == 1


def test_copy_goes_on_where_it_stopped(spark, tmp_path):
    src, dst, ckpt = (str(tmp_path / n) for n in ("src", "dst", "ckpt"))
    for part in range(6):
        spark.range(part * 10, part * 10 + 10, 1, 1).write.mode("append").parquet(src)
    assert incremental_copy(spark, src, dst, ckpt, files_per_batch=1, max_batches=2) == 2
    assert read_copy(spark, dst).count() == 20
    assert incremental_copy(spark, src, dst, ckpt, files_per_batch=1, max_batches=1) == 1
    assert read_copy(spark, dst).count() == 30
    incremental_copy(spark, src, dst, ckpt, files_per_batch=2)
    spark.range(60, 70, 1, 1).write.mode("append").parquet(src)
    assert incremental_copy(spark, src, dst, ckpt) == 1
    assert incremental_copy(spark, src, dst, ckpt) == 0
    assert sorted(r.id for r in read_copy(spark, dst).collect()) == list(range(70))


def test_copy_counts_every_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(0, 260, 1, 130).write.parquet(src)
    assert incremental_copy(spark, src, str(tmp_path / "a"), str(tmp_path / "ca"), 1, max_batches=120) == 120
    assert incremental_copy(spark, src, str(tmp_path / "a"), str(tmp_path / "ca"), 1) == 10
    assert read_copy(spark, str(tmp_path / "a")).distinct().count() == read_copy(spark, str(tmp_path / "a")).count() == 260


def test_running_counts_are_compacted(spark, land, tmp_path):
    folder, out, ckpt = land(("00:10:00", 1), ("01:10:00", 2)), str(tmp_path / "o"), str(tmp_path / "c")

    def run():
        hourly.write_running_counts(hourly.stream_hourly_demand(read_stream(spark, folder)), out, ckpt)
        return table(hourly.read_running_counts(spark, out))

    for k in range(3):
        land((f"01:{20 + k}:00", 2), ("02:00:00", k))
    before = run()
    hourly.compact_running_counts(spark, out)
    compact, batches = hourly._live_batches(spark, out)
    assert len(compact) == len(batches) == 1
    assert table(hourly.read_running_counts(spark, out)) == before
    land(("01:50:00", 2))
    assert run() == {**before, (1, 2): before[1, 2] + 1}


def test_an_id_first_seen_in_the_stream_is_kept(spark, land, tmp_path):
    folder, out, ckpt = land(("00:10:00", 1)), str(tmp_path / "o"), str(tmp_path / "c")
    land(("01:10:00", 9), ("05:00:00", 1))
    land(("09:00:00", 1))
    ids = spark.createDataFrame([(1,), (2,)], "pickup_community_area int")
    hourly.stream_filled_demand(hourly.stream_hourly_demand(read_stream(spark, folder)), ids, out, ckpt)
    got = table(spark.read.parquet(out))
    assert got[1, 9] == 1 and got[5, 9] == 0 and got[0, 1] == 1 and got[5, 1] == 1
    assert sum(got.values()) == 3


def test_watermark_needs_no_zoned_input(spark, land):
    counts = hourly.stream_hourly_demand(read_stream(spark, land(("00:10:00", 1))).withColumn("trip_start_timestamp", F.col("trip_start_timestamp").cast("timestamp_ntz")))
    assert counts.isStreaming and dict(counts.dtypes)["timestamp_hour"] == "timestamp"


def test_idle_hours_close_by_the_clock(spark, land, tmp_path):
    from demand_engine.sources.committed import CommittedTable

    folder, out = land(("00:10:00", 1), ("02:10:00", 2), ("02:20:00", 2)), str(tmp_path / "o")
    hourly.write_running_counts(hourly.stream_hourly_demand(read_stream(spark, folder)), out, str(tmp_path / "c"))
    closed = CommittedTable(spark, str(tmp_path / "closed"))

    def close(now):
        return hourly.close_steps(spark, out, closed, f"2024-01-01 {now}", "1 hour")

    assert close("01:59:59") == 0
    assert close("02:00:00") == 1 and table(closed.read()) == {(0, 1): 1, (0, 2): 0}
    # No further event comes; a broken commit leaves nothing behind, a repeated call adds nothing.
    commit = CommittedTable._commit
    CommittedTable._commit = lambda self, *a: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError):
            close("06:30:00")
    finally:
        CommittedTable._commit = commit
    assert close("06:30:00") == 4 and close("06:30:00") == 0 and close("05:00:00") == 0
    want = {(h, a): 0 for h in range(5) for a in (1, 2)} | {(0, 1): 1, (2, 2): 2}
    assert table(closed.read()) == want and closed.read().count() == len(want)
    land(("04:00:00", 1), ("05:30:00", 3))
    hourly.write_running_counts(hourly.stream_hourly_demand(read_stream(spark, folder)), out, str(tmp_path / "c"))
    assert close("07:00:00") == 1
    assert table(closed.read()) == want | {(5, 1): 0, (5, 2): 0, (5, 3): 1}


def test_a_stream_of_ticks_closes(spark, land, tmp_path):
    import time

    from demand_engine.sources.committed import CommittedTable

    folder, out = land(("00:10:00", 1)), str(tmp_path / "o")
    hourly.write_running_counts(hourly.stream_hourly_demand(read_stream(spark, folder)), out, str(tmp_path / "c"))
    closed = CommittedTable(spark, str(tmp_path / "closed"))
    query = hourly.close_on_clock(spark, out, closed, str(tmp_path / "clock"), "1 second", "400 days", step="day", out_time="timestamp_hour")
    until = time.time() + 60
    while not closed.state()["batches"] and time.time() < until:
        time.sleep(1)
    query.stop()
    got = closed.read()
    assert got.count() == got.select("timestamp_hour").distinct().count() > 300
    assert got.agg(F.sum("trip_count")).first()[0] == 1
