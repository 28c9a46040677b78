import pytest
from pyspark.sql import functions as F

from demand_engine.sources import committed
from demand_engine.sources.committed import CommitConflict, CommittedTable


def ids(df):
    return sorted((r.id for r in df.collect()), key=lambda x: (x is not None, x))


def broken(spark):
    return spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("bigint")).alias("id"))


def test_a_broken_replacement_leaves_the_old_rows(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        table.read()
    assert table.replace(spark.range(3)) == 1
    before = table.read()
    with pytest.raises(Exception, match="broken"):
        table.replace(broken(spark))
    assert ids(table.read()) == [0, 1, 2] and table.count() == 3
    assert table.replace(spark.range(5, 7)) == 2
    # A reader that began before the switch still has its rows.
    assert ids(before) == [0, 1, 2] and ids(table.read()) == [5, 6]
    assert table.vacuum() >= 1 and ids(table.read()) == [5, 6] and table.state()["version"] == 2
    table.replace(spark.range(0))
    assert table.read().count() == 0


def test_an_incomplete_manifest_is_no_version(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(2))
    (tmp_path / "t/_commits/000000002.json").write_text('{"batches": [')
    assert ids(table.read()) == [0, 1]
    assert table.replace(spark.range(4)) == 3 and table.count() == 4


def test_of_two_writers_one_is_refused(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(2))
    state = table.state()
    table.append(spark.range(2, 4), "a")
    with pytest.raises(CommitConflict):
        table._commit(state, [], None)
    assert ids(table.read()) == [0, 1, 2, 3]


def test_appends_of_one_batch_repeat_safely(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))
    assert table.append(spark.range(3), "one") and not table.append(broken(spark), "one")
    assert table.append(spark.range(3, 5), "two") and ids(table.read()) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("bits", [32, 1])
def test_append_missing_writes_new_rows_only(spark, tmp_path, monkeypatch, bits):
    """With one bit every key may be there, so all go the exact way."""
    monkeypatch.setattr(committed, "FILTER_BITS", bits)
    src = spark.range(20).select(F.when(F.col("id") > 0, F.col("id")).alias("id"), F.lit("x").alias("_at"), (F.col("id") % 3).alias("k 2"))
    table = CommittedTable(spark, str(tmp_path / "t"), ["id", "k 2"])
    assert table.append_missing(src.where("id < 8 or id is null")) == 8
    first = {p for p in (tmp_path / "t").iterdir() if p.name.startswith("data-")}
    stamps = {f: f.stat().st_mtime_ns for p in first for f in p.iterdir()}
    assert table.append_missing(src) == 12
    assert {f: f.stat().st_mtime_ns for f in stamps} == stamps
    assert table.append_missing(src) == 0 and table.state()["version"] == 2
    assert ids(table.read()) == [None, *range(1, 20)] and table.read().columns == src.columns
    assert table.append_missing(src.withColumn("id", F.lit(99)), "b") == 20 and table.append_missing(broken(spark), "b") == 0


def test_new_keys_do_not_read_the_table(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"), ["id"])
    table.replace(spark.range(1000))
    made = table._missing(spark.range(5000, 5100), table.state())
    assert "data-" not in made._jdf.queryExecution().toString().replace("_keys/data-", "")
    assert made.count() == 100


def test_copy_goes_on_from_its_mark(spark, tmp_path, monkeypatch):
    table = CommittedTable(spark, str(tmp_path / "t"))
    src = spark.range(95).select((F.col("id") * 3).alias("id"), F.lit("v").alias("v"))
    src = src.union(spark.createDataFrame([(None, "n")], "id bigint, v string"))
    assert table.copy_from(src, "id", 10, 2) == 2
    assert table.count() == 21 and table.state()["mark"] == "57"
    commit, calls = CommittedTable._commit, []

    def dies(self, *a):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return commit(self, *a)

    monkeypatch.setattr(CommittedTable, "_commit", dies)
    with pytest.raises(RuntimeError, match="lost"):
        table.copy_from(src, "id", 10)
    monkeypatch.undo()
    assert table.count() == 31
    assert table.copy_from(src, "id", 10) == 7 and ids(table.read()) == [None, *range(0, 285, 3)]
    assert table.copy_from(src, "id", 10) == 0 and table.count() == 96
    later = src.union(spark.createDataFrame([(1000, "w")], "id bigint, v string"))
    assert table.copy_from(later, "id", 10) == 1 and table.count() == 97
    assert CommittedTable(spark, str(tmp_path / "empty")).copy_from(src.limit(0), "id") == 0


@pytest.mark.parametrize("kind", ["string", "timestamp", "date"])
def test_copy_by_other_keys(spark, tmp_path, kind):
    made = {"string": F.format_string("key-%05d", "id"), "timestamp": F.timestamp_micros(F.col("id") * 7_000_001), "date": F.date_from_unix_date(F.col("id").cast("int"))}
    src = spark.range(37).select(made[kind].alias("id")).repartition(3)
    table = CommittedTable(spark, str(tmp_path / "t"))
    assert [table.copy_from(src, "id", 10, 3) for _ in range(3)] == [3, 1, 0]
    assert ids(table.read()) == ids(src)
