"""Tables that change by commits: atomic replacement, appends that repeat safely, resumable copies.

A table is a folder. Every write goes to a data folder of its own; then a manifest with the next number names the data
folders that are the table from now on. Readers take the newest complete manifest, so they see the old rows until the
new ones are there as a whole, and a write that fails leaves the table as it was. Manifests are created exclusively: of
two writers that start from one version the slower one gets ``CommitConflict`` and changes nothing.

With ``key`` every data folder gets a filter of its keys, a bit per hash, built in Spark and never whole on the driver;
``append_missing`` looks rows up in it and reads the table's own keys only for rows whose bit is set.

The driver reads one manifest: a line per data folder, whatever the number of rows.

Defined results: a table without a commit can't be read (ValueError); an empty frame can be written and read; a null key
is a key like others; rows of the source that repeat a key are appended or left out together.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from demand_engine.operators.ordering import key_at

#: Bits of a key filter, as a power of two; it is stored by pieces of PIECE_BITS, and only those with a key.
FILTER_BITS = 32
PIECE_BITS = 32_768


class CommitConflict(RuntimeError):
    """Another writer has committed in between; nothing was changed."""


class CommittedTable:
    def __init__(self, spark: SparkSession, root: str, key: list[str] = ()):
        self.spark, self.root, self.key = spark, root.rstrip("/"), list(key)

    # Files

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifest(self, number: int) -> dict | None:
        """The manifest of a number; None if it isn't complete."""
        stream = self._files().open(self._path(f"_commits/{number:09d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def _numbers(self) -> list[int]:
        folder = self._path("_commits")
        if not self._files().exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files().listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def state(self) -> dict:
        """The newest complete manifest: ``version``, ``next`` (the number a commit takes), ``batches`` (``id, folder,
        rows``) and ``mark`` (how far ``copy_from`` has come)."""
        numbers = self._numbers()
        for number in reversed(numbers):
            if (found := self._manifest(number)) is not None:
                return {**found, "version": number, "next": numbers[-1] + 1}
        return {"version": 0, "next": (numbers or [0])[-1] + 1, "batches": [], "mark": None}

    def _commit(self, state: dict, batches: list[dict], mark) -> dict:
        path = self._path(f"_commits/{state['next']:09d}.json")
        if self._files().exists(path):
            raise CommitConflict(f"{self.root} has a version {state['next']} already")
        try:
            stream = self._files().create(path, False)
        except Exception as error:
            raise CommitConflict(f"{self.root}: version {state['next']} can't be created") from error
        try:
            stream.write(bytearray(json.dumps({"batches": batches, "mark": mark}).encode()))
        finally:
            stream.close()
        return {"version": state["next"], "next": state["next"] + 1, "batches": batches, "mark": mark}

    def _write(self, df: DataFrame, batch: str, **metrics: Column) -> tuple[dict, dict]:
        """Writes the rows to a new folder, counted by the write itself; the batch's entry and the metrics."""
        folder = f"data-{uuid.uuid4().hex}"
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()])
        counted.write.parquet(f"{self.root}/{folder}")
        found = seen.get
        if self.key:
            keys = self.spark.read.parquet(f"{self.root}/{folder}").select(*self.key)
            self._key_bits(keys).write.parquet(f"{self.root}/_keys/{folder}")
        return {"id": batch, "folder": folder, "rows": found["rows"]}, found

    # Readers

    def read(self) -> DataFrame:
        batches = self.state()["batches"]
        if not batches:
            raise ValueError(f"nothing is committed to {self.root}")
        return self.spark.read.parquet(*[f"{self.root}/{b['folder']}" for b in batches])

    def count(self) -> int:
        """Rows of the table, from the manifest."""
        return sum(b["rows"] for b in self.state()["batches"])

    # Writers

    def replace(self, df: DataFrame, batch: str | None = None) -> int:
        """The rows become the table; the version."""
        state = self.state()
        entry, _ = self._write(df, batch or uuid.uuid4().hex)
        return self._commit(state, [entry], None)["version"]

    def append(self, df: DataFrame, batch: str, mark: str | None = None) -> bool:
        """Adds a batch, and a mark of how far the table has come, if one is given; False, without reading ``df``, if a
        batch of that id is in the table."""
        state = self.state()
        if any(b["id"] == batch for b in state["batches"]):
            return False
        entry, _ = self._write(df, batch)
        self._commit(state, [*state["batches"], entry], mark or state["mark"])
        return True

    def append_missing(self, src: DataFrame, batch: str | None = None) -> int:
        """Adds the rows whose key the table lacks, as new files only; their number. Nothing is committed if there are
        none, or if a batch of that id is in the table."""
        if not self.key:
            raise ValueError("append_missing needs a table with a key")
        state = self.state()
        if batch is not None and any(b["id"] == batch for b in state["batches"]):
            return 0
        entry, _ = self._write(self._missing(src, state), batch or uuid.uuid4().hex)
        if entry["rows"]:
            self._commit(state, [*state["batches"], entry], state["mark"])
        return entry["rows"]

    def copy_from(self, src: DataFrame, key: str, rows_per_batch: int = 100_000, max_batches: int = 100) -> int:
        """Goes on copying a table of any kind in the order of a unique key that only grows; how many batches were
        written. A batch is a range of keys of ``rows_per_batch`` rows, cut by counts; its greatest key is committed with
        it, so the next call goes on behind it wherever the last one ended or broke. Rows without a key come first."""
        state, kind = self.state(), src.select(key).schema[0].dataType.simpleString()
        value = F.col(f"`{key}`")

        def behind(mark) -> Column:
            return F.lit(True) if mark is None else value > F.lit(mark).cast(kind)

        left = src.where(behind(state["mark"]))
        batches = min(max_batches, left.count() // rows_per_batch + 1)
        ends = {f"e{k}": (lambda _, k=k: F.lit((k + 1) * rows_per_batch - 1)) for k in range(batches)}
        cuts = src.sparkSession.range(1).select(*[c.cast("string").alias(n) for n, c in key_at(left, key, ends).items()]).first()
        written = 0
        for end in cuts:
            inside = behind(state["mark"]) & (F.lit(True) if end is None else value <= F.lit(end).cast(kind))
            if state["mark"] is None:
                inside = inside | value.isNull()
            # The last range is open; what arrives behind it meanwhile is for the next call.
            rows = src.where(F.coalesce(inside, F.lit(False)))
            if end is None:
                rows = rows.orderBy(value.asc_nulls_first()).limit(rows_per_batch)
            entry, found = self._write(rows, f"copy-{state['next']}", mark=F.max(value).cast("string"))
            if entry["rows"]:
                state = self._commit(state, [*state["batches"], entry], found["mark"] or state["mark"])
                written += 1
            if end is None:
                break
        return written

    def vacuum(self) -> int:
        """Deletes the data folders that the newest manifest doesn't name, and older manifests; how many folders. Only
        while nobody writes, or reads an older version."""
        state = self.state()
        live = {b["folder"] for b in state["batches"]}
        gone = [s.getPath().getName() for s in self._files().listStatus(self._path("")) if s.getPath().getName().startswith("data-")]
        gone = [name for name in gone if name not in live]
        for name in gone:
            self._files().delete(self._path(name), True)
            self._files().delete(self._path(f"_keys/{name}"), True)
        for number in self._numbers():
            if number < state["version"]:
                self._files().delete(self._path(f"_commits/{number:09d}.json"), False)
        return len(gone)

    # Keys

    def _place(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.key]), F.lit(1 << FILTER_BITS))

    def _key_bits(self, keys: DataFrame) -> DataFrame:
        place = keys.select(self._place().alias("at"))
        by_piece = place.groupBy(F.floor(F.col("at") / PIECE_BITS).alias("piece"))
        return by_piece.agg(F.bitmap_construct_agg(F.col("at") % PIECE_BITS).alias("bits"))

    def _missing(self, src: DataFrame, state: dict) -> DataFrame:
        folders = [b["folder"] for b in state["batches"]]
        if not folders:
            return src
        # The row as one column, so that no name of it can clash with those used here.
        rows = src.select(F.struct(*[F.col(f"`{c}`") for c in src.columns]).alias("row"), self._place().alias("at"))
        bits = self.spark.read.parquet(*[f"{self.root}/_keys/{f}" for f in folders])
        known = bits.groupBy("piece").agg(F.bitmap_or_agg("bits").alias("bits"))
        within = F.col("at") % PIECE_BITS
        byte = F.conv(F.hex(F.substring("bits", (within / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.coalesce(F.getbit(byte, (within % 8).cast("int")) == 1, F.lit(False))
        looked_up = rows.join(known, F.floor(F.col("at") / PIECE_BITS) == F.col("piece"), "left").select("row", is_set.alias("maybe"))
        sure, maybe = (looked_up.where(x).select("row") for x in (~F.col("maybe"), F.col("maybe")))
        if maybe.isEmpty():
            return sure.select("row.*")
        table = self.spark.read.parquet(*[f"{self.root}/{f}" for f in folders])
        own = table.select(F.struct(*[F.col(f"`{k}`") for k in self.key]).alias("own"))
        same = F.lit(True)
        for k in self.key:
            same = same & F.col("row").getField(k).eqNullSafe(F.col("own").getField(k))
        return sure.unionByName(maybe.join(own, same, "left_anti")).select("row.*")
