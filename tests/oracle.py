"""Compares registered queries with their oracles in DuckDB.

python -m tests.oracle [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "float": "FLOAT",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(con, df, sql: str) -> str:
    """'' if equal, else what differs: names, types or rows (as a bag)."""
    rel = con.sql(sql)
    want_types = dict(zip(rel.columns, map(str, rel.types)))
    have_types = {c: TYPES.get(t, t) for c, t in df.dtypes}
    if set(want_types) != set(have_types):
        return f"columns {sorted(have_types)} <> {sorted(want_types)}"
    loose = {c: (have_types[c], want_types[c]) for c in want_types if have_types[c] != want_types[c]}
    cols = sorted(want_types)
    have = Counter(tuple(r) for r in (repr_row(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()))
    want = Counter(tuple(r) for r in (repr_row(r) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall()))
    if have != want:
        return f"rows {have.total()} <> {want.total()}; only here {list((have - want).items())[:2]}; only there {list((want - have).items())[:2]}"
    return f"types {loose}" if loose else ""


def repr_row(row):
    return [repr(v) for v in row]


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    names = argv[1:] or list(entry.queries())
    for name in names:
        begun = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            if sql is None:
                verdict = f"rows only: {df.count()}"
            else:
                verdict = compare(con, df, sql) or "ok"
        except Exception as error:  # reported, the others go on
            verdict = f"{type(error).__name__}: {str(error)[:1200]}"
        bad += verdict != "ok" and not verdict.startswith("rows only")
        print(f"{name:28s} {time.time() - begun:6.2f}s  {verdict}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
