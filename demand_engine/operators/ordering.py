"""Sorts, top-k, pages and exact order statistics that never gather a group in one task."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Binary digits of a value, after its sign and power of two, that make its bucket.
BUCKET_BITS = 20
#: The bucket of rows without a value, before all others.
NO_VALUE = -(2**62)
#: Bytes of a text key that one level of the descent looks at, and rows that are few enough to sort.
LEVEL_BYTES = 3
SORTED_ROWS = 10_000


def _present(value: Column, dtype: str) -> Column:
    present = value.isNotNull()
    return present & ~F.isnan(value) if dtype in ("double", "float") else present


def _number(value: Column, dtype: str) -> Column:
    """A double that never falls where the value rises; equal for values that differ little."""
    if dtype in ("timestamp", "timestamp_ntz", "date"):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    return value.cast("double")


def _bucket(x: Column, bits: int) -> Column:
    """The bucket of a double: its sign, power of two and leading ``bits`` binary digits as one number that
    rises with x. It depends on the value alone, so every reader makes the same cut. An exponent that is off
    by one, from rounding in the logarithm, gives the same number."""
    size = F.least(F.abs(x), F.lit(1.7976931348623157e308))
    power = F.least(F.floor(F.log2(size)), F.lit(1023))
    width = 1 << bits
    place = (power + 1100) * width + F.floor(size / F.pow(F.lit(2.0), power) * width).cast("bigint") - width
    return F.when(x == 0, F.lit(0).cast("bigint")).when(x > 0, place).otherwise(-place)


def bucket_of(df: DataFrame, value: str) -> Column:
    """The bucket of a column of ``df``; NO_VALUE for nulls and NaN."""
    dtype = dict(df.dtypes)[value]
    x = _bucket(_number(F.col(value), dtype), BUCKET_BITS)
    return F.when(_present(F.col(value), dtype), x).otherwise(F.lit(NO_VALUE))


def holds_rank(rank: Column, first: str = "_before") -> Column:
    """Whether a rank falls on the ``_n`` rows after the ``first`` ones."""
    return (rank >= F.col(first)) & (rank < F.col(first) + F.col("_n"))


def value_histogram(df: DataFrame, keys: list[str], value: str, carry: dict[str, Callable[[Column], Column]] = {}) -> DataFrame:
    """``_bucket, _n`` per key and bucket of the value, counted map-side, and the ``carry`` aggregates of the bucket.
    Buckets are the same everywhere, so histograms of parts merge by adding up. Rows without a value are a bucket
    with ``_n`` 0."""
    return _bucketed(df, keys, value).groupBy(*keys, "_bucket").agg(
        F.count(value).alias("_n"), *[made(F.col(value)).alias(name) for name, made in carry.items()]
    )


def _bucketed(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    there = F.when(_present(F.col(value), dict(df.dtypes)[value]), F.col(value))
    return df.select(*keys, there.alias(value), bucket_of(df, value).alias("_bucket"))


def moments(names: dict[str, str]) -> tuple[dict, Callable[[DataFrame, list[str]], DataFrame]]:
    """Count, mean, sample deviation, least and greatest of a column, merged from the buckets of its histogram:
    what ``values_at`` carries, and how the buckets of a key are put together. ``names`` gives result names by
    ``count, mean, std, min, max``."""
    bucket = {
        "_mean": lambda v: F.avg(v.cast("double")),
        "_spread": lambda v: F.var_pop(v.cast("double")),
        "_min": lambda v: F.min(v.cast("double")),
        "_max": lambda v: F.max(v.cast("double")),
    }

    def merge(histogram: DataFrame, keys: list[str]) -> DataFrame:
        whole, n = Window.partitionBy(*keys), F.col("_n")
        merged = histogram.withColumn("_count", F.sum(n).over(whole)).withColumn(
            "_all", F.sum(n * F.col("_mean")).over(whole) / F.col("_count")
        )
        # Squared deviations of a bucket from the mean of all: its own and that of its mean.
        apart = n * (F.col("_spread") + (F.col("_mean") - F.col("_all")) * (F.col("_mean") - F.col("_all")))
        std = F.when(F.col("_count") > 1, F.sqrt(F.sum(apart).over(whole) / (F.col("_count") - 1)))
        found = {
            "count": F.col("_count"),
            "mean": F.col("_all"),
            "std": std,
            "min": F.min("_min").over(whole),
            "max": F.max("_max").over(whole),
        }
        return merged.withColumns({name: found[kind] for kind, name in names.items()}).drop("_count", "_all", *bucket)

    return bucket, merge


def rank_buckets(
    df: DataFrame,
    keys: list[str],
    value: str,
    ranks: dict[str, Callable[[Column], Column]],
    carry: tuple[dict, Callable[[DataFrame, list[str]], DataFrame]] | None = None,
    keep_empty: bool = False,
) -> DataFrame:
    """The buckets that hold a rank: per key ``_bucket``, ``_start`` (rows of the key before it), ``total`` and what
    ``carry`` merges for the key. With ``keep_empty`` a key without values has the bucket of its nulls."""
    made, merge = carry or ({}, lambda histogram, _: histogram)
    histogram = value_histogram(df, keys, value, made)
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = histogram.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).withColumn(
        "total", F.sum("_n").over(Window.partitionBy(*keys))
    )
    holds = reduce(or_, [holds_rank(rank(F.col("total")), "_start") for rank in ranks.values()])
    if keep_empty:
        holds = holds | ((F.col("total") == 0) & (F.col("_bucket") == NO_VALUE))
    return merge(placed, keys).where(holds).drop("_n")


def values_at(
    df: DataFrame,
    keys: list[str],
    value: str,
    ranks: dict[str, Callable[[Column], Column]],
    bounded_keys: bool = False,
    carry: tuple[dict, Callable[[DataFrame, list[str]], DataFrame]] | None = None,
    carried: list[str] = [],
    keep_empty: bool = False,
) -> DataFrame:
    """Per key, the values at given ranks: ``total``, one column per entry of ``ranks``, and the columns ``carried``
    that ``carry`` (``moments``) merges from the histogram.

    Rows are ranked by value within their key. A rank counts from 0 and is given as a function of the key's
    number of rows; behind the end it gives null. Rows without a value have no rank.

    Two scans and one lazy plan: the first counts a histogram of each key's values map-side; the second keeps the rows
    of buckets that hold a rank, counted per value before they are joined with those buckets and once more ranked. So
    nothing is sorted but the neighbourhood of the ranks, and a hot key is one row a bucket and task. Without keys, or
    with ``bounded_keys`` (a few, whatever the data), the buckets are broadcast: two a rank and key.
    """
    small = F.broadcast if bounded_keys or not keys else lambda hits: hits
    hits = small(rank_buckets(df, keys, value, ranks, carry, keep_empty))
    rows = _bucketed(df, keys, value)
    by = [*keys, "_bucket"]
    if bounded_keys or not keys:
        counted = rows.join(hits, by).groupBy(*by, "_start", "total", *carried, value).agg(F.count(value).alias("_n"))
    else:
        counted = rows.groupBy(*by, value).agg(F.count(value).alias("_n")).join(hits, by)
    earlier = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("_before", F.col("_start") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    found = [
        F.max(F.when(holds_rank(rank(F.col("total")), "_before"), F.col(value))).alias(name) for name, rank in ranks.items()
    ]
    return ranked.groupBy(*keys).agg(F.max("total").alias("total"), *[F.max(c).alias(c) for c in carried], *found)


def quantile_ranks(probs: dict[str, float]) -> tuple[dict[str, Callable[[Column], Column]], Callable[[str], Column]]:
    """The ranks on either side of each quantile, and the interpolated quantile from ``total`` and the values there."""

    def at(p: float, total: Column) -> Column:
        return F.lit(float(p)) * (total - 1)

    ranks = {}
    for name, p in probs.items():
        ranks[f"_lo_{name}"] = lambda total, p=p: F.floor(at(p, total))
        ranks[f"_hi_{name}"] = lambda total, p=p: F.ceil(at(p, total))

    def interpolate(name: str) -> Column:
        place = at(probs[name], F.col("total"))
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return low + (high - low) * (place - F.floor(place))

    return ranks, interpolate


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: dict[str, float],
    bounded_keys: bool = False,
    describe: dict[str, str] = {},
    keep_empty: bool = False,
) -> DataFrame:
    """Exact, linearly interpolated quantiles per key, one column per entry of ``probs``, and from the same scan those
    of ``count, mean, std, min, max`` that ``describe`` gives a name.

    Nulls and rows with a null key are left out, so a key without values has no row, or with ``keep_empty`` one of
    nulls.
    """
    keep = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True))
    if not keep_empty:
        keep = keep & _present(F.col(value), dict(df.dtypes)[value])
    values = df.where(keep).select(*keys, F.col(value).cast("double").alias("_value"))
    ranks, interpolate = quantile_ranks(probs)
    carry = moments(describe) if describe else None
    found = values_at(values, keys, "_value", ranks, bounded_keys, carry, list(describe.values()), keep_empty)
    return found.select(*keys, *describe.values(), *[interpolate(name).alias(name) for name in probs])


def _text_at(df: DataFrame, key: str, rank: int) -> str | None:
    """The text key at a rank, null behind the end. A radix descent: one scan counts the rows that begin as far as is
    known by their next LEVEL_BYTES bytes, and the bucket with the rank is opened further, until it has SORTED_ROWS
    rows or fewer, or one key. So a common beginning of all keys costs a scan for each few bytes and no large sort."""
    rows = df.select(F.hex(F.encode(key, "UTF-8")).alias("_hex"))
    start, known = 0, ""
    while True:
        after = F.substring("_hex", len(known) + 1, 2 * LEVEL_BYTES)
        counted = rows.where(F.col("_hex").startswith(known)).groupBy(after.alias("_next")).agg(F.count(F.lit(1)).alias("_n"))
        earlier = Window.orderBy("_next").rowsBetween(Window.unboundedPreceding, -1)
        placed = counted.withColumn("_start", F.lit(start) + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        hit = placed.where(holds_rank(F.lit(rank), "_start")).first()
        if hit is None:
            return None
        start, known = hit["_start"], known + hit["_next"]
        ended = len(hit["_next"]) < 2 * LEVEL_BYTES
        if ended or hit["_n"] <= SORTED_ROWS:
            inside = rows.where((F.col("_hex") == known) if ended else F.col("_hex").startswith(known))
            row = inside.limit(1).first() if ended else inside.orderBy("_hex").offset(rank - start).limit(1).first()
            return bytes.fromhex(row["_hex"]).decode()


def key_at(df: DataFrame, key: str, ranks: dict[str, Callable[[Column], Column]]) -> dict[str, Column]:
    """Scalars: the unique key at each rank of its order, null behind the last row. Text keys are looked up at once,
    others when the result is read."""
    rows = df.select(key).where(F.col(key).isNotNull())
    if dict(df.dtypes)[key] == "string":
        total = F.lit(rows.count())
        wanted = df.sparkSession.range(1).select(*[rank(total).cast("bigint").alias(name) for name, rank in ranks.items()]).first()
        return {name: F.lit(_text_at(rows, key, wanted[name])) for name in ranks}
    found = values_at(rows, [], key, ranks)
    row = found.select(F.struct(*ranks).alias("at")).scalar()
    return {name: row.getField(name) for name in ranks}


def sort_table(df: DataFrame, *order: str) -> DataFrame:
    """Global order for a result that is read in order."""
    return df.orderBy(*order)


def sorted_for_storage(df: DataFrame, *order: str) -> DataFrame:
    """The same order as file layout: ranges per file, sorted inside, so a time filter skips files."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def preview(df: DataFrame, n: int = 5, order: tuple[str, ...] = ("timestamp_hour", "pickup_community_area")) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, value: str, key: str, k: int) -> DataFrame:
    """The k largest; ties go to the smaller key."""
    return df.orderBy(F.desc(value), key).limit(k)


def page(df: DataFrame, key: str, offset: int, n: int) -> DataFrame:
    """Rows ``offset .. offset+n-1`` in the order of a unique key.

    Only the keys are ranked; the rows are then filtered by the first and last key of the page. A far
    page costs no more than a near one, and no task holds the rows before it. To copy a whole table
    use the incremental copy instead.
    """
    at = key_at(df, key, {"first": lambda _: F.lit(offset), "last": lambda _: F.lit(offset + n - 1)})
    after_first = F.coalesce(F.col(key) >= at["first"], F.lit(False))
    return df.where(after_first & F.coalesce(F.col(key) <= at["last"], F.lit(True)))


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the smallest unique key, for n too large to sort in one task."""
    at = key_at(df, key, {"last": lambda _: F.lit(n - 1)})
    return df.where(F.col(key).isNotNull() & F.coalesce(F.col(key) <= at["last"], F.lit(True)))


def append(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return a.unionByName(b)
