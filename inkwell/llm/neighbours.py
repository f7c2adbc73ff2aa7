"""The next row in id order, without one task that sees all rows."""

from __future__ import annotations

from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one bucket at scale; small inputs get a few buckets per shuffle partition.
BUCKET_ROWS = 200_000


def order_key(id_col: Column, text: Column) -> Column:
    """The id; rows without one come below all ids, spread by a hash of their text."""
    return F.coalesce(id_col, F.lit(-(1 << 63)) + F.pmod(F.xxhash64(text), F.lit(1 << 40)))


def literal(values: list, kind: str) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are at most ``key``: a search among
    every ``step``-th bound, then among the ``step`` from there."""
    if not bounds:
        return F.lit(0)
    step = isqrt(len(bounds)) + 1

    def at_most(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= key))

    skipped = F.greatest(at_most(literal(bounds[::step], "bigint")) - 1, F.lit(0)) * step
    return skipped + at_most(F.slice(literal(bounds, "bigint"), skipped + 1, F.lit(step)))


def with_next(docs: DataFrame, derive: dict[str, Column], carried: list[str]) -> DataFrame:
    """``docs(key, text, ...)`` with the columns of ``derive`` and, for each
    name in ``carried``, ``next_<name>``: its value in the next row in
    descending (key, then ascending text) order; after the last row the first.

    Rows are dealt to buckets of neighbouring keys by quantile bounds, and the
    first row of each bucket is also sent to the bucket before it, so whole
    texts are shuffled once and every bucket is sorted on its own.  What comes
    to the driver is one number per bucket."""
    spark = docs.sparkSession
    rows = docs.count()
    n = max(ceil(rows / BUCKET_ROWS), min(rows, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    bounds: list[int] = []
    if n > 1:
        shares = literal([i / n for i in range(1, n)], "double")
        found = docs.agg(F.percentile_approx("key", shares, F.lit(max(10_000, 4 * n))).alias("q")).first()["q"]
        bounds = sorted(set(found or []))
    dealt = docs.withColumn("bucket", bucket_of(F.col("key"), bounds))
    tops = sorted(dealt.groupBy("bucket").agg(F.max("key")).collect(), reverse=True)
    ghosts = [(tops[(i + 1) % len(tops)][1], b) for i, (b, _) in enumerate(tops)]
    target = spark.createDataFrame(ghosts, "key bigint, bucket int")
    first = docs.join(F.broadcast(target), "key").select(*docs.columns, "bucket")
    both = (dealt.withColumn("ghost", F.lit(False)).unionByName(first.withColumn("ghost", F.lit(True)))
            .repartition("bucket").withColumns(derive))
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc("key"), F.asc_nulls_first("text"))
    return (both.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried})
            .filter(~F.col("ghost")).drop("ghost", "bucket"))
