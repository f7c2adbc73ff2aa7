"""Running sums and ranks over a whole table without one big task.

The rows are range-partitioned by the order and written, every partition is
summed, and each row's running sum inside its partition starts where the
partitions before it end.  Only one row per partition is broadcast."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.session import materialize_table


def with_running_sums(df: DataFrame, order: Sequence[Column], sums: Mapping[str, str]) -> DataFrame:
    """``df`` with a column per entry (new name -> summed column): the sum over
    all rows up to and including this one.  The order must be one of distinct
    rows, else rows that tie share a partition in any order.  The rows are
    written when the plan is built, so that all of it sees the same ranges."""
    part = "_part"
    ranged = materialize_table(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranged")
    totals = ranged.groupBy(part).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)     # one row per partition
    starts = totals.select(part, *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums])
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.select("*", *[F.sum(c).over(inside).alias(n) for n, c in sums.items()]) \
        .join(F.broadcast(starts), part) \
        .select(*df.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in sums])


def with_rank(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """``df`` with the 0-based position of each row in the order."""
    ranked = with_running_sums(df.withColumn("_one", F.lit(1).cast("long")), order, {out: "_one"})
    return ranked.withColumn(out, F.col(out) - 1).drop("_one")


def exact_quantiles(df: DataFrame, value: str, quantiles: Sequence[float]) -> list[float | None]:
    """Quantiles by linear interpolation between the two nearest ranks (NaN is
    the largest value, nulls are left out; no values: None).  Values are counted
    once each, ranked by running counts, and only the wanted ranks are read."""
    counted = df.select(F.col(value).cast("double").alias("v")).where("v is not null") \
        .groupBy("v").agg(F.count("*").alias("n"))
    ranked = with_running_sums(counted, [F.col("v")], {"upto": "n"})
    total = ranked.agg(F.max("upto")).first()[0]
    if not total:
        return [None] * len(quantiles)
    places = [(total - 1) * q for q in quantiles]
    ranks = sorted({r for p in places for r in (math.floor(p), math.ceil(p))})
    rank = F.explode(F.filter(F.array(*[F.lit(r).cast("long") for r in ranks]),
                              lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n"))))
    at = {r["rank"]: r["v"] for r in ranked.select("v", rank.alias("rank")).collect()}
    return [at[math.floor(p)] if p == math.floor(p) else
            at[math.floor(p)] + (at[math.ceil(p)] - at[math.floor(p)]) * (p - math.floor(p)) for p in places]
