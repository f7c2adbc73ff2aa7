"""Nearest labels among many (E12, E13): an inverted file with exact results.

Labels are dealt to the nearest of about sqrt(n) centres and, within a centre,
to rings of equal angle around it and blocks of about ``BLOCK_LABELS`` labels.
A vector at angle t from a centre is at least max(0, t - far, near - t) away
from every label of a block that spans the angles [near, far], so a block whose
bound is below a row's n-th best similarity cannot hold one of its n nearest
labels.  Each row is first matched with the blocks of the best bounds that hold
n labels; the similarity of the n-th of these decides which blocks it has to
see.  Nothing is approximated: centres only decide how many blocks are skipped.

A (row, block) pair is two numbers; rows meet blocks by a cogroup on (block,
part), one matrix product each, where a block that many rows have to see has as
many parts as it needs.  To the driver come the centres and one line of bounds
per block.

Defined results: labels and rows with a null or zero vector have no direction
and do not take part; with fewer labels than asked for, all are ranked;
similarities equal to 12 places are ties, in label order; repeated labels and
repeated keys each count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.functions.text import bind
from inkwell.operators.embeddings import _matrix, as_double, norm
from inkwell.session import materialize_table, ship_package

#: Labels of a block, and rows that meet a block in one group.
BLOCK_LABELS, GROUP_ROWS = 256, 4096
#: The centres are fitted on the labels with the smallest hashes; every label is indexed.
SAMPLE_LABELS, MAX_CENTRES, ITERATIONS = 20_000, 4096, 5
#: Angle of a ring; a centre has at most 32.
RING = 0.1
#: What rounding can add to an angle, and to a similarity.
ANGLE_SLACK, SIMILARITY_SLACK = 1e-7, 1e-9
#: Cells of a row-by-block matrix held at one time.
CELLS = 1 << 20


def unit(v: Column) -> Column:
    """The vector at length 1; null without a direction."""
    return bind(as_double(v), lambda d: bind(norm(d), lambda s: F.when(s > 0, F.transform(d, lambda x: x / s))))


@dataclass(frozen=True)
class LabelIndex:
    """``blocks(block, members array<struct<label, unit>>)``, members in label
    order, with the centres and each block's centre, angles and size."""
    centres: np.ndarray
    blocks: DataFrame
    block: np.ndarray
    centre: np.ndarray
    near: np.ndarray
    far: np.ndarray
    size: np.ndarray
    label_type: T.DataType


def fit_centres(units: np.ndarray, k: int, iterations: int = ITERATIONS) -> np.ndarray:
    """Spherical k-means from the first k rows; a centre without rows stays."""
    centres = units[:k].copy()
    for _ in range(iterations):
        nearest = np.argmax(units @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres


def build_label_index(labels: DataFrame, label: str, vec: str, block_labels: int = BLOCK_LABELS) -> LabelIndex:
    spark = labels.sparkSession
    kind = labels.schema[label].dataType
    given = labels.select(F.monotonically_increasing_id().alias("at"), F.col(label).alias("label"), unit(F.col(vec)).alias("unit"))
    units = materialize_table(given.where(F.col("unit").isNotNull()), "label-units")
    n = units.count()
    sample = units.orderBy(F.xxhash64("at")).limit(SAMPLE_LABELS).select("unit").collect()
    points = np.array([r["unit"] for r in sample], dtype=float)
    centres = fit_centres(points, min(ceil(sqrt(n)), MAX_CENTRES, len(points))) if n else np.zeros((0, 0))
    shared = spark.sparkContext.broadcast(centres)
    ship_package(spark)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                cosine = _matrix(part.column(2)) @ shared.value.T
                best = np.argmax(cosine, axis=1)
                angle = np.arccos(np.clip(cosine[np.arange(len(best)), best], -1, 1))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(best.astype(np.int64)), pa.array(angle)],
                                                 names=[*part.schema.names, "centre", "angle"])

    schema = T.StructType([*units.schema.fields, T.StructField("centre", T.LongType()), T.StructField("angle", T.DoubleType())])
    dealt = materialize_table(units.mapInArrow(nearest, schema).withColumn("ring", F.floor(F.col("angle") / RING)), "label-cells")
    # at most MAX_CENTRES x 32 rows
    parts = dealt.groupBy("centre", "ring").agg(F.ceil(F.count("*") / block_labels).alias("parts"))
    cell = F.col("centre") * 64 + F.col("ring")
    named = dealt.join(F.broadcast(parts), ["centre", "ring"]).withColumn(
        "block", F.shiftleft(cell, 32) + F.pmod(F.xxhash64("at"), F.col("parts")))
    blocks = materialize_table(named.groupBy("block").agg(
        F.first("centre").alias("centre"), F.min("angle").alias("near"), F.max("angle").alias("far"), F.count("*").alias("n"),
        F.array_sort(F.collect_list(F.struct("label", "unit"))).alias("members")), "label-blocks")
    bounds = blocks.select("block", "centre", "near", "far", "n").orderBy("block").collect()
    block, centre, near, far, size = (np.array([r[i] for r in bounds], dtype=t) for i, t in enumerate([np.int64, np.int64, float, float, np.int64]))
    return LabelIndex(centres, blocks.select("block", "members"), block, centre, near, far, size, kind)


def similarity_bounds(index: LabelIndex, units: np.ndarray) -> np.ndarray:
    """For each row and block, what no similarity to a label of it exceeds."""
    t = np.arccos(np.clip(units @ index.centres.T, -1, 1))[:, index.centre]
    away = np.maximum(np.maximum(t - index.far, index.near - t), 0)
    return np.cos(np.maximum(away - ANGLE_SLACK, 0))


def blocks_to_see(rows: DataFrame, index: LabelIndex, top_n: int) -> DataFrame:
    """(row, block) pairs of ``rows(row, unit[, least])``: the blocks whose
    bound reaches ``least``, or without it the best-bounded that hold ``top_n``
    labels."""
    bare = LabelIndex(index.centres, None, index.block, index.centre, index.near, index.far, index.size, None)
    shared = rows.sparkSession.sparkContext.broadcast(bare)
    ship_package(rows.sparkSession)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx = shared.value
        step = max(CELLS // max(len(idx.block), 1), 1)
        for b in batches:
            for at in range(0, b.num_rows if len(idx.block) else 0, step):
                part = b.slice(at, step)
                bound = similarity_bounds(idx, _matrix(part.column(1)))
                if part.num_columns > 2:
                    least = part.column(2).to_numpy(zero_copy_only=False).astype(float)
                    row, block = np.nonzero(bound >= least[:, None] - SIMILARITY_SLACK)
                else:
                    order = np.argsort(-bound, axis=1, kind="stable")
                    held = np.cumsum(idx.size[order], axis=1)
                    row, place = np.nonzero(held - idx.size[order] < top_n)
                    block = order[row, place]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(idx.block[block])], names=["row", "block"])

    return rows.mapInArrow(choose, "row bigint, block bigint")


def best_in_blocks(rows: DataFrame, pairs: DataFrame, index: LabelIndex, top_n: int, group_rows: int) -> DataFrame:
    """(row, label, similarity, rank): the ``top_n`` labels of each row in the
    blocks it is paired with."""
    pairs = materialize_table(pairs, "label-pairs")
    parts = pairs.groupBy("block").agg(F.ceil(F.count("*") / group_rows).alias("parts"))
    left = (pairs.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
            .join(rows.select("row", "unit"), "row").select("block", "part", "row", "unit"))
    right = index.blocks.join(parts, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "members")

    def rank(given: pa.Table, block: pa.Table) -> pa.Table:
        names = ["row", "label", "similarity"]
        if not given.num_rows or not block.num_rows:
            return out_schema.empty_table()
        members = block.column("members").combine_chunks().flatten()
        labels, units = members.field("label"), _matrix(members.field("unit"))
        sims = np.round(_matrix(given.column("unit")) @ units.T, 12)
        best = np.argsort(-sims, axis=1, kind="stable")[:, :top_n]
        row = given.column("row").combine_chunks().take(pa.array(np.repeat(np.arange(len(sims)), best.shape[1])))
        return pa.Table.from_arrays([row, labels.take(pa.array(best.ravel())),
                                     pa.array(np.take_along_axis(sims, best, axis=1).ravel())], names=names)

    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("label", index.label_type), T.StructField("similarity", T.DoubleType())])
    from pyspark.sql.pandas.types import to_arrow_schema
    out_schema = to_arrow_schema(schema)
    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(rank, schema)
    order = Window.partitionBy("row").orderBy(F.desc("similarity"), "label")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n)


def nearest_labels(df: DataFrame, key: str, vec: str, index: LabelIndex, top_n: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(``key``, rank, label, similarity): the ``top_n`` labels of the highest
    cosine to each row's vector, as ``zero_shot_labels`` finds them by comparing
    every row with every label."""
    rows = materialize_table(df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), unit(F.col(vec)).alias("unit"))
                             .where(F.col("unit").isNotNull()), "label-rows")
    first = best_in_blocks(rows, blocks_to_see(rows.select("row", "unit"), index, top_n), index, top_n, group_rows)
    least = first.where(F.col("rank") == top_n).select("row", F.col("similarity").alias("least"))
    bounded = rows.join(least, "row", "left").select("row", "unit", F.coalesce("least", F.lit(-2.0)).alias("least"))
    found = best_in_blocks(rows, blocks_to_see(bounded, index, top_n), index, top_n, group_rows)
    return found.join(rows.select("row", "key"), "row").select(F.col("key").alias(key), "rank", "label", "similarity")


def nearest_other_labels(labels: DataFrame, label: str, vec: str, top_n: int) -> DataFrame:
    """E13 for many labels: (label_a, rank, label_b, similarity), the ``top_n``
    nearest labels of each label, itself included, without the whole matrix."""
    found = nearest_labels(labels.select(F.col(label).alias("label_a"), vec), "label_a", vec, build_label_index(labels, label, vec), top_n)
    return found.withColumnRenamed("label", "label_b")
