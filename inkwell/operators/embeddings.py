"""Vectors (E6, E12, E13, E15, E16).

Candidate label vectors and projections are parameters: they are gathered
once and broadcast to the tasks, where each Arrow batch of vectors is one numpy
matrix product -- no cross join, no shuffle, and nothing of them in the plan.
The least-squares projection is solved from a tree of QR factorisations; Gram
matrices are summed per partition, then as whole rows by a partial aggregation.
Of either only matrices of the vectors' width reach the driver."""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.operators.vocab import spaced_words, top_vocab_from_table
from inkwell.session import materialize_table, ship_package


# ---------------------------------------------------------------------------
# Column maths
# ---------------------------------------------------------------------------
def as_double(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two double arrays; zero norm -> null."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def _matrix(arr: pa.Array) -> np.ndarray:
    """Rows of an array column of one length as a float matrix."""
    arr = arr.combine_chunks() if isinstance(arr, pa.ChunkedArray) else arr
    return arr.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(arr), -1)


# ---------------------------------------------------------------------------
# Labels (a parameter)
# ---------------------------------------------------------------------------
def label_vectors_by_min_id(df: DataFrame, label: str, vec: str, order: str) -> DataFrame:
    """One vector per label: the row with the lowest ``order`` value."""
    return df.groupBy(label).agg(F.min_by(F.col(vec), F.col(order)).alias(vec))


def collect_labels(labels: DataFrame, label: str, vec: str) -> tuple[list, np.ndarray]:
    """The candidate labels, sorted, and their vectors as a matrix."""
    rows = sorted(((r[0], r[1]) for r in labels.select(label, vec).collect()), key=lambda t: t[0])
    return [r[0] for r in rows], np.array([r[1] for r in rows], dtype=float)


def zero_shot_labels(df: DataFrame, key: str, vec: str, labels: DataFrame, label: str, label_vec: str,
                     top_n: int | None = 5, z: list[list[float]] | None = None) -> DataFrame:
    """Rank candidate labels by cosine to each row's vector (optionally
    after projecting both by Z); keep the top ``top_n`` (None = all).
    Output ``key, rank (1-based), label, similarity`` (null for a zero vector;
    equal similarities in label order).  The label matrix is broadcast to the
    tasks and each Arrow batch is one matrix product."""
    spark = df.sparkSession
    names, matrix = collect_labels(labels, label, label_vec)
    kind = labels.schema[label].dataType
    if z is not None:
        matrix = matrix @ np.asarray(z, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        matrix = matrix / np.sqrt((matrix ** 2).sum(axis=1, keepdims=True)) if len(matrix) else matrix
    shared = spark.sparkContext.broadcast((matrix, None if z is None else np.asarray(z, dtype=float)))
    n = len(names) if top_n is None else min(top_n, len(names))
    ship_package(spark)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, proj = shared.value
        for b in batches:
            for at in range(0, b.num_rows if n else 0, 1024):
                part = b.slice(at, 1024)
                v = _matrix(part.column(1))
                v = v if proj is None else v @ proj
                size = np.sqrt((v ** 2).sum(axis=1, keepdims=True))
                sims = np.divide(v @ unit.T, size, out=np.full((len(v), len(unit)), np.nan), where=size > 0)
                best = np.argsort(-sims, axis=1, kind="stable")[:, :n]
                found = np.take_along_axis(sims, best, axis=1).ravel()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.repeat(np.arange(len(v)), n))), pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), len(v))),
                     pa.array(best.ravel().astype(np.int32)), pa.array(found, mask=np.isnan(found))], names=[key, "rank", "_at", "similarity"])

    schema = T.StructType([df.schema[key], T.StructField("rank", T.IntegerType()), T.StructField("_at", T.IntegerType()),
                           T.StructField("similarity", T.DoubleType())])
    ranked = df.where(F.col(vec).isNotNull()).select(key, vec).mapInArrow(rank, schema)
    literal = F.from_json(F.lit(json.dumps(names)), T.ArrayType(kind))
    return ranked.select(key, "rank", F.get(literal, F.col("_at")).alias("label"), "similarity")


def label_similarity(labels: DataFrame, label: str, vec: str, z: list[list[float]] | None = None,
                     top_n: int | None = None) -> DataFrame:
    """Label-label cosine matrix, each row ranked: all labels, or the
    ``top_n`` nearest of each."""
    renamed = labels.select(F.col(label).alias("label_a"), F.col(vec).alias("_vec"))
    out = zero_shot_labels(renamed, "label_a", "_vec", labels, label, vec, top_n=top_n, z=z)
    return out.withColumnRenamed("label", "label_b")


# ---------------------------------------------------------------------------
# E6 pooling and encoding
# ---------------------------------------------------------------------------
def mean_pool_vectors(df: DataFrame, group: list[str], vec: str) -> DataFrame:
    """Mean vector of each group, by a partial aggregation of whole vectors."""
    return df.where(F.col(vec).isNotNull()).groupBy(*group).agg(
        vector_to_array(Summarizer.mean(array_to_vector(as_double(F.col(vec))))).alias(vec))


def mean_pool(df: DataFrame, group: list[str], vec: str) -> DataFrame:
    """The same in long form ``group, dim, value``."""
    return mean_pool_vectors(df, group, vec).select(*group, F.posexplode(vec).alias("dim", "value"))


#: Characters of text, about, whose words a task looks up at a time.
BLOCK_CHARS = 16_000_000


def text_vectors(texts: DataFrame, key: str, text: str, word_vectors: DataFrame, out: str = "vector",
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Mean of the word vectors of each text's words (a word counts as
    often as it occurs; words without a vector do not count).  The texts are
    dealt into blocks, and a block gets the vector of each of its words once
    from the ``(term, count, vector)`` table, so vectors move per block, not per
    word of a text.  A key's texts may lie in many blocks: their sums are added
    (the number of blocks is counted when the plan is built)."""
    spark = texts.sparkSession
    ship_package(spark)
    spaced = texts.select(F.col(key).alias("_key"), spaced_words(F.col(text)).alias("_text")).where("_text <> ''")
    chars = texts.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // block_chars))
    dealt = spaced.withColumn("_block", F.pmod(F.xxhash64("_key", "_text"), F.lit(n))).repartition(n, "_block")
    needed = dealt.select("_block", F.explode(F.split("_text", " ")).alias("term")).distinct()
    known = word_vectors.select("term", F.col("vector").alias("_v")).where("term <> '' AND _v IS NOT NULL")
    vectors = needed.join(known, "term").select(F.col("_block").alias("_to"), "term", "_v")

    def sums(found: pa.Table, given: pa.Table) -> pa.Table:
        keys, counts, rows = [], [], []
        if found.num_rows and given.num_rows:
            place = {w: i for i, w in enumerate(dict.fromkeys(given.column("term").to_pylist()))}
            at = np.fromiter((place[w] for w in given.column("term").to_pylist()), np.int64, given.num_rows)
            listed = _matrix(given.column("_v"))
            matrix, times = np.zeros((len(place), listed.shape[1])), np.bincount(at, minlength=len(place))
            np.add.at(matrix, at, listed)
            for i, line in enumerate(found.column("_text")):
                hits = [(place[w], c) for w, c in Counter(line.as_py().split(" ")).items() if w in place]
                if hits:
                    ids, uses = np.array(hits, np.int64).T
                    keys.append(i)
                    counts.append(int(uses @ times[ids]))
                    rows.append(uses.astype(float) @ matrix[ids])
        flat = np.concatenate(rows) if rows else np.zeros(0)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
        return pa.table({"_key": found.column("_key").take(pa.array(keys, pa.int64())), "_n": pa.array(counts, pa.int64()),
                         "_sum": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))})

    schema = T.StructType([T.StructField("_key", texts.schema[key].dataType), T.StructField("_n", T.LongType()),
                           T.StructField("_sum", T.ArrayType(T.DoubleType()))])
    parts = dealt.groupBy("_block").cogroup(vectors.groupBy("_to")).applyInArrow(sums, schema)
    total = parts.groupBy("_key").agg(F.sum("_n").alias("_n"), vector_to_array(Summarizer.sum(array_to_vector("_sum"))).alias("_sum"))
    return total.select(F.col("_key").alias(key), F.transform("_sum", lambda x: x / F.col("_n")).alias(out))


class HashingEncoder:
    """Deterministic stand-in sentence encoder: mean of per-token pseudo
    random unit vectors seeded by a stable hash (no model weights ship
    here).  Any object with ``__call__(list[str]) -> np.ndarray`` works."""

    def __init__(self, dim: int = 64, cached: int = 100_000):
        self.dim = dim
        self._token_vec = lru_cache(cached)(self._token_vec)

    def _token_vec(self, tok: str) -> np.ndarray:
        rng = np.random.default_rng(zlib.crc32(tok.encode("utf-8")))
        v = rng.standard_normal(self.dim)
        return v / np.linalg.norm(v)

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim))
        for r, t in enumerate(texts):
            toks = (t or "").lower().split()
            if toks:
                out[r] = np.mean([self._token_vec(x) for x in toks], axis=0)
        return out


def encode_texts(df: DataFrame, text: str, out: str = "vector",
                 encoder_factory: Callable[[], Callable[[list[str]], np.ndarray]] = HashingEncoder) -> DataFrame:
    """E6 with an injected encoder: an iterator pandas UDF builds the
    encoder once per task and encodes Arrow batches
    (``spark.sql.execution.arrow.maxRecordsPerBatch`` rows each)."""

    ship_package(df.sparkSession)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def _encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder_factory()
        for s in batches:
            mat = enc(s.tolist())
            yield pd.Series([row.tolist() for row in np.asarray(mat)])

    return df.withColumn(out, _encode(F.col(text)))


# ---------------------------------------------------------------------------
# E15 / E16 least-squares projection
# ---------------------------------------------------------------------------
def gram_partials(df: DataFrame, x: str, y: str) -> DataFrame:
    """Per-partition partial XtX and XtY, one array per matrix row:
    ``(kind, i, row)``."""
    ship_package(df.sparkSession)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for b in batches:
            if b.num_rows:
                X, Y = _matrix(b.column(0)), _matrix(b.column(1))
                new = (X.T @ X, X.T @ Y)
                sums = new if sums is None else tuple(s + t for s, t in zip(sums, new))
        for kind, m in zip(("xtx", "xty"), sums or ()):
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(m)), pa.array(np.arange(len(m), dtype=np.int32)),
                                              pa.array(m.tolist(), pa.list_(pa.float64()))], names=["kind", "i", "row"])

    return df.select(x, y).mapInArrow(part, "kind string, i int, row array<double>")


def gram_rows(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows of XtX and XtY, summed over partitions as whole rows."""
    return gram_partials(df, x, y).groupBy("kind", "i").agg(
        vector_to_array(Summarizer.sum(array_to_vector("row"))).alias("row"))


def gram(df: DataFrame, x: str, y: str) -> DataFrame:
    """XtX and XtY cells ``(kind, i, j, v)``."""
    return gram_rows(df, x, y).select("kind", "i", F.posexplode("row").alias("j", "v"))


def gram_matrices(df: DataFrame, x: str, y: str) -> tuple[np.ndarray, np.ndarray]:
    rows = sorted((r["kind"], r["i"], r["row"]) for r in gram_rows(df, x, y).collect())
    return tuple(np.array([row for k, _, row in rows if k == kind]) for kind in ("xtx", "xty"))


#: Triangular factors that one task, or in the end the driver, merges.
MERGED_FACTORS = 16


def _triangles(batches: Iterator[pa.RecordBatch], rows: Callable[[pa.RecordBatch], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One triangular factor of all rows of a task, or none without rows."""
    r = None
    for b in batches:
        if b.num_rows:
            block = rows(b)
            r = np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")
    if r is not None:
        yield pa.RecordBatch.from_arrays([pa.array([r.ravel().tolist()], pa.list_(pa.float64())),
                                          pa.array([r.shape[1]], pa.int32())], names=["r", "width"])


def qr_factor(df: DataFrame, x: str, y: str) -> tuple[np.ndarray, int]:
    """The triangular factor R of [X Y] and the width of X, by a tree of QR
    factorisations: each task factors its rows batch by batch, then factors meet
    ``MERGED_FACTORS`` at a time until the driver has few enough left.  Unlike
    the Gram matrices, R has the condition number of X itself."""
    ship_package(df.sparkSession)
    schema = "r array<double>, width int, x_width int"

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x_width = []

        def rows(b: pa.RecordBatch) -> np.ndarray:
            X = _matrix(b.column(0))
            x_width[:] = [X.shape[1]]
            return np.hstack([X, _matrix(b.column(1))])
        for out in _triangles(batches, rows):
            yield out.append_column("x_width", pa.array(x_width, pa.int32()))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x_width = []

        def rows(b: pa.RecordBatch) -> np.ndarray:
            x_width[:] = [b.column(2)[0].as_py()]
            return _matrix(b.column(0)).reshape(-1, b.column(1)[0].as_py())
        for out in _triangles(batches, rows):
            yield out.append_column("x_width", pa.array(x_width, pa.int32()))

    given = df.select(x, y).where(F.col(x).isNotNull() & F.col(y).isNotNull())
    factors = materialize_table(given.mapInArrow(local, schema), "qr-factors")
    n = factors.count()
    while n > MERGED_FACTORS:
        merged = factors.repartition(-(-n // MERGED_FACTORS)).mapInArrow(merge, schema)
        factors = materialize_table(merged, "qr-factors")
        n = factors.count()
    rows = factors.collect()
    if not rows:
        raise ValueError("no rows to fit")
    stacked = np.vstack([np.reshape(r["r"], (-1, r["width"])) for r in rows])
    return np.linalg.qr(stacked, mode="r"), rows[0]["x_width"]


def fit_projection(df: DataFrame, x: str, y: str, ridge: float = 0.0) -> list[list[float]]:
    """Z = argmin |XZ - Y|^2 + ridge |Z|^2, of the least norm if there are
    several, solved from the triangular factor of [X Y] (its size is bounded by
    the dimensions) on the driver.  Rows with a null vector are left out."""
    r, d = qr_factor(df, x, y)
    a, b = r[:, :d], r[:, d:]
    if ridge:
        a = np.vstack([a, np.sqrt(ridge) * np.eye(d)])
        b = np.vstack([b, np.zeros((d, b.shape[1]))])
    z, *_ = np.linalg.lstsq(a, b, rcond=None)
    return z.tolist()


def fit_vocab_projection(word_vectors: DataFrame, k: int, encoder_factory=None, ridge: float = 0.0) -> list[list[float]]:
    """E15 on words: the ``k`` most frequent terms, their sentence-encoder
    vectors as X and their word vectors as Y."""
    top = top_vocab_from_table(word_vectors, k).select("term").join(word_vectors.select("term", F.col("vector").alias("_y")), "term")
    return fit_projection(encode_texts(top, "term", "_x", encoder_factory or HashingEncoder), "_x", "_y", ridge)


def projection_frame(spark, z: list[list[float]]) -> DataFrame:
    rows = [(i, j, float(z[i][j])) for i in range(len(z)) for j in range(len(z[0]))]
    return spark.createDataFrame(rows, "i int, j int, z double")


def apply_projection(df: DataFrame, vec: str, z: list[list[float]], out: str | None = None) -> DataFrame:
    """Multiply each vector by Z, one matrix product per Arrow batch."""
    shared = df.sparkSession.sparkContext.broadcast(np.asarray(z, dtype=float))
    ship_package(df.sparkSession)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def _apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            given = np.flatnonzero(s.notna())
            found: list = [None] * len(s)
            if len(given):
                for i, row in zip(given, np.stack(s.iloc[given].to_list()).astype(float) @ shared.value):
                    found[i] = row
            yield pd.Series(found, dtype=object)

    return df.withColumn(out or vec, _apply(F.col(vec)))
