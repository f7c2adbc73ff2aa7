"""Packing along a space-filling curve.

Every document becomes its token ids and an end id.  The hashed ids are
projected to a few dimensions, which give a Hilbert key; documents are ordered
by (key, doc_id), within runs if some are given, and laid end to end along the curve, and that stream is cut
every ``capacity`` tokens, so a sequence holds neighbours of the curve and
only what is left over at the end is shorter.  That rest is cut at powers of
two, so no sequence needs padding.

Positions in the stream come from a range sort of one small row per document
and one sum per partition; token ids move once, to meet their position.  A
group of equal keys is spread over partitions by doc_id, and nothing but one
number per partition reaches the driver.

Defined results: a null or empty text is the end id alone; repeated rows are
packed once each; null doc_ids come first among equal keys; an empty table
gives no rows.  Only the named columns are read, so extra columns never clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import map_arrow, slices, written
from inkwell.llm.token_ids import word_tokens

#: Tokens of a full sequence, and the id that ends a document.
CAPACITY, END_ID = 4096, 2
#: Dimensions of the projection, bits of each in the Hilbert key, and the
#: stretch that fills the unit cube with the mean vectors of documents.
DIMENSIONS, BITS, STRETCH = 3, 10, 6.0
PROJECTION_SEED = 20

#: Text bytes that are turned into ids at one time.
TOKEN_SLICE = 4 << 20


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Position of each integer point (rows; ``bits`` bits a coordinate) on the
    Hilbert curve, by Skilling's transform (AIP Conf. Proc. 707, 2004)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            high = (x[i] >> b & 1).astype(bool)
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> b & 1, (1 << b) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | x[i] >> b & 1
    return key


def projection(vocabulary: int) -> np.ndarray:
    """A fixed random direction for every token id."""
    return np.random.default_rng(PROJECTION_SEED).standard_normal((vocabulary, DIMENSIONS)).astype(np.float32)


def curve_keys(ids: np.ndarray, ends: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Hilbert key of each document from the mean direction of its ids."""
    begins = np.concatenate([[0], ends[:-1]])
    some = ends > begins
    mean = np.zeros((len(ends), DIMENSIONS))
    if some.any():
        mean[some] = np.add.reduceat(directions[ids], begins[some], axis=0) / (ends - begins)[some, None]
    unit = 1 / (1 + np.exp(-STRETCH * mean))
    return hilbert_keys((unit * (1 << BITS)).astype(np.int64), BITS)


def tokenised(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
              run_col: str | None = None) -> DataFrame:
    """(row_id, doc_id, run, key, doc_tokens, ids binary); row_id numbers the rows
    and is stable once the result is written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(tokenizer)
        directions, end = projection(words.size), np.array([END_ID], words.dtype).tobytes()
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, max_bytes=TOKEN_SLICE):
                ids, ends = words.texts(part.column("text"))
                at = [0, *ends.tolist()]
                raw = [ids[a:b].tobytes() + end for a, b in zip(at, at[1:])]
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), part.column("doc_id"), part.column("run"), pa.array(curve_keys(ids, ends, directions)),
                     pa.array(np.diff(at) + 1), pa.array(raw, pa.binary())],
                    names=["row_id", "doc_id", "run", "key", "doc_tokens", "ids"])
                row += n

    of_run = (F.col(run_col) if run_col else F.lit(0)).cast("bigint").alias("run")
    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), of_run, F.col(text_col).alias("text")), run,
                     "row_id bigint, doc_id bigint, run bigint, key bigint, doc_tokens bigint, ids binary")


def stream_positions(rows: DataFrame) -> tuple[DataFrame, int]:
    """(row_id, position): tokens before each row of ``rows(row_id, doc_id,
    run, key, doc_tokens)`` in curve order within each run, and the number of
    all tokens."""
    spark = rows.sparkSession
    order = ["run", "key", "doc_id", "row_id"]
    ordered = (rows.select(*order, "doc_tokens")
               .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
               .sortWithinPartitions(*order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.column("doc_tokens").to_numpy()
            ends = np.cumsum(n) + before
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part)), b.column("row_id"), pa.array(ends - n), b.column("doc_tokens")],
                names=["part", "row_id", "local", "doc_tokens"])
            before = int(ends[-1]) if len(n) else before

    local = written(map_arrow(ordered, run, "part bigint, row_id bigint, local bigint, doc_tokens bigint"), "positions")
    sums = sorted(tuple(r) for r in local.groupBy("part").agg(F.sum("doc_tokens")).collect())
    total, offsets = 0, []
    for part, n in sums:
        offsets.append((part, total))
        total += n
    base = spark.createDataFrame(offsets, "part bigint, base bigint")
    return (local.join(F.broadcast(base), "part")
            .select("row_id", (F.col("base") + F.col("local")).alias("position")), total)


def sequence_starts(total: int, capacity: int) -> tuple[int, list[int]]:
    """Number of full sequences, and where the sequences of the rest begin:
    its binary digits, the largest first."""
    full, rest = divmod(total, capacity)
    starts, at = [], full * capacity
    while rest:
        starts.append(at)
        size = 1 << rest.bit_length() - 1
        at, rest = at + size, rest - size
    return full, starts


def pieces(rows: DataFrame, positions: DataFrame, total: int, capacity: int, id_bytes: int) -> DataFrame:
    """Cut every document where a sequence of the stream begins."""
    full, rest = sequence_starts(total, capacity)
    tail, rest_ends = full * capacity, [*rest[1:], total]

    def cut(position: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """start, length, sequence, offset"""
        at, end = position, position + n
        while at < end:
            if at < tail:
                seq = at // capacity
                begin, stop = seq * capacity, (seq + 1) * capacity
            else:
                k = int(np.searchsorted(rest, at, side="right")) - 1
                seq, begin, stop = full + k, rest[k], rest_ends[k]
            stop = min(stop, end)
            yield at - position, stop - at, seq, at - begin
            at = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for b in batches:
            out: list[tuple] = []
            for doc_id, n, position, raw in zip(*(b.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "position", "ids"))):
                ids = np.frombuffer(raw, f"<u{id_bytes}").astype("<u4")
                out += [(doc_id, s, k, zlib.crc32(ids[s:s + k]), n, seq, off) for s, k, seq, off in cut(position, n)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else
                                             [pa.array([], pa.int64())] * 7, names=names)

    joined = rows.join(positions, "row_id").select("doc_id", "doc_tokens", "position", "ids")
    return map_arrow(joined, run, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                                  "sequence_id bigint, offset bigint")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text", run_col: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.  ``tokenizer`` is the path of a tokenizer file that
    every executor can open.  Runs of documents by ``run_col`` stay one after
    the other, and the curve orders the documents of each."""
    rows = written(tokenised(docs, tokenizer, id_col, text_col, run_col), "token-ids")
    positions, total = stream_positions(rows)
    return pieces(rows, positions, total, capacity, word_tokens(tokenizer).dtype.itemsize)
