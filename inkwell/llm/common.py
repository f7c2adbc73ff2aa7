"""Helpers shared by the operators: table access, tables written to the
shared folder, and Arrow text batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.session import scratch_path, ship_package

#: Text bytes that a Python task holds as numpy work arrays at one time.
SLICE_BYTES = 2 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table below ``spark.checkpoint.dir`` and read it back:
    cuts the lineage, and what was computed survives a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with this package shipped to the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def slices(batch: pa.RecordBatch, column: str = "text", max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``max_bytes`` of text each; one longer text is a
    slice of its own."""
    n = batch.num_rows
    if n == 0:
        return
    _, offsets = text_buffer(batch.column(column))
    start = 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield batch.slice(start, end - start)
        start = end


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets, without a copy.
    A null text has no bytes."""
    if pa.types.is_large_string(arr.type):
        arr = arr.cast(pa.string())
    _, off, data = arr.buffers()
    if len(arr) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int32, len(arr) + 1, arr.offset * 4).astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, offsets


def text_bytes(arr: pa.Array) -> Iterator[bytes]:
    """Each text as UTF-8 bytes; null counts as empty."""
    buf, offsets = text_buffer(arr)
    raw = memoryview(buf)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield bytes(raw[a:b])


def crc32_table() -> str:
    """DuckDB text of ``crc``: one row, the 256 values of CRC-32's table."""
    turn = "list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)"
    return f"crc AS (SELECT list({turn} ORDER BY n) AS crc FROM range(256) t(n))"


def crc32_sql(text: str) -> str:
    """DuckDB text of the CRC-32 of an ASCII text; ``crc`` has to be in scope."""
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::bigint)"
    turn = "lambda v, b: xor(v >> 8, crc[1 + (xor(v, b) & 255)])"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), {turn}), 4294967295::bigint)"
