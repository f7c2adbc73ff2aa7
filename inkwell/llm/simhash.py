"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all values within half the radius; two
fingerprints within the radius share at least one of them, so a shuffle on
these variants brings every linked pair together.  Collisions are verified on
the bit distance.  A variant has at most as many distinct fingerprints as its
ball has points (65 at radius 1), so no group is large: exact copies are
folded into one fingerprint beforehand with a pre-aggregated minimum.

Defined results: words are runs other than the six ASCII white-space
characters; a null, empty or blank text has fingerprint 0; the component id is
the smallest non-null doc_id reachable (null where all are null); repeated
rows each get their row; an empty table gives no rows.  Only the named columns
are read, so extra columns never clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from inkwell.llm.common import map_arrow, text_bytes, written
from inkwell.llm.components import connected_components

SEED = 42
#: A fingerprint with over 1 / HEAVY_SHARE of the rows is dealt over SALTS keys.
HEAVY_SHARE, SALTS = 1000, 64
#: Bytes of one text that are cut into words at one time.
BLOCK_BYTES = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _blocks(text: bytes) -> Iterator[bytes]:
    """The text in runs of about BLOCK_BYTES that end at white space."""
    start = 0
    while start < len(text):
        cut = _SPACE.search(text, start + BLOCK_BYTES) if len(text) - start > BLOCK_BYTES else None
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def shingle_hashes(text: bytes, words_per_shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of the space-joined shingles of lower-cased ``text``, in runs;
    fewer words than a shingle has count as one shingle."""
    k, carry, some = words_per_shingle, [], False
    for block in _blocks(text.lower()):
        words = carry + block.split()
        carry = words[len(words) - k + 1:] if len(words) >= k else words
        if len(words) < k:
            continue
        some = True
        joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        first, last = (ends - lengths)[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
        yield np.array([xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in zip(first, last)], np.uint64)
    if carry and not some:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], np.uint64)


def fingerprint(text: bytes, words_per_shingle: int) -> int:
    """Bit i is 1 if it is set in over half of the shingle hashes."""
    ones, total = np.zeros(64, np.int64), 0
    for run in shingle_hashes(text, words_per_shingle):
        total += len(run)
        for part in np.array_split(run, len(run) // 65_536 + 1):
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, words_per_shingle: int, text_col: str = "text") -> DataFrame:
    """(row struct, fingerprint bigint): every row whole, and the 64 bits of
    its text as a signed number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = text_bytes(pa.RecordBatch.from_struct_array(b.column("row")).column(text_col))
            fps = np.fromiter((fingerprint(t, words_per_shingle) for t in texts), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(fps)], names=["row", "fingerprint"])

    rows = docs.select(F.struct("*").alias("row"))
    return map_arrow(rows, run, StructType([*rows.schema.fields, StructField("fingerprint", LongType())]))


def fingerprints(docs: DataFrame, words_per_shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint bigint) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, words_per_shingle) for t in text_bytes(b.column(1))), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["doc_id", "fingerprint"])

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run,
                     "doc_id bigint, fingerprint bigint")


def variants(fp: Column, radius: int) -> Column:
    """All 64-bit values within ``radius`` differing bits of ``fp``."""
    masks = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(64), n)]
    signed = F.lit(",".join(str(m - (1 << 64) if m >> 63 else m) for m in masks))
    return F.transform(F.split(signed, ",").cast("array<bigint>"), lambda m: fp.bitwiseXOR(m))


def links(fps: DataFrame, max_distance: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints of ``fps(fingerprint)`` that
    differ in at most ``max_distance`` bits, enough to connect every linked
    pair.  Even radius: members of a variant's ball are all linked, so each is
    joined to the smallest one.  Odd radius: one side emits the smaller ball,
    the other the larger, and each verified pair is an edge."""
    near, far = max_distance // 2, max_distance - max_distance // 2
    a = fps.select(F.col("fingerprint").alias("b"), F.explode(variants(F.col("fingerprint"), near)).alias("variant"))
    if near == far:
        pairs = a.withColumn("a", F.min("b").over(Window.partitionBy("variant")))
    else:
        pairs = a.join(fps.select(F.col("fingerprint").alias("a"),
                                  F.explode(variants(F.col("fingerprint"), far)).alias("variant")), "variant")
    verified = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    return pairs.filter((F.col("a") != F.col("b")) & verified).select("a", "b")


def near_duplicates(docs: DataFrame, words_per_shingle: int, max_distance: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, label, component_id): ``label`` is a fingerprint
    shared by the whole component, ``component_id`` its smallest doc_id.

    A large group of copies has one fingerprint; when the classes go back to
    the rows, such a fingerprint's rows are dealt over ``SALTS`` join keys."""
    rows = written(fingerprints(docs, words_per_shingle, id_col, text_col), "fingerprints")
    distinct = written(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "distinct")
    labels = connected_components(links(distinct, max_distance))
    members = labels.join(distinct, labels["node"] == distinct["fingerprint"]).select("fingerprint", "label", "first_id")
    smallest = members.groupBy("label").agg(F.min("first_id").alias("component_id"))
    linked = members.drop("first_id").join(smallest, "label")
    classes = distinct.join(linked, "fingerprint", "left").select(
        "fingerprint", F.coalesce("label", "fingerprint").alias("label"),
        F.when(F.col("label").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"))
    # at most HEAVY_SHARE fingerprints can hold more than 1 / HEAVY_SHARE of the rows each
    most = rows.count() / HEAVY_SHARE
    heavy = [r["fingerprint"] for r in distinct.filter(F.col("n") > most).select("fingerprint").collect()]
    is_heavy = F.col("fingerprint").isin(heavy) if heavy else F.lit(False)
    salted = rows.withColumn("salt", F.when(is_heavy, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(0))
    spread = classes.withColumn("salt", F.explode(F.when(
        is_heavy, F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).otherwise(F.array(F.lit(0).cast("bigint")))))
    return salted.join(spread, ["fingerprint", "salt"]).select("doc_id", "fingerprint", "label", "component_id")


def deduplicate(docs: DataFrame, words_per_shingle: int, max_distance: int) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that stand for their
    component: the one with its smallest doc_id (any one of repeated rows; of
    rows without an id only if no row of the component has one).

    Fingerprints are made twice, once for the components and once beside the
    rows, so that whole rows are shuffled once: by (doc_id, fingerprint), which
    no group of copies shares, for the join and for the choice among repeated
    rows."""
    found = near_duplicates(docs, words_per_shingle, max_distance)
    chosen = (found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
              .groupBy("label", "component_id").agg(F.min("fingerprint").alias("fingerprint"))
              .select(*_not_null("component_id"), "fingerprint"))
    rows = with_fingerprint(docs, words_per_shingle).select("row", "fingerprint", *_not_null("row.doc_id"))
    key = ["id", "no_id", "fingerprint"]
    kept = rows.join(chosen, key, "left_semi")
    order = Window.partitionBy(*key).orderBy(F.asc_nulls_first("row.text"))
    one = kept.withColumn("n", F.row_number().over(order)).filter("n = 1")
    return one.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def _not_null(id_col: str) -> list[Column]:
    """An id as two columns that are never null."""
    return [F.coalesce(id_col, F.lit(0)).alias("id"), F.col(id_col).isNull().alias("no_id")]


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
