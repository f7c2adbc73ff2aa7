"""Merkle manifest of a dataset, stored in van Emde Boas order.

Every row is a leaf.  The leaves of a group, in order, are hashed in pairs
until one node, the group's root, is left; the group roots, in order, make the
top tree in the same way.

A tree is cut into aligned blocks of ``HEIGHT`` levels: block k of a level holds
the subtree over ``2 ** HEIGHT`` nodes from ``k * 2 ** HEIGHT`` on, and its root
is node k of the next level, so the same step goes on over the block roots.  A
block is one binary value of raw digests in van Emde Boas order: the subtree is
split at half its height, the top half stored first and each bottom half behind
it, and those again.  Where a node lies follows from its depth and index alone
(``address``), which building a block and reading the siblings of a leaf both
use.

Leaves are numbered by a range sort: a partition numbers its own rows, and one
small row per partition, carried over on the driver, gives the numbers before
it; a group that holds most rows is spread over partitions and blocks like any
other.  Digests move, texts do not.  Leaves, blocks of each level and paths are
written tables.

Defined results: null keys come first, rows of one key are ordered by their
leaf digest, and a repeated row is one more leaf; a null column is ``-`` in the
leaf; a row without a doc_id is never tampered with; an empty table has no
rows and no root.  Only the named columns are read, so extra columns never
clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import crc32_sql, crc32_table, map_arrow, written
from inkwell.session import ship_package

#: Levels of a block above its leaves.
HEIGHT = 10
#: Bytes of a digest, and of one step of a path: the side of the sibling
#: (``ALONE`` without one), then its digest.
DIGEST, STEP = 32, 33
ALONE, LEFT, RIGHT = 0, 1, 2

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Place in van Emde Boas order of node ``index`` of row ``depth`` of a
    complete binary tree with ``levels`` rows."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    low, below = levels - top, depth - top
    tree, inner = index >> below, index & ((1 << below) - 1)
    return (1 << top) - 1 + tree * ((1 << low) - 1) + address(low, below, inner)


@lru_cache(maxsize=64)
def addresses(levels: int) -> list[np.ndarray]:
    """``address`` of all nodes, by row."""
    return [address(levels, d, np.arange(1 << d)) for d in range(levels)]


def combined(digests: list[bytes]) -> bytes:
    """H over hexadecimal digests."""
    return hashlib.sha256(b"".join(digests)).hexdigest().encode()


def height_of(block: int, leaves: int, height: int) -> int:
    """Only a tree's first block can hold all of the tree; it then ends where
    one node is left."""
    return (leaves - 1).bit_length() if block == 0 and leaves < 1 << height else height


def stored(digests: list[bytes], height: int) -> tuple[bytes, bytes]:
    """The block's nodes in van Emde Boas order, and its root (hexadecimal)."""
    places = addresses(height + 1)
    nodes = np.zeros(((2 << height) - 1, DIGEST), np.uint8)
    row = digests
    for depth in range(height, -1, -1):
        raw = np.frombuffer(bytes.fromhex(b"".join(row).decode()), np.uint8).reshape(-1, DIGEST)
        nodes[places[depth][:len(row)]] = raw
        if depth:
            row = [combined(row[i:i + 2]) for i in range(0, len(row), 2)]
    return nodes.tobytes(), row[0]


def siblings(nodes: bytes, leaves: int, height: int) -> list[bytes]:
    """The path of every leaf inside its block: a step per level, upwards."""
    places = addresses(height + 1)
    table = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
    out = np.zeros((leaves, height, STEP), np.uint8)
    at = np.arange(leaves)
    for up in range(height):
        own, width = at >> up, -(-leaves >> up)
        other = own ^ 1
        there = other < width
        out[there, up, 0] = np.where(other < own, LEFT, RIGHT)[there]
        out[there, up, 1:] = table[places[height - up][other[there]]]
    return [p.tobytes() for p in out]


def steps(path: bytes) -> Iterator[tuple[int, bytes]]:
    """Side and hexadecimal digest of each step."""
    text = path.hex().encode()
    for k in range(0, len(path), STEP):
        yield path[k], text[2 * k + 2:2 * (k + STEP)]


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for side, other in steps(path):
        leaf = combined([leaf] if side == ALONE else [other, leaf] if side == LEFT else [leaf, other])
    return leaf


def proof_digest(path: bytes) -> str:
    """H over the siblings, level by level."""
    return hashlib.sha256(b"".join(d for side, d in steps(path) if side != ALONE)).hexdigest()


def leaf_digest(values: list[Column]) -> Column:
    """H of length-prefixed values; a null is ``-``."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, values)).cast("binary"), 256)


def numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows(tree string, leaf, ...)`` with ``at``: their place in their tree
    in the order of ``keys`` and leaf, as a written table."""
    spark = rows.sparkSession
    order = [F.col("tree"), *[F.col(k).asc_nulls_first() for k in keys], F.col("leaf")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.withColumn("spread", F.monotonically_increasing_id())
    ordered = (spread.repartitionByRange(parts, *order, F.col("spread")).sortWithinPartitions(*order, F.col("spread"))
               .select(*rows.columns))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, runs, tree, count = TaskContext.get().partitionId(), 0, 0, None, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            names = b.column("tree")
            fresh = np.concatenate([[names[0].as_py() != tree],
                                    pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False)]).astype(bool)
            begin = np.maximum.accumulate(np.where(fresh, np.arange(n), -count))
            local = np.arange(n) - begin
            run_of = runs + np.cumsum(fresh)
            first = run_of == 1
            tree, count, runs = names[n - 1].as_py(), int(local[-1]) + 1, int(run_of[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, part)), pa.array(np.arange(seen, seen + n)), pa.array(first), pa.array(local)],
                                             names=[*b.schema.names, "part", "row", "head", "local"])
            seen += n

    local = written(map_arrow(ordered, run, f"{schema}, part bigint, row bigint, head boolean, local bigint"), "leaves")
    ends = local.groupBy("part").agg(F.min_by("tree", "row").alias("first"), F.max(F.struct("row", "tree", "local")).alias("last")).collect()
    before, tree, count = [], None, 0
    for e in sorted(ends, key=lambda e: e["part"]):
        base = count if e["first"] == tree else 0
        before.append((e["part"], base))
        tree, count = e["last"]["tree"], e["last"]["local"] + 1 + (base if e["last"]["tree"] == e["first"] else 0)
    bases = spark.createDataFrame(before, "part bigint, base bigint")
    place = F.col("local") + F.when(F.col("head"), F.col("base")).otherwise(F.lit(0))
    return local.join(F.broadcast(bases), "part").select(*rows.columns, place.alias("at"))


_BLOCK = "tree string, block bigint, leaves int, height int, root string, nodes binary"


def rise(nodes: DataFrame, levels_of_block: int) -> DataFrame:
    """The blocks over ``nodes(tree, at, leaf)``."""
    ship_package(nodes.sparkSession)

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        tree, block = (k.as_py() for k in key)
        digests = [d.encode() for d in rows.sort_by("at").column("leaf").to_pylist()]
        height = height_of(block, len(digests), levels_of_block)
        raw, root = stored(digests, height)
        return pa.table({"tree": pa.array([tree], pa.string()), "block": pa.array([block], pa.int64()),
                         "leaves": pa.array([len(digests)], pa.int32()), "height": pa.array([height], pa.int32()),
                         "root": pa.array([root.decode()]), "nodes": pa.array([raw], pa.binary())})

    block = F.shiftright("at", levels_of_block).alias("block")
    return nodes.select("tree", block, "at", "leaf").groupBy("tree", "block").applyInArrow(run, _BLOCK)


def levels(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The written blocks of each level, from the leaves up."""
    out = []
    while True:
        out.append(written(rise(nodes, height), f"blocks-{len(out)}"))
        if (out[-1].agg(F.max("block")).first()[0] or 0) == 0:
            return out
        nodes = out[-1].select("tree", F.col("block").alias("at"), F.col("root").alias("leaf"))


def paths_below(blocks: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """(tree, at, path, ...) of the nodes under ``blocks``: the path inside the
    block, then that of the block's root, from ``above(tree, at, path, ...)``."""
    carried = [f for f in above.schema if f.name not in ("tree", "at", "path")]
    schema = "tree string, at bigint, path binary" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in carried)
    rows = blocks.drop("root").join(above.withColumnRenamed("at", "block"), ["tree", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                own = siblings(r["nodes"], r["leaves"], r["height"])
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["tree"]] * n, pa.string()), pa.array(np.arange(n) + (r["block"] << height)), pa.array([p + r["path"] for p in own], pa.binary()),
                     *[pa.array([r[f.name]] * n, pa.string()) for f in carried]],
                    names=["tree", "at", "path", *[f.name for f in carried]])

    return map_arrow(rows, run, schema)


@dataclass
class Manifest:
    """``leaves(tree, at, leaf, ...)``, the blocks of each level of the groups'
    trees, and those of the tree over the groups' roots."""

    leaves: DataFrame
    groups: list[DataFrame]
    tops: DataFrame
    top: list[DataFrame]
    height: int

    def group_paths(self) -> DataFrame:
        """(tree, at, path, subroot, root) of every group's root."""
        found = self.top[-1].select("tree", F.col("block").alias("at"), F.lit(b"").alias("path"), "root")
        for blocks in reversed(self.top):
            found = paths_below(blocks, found, self.height)
        named = self.tops.select("at", "group", F.col("leaf").alias("subroot"))
        return found.join(named, "at").select(F.col("group").alias("tree"), F.lit(0).cast("bigint").alias("at"), "path", "subroot", "root")

    def block_paths(self) -> DataFrame:
        """(tree, at, path, subroot, root) of the roots of the lowest blocks."""
        found = self.group_paths()
        for k, blocks in enumerate(reversed(self.groups[1:])):
            found = written(paths_below(blocks, found, self.height), f"paths-{k}")
        return found


def build(rows: DataFrame, keys: list[str], height: int = HEIGHT) -> Manifest:
    """The manifest of ``rows(tree string, key columns, leaf)``."""
    leaves = numbered(rows, keys)
    groups = levels(leaves, height)
    roots = groups[-1].select(F.lit("top").alias("tree"), F.col("tree").alias("group"), F.col("root").alias("leaf"))
    tops = numbered(roots, ["group"])
    return Manifest(leaves, groups, tops, levels(tops, height), height)


def document_leaves(docs: DataFrame, group_col: str = "lang", fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id") -> DataFrame:
    """(tree, doc_id, leaf, claimed) of documents.  ``claimed`` is what a check
    finds: the leaf, or where 7 divides the CRC-32 of the id that of the row
    with one character more in n_chars."""
    def more(c: str) -> Column:
        return (F.col(c).cast("decimal(20,0)") + 1) if c == "n_chars" else F.col(c)

    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col)), F.lit("-"))
    leaf = leaf_digest([F.col(c) for c in fields])
    tampered = F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 0
    return docs.select(tree.alias("tree"), F.col(id_col).alias("doc_id"), leaf.alias("leaf"),
                       F.when(tampered, leaf_digest([more(c) for c in fields])).alias("claimed"))


def proofs(manifest: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of
    every leaf: siblings are read from the blocks, and the claimed leaf is
    folded along them."""
    spark = manifest.leaves.sparkSession
    ship_package(spark)
    schema = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    above = manifest.block_paths().select("tree", F.col("at").alias("block"), "path", "subroot", F.col("root").alias("top_root"))
    blocks = manifest.groups[0].join(above, ["tree", "block"])
    leaves = manifest.leaves.withColumn("block", F.shiftright("at", manifest.height))

    def run(key: tuple, rows: pa.Table, block: pa.Table) -> pa.Table:
        b = block.to_pylist()[0]
        rows = rows.sort_by("at")
        own = [p + b["path"] for p in siblings(b["nodes"], b["leaves"], b["height"])]
        leaf, claimed = rows.column("leaf").to_pylist(), rows.column("claimed").to_pylist()
        roots = [folded((c or x).encode(), p).decode() for x, c, p in zip(leaf, claimed, own)]
        n = len(own)
        return pa.table({"doc_id": rows.column("doc_id"), "leaf": leaf, "subroot": [b["subroot"]] * n, "root": [b["top_root"]] * n,
                         "proof_sha256": [proof_digest(p) for p in own], "folded_root": roots, "verified": [r == b["top_root"] for r in roots]})

    return leaves.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(run, schema)


def oracle() -> str:
    """DuckDB text of the query: both trees level by level, and every leaf folded."""
    def leaf(more: int) -> str:
        def part(c: str) -> str:
            value = f"(n_chars::hugeint + {more})::varchar" if c == "n_chars" else f"{c}::varchar"
            return f"coalesce(strlen({value})::varchar || ':' || {value}, '-')"

        return "sha256(" + " || ".join(map(part, FIELDS)) + ")"

    def tree(name: str, first: str) -> str:
        return f"""{name}(tree, lvl, i, h) AS (
  {first}
  UNION ALL
  SELECT tree, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}) WHERE n > 1 GROUP BY tree, lvl, i // 2)"""

    def fold(name: str, first: str, nodes: str, root: str) -> str:
        return f"""{name}(r, tree, lvl, i, h, proof) AS (
  {first}
  UNION ALL
  SELECT f.r, f.tree, f.lvl + 1, f.i // 2,
         sha256(CASE WHEN s.h IS NULL THEN f.h WHEN f.i % 2 = 1 THEN s.h || f.h ELSE f.h || s.h END), f.proof || coalesce(s.h, '')
  FROM {name} f JOIN {root} USING (tree) LEFT JOIN {nodes} s ON s.tree = f.tree AND s.lvl = f.lvl AND s.i = xor(f.i, 1)
  WHERE f.lvl < {root}.lvl)"""

    root = "(SELECT tree, max(lvl) AS lvl, arg_max(h, lvl) AS h FROM {} GROUP BY tree)"
    return f"""
WITH RECURSIVE {crc32_table()},
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '-') AS tree, {leaf(0)} AS leaf,
                CASE WHEN {crc32_sql("doc_id::varchar")} % 7 = 0 THEN {leaf(1)} END AS claimed FROM documents, crc),
numbered AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM docs),
{tree("nodes", "SELECT tree, 0, i, leaf FROM numbered")},
subs AS {root.format("nodes")},
top_numbered AS (SELECT tree AS own, row_number() OVER (ORDER BY tree) - 1 AS i, h FROM subs),
{tree("top_nodes", "SELECT 'top', 0, i, h FROM top_numbered")},
tops AS {root.format("top_nodes")},
{fold("own", "SELECT r, tree, 0, i, coalesce(claimed, leaf), '' FROM numbered", "nodes", "subs")},
own_done AS (SELECT own.r, own.tree, own.h, own.proof FROM own JOIN subs USING (tree) WHERE own.lvl = subs.lvl),
{fold("above", "SELECT o.r, 'top', 0, t.i, o.h, o.proof FROM own_done o JOIN top_numbered t ON t.own = o.tree", "top_nodes", "tops")},
done AS (SELECT above.r, above.h, above.proof FROM above JOIN tops USING (tree) WHERE above.lvl = tops.lvl)
SELECT n.doc_id, n.leaf, subs.h AS subroot, tops.h AS root, sha256(done.proof) AS proof_sha256, done.h AS folded_root,
       done.h = tops.h AS verified
FROM numbered n JOIN done USING (r) JOIN subs USING (tree), tops"""
