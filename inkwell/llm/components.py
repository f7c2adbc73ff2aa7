"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges(a, b)`` (bigint); nodes of one
    component share a label, which is one of its nodes.

    Each round every node points to its smallest neighbour (or itself) and the
    edges are redrawn between the nodes pointed to; with node ids in no
    particular order (hash values) the nodes that still have an edge become
    fewer by a constant factor, so the rounds are logarithmic.  Per round: one
    pre-aggregated minimum and two joins on evenly hashed nodes (a hub's rows
    are split by AQE's skew join).  Every round is a written table, so a lost
    executor costs at most one round, and nothing is collected."""
    cols = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    left = written(edges.select(*cols).filter("a <> b").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("p"))
                         .select("node", F.least("node", "p").alias("parent")), "parents")
        pa = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        pb = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        left = written(left.join(pa, "a").join(pb, "b").filter("pa <> pb")
                       .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        if labels is None:
            labels = parent.select("node", F.col("parent").alias("label"))
        else:
            step = parent.select(F.col("node").alias("label"), "parent")
            labels = written(labels.join(step, "label", "left")
                             .select("node", F.coalesce("parent", "label").alias("label")), "labels")
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
