import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwell.operators import label_index as L
from inkwell.operators.embeddings import zero_shot_labels


def frame(spark, vectors, name="label"):
    return spark.createDataFrame([(f"l{i:05d}", None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)],
                                 f"{name} string, vec array<double>")


def clustered(rnd, groups, each, dim, spread):
    centres = rnd.normal(size=(groups, dim))
    return np.vstack([c + spread * rnd.normal(size=(each, dim)) for c in centres])


def brute(rows, labels, top_n):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = np.round(unit(rows) @ unit(labels).T, 12)
    return {(f"l{i:05d}", r + 1): round(float(s[j]), 9) for i, s in enumerate(sims)
            for r, j in enumerate(sorted(range(len(s)), key=lambda j: (-s[j], j))[:top_n])}


def result(df, key="key"):
    return {(r[key], r["rank"]): round(r["similarity"], 9) for r in df.collect()}


@pytest.mark.parametrize("spread", [0.1, 3.0])
def test_equal_to_brute_force(spark, spread):
    rnd = np.random.default_rng(5)
    labels, rows = clustered(rnd, 12, 60, 8, spread), rnd.normal(size=(50, 8))
    index = L.build_label_index(frame(spark, labels), "label", "vec", block_labels=16)
    got = L.nearest_labels(frame(spark, rows, "key"), "key", "vec", index, 5, group_rows=7)
    assert got.columns == ["key", "rank", "label", "similarity"]
    assert result(got) == brute(rows, labels, 5)
    slow = zero_shot_labels(frame(spark, rows, "key"), "key", "vec", frame(spark, labels), "label", "vec", top_n=5)
    assert sorted((r["key"], r["rank"], r["label"]) for r in got.collect()) == sorted((r["key"], r["rank"], r["label"]) for r in slow.collect())


def test_blocks_that_cannot_win_are_skipped(spark):
    rnd = np.random.default_rng(6)
    labels = clustered(rnd, 40, 50, 16, 0.05)
    index = L.build_label_index(frame(spark, labels), "label", "vec")
    assert index.size.sum() == len(labels)
    rows = spark.createDataFrame([(i, (v / np.linalg.norm(v)).tolist(), 0.95) for i, v in enumerate(labels[::20])], "row bigint, unit array<double>, least double")
    pairs = L.blocks_to_see(rows, index, 3).count()
    assert pairs < rows.count() * len(index.block) / 5


def test_bounds_hold_for_every_label(spark):
    rnd = np.random.default_rng(7)
    labels = clustered(rnd, 5, 40, 4, 0.5)
    index = L.build_label_index(frame(spark, labels), "label", "vec", block_labels=8)
    rows = rnd.normal(size=(30, 4))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    bound = L.similarity_bounds(index, rows)
    members = {r["block"]: np.array([m["unit"] for m in r["members"]]) for r in index.blocks.collect()}
    for b, block in enumerate(index.block):
        assert ((rows @ members[block].T).max(axis=1) <= bound[:, b] + 1e-12).all()


def test_ties_repeats_nulls_and_few_labels(spark):
    labels = frame(spark, [[1, 0], [2, 0], [0, 1], None, [0, 0], [1, 0]])
    rows = frame(spark, [[3, 0], None, [0, 0], [-1, 0]], "key")
    twice = rows.unionByName(rows.limit(1))
    index = L.build_label_index(labels, "label", "vec", block_labels=1)
    got = sorted((r["key"], r["rank"], r["label"], r["similarity"]) for r in L.nearest_labels(twice, "key", "vec", index, 9).collect())
    one = [(1, "l00000", 1.0), (2, "l00001", 1.0), (3, "l00005", 1.0), (4, "l00002", 0.0)]
    other = [(1, "l00002", 0.0), (2, "l00000", -1.0), (3, "l00001", -1.0), (4, "l00005", -1.0)]
    assert got == sorted([("l00000", *r) for r in one + one] + [("l00003", *r) for r in other])


def test_empty_tables(spark):
    labels, rows = frame(spark, [[1, 0]]), frame(spark, [[1, 1]], "key")
    none = L.build_label_index(labels.limit(0), "label", "vec")
    assert L.nearest_labels(rows, "key", "vec", none, 3).count() == 0
    assert L.nearest_labels(rows.limit(0), "key", "vec", L.build_label_index(labels, "label", "vec"), 3).count() == 0


def test_one_direction_for_a_third_of_all_labels(spark):
    rnd = np.random.default_rng(8)
    labels = np.vstack([np.tile([1.0, 0, 0], (300, 1)), rnd.normal(size=(600, 3))])
    index = L.build_label_index(frame(spark, labels), "label", "vec", block_labels=32)
    assert index.size.max() < 100
    got = L.nearest_other_labels(frame(spark, labels).where(F.col("label") >= "l00200"), "label", "vec", 2)
    assert result(got, "label_a") == {(f"l{int(k[1:]) + 200:05d}", r): s for (k, r), s in brute(labels[200:], labels[200:], 2).items()}
