"""Evaluation (G1-G8), entailment buckets (E10/E11), vectors."""

import pytest
from pyspark.sql import functions as F

from inkwell.operators import embeddings as V
from inkwell.operators import evaluation as G
from inkwell.operators.ranking import exact_quantiles, with_rank
from inkwell.operators.entailment import entailment_bucket, entailment_labels


def test_threshold_sweep_single_class(spark):
    df = spark.createDataFrame([(False, 0.2), (False, 0.7)], "y boolean, p double")
    rows = {r["threshold"]: r for r in G.threshold_sweep(df, "y", "p", [0.5]).collect()}
    r = rows[0.5]
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (1, 1, 0, 0)
    assert r["tpr"] is None and r["fpr"] == 0.5


@pytest.mark.parametrize("p,b", [(0.4, "contradiction"), (0.41, "neutral"), (0.6, "entailment"), (0.59, "neutral")])
def test_entailment_bucket(spark, p, b):
    assert spark.createDataFrame([(p,)], "p double").select(entailment_bucket(F.col("p")).alias("b")).first()["b"] == b


def test_entailment_default_scorer(spark):
    df = spark.createDataFrame([(1, "Police at the court"), (2, ""), (3, "nothing")], "k int, t string")
    got = {r["k"]: r for r in entailment_labels(df, "t", ["k"]).collect()}
    assert 2 not in got                                   # empty text is not scored
    assert got[1]["isLawAndOrder_p"] == pytest.approx(2.5 / 9)
    assert got[3]["isLawAndOrder"] is False


def test_zero_shot_and_projection(spark):
    emb = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [0.0, 1.0])], "id int, v array<double>")
    labels = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 1.0])], "label string, v array<double>")
    out = {(r["id"], r["rank"]): (r["label"], r["similarity"])
           for r in V.zero_shot_labels(emb, "id", "v", labels, "label", "v", top_n=1).collect()}
    assert out[(1, 1)] == ("x", pytest.approx(1.0)) and out[(3, 1)][0] == "y"
    assert out[(2, 1)] == ("y", pytest.approx(0.8))
    xy = emb.select("v", F.col("v").alias("y"))
    z = V.fit_projection(xy, "v", "y")
    assert [x for row in z for x in row] == pytest.approx([1.0, 0.0, 0.0, 1.0], abs=1e-9)


def test_profile_and_accuracy(spark):
    df = spark.createDataFrame([(1, 1, "a"), (0, 1, "b"), (1, 1, "a"), (0, 0, "b")], "t int, p int, c string")
    acc = {r["matches"]: (r["n"], r["accuracy_pct"]) for r in G.label_accuracy(df, "t", "p").collect()}
    assert acc[True] == (3, 75.0) and acc[False] == (1, 75.0)
    prof = {r["stat"]: r["value"] for r in G.profile(df, "t", "c", approx=False).collect()}
    assert prof["count"] == 4 and prof["50%"] == 0.5 and prof["count_a"] == 2


def test_profile_of_many_values_uses_a_sketch(spark):
    df = spark.range(10_001).select((F.col("id") / 10.0).alias("v"))
    prof = {r["stat"]: r["value"] for r in G.profile(df, "v").collect()}
    assert [prof[q] for q in ("25%", "50%", "75%")] == pytest.approx([250.0, 500.0, 750.0], abs=0.5)


def test_sample_is_repeatable(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    a = [r["k"] for r in G.sample_articles(df, "k", 3).collect()]
    b = [r["k"] for r in G.sample_articles(df, "k", 3).collect()]
    assert a == b and len(a) == 3


def test_encode_texts_and_pooling(spark):
    import numpy as np
    df = spark.createDataFrame([(1, "a b"), (2, "b a"), (3, "")], "k int, t string")
    enc = V.encode_texts(df, "t", "v", encoder_factory=lambda: V.HashingEncoder(dim=8))
    rows = {r["k"]: r["v"] for r in enc.collect()}
    assert np.allclose(rows[1], rows[2]) and len(rows[1]) == 8      # order-free mean pooling
    assert np.allclose(rows[3], 0.0)
    pooled = V.mean_pool_vectors(enc.withColumn("g", F.lit(1)), ["g"], "v").first()["v"]
    assert np.allclose(pooled, np.mean([rows[1], rows[2], rows[3]], axis=0))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1000])
def test_exact_quantiles_of_distinct_doubles(spark, n):
    import numpy as np
    values = np.random.default_rng(n).standard_normal(n)
    rows = [(float(v),) for v in values] + [(None,)]
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(spark.createDataFrame(rows, "v double").repartition(5), "v", qs)
    assert got == ([None] * len(qs) if n == 0 else pytest.approx(np.quantile(values, qs), abs=1e-12))


def test_quantiles_of_a_hot_value(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, F.col("id") / 1.0).otherwise(7.0).alias("v"))
    want = sorted(i / 1.0 if i % 3 == 0 else 7.0 for i in range(10_000))
    assert exact_quantiles(df, "v", [0.5, 0.9]) == [want[4999], pytest.approx(want[8999] + (want[9000] - want[8999]) * 0.1)]


def test_rank_counts_on_over_partitions(spark):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5003).alias("x")).repartition(7)
    rows = with_rank(df, [F.desc("x")], "r").collect()
    assert [r["x"] for r in sorted(rows, key=lambda r: r["r"])] == sorted((r["x"] for r in rows), reverse=True)
    assert sorted(r["r"] for r in rows) == list(range(5_000))


def test_roc_curve_against_brute_force(spark):
    import random
    rng = random.Random(3)
    rows = [(rng.random() < 0.3, rng.choice([rng.random(), 0.5, 0.25])) for _ in range(400)] + [(None, 0.1), (True, None)]
    df = spark.createDataFrame(rows, "y boolean, s double").repartition(3)
    got = sorted(G.roc_curve(df, "y", "s").collect(), key=lambda r: -r["threshold"])
    real = [(y, s) for y, s in rows if y is not None and s is not None]
    pos, neg = [s for y, s in real if y], [s for y, s in real if not y]
    assert [(r["threshold"], r["tp"], r["fp"]) for r in got] == [
        (t, sum(s >= t for s in pos), sum(s >= t for s in neg)) for t in sorted({s for _, s in real}, reverse=True)]
    assert (got[-1]["tpr"], got[-1]["fpr"]) == (1.0, 1.0)
    rank = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
    assert len({r["auc"] for r in got}) == 1 and got[0]["auc"] == pytest.approx(rank, abs=1e-12)


def test_roc_curve_of_one_class_or_nothing(spark):
    df = spark.createDataFrame([(False, 0.2), (False, 0.7)], "y boolean, s double")
    assert [(r["tp"], r["fp"], r["tpr"], r["auc"]) for r in G.roc_curve(df, "y", "s").orderBy("threshold").collect()] \
        == [(0, 2, None, None), (0, 1, None, None)]
    assert G.roc_curve(df.limit(0), "y", "s").count() == 0


def test_projection_where_the_gram_matrix_is_singular(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    base = rng.standard_normal((400, 3))
    x = np.column_stack([base[:, 0], base[:, 0] + 1e-9 * base[:, 1], base[:, 2]])
    z = np.array([[1.0, 2.0], [-3.0, 0.5], [0.25, 1.0]])
    assert np.linalg.matrix_rank(x.T @ x) < 3
    df = spark.createDataFrame([(r.tolist(), (r @ z).tolist()) for r in x] + [(None, None)], "x array<double>, y array<double>")
    for parts in (1, 40):
        assert np.allclose(V.fit_projection(df.repartition(parts), "x", "y"), z, atol=1e-4)


def test_projection_with_ridge_and_fewer_rows_than_columns(spark):
    import numpy as np
    rng = np.random.default_rng(2)
    x, y = rng.standard_normal((2, 4)), rng.standard_normal((2, 2))
    df = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(x, y)], "x array<double>, y array<double>").repartition(2)
    assert np.allclose(V.fit_projection(df, "x", "y"), np.linalg.pinv(x) @ y)
    assert np.allclose(V.fit_projection(df, "x", "y", ridge=0.5), np.linalg.solve(x.T @ x + 0.5 * np.eye(4), x.T @ y))
