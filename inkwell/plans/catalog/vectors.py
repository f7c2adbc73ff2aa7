"""Vectors on the ``embeddings`` table.

Label vectors are the lowest ``vec_id`` row of each label."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from inkwell.operators import embeddings as V
from inkwell.operators.label_index import build_label_index, nearest_labels
from inkwell.operators.ranking import with_rank
from inkwell.operators.vocab import vocab_counts
from inkwell.plans.catalog import register
from inkwell.session import read_table

TOP_N = 3


def _emb(spark, sf):
    return read_table(spark, sf, "embeddings")


def _labels(spark, sf):
    return V.label_vectors_by_min_id(_emb(spark, sf), "label", "embedding", "vec_id")


@register("sentence_vectors", """
SELECT label, CAST(i - 1 AS INTEGER) AS dim, round(avg(x), 6) AS value FROM (
  SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
GROUP BY label, i""")
def sentence_vectors_q(spark, sf):
    return V.mean_pool(_emb(spark, sf), ["label"], "embedding").withColumn("value", F.round("value", 6))


LV = "lv AS (SELECT label, arg_min(embedding, vec_id) AS lvec FROM embeddings GROUP BY label)"


@register("zero_shot_labels", f"""
WITH {LV},
sims AS (SELECT e.vec_id, lv.label,
           list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(lv.lvec AS DOUBLE[])) AS sim
         FROM embeddings e CROSS JOIN lv),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, label) AS rk FROM sims)
SELECT vec_id, CAST(rk AS INTEGER) AS rank, label, round(sim, 5) AS similarity FROM r WHERE rk <= {TOP_N}""")
def zero_shot_labels_q(spark, sf):
    out = V.zero_shot_labels(_emb(spark, sf), "vec_id", "embedding", _labels(spark, sf), "label",
                             "embedding", top_n=TOP_N)
    return out.withColumn("similarity", F.round("similarity", 5))


@register("label_similarity", f"""
WITH {LV},
sims AS (SELECT a.label AS label_a, b.label AS label_b,
           list_cosine_similarity(CAST(a.lvec AS DOUBLE[]), CAST(b.lvec AS DOUBLE[])) AS sim
         FROM lv a CROSS JOIN lv b),
r AS (SELECT *, row_number() OVER (PARTITION BY label_a ORDER BY sim DESC, label_b) AS rk FROM sims)
SELECT label_a, CAST(rk AS INTEGER) AS rank, label_b, round(sim, 5) AS similarity FROM r""")
def label_similarity_q(spark, sf):
    labels = _labels(spark, sf)
    return V.label_similarity(labels, "label", "embedding").withColumn("similarity", F.round("similarity", 5))


@register("nearest_labels", f"""
WITH sims AS (SELECT e.vec_id, l.vec_id AS label,
           round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(l.embedding AS DOUBLE[])), 12) AS sim
         FROM embeddings e CROSS JOIN embeddings l WHERE e.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, label) AS rk FROM sims WHERE sim IS NOT NULL AND NOT isnan(sim))
SELECT vec_id, CAST(rk AS INTEGER) AS rank, label, round(sim, 5) AS similarity FROM r WHERE rk <= {TOP_N}""")
def nearest_labels_q(spark, sf):
    """Every row of the table is a label; the rows to label are those whose id
    is divisible by 100."""
    emb = _emb(spark, sf)
    index = build_label_index(emb, "vec_id", "embedding")
    out = nearest_labels(emb.where(F.col("vec_id") % 100 == 0), "vec_id", "embedding", index, TOP_N)
    return out.withColumn("similarity", F.round("similarity", 5))


def _xy(spark, sf):
    """X = each embedding, Y = the label vector of its label."""
    lab = _labels(spark, sf).select("label", F.col("embedding").alias("target"))
    return _emb(spark, sf).join(lab, "label")


XY = f"""{LV},
xy AS (SELECT e.vec_id, CAST(e.embedding AS DOUBLE[]) AS x, CAST(lv.lvec AS DOUBLE[]) AS y
       FROM embeddings e JOIN lv ON e.label = lv.label),
cells AS (
  SELECT 'xtx' AS kind, i, j, sum(x[i + 1] * x[j + 1]) AS v FROM xy, range(64) a(i), range(64) b(j) GROUP BY i, j
  UNION ALL SELECT 'xty', i, j, sum(x[i + 1] * y[j + 1]) FROM xy, range(64) a(i), range(64) b(j) GROUP BY i, j)"""


@register("gram_cells", f"""
WITH {XY}
SELECT kind, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(v, 4) + 0.0 AS v FROM cells""")
def gram_cells_q(spark, sf):
    return V.gram(_xy(spark, sf), "embedding", "target").withColumn("v", F.round("v", 4) + 0.0)


@register("fit_projection", f"""
WITH {XY}
SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, 0.0::DOUBLE AS residual FROM cells WHERE kind = 'xty'""")
def fit_projection_q(spark, sf):
    """The normal equations hold: every cell of XtX Z - XtY is 0."""
    pairs = _xy(spark, sf)
    z = V.fit_projection(pairs, "embedding", "target")
    xtx, xty = V.gram_matrices(pairs, "embedding", "target")
    cells = V.projection_frame(spark, (xtx @ np.array(z) - xty).tolist())
    return cells.select("i", "j", F.abs(F.round("z", 4)).alias("residual"))


#: A fixed 64 x 8 matrix, by a rule that SQL can repeat.
FIXED_Z = [[((i * 7 + j * 3) % 11 - 5) / 10 for j in range(8)] for i in range(64)]


@register("apply_projection", """
SELECT vec_id, CAST(j AS INTEGER) AS dim, round(list_sum(list_transform(range(64),
  lambda i: CAST(embedding[i + 1] AS DOUBLE) * ((i * 7 + j * 3) % 11 - 5) / 10.0)), 4) + 0.0 AS value
FROM embeddings, range(8) t(j)""")
def apply_projection_q(spark, sf):
    out = V.apply_projection(_emb(spark, sf), "embedding", FIXED_Z, "projected")
    return out.select("vec_id", F.posexplode("projected").alias("dim", "value")).withColumn("value", F.round("value", 4) + 0.0)


WV = r"""
toks AS (SELECT doc_id, unnest(string_split(trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g'), ' '), ' ')) AS term FROM documents),
top AS (SELECT term, count(*) AS n FROM toks WHERE term <> '' GROUP BY term),
wv AS (SELECT t.term, e.embedding FROM (SELECT term, row_number() OVER (ORDER BY n DESC, term) - 1 AS r FROM top) t
       JOIN embeddings e ON e.vec_id = t.r)"""


@register("text_vectors", f"""
WITH {WV},
hit AS (SELECT k.doc_id, w.embedding FROM toks k JOIN wv w ON k.term = w.term)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS dim, round(avg(x), 4) + 0.0 AS value FROM (
  SELECT doc_id, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i FROM hit) GROUP BY doc_id, i""")
def text_vectors_q(spark, sf):
    """Mean word vector of each document; the stand-in word vectors are the
    embeddings in the order of the most frequent words."""
    docs, emb = read_table(spark, sf, "documents").select("doc_id", "text"), _emb(spark, sf)
    top = with_rank(vocab_counts(docs, "text"), [F.desc("n"), F.asc("term")], "vec_id")
    vectors = top.join(emb, "vec_id").select("term", F.col("n").alias("count"), F.col("embedding").alias("vector"))
    out = V.text_vectors(docs, "doc_id", "text", vectors)
    return out.select("doc_id", F.posexplode("vector").alias("dim", "value")).withColumn("value", F.round("value", 4) + 0.0)
