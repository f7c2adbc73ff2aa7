"""Evaluation and profiling over labelled documents and articles."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import fields as B
from inkwell.functions import sentiment as S
from inkwell.operators import evaluation as G
from inkwell.operators.classifier import split_bucket
from inkwell.operators.entailment import entailment_labels
from inkwell.functions.predicates import keyword_match
from inkwell.operators.labelling import article_text
from inkwell.plans import oracles as O
from inkwell.plans.catalog import register
from inkwell.plans.catalog.labels import ARTICLE_TEXT_SQL, KEYWORD_FIXTURE, _kw_sql
from inkwell.plans.catalog.models import entail_p_sql
from inkwell.plans.oracle_sentiment import vader_ctes
from inkwell.plans.standins import load_articles
from inkwell.session import read_table

# Rule classifier for the toxic label (deterministic stand-in for a trained
# model) and a repeatable 67/33 split rule.
TOXIC_TERMS = ["idiot", "stupid", "worthless", "trash"]


def _reviews(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    lab = read_table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    j = docs.join(lab, "doc_id")
    return j.select("doc_id", "text", "toxic",
                    F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("sentiment"))


def _encoded(spark, sf):
    r = _reviews(spark, sf)
    lex = S.lexicon_map()
    return r.select("doc_id", "sentiment", G.encode_labels(F.col("sentiment")).alias("encoded_sentiment"),
                    S.sentence_compound(F.col("text"), lex).alias("vader_score")) \
        .withColumn("vader_encoded", G.encode_score(F.col("vader_score")))


REV = ("WITH rev_ AS (SELECT d.doc_id, d.text AS stext, CASE WHEN l.quality = 1 THEN 'positive' ELSE 'negative' END "
       "AS sentiment, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
       + vader_ctes("rev_", ["doc_id"])
       + ", enc_ AS (SELECT r.doc_id, r.sentiment, CASE r.sentiment WHEN 'positive' THEN 1 WHEN 'negative' THEN 0 END "
         "AS encoded_sentiment, v.compound AS vader_score, CASE WHEN v.compound < 0 THEN 0 ELSE 1 END AS vader_encoded "
         "FROM rev_ r JOIN vader_out v ON r.doc_id = v.doc_id)")


@register("encode_labels", REV + " SELECT doc_id, encoded_sentiment, vader_score, vader_encoded FROM enc_")
def encode_labels_q(spark, sf):
    return _encoded(spark, sf).select("doc_id", "encoded_sentiment", "vader_score", "vader_encoded")


@register("label_accuracy", REV + """ SELECT matches, n, round(CAST(sum(CASE WHEN matches THEN n ELSE 0 END) OVER ()
  AS DOUBLE) * 100.0 / sum(n) OVER (), 6) AS accuracy_pct FROM (SELECT encoded_sentiment = vader_encoded AS matches,
  count(*) AS n FROM enc_ GROUP BY 1)""")
def label_accuracy_q(spark, sf):
    out = G.label_accuracy(_encoded(spark, sf), "encoded_sentiment", "vader_encoded")
    return out.withColumn("accuracy_pct", F.round("accuracy_pct", 6))


@register("profile", REV + """ SELECT stat, round(value, 6) AS value FROM (
  SELECT unnest([{'stat': 'count', 'value': CAST(count(vader_score) AS DOUBLE)},
                 {'stat': 'mean', 'value': avg(vader_score)},
                 {'stat': 'std', 'value': stddev_samp(vader_score)},
                 {'stat': 'min', 'value': min(vader_score)},
                 {'stat': '25%', 'value': quantile_cont(vader_score, 0.25)},
                 {'stat': '50%', 'value': quantile_cont(vader_score, 0.5)},
                 {'stat': '75%', 'value': quantile_cont(vader_score, 0.75)},
                 {'stat': 'max', 'value': max(vader_score)}], recursive := true) FROM enc_)
  UNION ALL SELECT 'count_' || sentiment, CAST(count(*) AS DOUBLE) FROM enc_ GROUP BY sentiment""")
def profile_q(spark, sf):
    return G.profile(_encoded(spark, sf), "vader_score", "sentiment", approx=False).withColumn("value", F.round("value", 6))


@register("class_distribution", """
SELECT 'quality' AS "column", CAST(quality AS VARCHAR) AS class, count(*) AS n FROM labels GROUP BY quality
UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR), count(*) FROM labels GROUP BY toxic""")
def class_distribution_q(spark, sf):
    return G.class_distribution(read_table(spark, sf, "labels"), ["quality", "toxic"])


def _split_sql(k: str) -> str:
    return f"((({k} % 1000003) * 7919 + 13) % 100)"


@register("classifier_accuracy", f"""
SELECT CASE WHEN {_split_sql('d.doc_id')} < 67 THEN 'train' ELSE 'test' END AS split, count(*) AS n,
  round(avg(CASE WHEN l.toxic = (CASE WHEN {" OR ".join(f"contains(lower(d.text), {O.q(t)})" for t in TOXIC_TERMS)}
      THEN 1 ELSE 0 END) THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""")
def classifier_accuracy_q(spark, sf):
    r = _reviews(spark, sf)
    low = F.lower(F.col("text"))
    hit = F.lit(False)
    for t in TOXIC_TERMS:
        hit = hit | low.contains(t)
    scored = r.select(F.col("toxic"), F.when(hit, 1).otherwise(0).alias("pred"),
                      F.when(split_bucket(F.col("doc_id")) < 67, "train").otherwise("test").alias("split"))
    return G.classifier_accuracy(scored, "toxic", "pred", "split").withColumn("accuracy", F.round("accuracy", 6))


SWEEP_CAT = "isToxic"
SWEEP_TERMS = KEYWORD_FIXTURE[SWEEP_CAT]["should"]


def _sweep(spark, sf):
    spec = KEYWORD_FIXTURE[SWEEP_CAT]
    truth = keyword_match(article_text(), spec["should"], spec["should_not"])
    rows = load_articles(spark, sf).select(truth.alias("truth"), B.body_raw().alias("body"))
    scored = entailment_labels(rows, "body", ["truth"], topics={SWEEP_CAT: SWEEP_TERMS}, skip_empty=False)
    return G.threshold_sweep(scored, "truth", f"{SWEEP_CAT}_p")


_ys, _yn = _kw_sql("t", KEYWORD_FIXTURE[SWEEP_CAT])
SWEEP_SQL = O.with_articles("", (
    f"sc_ AS (SELECT doc_id, (NOT {_yn} AND {_ys}) AS y, {entail_p_sql('body', SWEEP_TERMS)} AS p "
    f"FROM (SELECT doc_id, {ARTICLE_TEXT_SQL} AS t, {O.BODY_RAW} AS body FROM articles)), "
    "th_(threshold) AS (VALUES (0.3), (0.6), (0.9)), "
    "cm_ AS (SELECT th_.threshold, "
    "CAST(sum(CASE WHEN NOT y AND NOT p >= threshold THEN 1 ELSE 0 END) AS BIGINT) AS tn, "
    "CAST(sum(CASE WHEN NOT y AND p >= threshold THEN 1 ELSE 0 END) AS BIGINT) AS fp, "
    "CAST(sum(CASE WHEN y AND NOT p >= threshold THEN 1 ELSE 0 END) AS BIGINT) AS fn, "
    "CAST(sum(CASE WHEN y AND p >= threshold THEN 1 ELSE 0 END) AS BIGINT) AS tp "
    "FROM th_ CROSS JOIN sc_ GROUP BY th_.threshold), "
    "sw_ AS (SELECT CAST(threshold AS DOUBLE) AS threshold, tn, fp, fn, tp, tp / nullif(tp + fn, 0) AS tpr, "
    "fp / nullif(tn + fp, 0) AS fpr FROM cm_)"))


@register("threshold_sweep", SWEEP_SQL + "SELECT * FROM sw_")
def threshold_sweep_q(spark, sf):
    return _sweep(spark, sf)


@register("roc_points", SWEEP_SQL + """, pt_ AS (
  SELECT threshold, fpr, tpr FROM sw_ WHERE fpr IS NOT NULL AND tpr IS NOT NULL
  UNION ALL SELECT CAST(NULL AS DOUBLE), unnest([0.0, 1.0]), unnest([0.0, 1.0])),
ar_ AS (SELECT threshold, fpr, tpr, (fpr - lag(fpr) OVER w) * (tpr + lag(tpr) OVER w) / 2.0 AS area
  FROM pt_ WINDOW w AS (ORDER BY fpr, tpr, threshold NULLS FIRST))
SELECT threshold, fpr, tpr, (SELECT round(sum(area), 6) FROM ar_) AS auc FROM ar_ WHERE threshold IS NOT NULL""")
def roc_points_q(spark, sf):
    return G.roc_points(_sweep(spark, sf)).withColumn("auc", F.round("auc", 6))


@register("roc_curve", REV + """, n_ AS (SELECT vader_score + length(text) / 1e7 AS threshold,
    count(*) FILTER (encoded_sentiment = 1) AS pos, count(*) FILTER (encoded_sentiment = 0) AS neg
  FROM enc_ JOIN documents USING (doc_id) GROUP BY 1),
c_ AS (SELECT threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM n_ WINDOW w AS (ORDER BY threshold DESC))
SELECT round(threshold, 9) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(tp / p, 6) AS tpr,
  round(fp / n, 6) AS fpr, round((SELECT sum(a.pos * b.neg * CASE WHEN a.threshold > b.threshold THEN 1.0
    WHEN a.threshold = b.threshold THEN 0.5 ELSE 0.0 END) FROM n_ a, n_ b) / (p * n), 6) AS auc FROM c_""")
def roc_curve_q(spark, sf):
    """Sentiment as a classifier of quality; the length sets equal scores apart."""
    lengths = read_table(spark, sf, "documents").select("doc_id", F.length("text").alias("_n"))
    scored = _encoded(spark, sf).join(lengths, "doc_id").select(
        "encoded_sentiment", (F.col("vader_score") + F.col("_n") / 1e7).alias("score"))
    out = G.roc_curve(scored, "encoded_sentiment", "score")
    return out.select(F.round("threshold", 9).alias("threshold"), "tp", "fp",
                      *[F.round(c, 6).alias(c) for c in ("tpr", "fpr", "auc")])


SAMPLE_N = 1


@register("sample_articles", O.with_articles(
    f"SELECT doc_id, {O.URI} AS asset_uri FROM articles ORDER BY md5(article_key), doc_id LIMIT {SAMPLE_N}"))
def sample_articles_q(spark, sf):
    arts = load_articles(spark, sf).select("doc_id", "article_key", B.asset_uri().alias("asset_uri"))
    return G.sample_articles(arts, "article_key", SAMPLE_N).select("doc_id", "asset_uri")
