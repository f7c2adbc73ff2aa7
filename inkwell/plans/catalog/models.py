"""Classifiers and entailment with injected or rule scorers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from inkwell.config import ENTAILMENT_TOPICS
from inkwell.functions import fields as B
from inkwell.operators.entailment import entailment_bucket, entailment_labels, entailment_percent
from inkwell.plans import oracles as O
from inkwell.plans.catalog import register
from inkwell.plans.standins import load_articles


def entail_p_sql(text: str, terms) -> str:
    """P of the whole text."""
    hits = " + ".join(f"(CASE WHEN contains(lower({text}), {O.q(t.lower())}) THEN 1 ELSE 0 END)" for t in terms)
    n = len(terms)
    return f"(1.0 / (1.0 + exp(0.0 - ln(({hits} + 0.5) / ({n} - ({hits}) + 0.5)))))"


PREMISE = O.BODY_CLEAN
ENTAIL_CTE = ("ent_ AS (SELECT doc_id, " + ", ".join(
    f"{entail_p_sql('premise', terms)} AS \"{name}_p\"" for name, terms in ENTAILMENT_TOPICS.items())
    + f" FROM (SELECT doc_id, {PREMISE} AS premise FROM articles) WHERE premise IS NOT NULL AND premise <> '')")


def _entail(spark, sf):
    arts = load_articles(spark, sf).select("doc_id", B.body_clean().alias("body"))
    return entailment_labels(arts, "body", ["doc_id"])


@register("entailment_labels", O.with_articles(
    "SELECT doc_id, " + ", ".join(f"round(\"{n}_p\", 6) AS \"{n}_p\", \"{n}_p\" >= 0.5 AS \"{n}\""
                                  for n in ENTAILMENT_TOPICS)
    + " FROM ent_", ENTAIL_CTE))
def entailment_labels_q(spark, sf):
    e = _entail(spark, sf)
    return e.select("doc_id", *[c for n in ENTAILMENT_TOPICS for c in (
        F.round(f"{n}_p", 6).alias(f"{n}_p"), F.col(n))])


@register("entailment_bucket", O.with_articles(
    " UNION ALL ".join(
        f"SELECT doc_id, {O.q(n)} AS topic, round(\"{n}_p\", 6) AS p, round(\"{n}_p\" * 100.0, 4) AS percent, "
        f"CASE WHEN \"{n}_p\" <= 0.4 THEN 'contradiction' WHEN \"{n}_p\" >= 0.6 THEN 'entailment' "
        f"ELSE 'neutral' END AS bucket FROM ent_" for n in ENTAILMENT_TOPICS), ENTAIL_CTE))
def entailment_bucket_q(spark, sf):
    e = _entail(spark, sf)
    long = e.select("doc_id", F.explode(F.array(*[
        F.struct(F.lit(n).alias("topic"), F.col(f"{n}_p").alias("p")) for n in ENTAILMENT_TOPICS])).alias("t"))
    p = F.col("t.p")
    return long.select("doc_id", F.col("t.topic").alias("topic"), F.round(p, 6).alias("p"),
                       F.round(entailment_percent(p), 4).alias("percent"), entailment_bucket(p).alias("bucket"))


# ---------------------------------------------------------------------------
# Spark ML on documents x labels
# ---------------------------------------------------------------------------
from inkwell.operators import classifier as CL  # noqa: E402
from inkwell.operators import kernel as KN  # noqa: E402
from inkwell.session import read_table, scratch_path  # noqa: E402


def _labelled(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return docs.join(read_table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")


SPLIT_SQL = "CASE WHEN ((d.doc_id % 1000003) * 7919 + 13) % 100 < 67 THEN 'train' ELSE 'test' END"


@register("train_text_classifier", f"""
SELECT {SPLIT_SQL} AS split, count(*) AS n, true AS better_than_chance
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""")
def train_text_classifier_q(spark, sf):
    """Rows of each side, and whether the fitted model is right on more than
    half of them."""
    _model, report = CL.train_text_classifier(_labelled(spark, sf), "doc_id", "text", "toxic")
    return report.select("split", "n", (F.col("accuracy") > 0.5).alias("better_than_chance"))


@register("grid_search", """
SELECT reg_param, max_iter, true AS accuracy_is_share, 1::BIGINT AS n_best
FROM (VALUES (0.01::DOUBLE, 10::INTEGER), (0.1::DOUBLE, 10::INTEGER)) g(reg_param, max_iter)""")
def grid_search_q(spark, sf):
    _model, grid = CL.grid_search(_labelled(spark, sf), "doc_id", "text", "toxic")
    best = F.sum(F.col("best").cast("long")).over(Window.partitionBy(F.lit(1)))
    return grid.select("reg_param", "max_iter", F.col("accuracy").between(0.0, 1.0).alias("accuracy_is_share"), best.alias("n_best"))


@register("kernel_classifier", f"""
SELECT {SPLIT_SQL} AS split, count(*) AS n, round(greatest(avg(quality), 1 - avg(quality)), 6) AS majority,
  true AS beats_majority FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL GROUP BY 1""")
def kernel_classifier_q(spark, sf):
    """The best of a grid of kernel SVMs on sentence vectors is right more often
    than the commoner class, on the training and on the test side."""
    labels = read_table(spark, sf, "labels").select("doc_id", "quality")
    rows = read_table(spark, sf, "documents").select("doc_id", "text").join(labels, "doc_id")
    _model, _grid, report = KN.kernel_grid_search(rows, "doc_id", "text", "quality", regs=(1e-4,))
    return report.select("split", "n", F.round("majority", 6).alias("majority"),
                         (F.col("accuracy") > F.col("majority")).alias("beats_majority"))


@register("model_artifact", f"""
SELECT d.doc_id, true AS same FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE {SPLIT_SQL} = 'test'""")
def model_artifact_q(spark, sf):
    data = _labelled(spark, sf).select("doc_id", "text", F.col("toxic").cast("double").alias("label"))
    train, test = CL.train_test_split(data, "doc_id")
    model = CL.text_pipeline().fit(train)
    path = scratch_path(spark, "model")
    CL.save_model(model, path)
    reloaded = CL.load_model(path)
    a = model.transform(test).select("doc_id", F.col("prediction").alias("prediction"))
    b = reloaded.transform(test).select("doc_id", F.col("prediction").alias("reloaded_prediction"))
    return a.join(b, "doc_id").select("doc_id", (F.col("prediction") == F.col("reloaded_prediction")).alias("same"))


SARCASM_RULE = ["!", "idiot", "stupid"]


@register("article_sarcasm", O.with_articles(
    "SELECT doc_id, count(*) AS n_fragments, avg(CASE WHEN " + " OR ".join(
        f"contains(lower(frag), {O.q(t)})" for t in SARCASM_RULE)
    + f" THEN 1.0 ELSE 0.0 END) AS sarcasm_score FROM (SELECT doc_id, unnest(string_split(c, '.')) AS frag "
      f"FROM (SELECT doc_id, {O.COMBINED} AS c FROM articles) WHERE c IS NOT NULL) GROUP BY doc_id"))
def article_sarcasm_q(spark, sf):
    arts = load_articles(spark, sf).select("doc_id", B.combined_text().alias("text"))
    return CL.article_sarcasm(arts, "doc_id", "text", scorer=CL.rule_scorer(SARCASM_RULE))
