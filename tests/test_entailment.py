"""Entailment over whole texts, with the stand-in and with an injected model."""

import numpy as np
import pytest

from inkwell.operators.entailment import entailment_labels, pandas_scorer, pieces, windows
from inkwell.plans.features import article_features
from tests.conftest import article_row, articles_df

TOPICS = {"isOne": ["needle", "pin"]}


def far(word):
    return "filler " * 400 + word


def strict_scorer():
    """A model that refuses empty premises; made inside so that workers need no test module."""
    def factory():
        def model(premises, hypotheses):
            assert all(premises) and len(premises) == len(hypotheses)
            hit = np.array([("needle" in p) and h == "discusses needle or pin" for p, h in zip(premises, hypotheses)])
            return np.stack([np.zeros(len(hit)), np.zeros(len(hit)), np.where(hit, 3.0, -3.0)], axis=1)
        return model
    return pandas_scorer(factory)


def test_a_hit_behind_the_first_window_counts(spark):
    df = spark.createDataFrame([(1, far("needle")), (2, far("nothing")), (3, ""), (4, None), (5, "needle and pin")], "id int, t string")
    for scorer in ({}, {"scorer": strict_scorer()}):
        got = {r["id"]: r["isOne"] for r in entailment_labels(df, "t", ["id"], TOPICS, **scorer).collect()}
        assert got == {1: True, 2: False, 5: True}


def test_an_injected_model_runs_in_the_feature_record(spark):
    rows = [article_row(key="a", blocks=[("p", far("needle"), None)]), article_row(key="b", blocks=[("p", "none", None)]),
            article_row(key="c", headline="no body"), article_row(key="d")]
    out = article_features(articles_df(spark, rows), topics=TOPICS, entail_scorer=strict_scorer())
    assert {r["article_key"]: r["isOne"] for r in out.collect()} == {"a": True, "b": False, "c": None, "d": None}


def test_a_fitted_sarcasm_model_runs_in_the_feature_record(spark):
    from inkwell.operators.classifier import text_pipeline
    train = spark.createDataFrame([("great stuff", 0.0), ("oh sure great", 1.0), ("nice day", 0.0), ("oh sure nice", 1.0)] * 5, "text string, label double")
    model = text_pipeline(num_features=256).fit(train)
    rows = [article_row(key="a", blocks=[("p", "oh sure great. nice day", None)]), article_row(key="d")]
    out = {r["article_key"]: r["sarcasm_score"] for r in article_features(articles_df(spark, rows), sarcasm_model=model).collect()}
    assert out == {"a": 0.5, "d": None}


def test_a_term_over_a_window_edge_counts(spark):
    from pyspark.sql import functions as F
    texts = {at: "x" * at + " needle " + "y" * 1500 for at in (880, 890, 896, 1015, 1018, 1024, 1792, 2000)}
    df = spark.createDataFrame(list(texts.items()), "id int, t string")
    for scorer in ({}, {"scorer": strict_scorer()}):
        assert {r["id"]: r["isOne"] for r in entailment_labels(df, "t", ["id"], TOPICS, **scorer).collect()} == dict.fromkeys(texts, True)
    for r in df.select("t", pieces(F.col("t"), 1024).alias("w")).collect():
        cut = windows(r["w"])
        assert max(map(len, cut)) <= 1024 and cut[0] == r["t"][:1024] and r["t"].endswith(cut[-1])


def test_hits_of_the_whole_text_add_up(spark):
    df = spark.createDataFrame([(1, "needle" + "x" * 3000 + "pin")], "id int, t string")
    terms = {"isAll": ["needle", "pin", "nothing"]}
    assert entailment_labels(df, "t", ["id"], terms).first()["isAll_p"] == pytest.approx(2.5 / 4)
