"""Entity enrichment (D1-D14): weights, zero-dropping, null denominators."""

import pytest
from pyspark.sql import functions as F

from inkwell.config import PERSON_TYPE, POLITICAL_PARTY_TYPE, POLITICIAN_TYPE
from inkwell.operators.entities import Enrichment, position_score

MENTION = ("article_key string, source string, uri string, label string, surface_form string, "
           "types array<string>, count int, same_as array<string>")


def _setup(spark):
    P, PP, OH = PERSON_TYPE, POLITICAL_PARTY_TYPE, POLITICIAN_TYPE
    mentions = spark.createDataFrame([
        ("a", "tagger_b", "p1", "Jane Doe", "", [P, OH], 3, []),        # politician, party L (left wing)
        ("a", "tagger_b", "labour_party", "Labour", "", [PP], None, []),  # party mention, count missing -> 1
        ("a", "tagger_b", "p2", "John Roe", "", [P], 1, []),
        ("b", "tagger_b", "centre_x", "Centre", "", [PP], 2, []),        # centrism -> score 0, dropped
        ("c", "tagger_b", "p3", "Zed Q", "", [P], 0, []),                  # zero count -> null proportion
    ], MENTION)
    kb = spark.createDataFrame([
        ("p1", "gender", "female"), ("p1", "party", "labour_party"),
        ("labour_party", "position", "Left-wing"), ("labour_party", "position", "Zzz"),
        ("centre_x", "position", "Centrism"), ("p2", "gender", "male"), ("p3", "gender", "male"),
    ], "subject string, predicate string, value string")
    names = spark.createDataFrame([("Jane", "mostly_female", "detector")], "first_name string, gender string, provider string")
    return Enrichment(mentions, kb, names)


def test_article_features(spark):
    enr = _setup(spark)
    arts = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "article_key string")
    got = {r["article_key"]: r for r in enr.article_features(arts).collect()}
    a = got["a"]
    assert a["political_score"] == pytest.approx(-2.0)          # (-2*3 + -2*1) / 4
    assert a["num_political_references"] == 1                    # one distinct party
    assert a["num_political_reference_entries"] == 4             # weights 3 + 1
    assert a["party_labour_refs"] == 1 and a["party_conservative_refs"] == 0
    assert a["female_proportion"] == pytest.approx(3 / 4)
    assert a["num_people_mentioned"] == 2 and a["num_politicians"] == 1
    assert got["b"]["political_score"] is None                   # only a zero score
    assert got["c"]["female_proportion"] is None                 # zero denominator
    assert got["d"]["num_people_mentioned"] == 0


def test_position_score_order(spark):
    df = spark.createDataFrame([("Centre-left",), ("Right-wing politics",), ("Center-right",), ("x",), (None,)], "p string")
    got = [r["s"] for r in df.select(position_score(F.col("p")).alias("s")).collect()]
    assert got == [-1, 2, 1, None, None]


def test_party_scores(spark):
    rows = _setup(spark).party_scores().orderBy("article_key").collect()
    assert [(r["article_key"], r["position"], r["score"]) for r in rows] == \
        [("a", "Left-wing", 1), ("b", "Centrism", 0)]


def test_hot_article_holding_a_third_of_mentions(spark):
    """One article with a third of all mentions: per-article aggregates are
    partial aggregations, so the hot key needs no special path; values are
    checked against a brute-force computation."""
    P, PP = PERSON_TYPE, POLITICAL_PARTY_TYPE
    rows = []
    for i in range(3000):
        art = "hot" if i % 3 == 0 else f"a{i % 200}"
        if i % 2:
            rows.append((art, "tagger_b", f"p{i % 7}", f"Name{i % 5} X", "", [P], i % 4, []))
        else:
            rows.append((art, "tagger_b", f"labour_party_{i % 3}", "Party", "", [PP], None, []))
    mentions = spark.createDataFrame(rows, MENTION)
    kb = spark.createDataFrame(
        [(f"p{k}", "gender", "female" if k % 2 else "male") for k in range(7)]
        + [(f"labour_party_{k}", "position", ["Left-wing", "Centrism", "Right-wing"][k]) for k in range(3)],
        "subject string, predicate string, value string")
    names = spark.createDataFrame([], "first_name string, gender string, provider string")
    enr = Enrichment(mentions, kb, names)
    arts = spark.createDataFrame([("hot",)], "article_key string")
    got = enr.article_features(arts).first()
    hot = [r for r in rows if r[0] == "hot"]
    fem = sum(r[6] for r in hot if r[5] == [P] and int(r[2][1:]) % 2 == 1)
    both = sum(r[6] for r in hot if r[5] == [P])
    assert got["female_proportion"] == pytest.approx(fem / both)
    scores = {0: -2, 1: 0, 2: 2}
    parties = [int(r[2].rsplit("_", 1)[1]) for r in hot if r[5] == [PP]]
    nz = [scores[k] for k in parties if scores[k] != 0]
    assert got["political_score"] == pytest.approx(sum(nz) / len(nz))
    assert got["num_political_references"] == len(set(parties))
    assert got["num_people_mentioned"] == len(hot) - len(parties)


def test_hot_uri_and_shuffled_dimensions(spark):
    """One subject and one first name in a third of all mentions, with no
    broadcast: same values as with one."""
    P, PP, OH = PERSON_TYPE, POLITICAL_PARTY_TYPE, POLITICIAN_TYPE
    rows = [(f"a{i % 50}", "tagger_b", "hot" if i % 3 == 0 else f"p{i % 40}", "Ann X" if i % 3 == 0 else f"N{i % 9} Y", "",
             [P, OH] if i % 2 else [P, PP], i % 5, []) for i in range(2000)]
    mentions = spark.createDataFrame(rows, MENTION)
    kb = spark.createDataFrame([("hot", "party", "labour_party"), ("labour_party", "position", "Left-wing"), ("hot", "position", "Centrism")]
                               + [(f"p{k}", "gender", "female") for k in range(0, 40, 2)], "subject string, predicate string, value string")
    names = spark.createDataFrame([("Ann", "mostly_female", "detector"), ("N1", "male", "genderize")],
                                  "first_name string, gender string, provider string")
    enr = lambda: Enrichment(mentions, kb, names).per_article
    plain = sorted(map(str, enr().collect()))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, enr().collect())) == plain and len(plain) == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_mentions_are_read_once(spark, tmpdir_path):
    """The final plan scans the mention files once."""
    enr = _setup(spark)
    enr.typed.sparkSession.createDataFrame([], MENTION).write.parquet(f"{tmpdir_path}/m")
    from inkwell.operators.entities import Enrichment as E
    stored = spark.read.parquet(f"{tmpdir_path}/m")
    kb = spark.createDataFrame([("a", "party", "b")], "subject string, predicate string, value string")
    names = spark.createDataFrame([("A", "male", "detector")], "first_name string, gender string, provider string")
    plan = E(stored, kb, names).per_article._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1


def test_party_scores_list_every_mention(spark):
    enr = _setup(spark)
    again = Enrichment(enr.typed.drop("is_person", "is_party", "is_politician").unionAll(
        enr.typed.drop("is_person", "is_party", "is_politician")),
        spark.createDataFrame([("labour_party", "position", "Left-wing"), ("centre_x", "position", "Centrism")],
                              "subject string, predicate string, value string"), enr.name_gender)
    arr = {r["article_key"]: r["partyScore"] for r in again.per_article.collect()}
    assert [(x["name"], x["position"], x["score"]) for x in arr["a"]] == [("Labour", "Left-wing", 1)] * 2
    assert [(x["name"], x["score"]) for x in arr["b"]] == [("Centre", 0)] * 2
    assert arr["c"] == []


def test_feature_record_keeps_duplicate_keys_and_streams_with_a_kb(spark, tmpdir_path):
    from inkwell.plans.features import article_features
    from tests.conftest import article_row, articles_df
    enr = _setup(spark)
    mentions = enr.typed.drop("is_person", "is_party", "is_politician")
    kb = spark.createDataFrame([("p1", "gender", "female")], "subject string, predicate string, value string")
    arts = articles_df(spark, [article_row(key="a", blocks=[("p", "One.", None)])] * 2 + [article_row(key="z", headline="h")])
    out = article_features(arts, mentions=mentions, kb_facts=kb, name_gender=enr.name_gender).collect()
    assert sorted((r["article_key"], r["gender_score"]) for r in out if r["article_key"] == "a") == [("a", 1.0)] * 2
    assert len(out) == 3
    import json
    import os
    from inkwell.streaming.enrich_stream import enrich_stream
    os.makedirs(f"{tmpdir_path}/in")
    with open(f"{tmpdir_path}/in/1", "w") as fo:
        json.dump({"metadata": {}, "promo": {"summary": "s"}, "content": {"blocks": []}}, fo)
    enrich_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/out", mentions=mentions, kb_facts=kb,
                  name_gender=enr.name_gender).awaitTermination(120)
    assert spark.read.json(f"{tmpdir_path}/out").count() == 1
