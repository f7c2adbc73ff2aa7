"""What the feature record computes once per text, mention or URI."""
import re

import pytest
from pyspark.sql import functions as F

from inkwell.functions import sentiment as S
from inkwell.functions.text import collapse_whitespace
from inkwell.operators.entailment import best_probability, term_share_scorer
from inkwell.operators.entities import join_uri, kb_lookup, party_position
from inkwell.operators.labelling import mention_label_aggregates, mention_label_bits

MENTIONS = "article_key string, source string, uri string, label string, surface_form string, types array<string>, count int, same_as array<string>"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_premise_is_lowered_once(spark):
    df = spark.createDataFrame([("Police and CRIME",), ("",), (None,)], "t string")
    out = df.select(best_probability(F.col("t"), ["police", "crime", "court"], term_share_scorer).alias("p"))
    assert [r["p"] and round(r["p"], 6) for r in out.collect()] == [0.625, 0.125, None]
    assert len(re.findall(r"lower\(", out._jdf.queryExecution().optimizedPlan().toString())) == 1


def test_mentions_carry_bits_not_flags(spark):
    teams = [(f"team{i}", f"http://t/{i:03d}#id") for i in range(70)]   # with the categories' more than one long
    cats = {"x": {"should": ["Covid", "Lock Down"], "should_not": ["Drill"]}, "y": {"should": []}}
    rows = [("1", "tagger_a", uri, "COVID", None, None, 1, None) for _, uri in teams[::3]]
    rows += [("1", "tagger_b", None, "a drill", None, None, 1, None), ("2", "tagger_b", None, None, None, None, 1, None)]
    df = spark.createDataFrame(rows, MENTIONS)
    agg, flags = mention_label_bits(df, cats, teams, "article_key")
    assert len(agg.columns) == 3 and len(flags) == 74
    out = {r["article_key"]: r for r in mention_label_aggregates(df, cats, teams).collect()}
    assert [out["1"][n] for n, _ in teams] == [i % 3 == 0 for i in range(70)] and not any(out["2"][n] for n, _ in teams)
    assert [out["1"][f"m_{c}"] for c in ("x__s", "x__n", "y__s", "y__n")] == [True, True, False, False]


def test_uris_are_sorted_by_hash(spark):
    left = spark.createDataFrame([("1", "http://x/a"), ("2", None), ("3", "http://x/a"), ("4", "http://x/c")], "k string, uri string")
    right = spark.createDataFrame([("http://x/a", 1), ("http://x/b", 2), (None, 3)], "uri string, v int")
    for spread in (None, "k"):
        out = join_uri(left, right.hint("merge"), "uri", spread)
        assert out.columns == ["uri", "k", "v"]
        assert {(r["k"], r["v"]) for r in out.collect()} == {("1", 1), ("2", None), ("3", 1), ("4", None)}
        assert re.search(r"Sort \[_hash", plan(out))
    facts = [("u1", "successor", "u2"), ("u2", "position", "Centrism"), ("u3", "wikiPageRedirects", "u2"), ("u4", "successor", "u9"),
             (None, "position", "Left-wing")]
    wide = kb_lookup(spark.createDataFrame(facts, "subject string, predicate string, value string"))
    assert {tuple(r) for r in party_position(wide).collect()} == {
        ("u1", "Centrism"), ("u2", "Centrism"), ("u3", "Centrism"), ("u4", None), (None, "Left-wing")}


WORDS = ["good", "fair", "win", "ok", ":)", "<3", "in", "cut", "x"]
TEXTS = ["not a thing here", "GOOD.", "(good)", "goods and fairness", "ok", "aégood", "Kind KILL", "well:) :) <3", "it's in the red",
         "", "   ", "-", "cut-throat", "cut the mustard", "İLL illİ", "I am ILL!", "_win_", "no,win", "x y", None, "win9 9win"]


def test_texts_passed_over_hold_no_known_word(spark):
    lex = S.lexicon_map()
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    known = F.exists(lex.entries(F.transform(S.tokens(F.col("t")), lex.word)), lambda e: e.isNotNull())
    rows = df.select("t", lex.may_know(F.col("t")).alias("may"), known.alias("known")).collect()
    assert not [r for r in rows if r["known"] and not r["may"]]
    assert {r["t"] for r in rows if r["known"]} >= {"GOOD.", "(good)", "ok", "I am ILL!", "_win_", "Kind KILL"}
    assert {r["t"] for r in rows if r["may"] is False} >= {"not a thing here", "goods and fairness", "win9 9win", "", "-"}


def test_texts_with_only_an_idiom_s_first_word_are_passed_over(spark):
    import random
    lex = S.lexicon_map({"good": 1.9, "bad": -2.5} | {k: 1.5 for k in ("in the red", "to die for", "bad ass", "break a leg", "the bomb")})
    pieces = ["in", "the", "The", "RED", "to", "die,", "for", "a", "x", "7", "-", "--", "(bomb)", "bo\ufdd0mb", "bombs", "bad", "ass!",
              "break", "leg", "é", "İ", "not", "so", "very", "in-the", "\t", "  ", "dog", "dog", "dog"]
    rng = random.Random(5)
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    texts += ["The dog went in to a house, on the hill.", "in a the red", "the x 7 bomb", "the a x 7 a bomb", "the -- bomb", "the - bomb",
              "the bo\ufdd0mb", "break a leg", "break leg", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    whole = F.get(F.transform(S._stage(F.array("t"), lex), lambda st: S._sentence_score(st, lex)), 0)   # nothing passed over
    rows = df.select("t", lex.may_know(F.col("t")).alias("may"), S.sentence_compound(F.col("t"), lex).alias("c"), whole.alias("w")).collect()
    assert not [r for r in rows if r["c"] != r["w"]] and len({r["c"] for r in rows}) > 20
    assert {r["t"]: r["may"] for r in rows}["The dog went in to a house, on the hill."] is False
    assert {r["t"]: r["c"] for r in rows}["the a x 7 a bomb"] > 0


def test_long_text_full_of_single_characters(spark):
    df = spark.createDataFrame([("the " + "a " * 100_000,), ("the" + " " * 200_000 + "bomb",)], "t string")
    assert [r[0] > 0 for r in df.select(S.sentence_compound(F.col("t"))).collect()] == [False, True]


def test_position_scores_come_with_the_kb(spark):
    """One aggregate per article; scores are no step of the mentions."""
    from inkwell.config import PERSON_TYPE, POLITICAL_PARTY_TYPE, POLITICIAN_TYPE
    from inkwell.operators.entities import Enrichment
    people, party = [PERSON_TYPE, POLITICIAN_TYPE], [POLITICAL_PARTY_TYPE]
    rows = [("1", "tagger_b", "p", "Ann X", "", people, 3, []), ("1", "tagger_b", "green_party", None, "Greens", party, None, []),
            ("1", "tagger_b", "green_party", None, "Greens", party, 2, []), ("1", "tagger_b", "y", "Both", "", people + party, 2, []),
            ("2", "tagger_b", "q", "Bob", "", [PERSON_TYPE], 1, []), ("3", "tagger_b", "unknown_green_party", "U", "", party, 4, []),
            ("3", "tagger_b", None, None, None, party, 1, []), (None, "tagger_b", "p", "Ann", "", people, None, [])]
    kb = [("p", "party", "labour_party"), ("labour_party", "position", "Left-wing"), ("green_party", "position", "Centre-left"),
          ("y", "position", "Right-wing"), ("p", "gender", "female")]
    per = Enrichment(spark.createDataFrame(rows, MENTIONS), spark.createDataFrame(kb, "subject string, predicate string, value string"),
                     spark.createDataFrame([("Bob", "male", "genderize")], "first_name string, gender string, provider string")).per_article
    got = {r["article_key"]: r for r in per.collect()}
    assert got["1"]["political_score"] == pytest.approx((3 * -2 + 3 * -1 + 2 * 2) / 8) and got[None]["political_score"] == -2
    assert [tuple(x) for x in got["1"]["partyScore"]] == [("Both", "Right-wing", 0)] + [("Greens", "Centre-left", 1)] * 2
    assert (got["1"]["num_political_references"], got["1"]["num_political_reference_entries"], got["1"]["num_politicians"]) == (3, 8, 2)
    assert got["1"]["party_greens_refs"] == got["1"]["party_labour_refs"] == got["3"]["party_greens_refs"] == 1
    assert [tuple(x) for x in got["3"]["partyScore"]] == [(None, None, 0), ("U", None, 1)] and got["3"]["political_score"] is None
    assert (got["2"]["female_proportion"], got["1"]["female_proportion"], got["2"]["partyScore"]) == (0.0, 1.0, [])
    assert len(re.findall(r"\nAggregate \[article_key|Aggregate \[article_key", per._jdf.queryExecution().optimizedPlan().toString())) == 1


@pytest.mark.parametrize("terms,text,value", [({"café": 2.0}, "CAFÉ", 2.0), ({"++": 1.0}, "a ++ b", 1.0), ({}, "good", 0.0)])
def test_any_lexicon_scores(spark, terms, text, value):
    got = spark.range(1).select(S.sentence_compound(F.lit(text), S.lexicon_map(terms))).first()[0]
    assert got == pytest.approx(value / (value * value + 15) ** 0.5, abs=1e-4)


def test_whitespace_runs(spark):
    texts = ["a b", " a  b ", "a\tb", "a  b\n", "\n\na \t b", "a  b", "a", "", "  "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(collapse_whitespace(F.col("t"))).collect()] == [" ".join(t.split()) for t in texts]
