"""Lexicon sentiment (E1-E5): golden anchor and label boundaries."""

import pytest
from pyspark.sql import functions as F

from inkwell.functions import sentiment as S
from inkwell.functions.text import split_on_period, split_sentences
from inkwell.operators.sentiment import article_sentiment


# FIXED VALUES: the golden sentences and the mean that must come out.
def test_golden_mean(spark):
    df = spark.createDataFrame([("VADER is smart, handsome, and funny. A really bad, horrible book.",)], "t string")
    row = df.select(S.sentence_scores(F.col("t")).alias("s")).first()
    assert [x["compound"] for x in row["s"]] == [0.8316, -0.8211]
    mean = df.select(S.mean_of(S.list_scores(split_sentences(F.col("t")))).alias("m")).first()["m"]
    assert mean == pytest.approx(0.00525, abs=1e-9)


def test_another_sentiment_model(spark):
    df = spark.createDataFrame([(1, "Good. Very good!"), (2, None), (3, "")], "k int, t string")
    out = article_sentiment(df, "t", ["k"], scorer=lambda s: F.transform(s, lambda x: F.length(x) / 10.0))
    got = {r["k"]: (r["n_sentences"], r["sentiment_score"], r["sentiment_label"]) for r in out.collect()}
    assert got[1] == (2, pytest.approx(0.75), "positive")
    assert got[2][0] == got[3][0] == 0 and got[2][1] is None and got[3][1] is None


def test_labels_per_sentence_and_aggregated(spark):
    df = spark.createDataFrame([(1, "It was OK"), (2, "A really bad, horrible book.")], "k int, t string")
    per = article_sentiment(df, "t", ["k"], convert_to_sents=False).orderBy("k").collect()
    assert [r["sentiment_label"] for r in per] == ["mildy_positive", "negative"]
    texts = spark.createDataFrame([(["It was OK", "A really bad, horrible book."],)], "t array<string>")
    m = texts.select(S.sentiment_label(S.mean_of(S.list_scores(F.col("t")))).alias("l")).first()["l"]
    assert m == "mildy_negative"


@pytest.mark.parametrize("score,label", [(0.1, "neutral"), (0.1000001, "mildy_positive"), (0.5, "positive"),
                                         (-0.1, "neutral"), (-0.5, "negative"), (-0.4999, "mildy_negative"),
                                         (None, "neutral")])
def test_label_boundaries(spark, score, label):
    df = spark.createDataFrame([(score,)], "s double")
    assert df.select(S.sentiment_label(F.col("s")).alias("l")).first()["l"] == label


def test_negation_booster_but(spark):
    df = spark.createDataFrame([("The food is not good",), ("The food is good",),
                                ("The food is very good",), ("good but bad",)], "t string")
    vals = [r["c"] for r in df.select(S.sentence_compound(F.col("t")).alias("c")).collect()]
    assert vals[0] < 0 < vals[1] < vals[2]
    assert vals[3] < 0          # the clause after 'but' dominates


def test_period_split_keeps_blanks(spark):
    df = spark.createDataFrame([("a. b..",)], "t string")
    assert df.select(split_on_period(F.col("t")).alias("p")).first()["p"] == ["a", " b", "", ""]


def test_large_lexicon_table_plans_fast(spark):
    import time
    docs = spark.createDataFrame([("A really bad, horrible book.",)], "t string")
    big = spark.createDataFrame([(f"w{i}", 1.0) for i in range(50_000)] + [("Bad", -2.5), ("horrible", -2.5), (None, 1.0)],
                                "term string, valence double")
    lex = S.lexicon_map(big)
    t0 = time.perf_counter()
    df = docs.select(S.sentence_compound(F.col("t"), lex).alias("c"))
    df._jdf.queryExecution().executedPlan()
    took = time.perf_counter() - t0
    assert df.first()["c"] == -0.8211
    assert took < 5, took


def test_lexicon_lookup_against_a_dict(spark):
    terms = {f"w{i}é": float(i) for i in range(300)}
    lex = S.lexicon_map(terms)
    df = spark.createDataFrame([(w,) for w in [*terms, "x", "", None]], "w string")
    got = {r["w"]: (r["v"], r["c"]) for r in df.select("w", lex.lookup(F.col("w")).alias("v"), lex.contains(F.col("w")).alias("c")).collect()}
    assert got == {w: (terms.get(w), w in terms) for w in [*terms, "x", "", None]}


def test_trie_regex_takes_the_longest():
    import re
    rx = S.trie_regex([("in", "the", "red"), ("in", "the"), ("to", "die", "for")])

    def framed(text):
        return "".join(f"{S.LOWER}{w}{S.END}" for w in text.split())
    assert re.search(rx, framed("back in the red light")).group(0) == framed("in the red")
    assert re.search(rx, framed("back in the redder light")).group(0) == framed("in the")
    assert re.search(rx, framed("to die fort")) is None


# text, the terms that score it, the same text with those terms as single words
IDIOM_TEXTS = [
    ("They cut the mustard", "They zz1"),
    ("They did not cut the mustard", "They did not zz1"),
    ("A very cut, the mustard!", "A very zz1!"),
    ("CUT THE MUSTARD they said", "ZZ1 they said"),
    ("CUT the MUSTARD they said", "zz1 they said"),
    ("good but in the red", "good but zz2"),
    ("in the red light", "zz2 light"),
    ("in the redder light", "zz3 redder light"),
    ("so in in the red in the", "so in zz2 zz3"),
    ("red in red the in", "red in red the in"),
    ("Well :) then", "Well zz4 then"),
    ("Well :D, then", "Well then"),
    ("Well :D then :)", "Well zz5 then zz4"),
    ("ab cd ef gh", "zz6 ef gh"),
]


def test_idioms_and_emoticons_act_as_single_words(spark):
    plain = {"good": 1.9, "zz1": 2.0, "zz2": -2.0, "zz3": 0.5, "zz4": 2.0, "zz5": 2.3, "zz6": 1.0, "zz7": -3.0}
    table = {"good": 1.9, "cut the mustard": 2.0, "in the red": -2.0, "In The": 0.5, ":)": 2.0, ":d": 2.3,
             "ab cd": 1.0, "cd ef gh": -3.0}
    df = spark.createDataFrame(IDIOM_TEXTS, "a string, b string")
    rows = df.select("a", S.sentence_compound(F.col("a"), S.lexicon_map(table)).alias("x"),
                     S.sentence_compound(F.col("b"), S.lexicon_map(plain)).alias("y")).collect()
    assert {r["a"]: r["x"] for r in rows if r["a"] != "Well :D then :)"} \
        == {r["a"]: r["y"] for r in rows if r["a"] != "Well :D then :)"}
    # an emoticon with a letter counts as a word in capitals
    assert {r["a"]: r["x"] for r in rows}["Well :D then :)"] == pytest.approx(round((2.3 + 0.733 + 2) / ((5.033 ** 2 + 15) ** .5), 4))


def test_long_text_full_of_idioms_is_linear(spark):
    import time
    df = spark.createDataFrame([("so in the red " * 100_000,)], "t string")
    t0 = time.perf_counter()
    assert df.select(S.sentence_compound(F.col("t")).alias("c")).first()["c"] == -1.0
    assert time.perf_counter() - t0 < 20


def test_oracle_agrees_on_idioms(spark):
    import duckdb
    from inkwell.plans.oracle_sentiment import vader_ctes
    texts = [a for a, _ in IDIOM_TEXTS] + [
        "Never so in the black, yeah right", "the bus stop", "to die for the bomb :-( <3", "UPPER hand is VERY good",
        "in the in the black", "kind of to die for", "", "not the bomb the bomb! :/"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = {r["k"]: r["c"] for r in df.select("k", S.sentence_compound(F.col("t")).alias("c")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE src (k INTEGER, stext VARCHAR)")
    con.executemany("INSERT INTO src VALUES (?, ?)", list(enumerate(texts)))
    want = dict(con.execute("WITH s_ AS (SELECT * FROM src)" + vader_ctes("s_", ["k"])
                            + " SELECT k, compound FROM vader_out").fetchall())
    assert got == pytest.approx(want, abs=1e-9)
    assert sum(v != 0 for v in got.values()) > 10
