import pytest
from pyspark.sql import functions as F

from inkwell.operators import sentence_model
from inkwell.operators.sentence_model import SentenceModel, SentenceTables, train_sentences
from inkwell.operators.sentiment import sentences

CORPUS = (["Dr. Smith came. He left.", "We saw Dr. Jones. He waved.", "The old doctor spoke. He was tired.", "Ask Dr. Brown today. He knows."] * 8
          + ["They met at noon. He paid.", "The bill was small. He smiled. It was late.", "No one came. He went home.", "It rained. He stayed.", "Many came by train and more came late. They came again by car.",
             "Late at noon we left home by car and paid, grew tired, smiled, wept, waved, failed and stayed small today, went and sold it here."] * 8
          + ["The firm Acme Co. of London grew. He sold it.", "Acme Co. of Leeds failed. He wept."] * 8)


def texts(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "k int, text string")


def split(spark, rows, model):
    out = {}
    for r in sentences(texts(spark, rows), "text", ["k"], model.splitter()).orderBy("k", "sent_idx").collect():
        out.setdefault(r["k"], []).append(r["sentence"])
    return [out.get(k, []) for k in range(len(rows))]


@pytest.fixture(scope="module")
def model(spark):
    return train_sentences(texts(spark, CORPUS), "text")


def test_abbreviations_are_learned(model):
    assert {"dr", "co"} <= model.abbreviations
    assert not model.abbreviations & {"came", "left", "it", "he", "home", "noon"}
    assert "he" in model.starters
    assert ("co", "of") in model.collocations


def test_breaks(spark, model):
    assert split(spark, ["Dr. Smith came. He left."], model) == [["Dr. Smith came.", "He left."]]
    cases = {
        "He asked Dr. Who?  Yes!\nHe did.": ["He asked Dr. Who?", "Yes!", "He did."],
        "He runs Acme Co. He is rich.": ["He runs Acme Co.", "He is rich."],
        "J. Smith said (so.) Then he left": ["J. Smith said (so.)", "Then he left"],
        "Wait... what? Well... Fine.": ["Wait... what?", "Well...", "Fine."],
        "One": ["One"], "": [], " \n": [], "Dr.": ["Dr."], "a. b": ["a. b"]}
    assert split(spark, list(cases), model) == list(cases.values())


def test_nothing_learned(spark):
    empty = train_sentences(texts(spark, ["no period here", "", None]), "text")
    assert empty == SentenceModel(frozenset(), frozenset(), frozenset())
    assert split(spark, ["Dr. Smith came. He left.", None], empty) == [["Dr.", "Smith came.", "He left."], []]
    assert train_sentences(texts(spark, CORPUS).limit(0), "text") == empty


def test_sets_are_bounded(spark):
    few = train_sentences(texts(spark, CORPUS), "text", max_types=5)
    assert len(few.abbreviations) <= 5 and len(few.starters) <= 5 and few.abbreviations <= {"dr", "co"}
    rows = texts(spark, CORPUS).select("k", F.lit(None).cast("string").alias("text"))
    assert train_sentences(rows, "text").abbreviations == frozenset()


def test_rare_types_are_learned(spark):
    """One of more than 100,000 words with a period."""
    common = spark.range(105).select(F.repeat(F.lit("so it was and then ended. "), 1000).alias("text"))
    rare = spark.createDataFrame([("we saw co. here",)], "text string")
    model = train_sentences(common.unionByName(rare), "text")
    assert "co" in model.abbreviations
    assert split(spark, ["we saw co. here"], model) == [["we saw co. here"]]


def test_large_sets_stay_tables(spark, model, monkeypatch):
    monkeypatch.setattr(sentence_model, "LITERALS", 1)
    large = train_sentences(texts(spark, CORPUS), "text")
    assert isinstance(large, SentenceTables)
    rows = [(1, "He asked Dr. Who?  Yes!\nHe did. Acme Co. of Leeds. Acme Co. He left."), (1, "J. Smith said (so.) Then he left"),
            (None, "Wait... what? Well... Fine. Dr. Smith came."), (2, None), (2, ""), (2, "Dr."), (1, "J. Smith said (so.) Then he left"),
            *enumerate(CORPUS)]
    df = spark.createDataFrame(rows, "k int, text string")
    found, splitter = large.over(df, "text")
    want = sentences(df, "text", ["k"], model.splitter()).collect()
    assert sorted(map(str, sentences(found, "text", ["k"], splitter).collect())) == sorted(map(str, want))
