"""Predicates and keyword labelling."""

from inkwell.functions import predicates as C
from inkwell.operators.labelling import boolean_categories, entity_uri_labels, tagger_labels
from tests.conftest import article_row, articles_df


def _one(spark, col, **kw):
    return articles_df(spark, [article_row(**kw)]).select(col.alias("v")).first()["v"]


def test_news_predicates(spark):
    assert _one(spark, C.is_uk_news(), uri="/news/world-europe-ukraine-12345678") is True   # 'uk' in 'ukraine'
    assert _one(spark, C.is_uk_news(), uri="/news/12345678") is None
    assert _one(spark, C.nation(), uri="/news/uk-northern-ireland-12345678") == "northern-ireland"
    assert _one(spark, C.nation(), uri="/news/uk-england-scotland-12345678") == "england"
    assert _one(spark, C.is_politics(), uri="/news/uk-politics-12345678") is True
    assert _one(spark, C.is_press_review(), headline="The Weekly Papers: x") is True
    assert _one(spark, C.is_press_review()) is False
    assert _one(spark, C.is_red_button_content(), summary="watch DIGIONLY") is True
    assert _one(spark, C.is_red_button_content()) is False
    assert _one(spark, C.is_legal(), headline="Man accused of theft") is True


def test_sport_predicates(spark):
    assert _one(spark, C.is_rankings(["Rankings"]), short="Rankings") is True
    assert _one(spark, C.is_rankings(["Rankings"])) is None
    assert _one(spark, C.is_competition_draw(["12345678"]), uri="/sport/12345678") is True
    assert _one(spark, C.is_competition_draw(["1"]), uri="/sport/") is None
    assert _one(spark, C.is_periodical(["Round-up"]), headline="Weekend ROUND-UP") is True


def test_keyword_spans_segments_and_should_not_wins(spark):
    cats = {"isX": {"should": ["black lives"], "should_not": []},
            "isY": {"should": ["brexit"], "should_not": ["deal"]}}
    about = [("1", "Black", "u", []), ("2", "Lives", "u", [])]
    df = articles_df(spark, [article_row(key="a", about=about, headline="Brexit deal", blocks=[]),
                             article_row(key="b", headline="Brexit", blocks=[])])
    got = {r["article_key"]: (r["isX"], r["isY"]) for r in boolean_categories(df, None, cats).collect()}
    assert got["a"] == (True, False)       # 'black lives' spans two tag labels; should_not wins
    assert got["b"] == (False, True)


def test_tagger_labels_and_entities(spark):
    m = spark.createDataFrame([
        ("a", "tagger_b", "u1", "Arsenal FC", "s", ["t"], 1,
         ["http://x/1", "http://www.bbc.co.uk/things/c4285a9a-9865-2343-af3a-8653f7b70734"]),
        ("a", "tagger_a", "http://www.bbc.co.uk/things/abc#id", None, "s", ["t"], 1, []),
    ], "article_key string, source string, uri string, label string, surface_form string, "
       "types array<string>, count int, same_as array<string>")
    lab = {r["source"]: r for r in tagger_labels(m).collect()}
    assert lab["tagger_a"]["tag_label"] == ""
    assert lab["tagger_b"]["tag_uris"] == ["http://www.bbc.co.uk/things/c4285a9a-9865-2343-af3a-8653f7b70734#id"]
    arts = m.sparkSession.createDataFrame([("a",), ("b",)], "article_key string")
    ent = {r["article_key"]: r for r in entity_uri_labels(arts, m).collect()}
    assert ent["a"]["isArsenal"] is True and ent["b"]["isArsenal"] is False
    assert ent["a"]["entity_flags"][0] is True and sum(ent["a"]["entity_flags"]) == 1
