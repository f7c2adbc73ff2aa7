"""Field projections: docstring and boundary cases."""

from pyspark.sql import functions as F

from inkwell.functions import fields as B
from tests.conftest import article_row, articles_df


def _one(spark, col, **kw):
    return articles_df(spark, [article_row(**kw)]).select(col.alias("v")).first()["v"]


def test_article_category_name(spark):
    assert _one(spark, B.article_category_name(), uri="/russian/news-12345678") == "news"
    assert _one(spark, B.article_category_name(), uri="/sport/football/") is None
    assert _one(spark, B.article_category_name(), uri="/news/12345678") is None          # bare 8 digits
    assert _one(spark, B.article_category_name(), uri="/news/123456789") == "1"          # 9 digits
    assert _one(spark, B.article_category_name(), uri="/news/UK-Politics--12345678") == "uk-politics-"


def test_category_levels_and_site(spark):
    uri = "/sport/football/12345678"
    assert _one(spark, B.category_level(0), uri=uri) == "sport"
    assert _one(spark, B.category_level(1), uri=uri) == "football"
    assert _one(spark, B.category_level(2), uri=uri) is None
    assert _one(spark, B.site(), uri=uri) == "sport"
    assert _one(spark, B.site(), uri=None) is None
    assert _one(spark, B.category_level(0), uri="/x") is None


def test_iso_dates_seconds_vs_millis(spark):
    assert _one(spark, B.last_published(), last_published=1564754800836) == "2019-08-02T14:06:40+00:00"
    assert _one(spark, B.last_published(), last_published=1353921092) == "2012-11-26T09:11:32+00:00"
    # exactly 1e11 is seconds (strictly greater means milliseconds)
    assert _one(spark, B.last_published(), last_published=100_000_000_000).startswith("5138-11-16T09:46:40")
    assert _one(spark, B.last_published(), last_published=0) is None
    assert _one(spark, B.news_update_or_last_published(), last_published=1353921092, timestamp=0) \
        == "2012-11-26T09:11:32+00:00"


def test_body_and_combined(spark):
    blocks = [("image", None, None), ("paragraph", "Hello &amp; <bold>world</bold>", "x"),
              ("paragraph", "  second line ", "x")]
    assert _one(spark, B.body_clean(), blocks=blocks) == "Hello & world second line"
    assert _one(spark, B.body_raw(), blocks=blocks) == "Hello &amp; <bold>world</bold>  second line "
    assert _one(spark, B.combined_text(), headline="H", summary="", blocks=blocks) == \
        "H Hello & world second line"
    assert _one(spark, B.combined_text(), headline="", blocks=[]) is None


def test_tags_redundancy_and_text(spark):
    about = [("1", "Sport", "u", ["core:Theme"]), ("2", "Premier League", "u", ["sport:Competition"]),
             ("3", "Football", "u", [])]
    uri = "/sport/football/12345678"
    tags = _one(spark, B.tags(), uri=uri, about=about)
    assert [t["label"] for t in tags] == ["Premier League"]
    assert _one(spark, B.tags_text(), uri=uri, about=about) == "Premier_League"
    assert _one(spark, B.tags_competition_text(), uri=uri, about=about) == "Premier_League"
    assert _one(spark, B.tags(), uri=uri, about=[]) is None
    assert _one(spark, B.tag_labels(), uri=uri, about=about) == ["Sport", "Premier League", "Football"]


def test_camel_case():
    assert B.underscore_to_camel("thing_id") == "thingId"
    assert B.underscore_to_camel("category_level_1") == "categoryLevel1"
    assert B.underscore_to_camel("a__b") == "a_B"
    assert B.underscore_to_camel("is_UK_news") == "isUkNews"


def test_camel_case_columns_nested(spark):
    df = spark.createDataFrame([(1, [("a", "b")])], "doc_id int, the_tags array<struct<thing_id:string,thing_label:string>>")
    out = B.camel_case_columns(df)
    assert out.columns == ["docId", "theTags"]
    assert out.schema["theTags"].dataType.elementType.names == ["thingId", "thingLabel"]


def test_flags_and_nested_path(spark):
    assert _one(spark, B.has_content_warning()) is False
    assert _one(spark, B.ad_campaign(), ad="") is False
    assert _one(spark, B.ad_campaign(), ad="kw") is True
    ev = spark.createDataFrame([('{"k": 0}',), ('{"k": 5}',), ('{}',), (None,)], "props string")
    got = [r["k"] for r in ev.select(B.json_path_value(F.col("props"), "$.k").alias("k")).collect()]
    assert got == [None, 5, None, None]


def test_prune_empty_nested_rules(spark):
    from inkwell.plans.records import prune_empty, to_record_json
    df = spark.createDataFrame(
        [("k", "", False, 0, [("a", ""), ("", None)], ("x", False, 0))],
        "key string, s string, b boolean, n int, arr array<struct<id:string,label:string>>, "
        "st struct<p:string,q:boolean,r:int>")
    rec = to_record_json(prune_empty(df, keep=["key"]), "key").first()["record"]
    # top level: '' dropped, false and 0 kept; nested: '' / false / 0 dropped
    assert rec == '{"b":false,"n":0,"arr":[{"id":"a"},{}],"st":{"p":"x"}}'


def test_site_dispatch_rejects(spark):
    import pytest
    from pyspark.sql import functions as F
    from inkwell.plans.records import site_dispatch
    df = articles_df(spark, [article_row(key="n", uri="/news/1"), article_row(key="s", uri="/sport/x/1"),
                             article_row(key="w", uri="/weather/1")])
    ok, rej = site_dispatch(df, [B.is_match_report().alias("m")], [B.is_breaking_news().alias("bn")],
                            [F.col("article_key")])
    assert sorted(r["article_key"] for r in ok.collect()) == ["n", "s"]
    assert [r["article_key"] for r in rej.collect()] == ["w"]
    _, strict_rej = site_dispatch(df, [], [], [F.col("article_key")], strict=True)
    with pytest.raises(Exception):
        strict_rej.collect()


def test_prune_empty_structs_and_list_elements(spark):
    from inkwell.plans.records import prune_empty, to_record_json
    df = spark.createDataFrame([("k", (("",),), ["", "x"], (("y",), 0)), ("n", None, [], (("",), 1))],
                               "key string, s struct<a:struct<b:string>>, l array<string>, t struct<a:struct<b:string>,n:int>")
    got = {r["key"]: r["record"] for r in to_record_json(prune_empty(df, keep=["key"]), "key").collect()}
    assert got == {"k": '{"s":{},"l":["","x"],"t":{"a":{"b":"y"}}}', "n": '{"t":{"n":1}}'}


def test_every_character_reference_is_decoded_once(spark):
    import html

    from inkwell.functions.text import clean_html, decode_entities
    texts = ["it&#8217;s caf&eacute; &#x27;x&#X27;", "&amp;lt; &amp;amp;", "&unknown; & &; &#; a&b;", "&#146;&#128512;&#0;&#xD800;&#x110000;",
             "&lt;b&gt;&quot;&hellip;&NotEqualTilde;", "none", "", "&eacute;&eacute;&", "&frac12;&sup2;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["d"] for r in df.select(decode_entities(F.col("t")).alias("d")).collect()]
    assert got == [html.unescape(t) for t in texts]
    one = df.limit(1).select(clean_html(F.lit("<p>it&#8217;s&nbsp; caf&eacute;</p>")).alias("c")).first()["c"]
    assert one == "it\u2019s caf\u00e9"
