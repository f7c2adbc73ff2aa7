"""Predicates, keyword and entity labelling."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.config import (CATEGORY_KEYWORDS, FOOTBALL_TEAMS, LEGAL_INDICATORS,
                            LEGAL_TAGS, NATIONS, PRESS_REVIEW_INDICATORS,
                            THINGS_URI_PREFIX)
from inkwell.functions import fields as B
from inkwell.functions import predicates as C
from inkwell.operators.keyword_automaton import boolean_categories_spanning, keyword_numbers
from inkwell.operators.labelling import (boolean_categories, entity_uri_labels,
                                         tagger_labels)
from inkwell.plans import oracles as O
from inkwell.plans.catalog import register
from inkwell.plans.standins import load_articles, load_mentions
from inkwell.session import read_table

A = O.with_articles

# Parameter lists for the sport predicates (the behaviour we reproduce ships
# none); fixed here so the queries are repeatable.
PERIODICAL_FIXTURE = ["weekly", "the "]
RANKINGS_FIXTURE = ["Rankings", "World rankings"]
SQUAD_FIXTURE = ["Squad", "Team news"]
DRAW_IDS_FIXTURE = ["00000010", "00000020", "00000135"]

# Extra keyword categories whose terms occur in the driver text: a
# should_not that overrides, a tagger-label hit, and a keyword spanning two
# tag labels.
KEYWORD_FIXTURE = {
    "isToxic": {"should": ["worthless", "stupid", "idiot"], "should_not": ["license"]},
    "isWidget": {"should": ["widget"], "should_not": ["red widget"]},
    "isSpanning": {"should": ["football source"], "should_not": []},
}


def _cat_sql(name: str, fn) -> str:
    return A(f"SELECT doc_id, {fn} AS {name} FROM articles")


@register("is_periodical", _cat_sql(
    "is_periodical", f"coalesce({O.contains_any_sql(O.HEADLINE, PERIODICAL_FIXTURE)}, false)"))
def is_periodical(spark, sf):
    return load_articles(spark, sf).select("doc_id", C.is_periodical(PERIODICAL_FIXTURE).alias("is_periodical"))


@register("is_red_button_content", _cat_sql(
    "is_red_button_content", f"coalesce(contains({O.SUMMARY}, 'DIGIONLY'), false)"))
def is_red_button(spark, sf):
    return load_articles(spark, sf).select("doc_id", C.is_red_button_content().alias("is_red_button_content"))


def _isin_sql(expr: str, values) -> str:
    return f"CASE WHEN {expr} IS NOT NULL THEN {expr} IN ({', '.join(O.q(v) for v in values)}) END"


@register("is_rankings", _cat_sql("is_rankings", _isin_sql(O.SHORT_HEADLINE, RANKINGS_FIXTURE)))
def is_rankings(spark, sf):
    return load_articles(spark, sf).select("doc_id", C.is_rankings(RANKINGS_FIXTURE).alias("is_rankings"))


@register("is_squad", _cat_sql("is_squad", _isin_sql(O.SHORT_HEADLINE, SQUAD_FIXTURE)))
def is_squad(spark, sf):
    return load_articles(spark, sf).select("doc_id", C.is_squad(SQUAD_FIXTURE).alias("is_squad"))


@register("is_competition_draw", _cat_sql(
    "is_competition_draw", _isin_sql(f"nullif({O.LAST_SEG}, '')", DRAW_IDS_FIXTURE)))
def is_competition_draw(spark, sf):
    return load_articles(spark, sf).select(
        "doc_id", C.is_competition_draw(DRAW_IDS_FIXTURE).alias("is_competition_draw"))


@register("is_uk_news", _cat_sql("is_uk_news", f"contains({O.CATEGORY}, 'uk')"))
def is_uk_news(spark, sf):
    return load_articles(spark, sf).select("doc_id", C.is_uk_news().alias("is_uk_news"))


@register("nation", _cat_sql("nation", "CASE " + " ".join(
    f"WHEN contains({O.CATEGORY}, {O.q(n)}) THEN {O.q(n)}" for n in NATIONS) + " END"))
def nation(spark, sf):
    return load_articles(spark, sf).select("doc_id", C.nation().alias("nation"))


@register("is_press_review", _cat_sql(
    "is_press_review", f"(coalesce({O.contains_any_sql(O.HEADLINE, PRESS_REVIEW_INDICATORS)}, false) OR "
    f"coalesce({O.contains_any_sql(O.SHORT_HEADLINE, PRESS_REVIEW_INDICATORS)}, false))"))
def is_press_review(spark, sf):
    return load_articles(spark, sf).select("doc_id", C.is_press_review().alias("is_press_review"))


@register("is_legal", _cat_sql(
    "is_legal", f"(coalesce({O.contains_any_sql(O.COMBINED, LEGAL_INDICATORS)}, false) OR "
    f"coalesce({O.contains_any_sql(O.TAGS_TEXT, LEGAL_TAGS)}, false))"))
def is_legal(spark, sf):
    return load_articles(spark, sf).select("doc_id", C.is_legal().alias("is_legal"))


@register("is_politics", _cat_sql("is_politics", f"contains({O.CATEGORY}, 'politics')"))
def is_politics(spark, sf):
    return load_articles(spark, sf).select("doc_id", C.is_politics().alias("is_politics"))


@register("is_elections", _cat_sql("is_elections", f"contains({O.CATEGORY}, 'election')"))
def is_elections(spark, sf):
    return load_articles(spark, sf).select("doc_id", C.is_elections().alias("is_elections"))


# ---------------------------------------------------------------------------
# C12 / C13
# ---------------------------------------------------------------------------
ARTICLE_TEXT_SQL = (f"lower(concat_ws(' ', nullif(array_to_string({O.TAG_LABELS}, ' '), ''), "
                    f"coalesce(headline_raw, ''), coalesce(summary_raw, ''), {O.BODY_RAW}))")


def _kw_sql(text: str, spec) -> tuple[str, str]:
    should = [s.lower() for s in spec.get("should", [])]
    should_not = [s.lower() for s in spec.get("should_not", [])]
    s = "(" + " OR ".join(f"contains({text}, {O.q(t)})" for t in should) + ")" if should else "false"
    n = "(" + " OR ".join(f"contains({text}, {O.q(t)})" for t in should_not) + ")" if should_not else "false"
    return f"coalesce({s}, false)", f"coalesce({n}, false)"


def _keyword_sql(categories) -> str:
    cols = []
    for name, spec in categories.items():
        s, n = _kw_sql("t", spec)
        cols.append(f"(NOT {n} AND {s}) AS \"{name}\"")
    return A(f"SELECT article_key, {', '.join(cols)} FROM (SELECT article_key, {ARTICLE_TEXT_SQL} AS t "
             f"FROM articles)")


@register("keyword_match", _keyword_sql(KEYWORD_FIXTURE))
def keyword_match(spark, sf):
    return boolean_categories(load_articles(spark, sf), None, KEYWORD_FIXTURE)


ALL_CATEGORIES = {**CATEGORY_KEYWORDS, **KEYWORD_FIXTURE}


def _boolean_categories_sql() -> str:
    art_cols, men_cols, final = [], [], []
    for name, spec in ALL_CATEGORIES.items():
        s, n = _kw_sql("t", spec)
        art_cols += [f"{s} AS \"{name}__s\"", f"{n} AS \"{name}__n\""]
        ms, mn = _kw_sql("lower(tag_label)", spec)
        men_cols += [f"bool_or({ms}) AS \"m_{name}__s\"", f"bool_or({mn}) AS \"m_{name}__n\""]
        final.append(f"(NOT (a.\"{name}__n\" OR coalesce(m.\"m_{name}__n\", false)) AND "
                     f"(a.\"{name}__s\" OR coalesce(m.\"m_{name}__s\", false))) AS \"{name}\"")
    body = (f"SELECT a.article_key, {', '.join(final)} FROM "
            f"(SELECT article_key, {', '.join(art_cols)} FROM (SELECT article_key, {ARTICLE_TEXT_SQL} AS t "
            f"FROM articles)) a LEFT JOIN "
            f"(SELECT article_key, {', '.join(men_cols)} FROM tagged WHERE tag_label IS NOT NULL "
            f"GROUP BY article_key) m ON a.article_key = m.article_key")
    return A(body, O.MENTIONS_CTE + "," + TAGGED_CTE)


TAGGED_CTE = f"""
tagged AS (
  SELECT article_key, source,
    CASE WHEN source = 'tagger_a' THEN coalesce(label, '') WHEN source = 'tagger_b' THEN label END AS tag_label,
    CASE WHEN source = 'tagger_a' THEN [coalesce(uri, '')]
         WHEN source = 'tagger_b' THEN list_transform(list_filter(coalesce(same_as, []::VARCHAR[]),
           lambda u: starts_with(u, {O.q(THINGS_URI_PREFIX)})), lambda u: u || '#id') END AS tag_uris
  FROM mentions
)"""


@register("boolean_categories", _boolean_categories_sql())
def boolean_categories_q(spark, sf):
    return boolean_categories(load_articles(spark, sf), load_mentions(spark, sf), ALL_CATEGORIES)


# Keywords over the seams of parts: label to label of one tagger, from tagger A
# to tagger B, and a should_not over a seam.
SPANNING_FIXTURE = {
    **ALL_CATEGORIES,
    "isLabelPair": {"should": ["widget small", "gizmo red", "large blue"], "should_not": ["part red widget blue"]},
    "isOverThreeLabels": {"should": ["red widget blue widget green", "widget small bolt large"], "should_not": []},
    "isSeam": {"should": ["t s", "e r"], "should_not": ["t b"]},
}


def _spanning_sql() -> str:
    cols = []
    for name, spec in SPANNING_FIXTURE.items():
        s, n = _kw_sql("t", spec)
        cols.append(f"(NOT {n} AND {s}) AS \"{name}\"")
    mentions = O.MENTIONS_CTE.replace("types, count, same_as FROM tagger_b_", "types, count, same_as, l_linenumber FROM tagger_b_") \
        .replace("surface_form, types, count, same_as\n", "surface_form, types, count, same_as, l_linenumber\n")
    tagged = TAGGED_CTE.replace("SELECT article_key, source,", "SELECT article_key, source, l_linenumber,")
    body = (f"SELECT article_key, {', '.join(cols)} FROM (SELECT article_key, "
            "CASE WHEN l IS NULL THEN t ELSE t || ' ' || l END AS t "
            f"FROM (SELECT article_key, {ARTICLE_TEXT_SQL} AS t FROM articles) LEFT JOIN (SELECT article_key, "
            "lower(string_agg(tag_label, ' ' ORDER BY source, l_linenumber)) AS l "
            "FROM tagged WHERE tag_label IS NOT NULL GROUP BY article_key) USING (article_key))")
    return A(body, mentions + "," + tagged)


@register("boolean_categories_spanning", _spanning_sql())
def boolean_categories_spanning_q(spark, sf):
    return boolean_categories_spanning(load_articles(spark, sf), load_mentions(spark, sf, positions=True), SPANNING_FIXTURE)


@register("keyword_dictionary", """
WITH words AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS word FROM benchmark)
SELECT doc_id, (SELECT count(*) FROM words WHERE word <> '' AND contains(lower(text), word)) AS n_keywords FROM documents""")
def keyword_dictionary_q(spark, sf):
    """Every word of the benchmark items as a keyword, in every document."""
    words = read_table(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("word")).filter("word <> ''").distinct()
    found = keyword_numbers(F.lower(F.coalesce("text", F.lit(""))), sorted(r["word"] for r in words.collect()))
    return read_table(spark, sf, "documents").select("doc_id", F.size(found).cast("bigint").alias("n_keywords"))


@register("tagger_labels", f"WITH {O.MENTIONS_CTE}, {TAGGED_CTE} "
          "SELECT article_key, source, tag_label, array_to_string(tag_uris, '|') AS tag_uris FROM tagged")
def tagger_labels_q(spark, sf):
    return tagger_labels(load_mentions(spark, sf)).select(
        "article_key", "source", "tag_label", F.array_join("tag_uris", "|").alias("tag_uris"))


def _entity_sql() -> str:
    flags = ", ".join(
        f"coalesce(bool_or(contains(lower(array_to_string(tag_uris, ' ')), {O.q(u.lower())})), false) AS \"{n}\""
        for n, u in FOOTBALL_TEAMS)
    names = [n for n, _ in FOOTBALL_TEAMS]
    outer = ", ".join(f"coalesce(e.\"{n}\", false) AS \"{n}\"" for n in names)
    count = " + ".join(f"CAST(coalesce(e.\"{n}\", false) AS BIGINT)" for n in names)
    return (f"WITH {O.MENTIONS_CTE}, {TAGGED_CTE}, "
            f"e AS (SELECT article_key, {flags} FROM tagged GROUP BY article_key) "
            f"SELECT o.article_key, {outer}, {count} AS n_entities FROM "
            f"(SELECT CAST(o_orderkey AS VARCHAR) AS article_key FROM orders) o "
            f"LEFT JOIN e ON o.article_key = e.article_key")


@register("entity_uri_labels", _entity_sql())
def entity_uri_labels_q(spark, sf):
    orders = read_table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("article_key"))
    out = entity_uri_labels(orders, load_mentions(spark, sf))
    names = [n for n, _ in FOOTBALL_TEAMS]
    n_true = sum((F.col(n).cast("long") for n in names[1:]), F.col(names[0]).cast("long"))
    return out.select("article_key", *names, n_true.alias("n_entities"))
