"""H1-H3: the feature record, corpus enrichment and per-site records."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.config import (CATEGORY_KEYWORDS, ENTAILMENT_TOPICS, FOOTBALL_TEAMS,
                            LEGAL_INDICATORS, LEGAL_TAGS, NATIONS, PARTY_COLUMNS,
                            PRESS_REVIEW_INDICATORS)
from inkwell.functions.fields import underscore_to_camel
from inkwell.operators.entities import Enrichment
from inkwell.plans import oracles as O
from inkwell.plans.catalog import register
from inkwell.plans.catalog.entities import ENTITY_BODY, SLUG_SQL
from inkwell.plans.catalog.labels import (ARTICLE_TEXT_SQL, DRAW_IDS_FIXTURE, PERIODICAL_FIXTURE,
                                          RANKINGS_FIXTURE, SQUAD_FIXTURE, TAGGED_CTE, _kw_sql)
from inkwell.plans.catalog.models import ENTAIL_CTE, SARCASM_RULE
from inkwell.plans.catalog.text import SENTS_CTE
from inkwell.plans.features import article_features, enrich_corpus
from inkwell.plans.oracle_sentiment import label_sql, vader_ctes
from inkwell.plans.records import site_records
from inkwell.operators.classifier import rule_scorer
from inkwell.plans.standins import load_articles, load_kb_facts, load_mentions, load_name_gender
from inkwell.session import scratch_path

TEAM_NAMES = [n for n, _ in FOOTBALL_TEAMS]
H1_COLUMNS = ["article_key", *CATEGORY_KEYWORDS, "n_teams", *ENTAILMENT_TOPICS, "sentiment_label",
              "sarcasm_score", "political_score", "gender_score"]


def _h1(spark, sf):
    return article_features(load_articles(spark, sf), load_mentions(spark, sf), load_kb_facts(spark, sf),
                            load_name_gender(spark, sf), sarcasm_scorer=rule_scorer(SARCASM_RULE),
                            materialize_kb=True)


def _nested_as_text(teams, parties):
    """The record's arrays as text, parties in the order of that text."""
    party = F.transform(parties, lambda p: F.concat_ws("|", p["name"], F.coalesce(p["position"], F.lit("")), p["score"]))
    return [F.array_join(F.transform(teams, lambda t: F.when(t, "1").otherwise("0")), "").alias("teams"),
            F.array_join(F.array_sort(party), ";").alias("parties")]


def _h1_sql() -> str:
    art_cols, mag_cols, final = [], [], []
    for name, spec in CATEGORY_KEYWORDS.items():
        s, n = _kw_sql("t", spec)
        art_cols += [f"{s} AS \"{name}__s\"", f"{n} AS \"{name}__n\""]
        ms, mn = _kw_sql("lower(tag_label)", spec)
        mag_cols += [f"bool_or({ms}) AS \"m_{name}__s\"", f"bool_or({mn}) AS \"m_{name}__n\""]
        final.append(f"(NOT (a.\"{name}__n\" OR coalesce(m.\"m_{name}__n\", false)) AND "
                     f"(a.\"{name}__s\" OR coalesce(m.\"m_{name}__s\", false))) AS \"{name}\"")
    mag_cols += [f"bool_or(contains(lower(array_to_string(tag_uris, ' ')), {O.q(u.lower())})) AS \"{n}\""
                 for n, u in FOOTBALL_TEAMS]
    n_teams = " + ".join(f"CAST(coalesce(m.\"{n}\", false) AS INTEGER)" for n in TEAM_NAMES)
    teams = " || ".join(f"CASE WHEN m.\"{n}\" THEN '1' ELSE '0' END" for n in TEAM_NAMES)
    ent = ", ".join(f"CASE WHEN a.comb IS NOT NULL AND e.doc_id IS NOT NULL THEN e.\"{n}_p\" >= 0.5 END AS \"{n}\""
                    for n in ENTAILMENT_TOPICS)
    sarc_pred = " OR ".join(f"contains(lower(frag), {O.q(t)})" for t in SARCASM_RULE)
    ctes = ",".join([
        O.MENTIONS_CTE, TAGGED_CTE, O.KB_CTE, O.NAME_GENDER_CTE, ENTITY_BODY, SENTS_CTE
        + vader_ctes("sents_", ["doc_id", "sent_idx"]), ENTAIL_CTE,
        f"art_ AS (SELECT doc_id, article_key, {', '.join(art_cols)}, comb FROM "
        f"(SELECT doc_id, article_key, {ARTICLE_TEXT_SQL} AS t, {O.COMBINED} AS comb FROM articles))",
        f"mag_ AS (SELECT article_key, {', '.join(mag_cols)} FROM tagged GROUP BY article_key)",
        "pty_ AS (SELECT article_key, coalesce(string_agg(txt, ';' ORDER BY txt), '') AS parties FROM ("
        f"SELECT t.article_key, CASE WHEN t.is_party THEN concat_ws('|', coalesce(t.label, t.surface_form), coalesce(p.position, ''), "
        f"CASE WHEN {SLUG_SQL.replace('party_uri', 't.uri')} IS NOT NULL THEN '1' ELSE '0' END) END AS txt "
        "FROM typed t LEFT JOIN positions p ON t.uri = p.party_uri WHERE t.is_person OR t.is_party) GROUP BY article_key)",
        "sent_ AS (SELECT doc_id, avg(compound) AS m FROM vader_out GROUP BY doc_id)",
        f"sarc_ AS (SELECT doc_id, avg(CASE WHEN {sarc_pred} THEN 1.0 ELSE 0.0 END) AS s FROM "
        f"(SELECT doc_id, unnest(string_split(comb, '.')) AS frag FROM art_ WHERE comb IS NOT NULL) GROUP BY doc_id)",
    ])
    body = (f"SELECT a.article_key, {', '.join(final)}, {n_teams} AS n_teams, {ent}, "
            f"CASE WHEN a.comb IS NOT NULL THEN {label_sql('sent_.m')} END AS sentiment_label, "
            f"sarc_.s AS sarcasm_score, pol.political_score, ppl.female_proportion AS gender_score, "
            f"{teams} AS teams, pty_.parties "
            f"FROM art_ a LEFT JOIN pty_ ON a.article_key = pty_.article_key LEFT JOIN mag_ m ON a.article_key = m.article_key "
            f"LEFT JOIN ent_ e ON a.doc_id = e.doc_id LEFT JOIN sent_ ON a.doc_id = sent_.doc_id "
            f"LEFT JOIN sarc_ ON a.doc_id = sarc_.doc_id LEFT JOIN pol ON a.article_key = pol.article_key "
            f"LEFT JOIN ppl ON a.article_key = ppl.article_key")
    return O.with_articles(body, ctes)


@register("article_features", _h1_sql())
def article_features_q(spark, sf):
    return _h1(spark, sf).select(*H1_COLUMNS, *_nested_as_text(F.col("premierLeagueTeams"), F.col("partyScore")))


@register("enrich_corpus", _h1_sql().replace("SELECT a.article_key, ", f"SELECT a.article_key, a.site, a.headline_raw AS headline, ")
          .replace("art_ AS (SELECT doc_id, article_key, ", "art_ AS (SELECT doc_id, article_key, site, headline_raw, ")
          .replace("FROM (SELECT doc_id, article_key, ", f"FROM (SELECT doc_id, article_key, {O.SITE} AS site, headline_raw, "))
def enrich_corpus_q(spark, sf):
    """The enriched documents as written, with all their features."""
    path = scratch_path(spark, "enriched-corpus")
    out = enrich_corpus(load_articles(spark, sf), path, mentions=load_mentions(spark, sf),
                        kb_facts=load_kb_facts(spark, sf), name_gender=load_name_gender(spark, sf),
                        sarcasm_scorer=rule_scorer(SARCASM_RULE), materialize_kb=True)
    back = spark.read.schema(out.schema).json(path)
    return back.select("article_key", "site", F.col("promo.headlines.headline").alias("headline"),
                       *[F.col(f"features.{c}").alias(c) for c in H1_COLUMNS[1:]],
                       *_nested_as_text(F.col("features.premierLeagueTeams"), F.col("features.partyScore")))


# ---------------------------------------------------------------------------
# H3
# ---------------------------------------------------------------------------
def _pairs_common() -> list[tuple[str, str]]:
    return [
        ("asset_uri", O.URI), ("type", "'asset'"), ("site", O.SITE),
        ("has_content_warning", "coalesce(opt_content_warning, false)"), ("tags_text", O.TAGS_TEXT),
        ("category_level_1", O.level_sql(0)), ("category_level_2", O.level_sql(1)),
        ("category_level_3", O.level_sql(2)), ("last_updated", O.iso_sql("ts_last_updated")),
        ("last_published", O.iso_sql("ts_last_published")),
        ("first_published", O.iso_sql("ts_first_published")),
        ("news_update_or_last_published",
         f"coalesce({O.iso_sql('ts_timestamp')}, {O.iso_sql('ts_last_published')})"),
        ("headline", O.HEADLINE), ("short_headline", O.SHORT_HEADLINE), ("summary", O.SUMMARY),
        ("body", O.BODY_CLEAN), ("combined_body_summary_headline", O.COMBINED),
        ("ad_campaign", "nullif(ad_campaign_keyword, '') IS NOT NULL"),
        ("tags", f"nullif(array_to_string(list_transform({O.TAGS_KEPT}, lambda t: t.id || '=' || t.label), '|'), '')"),
    ]


def _tags_as_text(df):
    return df.withColumn("tags", F.array_join(F.transform("tags", lambda t: F.concat_ws("=", t["id"], t["label"])), "|"))


def _in_sql(expr, values):
    return f"CASE WHEN {expr} IS NOT NULL THEN {expr} IN ({', '.join(O.q(v) for v in values)}) END"


NEWS_PAIRS = [
    ("article_category_name", O.CATEGORY),
    ("is_breaking_news", "coalesce(opt_breaking, false)"),
    ("is_uk_news", f"contains({O.CATEGORY}, 'uk')"),
    ("nation", "CASE " + " ".join(f"WHEN contains({O.CATEGORY}, {O.q(n)}) THEN {O.q(n)}" for n in NATIONS) + " END"),
    ("is_press_review", f"(coalesce({O.contains_any_sql(O.HEADLINE, PRESS_REVIEW_INDICATORS)}, false) OR "
                        f"coalesce({O.contains_any_sql(O.SHORT_HEADLINE, PRESS_REVIEW_INDICATORS)}, false))"),
    ("is_legal", f"(coalesce({O.contains_any_sql(O.COMBINED, LEGAL_INDICATORS)}, false) OR "
                 f"coalesce({O.contains_any_sql(O.TAGS_TEXT, LEGAL_TAGS)}, false))"),
    ("is_politics", f"contains({O.CATEGORY}, 'politics')"),
    ("is_elections", f"contains({O.CATEGORY}, 'election')"),
]
ENTITY_COLS = ["female_proportion", "num_people_mentioned", "num_political_references",
               "num_politicians", "political_score", *PARTY_COLUMNS]

SPORT_PAIRS = [
    ("tags_competition_text", O.TAGS_COMPETITION),
    ("is_periodical", f"coalesce({O.contains_any_sql(O.HEADLINE, PERIODICAL_FIXTURE)}, false)"),
    ("is_red_button_content", f"coalesce(contains({O.SUMMARY}, 'DIGIONLY'), false)"),
    ("is_rankings", _in_sql(O.SHORT_HEADLINE, RANKINGS_FIXTURE)),
    ("is_squad", _in_sql(O.SHORT_HEADLINE, SQUAD_FIXTURE)),
    ("is_competition_draw", _in_sql(f"nullif({O.LAST_SEG}, '')", DRAW_IDS_FIXTURE)),
    ("is_match_report", "coalesce(is_oppm, false)"),
]
SPORT_LISTS = dict(periodical=PERIODICAL_FIXTURE, rankings=RANKINGS_FIXTURE, squad=SQUAD_FIXTURE,
                   draw_ids=DRAW_IDS_FIXTURE)


def _record_sql(site: str, pairs, with_entities: bool) -> str:
    cols = [f"a.article_key AS \"articleKey\""] + [
        f"{e} AS \"{underscore_to_camel(n)}\"" for n, e in _pairs_common() + pairs]
    joins = ""
    ctes = ""
    if with_entities:
        cols += [f"f.{c} AS \"{underscore_to_camel(c)}\"" for c in ENTITY_COLS]
        joins = " LEFT JOIN feat f ON a.article_key = f.article_key"
        ctes = ",".join([O.MENTIONS_CTE, O.KB_CTE, O.NAME_GENDER_CTE, ENTITY_BODY])
    return O.with_articles(f"SELECT {', '.join(cols)} FROM articles a{joins} WHERE {O.SITE} = {O.q(site)}", ctes)


def _records(spark, sf, site, entity_features):
    recs = site_records(load_articles(spark, sf), entity_features=entity_features, **SPORT_LISTS)
    return recs.where(F.col("site") == site)


@register("news_record", _record_sql("news", NEWS_PAIRS, True))
def news_record_q(spark, sf):
    enr = Enrichment(load_mentions(spark, sf), load_kb_facts(spark, sf), load_name_gender(spark, sf),
                     materialize_kb=True)
    recs = _records(spark, sf, "news", enr.per_article.select("article_key", *ENTITY_COLS))
    cols = ["articleKey"] + [underscore_to_camel(n) for n, _ in _pairs_common() + NEWS_PAIRS] + \
        [underscore_to_camel(c) for c in ENTITY_COLS]
    return _tags_as_text(recs).select(*cols)


@register("sport_record", _record_sql("sport", SPORT_PAIRS, False))
def sport_record_q(spark, sf):
    recs = _records(spark, sf, "sport", None)
    cols = ["articleKey"] + [underscore_to_camel(n) for n, _ in _pairs_common() + SPORT_PAIRS]
    return _tags_as_text(recs).select(*cols)
