"""Entity enrichment over the stand-in mentions, KB and name
dictionaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.config import (PARTY_COLUMNS, PERSON_TYPE, POLITICAL_PARTIES,
                            POLITICAL_PARTY_TYPE, POLITICAL_POSITION_SCORES,
                            POLITICIAN_TYPE)
from inkwell.operators.entities import (Enrichment, kb_lookup, mentions_by_type,
                                        position_score)
from inkwell.plans import oracles as O
from inkwell.plans.catalog import register
from inkwell.plans.standins import load_kb_facts, load_mentions, load_name_gender
from inkwell.session import read_table


def _enrichment(spark, sf) -> Enrichment:
    return Enrichment(load_mentions(spark, sf), load_kb_facts(spark, sf), load_name_gender(spark, sf),
                      materialize_kb=True)


def _orders(spark, sf):
    return read_table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("article_key"))


SCORE_SQL = "CASE " + " ".join(
    f"WHEN contains(lower(regexp_replace(position, '[^a-zA-Z]', ' ', 'g')), {O.q(p)}) THEN {s}"
    for p, s in POLITICAL_POSITION_SCORES) + " END"
SLUG_SQL = "CASE " + " ".join(f"WHEN contains(lower(party_uri), {O.q(s)}) THEN {O.q(s)}"
                              for s in POLITICAL_PARTIES) + " END"

ENTITY_BODY = f"""
typed AS (
  SELECT *, list_contains(coalesce(types, []::VARCHAR[]), {O.q(PERSON_TYPE)}) AS is_person,
    list_contains(coalesce(types, []::VARCHAR[]), {O.q(POLITICAL_PARTY_TYPE)}) AS is_party,
    list_contains(coalesce(types, []::VARCHAR[]), {O.q(PERSON_TYPE)})
      AND list_contains(coalesce(types, []::VARCHAR[]), {O.q(POLITICIAN_TYPE)}) AS is_politician
  FROM mentions WHERE source = 'tagger_b'
),
kb_wide AS (
  SELECT subject,
    min(CASE WHEN predicate = 'party' THEN value END) AS party,
    min(CASE WHEN predicate = 'gender' THEN value END) AS gender,
    min(CASE WHEN predicate = 'position' THEN value END) AS position,
    min(CASE WHEN predicate = 'successor' THEN value END) AS successor,
    min(CASE WHEN predicate = 'wikiPageRedirects' THEN value END) AS redirect
  FROM kb_facts WHERE predicate IN ('party', 'gender', 'position', 'successor', 'wikiPageRedirects')
  GROUP BY subject
),
det AS (SELECT first_name, min(gender) AS det_gender FROM name_gender WHERE provider = 'detector' GROUP BY 1),
gz AS (SELECT first_name, min(gender) AS gz_gender FROM name_gender WHERE provider = 'genderize' GROUP BY 1),
people0 AS (
  SELECT t.article_key, t.uri, t.label, t.count, t.is_politician, k.party, k.gender AS kb_gender,
    string_split(t.label, ' ')[1] AS first_name
  FROM typed t LEFT JOIN kb_wide k ON t.uri = k.subject WHERE t.is_person
),
people1 AS (
  SELECT p.*, CASE WHEN p.first_name IS NOT NULL THEN coalesce(p.kb_gender,
      CASE WHEN d.det_gender = 'mostly_female' THEN 'female' WHEN d.det_gender = 'mostly_male' THEN 'male'
           ELSE coalesce(d.det_gender, 'unknown') END) ELSE p.kb_gender END AS g1
  FROM people0 p LEFT JOIN det d ON p.first_name = d.first_name
),
people AS (
  SELECT p.*, CASE WHEN p.g1 IN ('male', 'female') THEN p.g1 ELSE gz.gz_gender END AS gender
  FROM people1 p LEFT JOIN gz ON p.first_name = gz.first_name
),
entries AS (
  SELECT article_key, party AS party_uri, CAST(coalesce(count, 1) AS BIGINT) AS weight, 'politician' AS kind
  FROM people WHERE is_politician
  UNION ALL
  SELECT article_key, uri, CAST(coalesce(count, 1) AS BIGINT), 'party' FROM typed WHERE is_party
),
refs AS (SELECT DISTINCT article_key, party_uri FROM entries WHERE party_uri IS NOT NULL),
pos AS (
  SELECT subject, position, successor, redirect FROM kb_wide
  WHERE position IS NOT NULL OR successor IS NOT NULL OR redirect IS NOT NULL
),
positions AS (
  SELECT a.subject AS party_uri, coalesce(a.position, s.position, r.position) AS position
  FROM pos a LEFT JOIN pos s ON a.successor = s.subject LEFT JOIN pos r ON a.redirect = r.subject
),
expanded AS (
  SELECT e.article_key, e.party_uri, e.weight, e.kind, p.position, {SCORE_SQL.replace('position', 'p.position')} AS score
  FROM entries e LEFT JOIN positions p ON e.party_uri = p.party_uri WHERE e.party_uri IS NOT NULL
),
pol AS (
  SELECT article_key,
    sum(CASE WHEN score IS NOT NULL AND score <> 0 THEN score * weight END)
      / sum(CASE WHEN score IS NOT NULL AND score <> 0 THEN weight END) AS political_score,
    CAST(sum(weight) AS BIGINT) AS num_political_reference_entries
  FROM expanded GROUP BY article_key
),
flags AS (
  SELECT article_key, count(*) AS num_political_references,
    {', '.join(f"max(CASE WHEN slug = {O.q(s)} THEN 1 ELSE 0 END) AS {c}"
               for s, c in zip(POLITICAL_PARTIES, PARTY_COLUMNS))}
  FROM (SELECT article_key, party_uri, {SLUG_SQL} AS slug FROM refs) GROUP BY article_key
),
ppl AS (
  SELECT article_key,
    sum(CASE WHEN gender = 'female' THEN coalesce(count, 0) ELSE 0 END)
      / nullif(sum(CASE WHEN gender IN ('female', 'male') THEN coalesce(count, 0) ELSE 0 END), 0)
      AS female_proportion,
    count(*) AS num_people_mentioned, count(*) FILTER (WHERE is_politician) AS num_politicians
  FROM people GROUP BY article_key
),
feat AS (
  SELECT o.article_key, pol.political_score, ppl.female_proportion,
    coalesce(flags.num_political_references, 0) AS num_political_references,
    coalesce(pol.num_political_reference_entries, 0) AS num_political_reference_entries,
    coalesce(ppl.num_people_mentioned, 0) AS num_people_mentioned,
    coalesce(ppl.num_politicians, 0) AS num_politicians,
    {', '.join(f"coalesce(flags.{c}, 0) AS {c}" for c in PARTY_COLUMNS)}
  FROM (SELECT CAST(o_orderkey AS VARCHAR) AS article_key FROM orders) o
  LEFT JOIN pol ON o.article_key = pol.article_key
  LEFT JOIN flags ON o.article_key = flags.article_key
  LEFT JOIN ppl ON o.article_key = ppl.article_key
)"""
ENTITY_CTES = O.MENTIONS_CTE + "," + O.KB_CTE + "," + O.NAME_GENDER_CTE + "," + ENTITY_BODY


def E(body: str) -> str:
    return f"WITH {ENTITY_CTES}\n{body}"


@register("mentions_by_type", E(
    "SELECT article_key, uri, is_person, is_party, is_politician FROM typed"))
def mentions_by_type_q(spark, sf):
    m = load_mentions(spark, sf).where(F.col("source") == "tagger_b")
    return mentions_by_type(m).select("article_key", "uri", "is_person", "is_party", "is_politician")


@register("kb_lookup", E(
    "SELECT subject, party, gender, position, successor, redirect AS \"wikiPageRedirects\" FROM kb_wide"))
def kb_lookup_q(spark, sf):
    return kb_lookup(load_kb_facts(spark, sf))


@register("gender_resolution", E("SELECT article_key, uri, first_name, gender FROM people"))
def gender_resolution_q(spark, sf):
    return _enrichment(spark, sf).people.select("article_key", "uri", "first_name", "gender")


@register("party_references", E("SELECT article_key, party_uri FROM refs"))
def party_references_q(spark, sf):
    return _enrichment(spark, sf).references


@register("party_position", E("SELECT party_uri, position FROM positions"))
def party_position_q(spark, sf):
    return _enrichment(spark, sf).positions


@register("position_expansion", E("SELECT article_key, party_uri, kind, weight, position FROM expanded"))
def position_expansion_q(spark, sf):
    return _enrichment(spark, sf).expanded.select("article_key", "party_uri", "kind", "weight", "position")


@register("position_score", E(
    f"SELECT subject, value AS position, {SCORE_SQL.replace('position', 'value')} AS score "
    f"FROM kb_facts WHERE predicate = 'position'"))
def position_score_q(spark, sf):
    kb = load_kb_facts(spark, sf).where(F.col("predicate") == "position")
    return kb.select("subject", F.col("value").alias("position"), position_score(F.col("value")).alias("score"))


def _feat(spark, sf):
    return _enrichment(spark, sf).article_features(_orders(spark, sf))


@register("political_score", E("SELECT article_key, political_score FROM feat"))
def political_score_q(spark, sf):
    return _feat(spark, sf).select("article_key", "political_score")


@register("num_political_references", E(
    "SELECT article_key, num_political_references, num_political_reference_entries FROM feat"))
def num_political_references_q(spark, sf):
    return _feat(spark, sf).select("article_key", "num_political_references", "num_political_reference_entries")


@register("party_flags", E(f"SELECT article_key, {', '.join(PARTY_COLUMNS)} FROM feat"))
def party_flags_q(spark, sf):
    return _feat(spark, sf).select("article_key", *PARTY_COLUMNS)


@register("female_proportion", E("SELECT article_key, female_proportion FROM feat"))
def female_proportion_q(spark, sf):
    return _feat(spark, sf).select("article_key", "female_proportion")


@register("mention_counts", E("SELECT article_key, num_people_mentioned, num_politicians FROM feat"))
def mention_counts_q(spark, sf):
    return _feat(spark, sf).select("article_key", "num_people_mentioned", "num_politicians")


@register("party_scores", E(
    f"SELECT t.article_key, coalesce(t.label, t.surface_form) AS name, p.position, "
    f"CASE WHEN {SLUG_SQL.replace('party_uri', 't.uri')} IS NOT NULL THEN 1 ELSE 0 END AS score "
    f"FROM typed t LEFT JOIN positions p ON t.uri = p.party_uri WHERE t.is_party"))
def party_scores_q(spark, sf):
    return _enrichment(spark, sf).party_scores()


@register("score_features", E(
    "SELECT article_key, round(political_score, 6) AS political_score, "
    "round(female_proportion, 6) AS gender_score, "
    "coalesce(CAST(round(political_score, 6) AS VARCHAR), 'None') AS political_score_str, "
    "coalesce(CAST(round(female_proportion, 6) AS VARCHAR), 'None') AS gender_score_str FROM feat"))
def score_features_q(spark, sf):
    f = _feat(spark, sf)
    ps, gs = F.round("political_score", 6), F.round("female_proportion", 6)
    return f.select("article_key", ps.alias("political_score"), gs.alias("gender_score"),
                    F.coalesce(ps.cast("string"), F.lit("None")).alias("political_score_str"),
                    F.coalesce(gs.cast("string"), F.lit("None")).alias("gender_score_str"))
