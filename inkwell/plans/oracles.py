"""DuckDB oracle texts: the same stand-ins and features written as SQL over
the driver's pre-registered views.  Built from reusable CTE fragments."""

from __future__ import annotations

from inkwell.config import (FOOTBALL_TEAMS, PERSON_TYPE, POLITICAL_PARTY_TYPE,
                            POLITICIAN_TYPE, THINGS_URI_PREFIX)
from inkwell.functions.text import WHITESPACE_CLASS
from inkwell.plans.standins import EPOCH0, URI_SLUGS


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_list(items) -> str:
    return "[" + ", ".join(q(i) for i in items) + "]"


# ---------------------------------------------------------------------------
# S1 articles (flattened) from documents
# ---------------------------------------------------------------------------
ARTICLES_CTE = f"""
docs_ AS (
  SELECT doc_id, text, lang, source, string_split(text, chr(10)) AS lines
  FROM documents
),
articles AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS article_key, lang, source, lines,
    nullif(concat(CASE WHEN doc_id % 5 = 0 THEN '/sport/football/' ELSE '/news/' END,
      CASE doc_id % 8 WHEN 0 THEN 'uk-england-london-' WHEN 1 THEN 'uk-politics-'
        WHEN 2 THEN 'world-europe-' WHEN 3 THEN 'election-2019-' WHEN 4 THEN 'uk-scotland-'
        WHEN 5 THEN 'business-' WHEN 6 THEN 'uk-northern-ireland-politics-' ELSE '' END,
      lpad(CAST(doc_id AS VARCHAR), 8, '0')), '') AS asset_uri,
    CASE WHEN doc_id % 6 = 0 THEN list_concat([NULL::VARCHAR], lines) ELSE lines END AS block_texts,
    lines[1] AS headline_raw,
    CASE WHEN doc_id % 3 <> 0 THEN substring(lines[1], 1, 30) END AS short_headline_raw,
    lines[2] AS summary_raw,
    CAST((({EPOCH0} + doc_id * 3600 + 59) * 1000 + doc_id % 1000) AS BIGINT) AS ts_last_updated,
    CAST(({EPOCH0} + doc_id * 3600 - 86400) * CASE WHEN doc_id % 3 = 0 THEN 1000 ELSE 1 END AS BIGINT)
      AS ts_first_published,
    CAST(({EPOCH0} + doc_id * 3600) * CASE WHEN doc_id % 2 = 1 THEN 1000 ELSE 1 END AS BIGINT)
      AS ts_last_published,
    CAST(CASE doc_id % 4 WHEN 0 THEN {EPOCH0} + doc_id * 1800 WHEN 2 THEN 0 END AS BIGINT) AS ts_timestamp,
    CASE doc_id % 17 WHEN 0 THEN 'campaign-' || source WHEN 1 THEN '' END AS ad_campaign_keyword,
    CASE WHEN doc_id % 5 = 0 THEN doc_id % 10 = 0 END AS is_oppm,
    doc_id % 11 = 0 AS opt_content_warning,
    CASE WHEN doc_id % 13 = 0 THEN true WHEN doc_id % 13 = 1 THEN NULL ELSE false END AS opt_breaking,
    CASE WHEN doc_id % 10 = 9 THEN []::STRUCT(id VARCHAR, label VARCHAR, kind VARCHAR[])[]
      ELSE list_concat(
        [{{'id': 't-' || lang,
          'label': CASE doc_id % 3 WHEN 0 THEN 'News' WHEN 1 THEN 'Football' ELSE 'Premier League' END,
          'kind': CASE WHEN doc_id % 3 = 2 THEN ['sport:Competition'] ELSE ['core:Theme'] END}},
         {{'id': source, 'label': 'Source ' || source, 'kind': ['core:Organisation']}}],
        CASE WHEN doc_id % 50 = 0 THEN [{{'id': 'legal-case', 'label': 'Alex Salmond case',
                                         'kind': ['core:Event']}}]
             ELSE []::STRUCT(id VARCHAR, label VARCHAR, kind VARCHAR[])[] END)
    END AS about
  FROM docs_
)"""

WS = WHITESPACE_CLASS
# FIXED VALUES: the named entities that occur in the driver's texts and pages.
ENTITIES = [("&quot;", '"'), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©")]


def clean_html_sql(expr: str, tags: list[str] | None = None) -> str:
    if tags:
        alt = "|".join(f"<{t}.*?>(.*?)</{t}>" for t in tags)
        expr = f"regexp_replace({expr}, {q(alt)}, '  ', 'g')"
    expr = f"regexp_replace({expr}, '(?s)<!--.*?-->', '', 'g')"
    expr = f"regexp_replace({expr}, '(?is)<script\\b[^>]*>.*?</script\\s*>', '', 'g')"
    expr = f"regexp_replace({expr}, '(?is)<style\\b[^>]*>.*?</style\\s*>', '', 'g')"
    expr = f"regexp_replace({expr}, '</?[A-Za-z!][^>]*>', '', 'g')"
    for ent, ch in ENTITIES:
        expr = f"replace({expr}, {q(ent)}, {q(ch)})"
    expr = f"replace({expr}, '&amp;', '&')"
    return f"trim(regexp_replace({expr}, {q(WS + '+')}, ' ', 'g'), ' ')"


def iso_sql(ts: str) -> str:
    secs = (f"(CASE WHEN nullif({ts}, 0) > 100000000000 THEN floor(nullif({ts}, 0) / 1000) "
            f"ELSE nullif({ts}, 0) END)")
    return (f"(strftime(make_timestamp(CAST({secs} AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S')"
            f" || '+00:00')")


# Derived article columns as SQL expressions over the ``articles`` CTE.
URI = "asset_uri"
SITE = f"nullif(regexp_extract({URI}, '^/(.+?)/', 1), '')"


def level_sql(i: int) -> str:
    parts = f"string_split({URI}, '/')"
    return f"(CASE WHEN len({parts}) - 2 > {i} THEN {parts}[{i + 2}] END)"


LAST_SEG = f"string_split({URI}, '/')[-1]"
CATEGORY = (f"lower(regexp_replace(nullif(regexp_extract({LAST_SEG}, "
            f"'([A-Za-z0-9\\-]{{1,}})[0-9]{{8}}', 1), ''), '-$', ''))")
HEADLINE = "nullif(headline_raw, '')"
SHORT_HEADLINE = "nullif(short_headline_raw, '')"
SUMMARY = "nullif(summary_raw, '')"
BODY_RAW = "array_to_string(list_transform(block_texts, lambda x: coalesce(x, '')), '')"
BODY_CLEAN = ("nullif(" + clean_html_sql(
    "array_to_string(list_transform(block_texts, lambda x: coalesce(x, '')), ' ')") + ", '')")
COMBINED = f"nullif(concat_ws(' ', {HEADLINE}, {SUMMARY}, {BODY_CLEAN}), '')"


def norm_label(x: str) -> str:
    return f"lower(replace({x}, ' ', '-'))"


TAGS_KEPT = (f"list_filter(about, lambda t: NOT coalesce(list_contains("
             f"list_filter([{norm_label(level_sql(0))}, {norm_label(level_sql(1))}], lambda z: z IS NOT NULL), "
             f"{norm_label('t.label')}), false))")
TAGS_TEXT = f"nullif(array_to_string(list_transform({TAGS_KEPT}, lambda t: replace(t.label, ' ', '_')), ' '), '')"
COMP_TAGS = "list_filter(about, lambda t: coalesce(list_contains(t.kind, 'sport:Competition'), false))"
TAGS_COMPETITION = (f"CASE WHEN len({COMP_TAGS}) > 0 THEN array_to_string(list_transform({COMP_TAGS}, "
                    f"lambda t: replace(t.label, ' ', '_')), ' ') END")
TAG_LABELS = "list_filter(list_transform(about, lambda t: t.label), lambda x: x IS NOT NULL)"


def with_articles(body: str, extra_ctes: str = "") -> str:
    return f"WITH {ARTICLES_CTE}{(',' + extra_ctes) if extra_ctes else ''}\n{body}"


def contains_any_sql(expr: str, terms, lower: bool = True) -> str:
    terms = list(terms)
    if not terms:
        return f"(CASE WHEN {expr} IS NOT NULL THEN false END)"
    hay = f"lower({expr})" if lower else expr
    return "(" + " OR ".join(f"contains({hay}, {q(t.lower() if lower else t)})" for t in terms) + ")"


# ---------------------------------------------------------------------------
# S2 mentions, F3 kb facts, F4 name dictionaries
# ---------------------------------------------------------------------------
def kb_uri_sql(key: str) -> str:
    return (f"('http://dbpedia.org/resource/' || {sql_list(URI_SLUGS)}[({key}) % {len(URI_SLUGS)} + 1]"
            f" || '_' || CAST({key} AS VARCHAR))")


TEAM_URIS = sql_list([u[:-3] for _, u in FOOTBALL_TEAMS])

MENTIONS_CTE = f"""
tagger_b_ AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS article_key, 'tagger_b' AS source,
    {kb_uri_sql('p_partkey')} AS uri, p_name AS label, p_brand AS surface_form,
    CASE WHEN p_type = 'PROMO' THEN [{q(POLITICAL_PARTY_TYPE)}]
         WHEN p_type IN ('ECONOMY', 'STANDARD') THEN [{q(PERSON_TYPE)}, {q(POLITICIAN_TYPE)}]
         ELSE [{q(PERSON_TYPE)}] END AS types,
    CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS count,
    ['http://dbpedia.org/resource/' || replace(p_name, ' ', '_'),
     CASE WHEN CAST(substring(p_brand, 7, 4) AS INTEGER) BETWEEN 1 AND {len(FOOTBALL_TEAMS)}
          THEN {TEAM_URIS}[CAST(substring(p_brand, 7, 4) AS INTEGER)]
          ELSE {q(THINGS_URI_PREFIX + 'brand-')} || CAST(CAST(substring(p_brand, 7, 4) AS INTEGER) AS VARCHAR)
     END] AS same_as,
    l_linenumber
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
mentions AS (
  SELECT article_key, source, uri, label, surface_form, types, count, same_as FROM tagger_b_
  UNION ALL
  SELECT article_key, 'tagger_a', uri,
    array_to_string(list_transform(string_split(label, ' '),
      lambda w: upper(substring(w, 1, 1)) || lower(substring(w, 2))), ' '),
    surface_form, types, count, same_as
  FROM tagger_b_ WHERE l_linenumber = 1
)"""

KB_CTE = f"""
kb_facts AS (
  SELECT subject, predicate, value FROM (
    SELECT {kb_uri_sql('p_partkey')} AS subject, unnest([
      {{'predicate': 'position', 'value': CASE p_partkey % 6 WHEN 0 THEN 'Left-wing' WHEN 1 THEN 'Centre-left'
          WHEN 2 THEN 'Centrism' WHEN 3 THEN 'Center-right' WHEN 4 THEN 'Right-wing politics' END}},
      {{'predicate': 'position', 'value': CASE WHEN p_partkey % 7 = 0 THEN 'Far-right' END}},
      {{'predicate': 'gender', 'value': CASE WHEN p_type <> 'PROMO' THEN
          CASE p_size % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' END END}},
      {{'predicate': 'party', 'value': CASE WHEN p_type IN ('ECONOMY', 'STANDARD')
          THEN {kb_uri_sql('p_partkey % 40')} END}},
      {{'predicate': 'successor', 'value': CASE WHEN p_partkey % 18 = 5 THEN {kb_uri_sql('p_partkey + 1')} END}},
      {{'predicate': 'wikiPageRedirects', 'value': CASE WHEN p_partkey % 18 = 11
          THEN {kb_uri_sql('p_partkey + 2')} END}}
    ], recursive := true)
    FROM part
  ) WHERE value IS NOT NULL
)"""

NAME_GENDER_CTE = """
names_ AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS first_name FROM part),
name_gender AS (
  SELECT * FROM (
    SELECT first_name, CASE length(first_name) % 4 WHEN 0 THEN 'mostly_female' WHEN 1 THEN 'male'
      WHEN 2 THEN 'andy' ELSE 'unknown' END AS gender, 'detector' AS provider FROM names_
    UNION ALL
    SELECT first_name, CASE WHEN length(first_name) % 2 = 0 THEN 'female'
      WHEN length(first_name) = 3 THEN 'male' END, 'genderize' FROM names_
  ) WHERE gender IS NOT NULL
)"""
