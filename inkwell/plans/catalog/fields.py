"""Article field projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import fields as B
from inkwell.functions.text import clean_html, remove_tag_blocks
from inkwell.plans import oracles as O
from inkwell.plans.catalog import register
from inkwell.plans.standins import load_articles
from inkwell.plans.records import prune_empty_keys, site_dispatch
from inkwell.session import read_table

A = O.with_articles


@register("nested_path", """
SELECT event_id, nullif(CAST(json_extract(props, '$.k') AS BIGINT), 0) AS k FROM events""")
def nested_path(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.select("event_id", B.json_path_value(F.col("props"), "$.k").alias("k"))


@register("asset_uri", A(f"SELECT doc_id, {O.URI} AS asset_uri, 'asset' AS type FROM articles"))
def asset_uri(spark, sf):
    return load_articles(spark, sf).select("doc_id", B.asset_uri().alias("asset_uri"),
                                            B.doc_type().alias("type"))


@register("site", A(f"SELECT doc_id, {O.SITE} AS site FROM articles"))
def site(spark, sf):
    return load_articles(spark, sf).select("doc_id", B.site().alias("site"))


@register("category_levels", A(
    f"SELECT doc_id, {O.level_sql(0)} AS category_level_1, {O.level_sql(1)} AS category_level_2, "
    f"{O.level_sql(2)} AS category_level_3 FROM articles"))
def category_levels(spark, sf):
    return load_articles(spark, sf).select(
        "doc_id", *[B.category_level(i).alias(f"category_level_{i + 1}") for i in range(3)])


@register("article_category_name", A(f"SELECT doc_id, {O.CATEGORY} AS article_category_name FROM articles"))
def article_category_name(spark, sf):
    return load_articles(spark, sf).select("doc_id", B.article_category_name().alias("article_category_name"))


@register("iso_dates", A(
    f"SELECT doc_id, {O.iso_sql('ts_last_updated')} AS last_updated, "
    f"{O.iso_sql('ts_last_published')} AS last_published, "
    f"{O.iso_sql('ts_first_published')} AS first_published FROM articles"))
def iso_dates(spark, sf):
    return load_articles(spark, sf).select(
        "doc_id", B.last_updated().alias("last_updated"), B.last_published().alias("last_published"),
        B.first_published().alias("first_published"))


@register("news_update_or_last_published", A(
    f"SELECT doc_id, coalesce({O.iso_sql('ts_timestamp')}, {O.iso_sql('ts_last_published')}) "
    f"AS news_update_or_last_published FROM articles"))
def news_update(spark, sf):
    return load_articles(spark, sf).select(
        "doc_id", B.news_update_or_last_published().alias("news_update_or_last_published"))


@register("headline_fields", A(
    f"SELECT doc_id, {O.HEADLINE} AS headline, {O.SHORT_HEADLINE} AS short_headline, "
    f"{O.SUMMARY} AS summary FROM articles"))
def headline_fields(spark, sf):
    return load_articles(spark, sf).select(
        "doc_id", B.headline().alias("headline"), B.short_headline().alias("short_headline"),
        B.summary().alias("summary"))


@register("body_clean", f"SELECT page_id, nullif({O.clean_html_sql('html')}, '') AS body FROM pages")
def body_clean(spark, sf):
    pages = read_table(spark, sf, "pages")
    return pages.select("page_id", F.nullif(clean_html(F.col("html")), F.lit("")).alias("body"))


@register("body_raw", A(f"SELECT doc_id, {O.BODY_RAW} AS body_raw FROM articles"))
def body_raw(spark, sf):
    return load_articles(spark, sf).select("doc_id", B.body_raw().alias("body_raw"))


REMOVE_TAGS = ["p", "li"]


@register("remove_tag_blocks", "SELECT page_id, regexp_replace(html, "
          + O.q("|".join(f"<{t}.*?>(.*?)</{t}>" for t in REMOVE_TAGS)) + ", '  ', 'g') AS html FROM pages")
def remove_tags(spark, sf):
    pages = read_table(spark, sf, "pages")
    return pages.select("page_id", remove_tag_blocks(F.col("html"), REMOVE_TAGS).alias("html"))


@register("combined_text", A(f"SELECT doc_id, {O.COMBINED} AS combined_text FROM articles"))
def combined_text(spark, sf):
    return load_articles(spark, sf).select("doc_id", B.combined_text().alias("combined_text"))


@register("flags", A(
    "SELECT doc_id, coalesce(opt_content_warning, false) AS has_content_warning, "
    "coalesce(opt_breaking, false) AS is_breaking_news, coalesce(is_oppm, false) AS is_match_report, "
    "nullif(ad_campaign_keyword, '') IS NOT NULL AS ad_campaign FROM articles"))
def flags(spark, sf):
    return load_articles(spark, sf).select(
        "doc_id", B.has_content_warning().alias("has_content_warning"),
        B.is_breaking_news().alias("is_breaking_news"), B.is_match_report().alias("is_match_report"),
        B.ad_campaign().alias("ad_campaign"))


@register("tags", A(
    f"SELECT doc_id, CASE WHEN len({O.TAGS_KEPT}) > 0 THEN CAST(len({O.TAGS_KEPT}) AS BIGINT) END AS n_tags, "
    f"nullif(array_to_string(list_transform({O.TAGS_KEPT}, lambda t: t.id || '=' || t.label), '|'), '') AS tags "
    f"FROM articles"))
def tags(spark, sf):
    t = B.tags()
    return load_articles(spark, sf).select(
        "doc_id", F.when(t.isNotNull(), F.size(t)).cast("long").alias("n_tags"),
        F.nullif(F.array_join(F.transform(t, lambda x: F.concat_ws(
            "=", x.getField("id"), x.getField("label"))), "|"), F.lit("")).alias("tags"))


@register("tags_text", A(f"SELECT doc_id, {O.TAGS_TEXT} AS tags_text FROM articles"))
def tags_text(spark, sf):
    return load_articles(spark, sf).select("doc_id", B.tags_text().alias("tags_text"))


@register("tags_competition_text", A(
    f"SELECT doc_id, {O.TAGS_COMPETITION} AS tags_competition_text FROM articles"))
def tags_competition_text(spark, sf):
    return load_articles(spark, sf).select("doc_id", B.tags_competition_text().alias("tags_competition_text"))


@register("tag_labels", A(
    f"SELECT doc_id, CAST(len({O.TAG_LABELS}) AS BIGINT) AS n_labels, "
    f"array_to_string({O.TAG_LABELS}, '|') AS tag_labels FROM articles"))
def tag_labels(spark, sf):
    lab = B.tag_labels()
    return load_articles(spark, sf).select("doc_id", F.size(lab).cast("long").alias("n_labels"),
                                            F.array_join(lab, "|").alias("tag_labels"))


@register("camel_case_columns", A(
    f"SELECT doc_id AS \"docId\", {O.URI} AS \"assetUri\", {O.level_sql(0)} AS \"categoryLevel1\", "
    f"{O.iso_sql('ts_last_published')} AS \"lastPublished\", {O.TAGS_TEXT} AS \"tagsText\", "
    f"{O.SHORT_HEADLINE} AS \"shortHeadline\" FROM articles"))
def camel_case_columns(spark, sf):
    snake = load_articles(spark, sf).select(
        F.col("doc_id"), B.asset_uri().alias("asset_uri"), B.category_level(0).alias("category_level_1"),
        B.last_published().alias("last_published"), B.tags_text().alias("tags_text"),
        B.short_headline().alias("short_headline"))
    return B.camel_case_columns(snake)


PRUNE_FIELDS = ["asset_uri", "site", "category_level_2", "short_headline", "summary",
                "tags_text", "has_content_warning", "news_update"]


@register("prune_empty", A(
    "SELECT doc_id, array_to_string(list_filter([" + ", ".join(
        f"CASE WHEN ({e}) IS NOT NULL THEN {O.q(n)} END" for n, e in [
            ("asset_uri", O.URI), ("site", O.SITE), ("category_level_2", O.level_sql(1)),
            ("short_headline", O.SHORT_HEADLINE), ("summary", O.SUMMARY), ("tags_text", O.TAGS_TEXT),
            ("has_content_warning", "coalesce(opt_content_warning, false)"),
            ("news_update", f"coalesce({O.iso_sql('ts_timestamp')}, {O.iso_sql('ts_last_published')})")])
    + "], lambda x: x IS NOT NULL), ',') AS kept_fields FROM articles"))
def prune_empty(spark, sf):
    rec = load_articles(spark, sf).select(
        "doc_id", B.asset_uri().alias("asset_uri"), B.site().alias("site"),
        B.category_level(1).alias("category_level_2"), B.short_headline().alias("short_headline"),
        B.summary().alias("summary"), B.tags_text().alias("tags_text"),
        B.has_content_warning().alias("has_content_warning"),
        B.news_update_or_last_published().alias("news_update"))
    return prune_empty_keys(rec, PRUNE_FIELDS, key="doc_id")


@register("site_dispatch", A(
    f"SELECT doc_id, {O.SITE} AS site, CASE WHEN {O.SITE} = 'news' THEN {O.CATEGORY} END AS article_category_name, "
    f"CASE WHEN {O.SITE} = 'sport' THEN {O.TAGS_COMPETITION} END AS tags_competition_text, "
    f"CASE WHEN {O.SITE} = 'sport' THEN coalesce(is_oppm, false) END AS is_match_report "
    f"FROM articles WHERE {O.SITE} IN ('news', 'sport')"))
def site_dispatch_q(spark, sf):
    accepted, _rejected = site_dispatch(
        load_articles(spark, sf),
        sport_cols=[B.tags_competition_text().alias("tags_competition_text"),
                    B.is_match_report().alias("is_match_report")],
        news_cols=[B.article_category_name().alias("article_category_name")],
        common_cols=[F.col("doc_id")])
    return accepted
