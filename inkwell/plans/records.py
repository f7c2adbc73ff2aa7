"""Search-document records (B17-B19, H3): per-site wide selects, null/empty
pruning and camelCase naming -- all schema-level, no Python per row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.functions import fields as B
from inkwell.functions import predicates as C
from inkwell.operators.entities import ZERO_COLUMNS


def _prune(col: Column, dtype: T.DataType, nested: bool) -> Column:
    """Empty string / empty array -> null; inside structs, ``false``, ``0`` and
    structs of which nothing is left go as well.  A top-level struct stays,
    with what is left of it, and so does every list element."""
    if isinstance(dtype, T.StringType):
        return F.nullif(col, F.lit(""))
    if isinstance(dtype, T.ArrayType):
        inner = F.transform(col, lambda x: _prune(x, dtype.elementType, False)) \
            if isinstance(dtype.elementType, T.StructType) else col
        return F.when(F.size(col) > 0, inner)
    if isinstance(dtype, T.StructType):
        fields = [_prune(col.getField(f.name), f.dataType, True).alias(f.name) for f in dtype.fields]
        pruned = F.when(col.isNotNull(), F.struct(*fields))
        if not nested:
            return pruned
        return F.when(reduce(lambda a, b: a | b, [f.isNotNull() for f in fields], F.lit(False)), pruned)
    if nested:
        return B.truthy_or_null(col, dtype)
    return col


def prune_empty(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Per-leaf pruning so that ``to_json`` (which omits nulls) renders
    the record without empty values.  Top-level ``false``/``0`` stay."""
    return df.select([F.col(f"`{f.name}`") if f.name in keep else
                      _prune(F.col(f"`{f.name}`"), f.dataType, False).alias(f.name)
                      for f in df.schema.fields])


def to_record_json(df: DataFrame, key: str) -> DataFrame:
    """Render pruned rows as JSON documents (nulls omitted)."""
    fields = [f.name for f in df.schema.fields if f.name != key]
    return df.select(key, F.to_json(F.struct(*[F.col(f"`{n}`") for n in fields])).alias("record"))


def prune_empty_keys(df: DataFrame, fields: Sequence[str], key: str) -> DataFrame:
    """The field names that survive pruning, comma-joined in field order."""
    pruned = prune_empty(df.select(key, *fields), keep=[key])
    doc = to_record_json(pruned, key)
    return doc.select(key, F.array_join(F.json_object_keys("record"), ",").alias("kept_fields"))


def site_dispatch(articles: DataFrame, sport_cols: Sequence[Column], news_cols: Sequence[Column],
                  common_cols: Sequence[Column] = (), strict: bool = False
                  ) -> tuple[DataFrame, DataFrame]:
    """Sport and news feature sets by site; other sites go to a reject
    DataFrame (``strict=True`` makes a reject an error at run time)."""
    s = B.site()
    base = articles.withColumn("site", s)
    sport = base.where(F.col("site") == "sport").select(*common_cols, "site", *sport_cols)
    news = base.where(F.col("site") == "news").select(*common_cols, "site", *news_cols)
    accepted = sport.unionByName(news, allowMissingColumns=True)
    rejected = base.where(~F.coalesce(F.col("site").isin("sport", "news"), F.lit(False)))
    if strict:
        rejected = rejected.withColumn(
            "_reject", F.raise_error(F.concat(F.lit("unsupported site: "),
                                              F.coalesce(F.col("site"), F.lit("<null>")))))
    return accepted, rejected


# ---------------------------------------------------------------------------
# H3 flat records per site
# ---------------------------------------------------------------------------
def common_fields(body: Column | None = None, combined: Column | None = None) -> list[Column]:
    lvl = [B.category_level(i) for i in range(3)]
    tg = B.tags(lvl[0], lvl[1])
    body = B.body_clean() if body is None else body
    combined = B.combined_text(body) if combined is None else combined
    return [
        B.asset_uri().alias("asset_uri"), B.doc_type().alias("type"), B.site().alias("site"),
        B.has_content_warning().alias("has_content_warning"), tg.alias("tags"),
        B.tags_text(tg).alias("tags_text"),
        lvl[0].alias("category_level_1"), lvl[1].alias("category_level_2"),
        lvl[2].alias("category_level_3"), B.last_updated().alias("last_updated"),
        B.last_published().alias("last_published"), B.first_published().alias("first_published"),
        B.news_update_or_last_published().alias("news_update_or_last_published"),
        B.headline().alias("headline"), B.short_headline().alias("short_headline"),
        B.summary().alias("summary"), body.alias("body"),
        combined.alias("combined_body_summary_headline"),
        B.ad_campaign().alias("ad_campaign"),
    ]


def news_fields(combined: Column | None = None) -> list[Column]:
    cat = B.article_category_name()
    combined = B.combined_text() if combined is None else combined
    return [cat.alias("article_category_name"), B.is_breaking_news().alias("is_breaking_news"),
            C.is_uk_news(cat).alias("is_uk_news"), C.nation(cat).alias("nation"),
            C.is_press_review().alias("is_press_review"),
            C.is_legal(combined, B.tags_text()).alias("is_legal"),
            C.is_politics(cat).alias("is_politics"), C.is_elections(cat).alias("is_elections")]


def sport_fields(periodical=(), rankings=(), squad=(), draw_ids=()) -> list[Column]:
    return [B.tags_competition_text().alias("tags_competition_text"),
            C.is_periodical(periodical).alias("is_periodical"),
            C.is_red_button_content().alias("is_red_button_content"),
            C.is_rankings(rankings).alias("is_rankings"), C.is_squad(squad).alias("is_squad"),
            C.is_competition_draw(draw_ids).alias("is_competition_draw"),
            B.is_match_report().alias("is_match_report")]


def site_records(articles: DataFrame, key: str = "article_key", entity_features: DataFrame | None = None,
                 camel: bool = True, **sport_lists) -> DataFrame:
    """H3: one flat record per accepted article (sport or news), nulls and
    empties pruned, optional entity features (D9-D12) joined by key,
    camelCase names."""
    # clean body and combined text once per article
    staged = articles.withColumn("_body", B.body_clean()) \
        .withColumn("_combined", B.combined_text(F.col("_body")))
    common = [c for i, c in enumerate(common_fields(F.col("_body"), F.col("_combined"))) if i != 2]
    accepted, _ = site_dispatch(staged, sport_fields(**sport_lists), news_fields(F.col("_combined")),
                                common_cols=[F.col(key)] + common)
    if entity_features is not None:
        accepted = accepted.join(entity_features, key, "left") \
            .fillna(0, [c for c in entity_features.columns if c in ZERO_COLUMNS])
    out = prune_empty(accepted, keep=[key])
    return B.camel_case_columns(out) if camel else out
