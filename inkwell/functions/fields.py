"""Article field projections (B1-B20) as Column expressions over the F1
article layout (top-level ``metadata``, ``promo``, ``content`` structs).

Null rules: a nested lookup yields null for a missing key and for any falsy
end value (``''``, ``0``, ``false``, empty array); extractors return null,
predicates return false."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.config import ARTICLE_TYPE_REGEX, COMPETITION_TYPE, SITE_REGEX
from inkwell.functions.text import clean_html


# ---------------------------------------------------------------------------
# B1 nested lookup
# ---------------------------------------------------------------------------
def truthy_or_null(col: Column, dtype: T.DataType) -> Column:
    """Falsy -> null, by type."""
    if isinstance(dtype, T.StringType):
        return F.nullif(col, F.lit(""))
    if isinstance(dtype, T.BooleanType):
        return F.when(col, col)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                          T.FloatType, T.DoubleType, T.DecimalType)):
        return F.nullif(col, F.lit(0).cast(dtype))
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.when(F.size(col) > 0, col)
    return col


def _field_type(schema: T.StructType, path: list[str]) -> T.DataType:
    dtype: T.DataType = schema
    for key in path:
        dtype = dtype[key].dataType  # type: ignore[index]
    return dtype


def nested_value(df: DataFrame, path: str | list[str]) -> Column:
    """B1 on a typed struct column: ``a.b.c`` with falsy -> null.  A missing
    intermediate struct propagates null."""
    keys = path.split(".") if isinstance(path, str) else list(path)
    col = F.col(keys[0])
    for k in keys[1:]:
        col = col.getField(k)
    return truthy_or_null(col, _field_type(df.schema, keys))


def json_path_value(json_col: Column, path: str, sql_type: str = "bigint") -> Column:
    """B1 on schema-less JSON text: ``$.a.b`` typed, falsy -> null."""
    v = F.try_variant_get(F.try_parse_json(json_col), path, sql_type)
    dtype = {"bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
             "double": T.DoubleType(), "boolean": T.BooleanType()}[sql_type]
    return truthy_or_null(v, dtype)


# ---------------------------------------------------------------------------
# B2-B5 URI derived fields
# ---------------------------------------------------------------------------
def asset_uri() -> Column:
    return F.nullif(F.col("metadata.locators.assetUri"), F.lit(""))


def doc_type() -> Column:
    return F.lit("asset")


def site(uri: Column | None = None) -> Column:
    """First path segment via ``^/(.+?)/``; null when absent."""
    uri = asset_uri() if uri is None else uri
    return F.nullif(F.regexp_extract(uri, SITE_REGEX, 1), F.lit(""))


def category_level(idx: int, uri: Column | None = None) -> Column:
    """Segments between the first ``/`` and the last segment."""
    uri = asset_uri() if uri is None else uri
    parts = F.split(uri, "/")
    middle = F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0)))
    return F.get(middle, idx)


def last_segment(uri: Column | None = None) -> Column:
    uri = asset_uri() if uri is None else uri
    return F.element_at(F.split(uri, "/"), -1)


def article_category_name(uri: Column | None = None,
                          regex: str = ARTICLE_TYPE_REGEX) -> Column:
    """First match in the last segment, one trailing dash dropped,
    lowercased."""
    found = F.nullif(F.regexp_extract(last_segment(uri), regex, 1), F.lit(""))
    return F.lower(F.regexp_replace(found, "-$", ""))


# ---------------------------------------------------------------------------
# B6/B7 dates
# ---------------------------------------------------------------------------
MS_THRESHOLD = 100_000_000_000  # value / 1e11 > 1  ->  milliseconds


def epoch_seconds(ts: Column) -> Column:
    """Seconds or milliseconds in one field -> whole seconds (sub-second
    truncated)."""
    return F.when(ts > F.lit(MS_THRESHOLD), F.floor(ts / 1000)).otherwise(ts).cast("long")


def iso_utc(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss+00:00`` in UTC, independent of the session time
    zone; 0 / null -> null."""
    secs = epoch_seconds(F.nullif(ts, F.lit(0).cast("long")))
    stamp = F.timestamp_add("SECOND", secs, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return F.concat(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def last_updated() -> Column:
    return iso_utc(F.col("metadata.lastUpdated"))


def last_published() -> Column:
    return iso_utc(F.col("metadata.lastPublished"))


def first_published() -> Column:
    return iso_utc(F.col("metadata.firstPublished"))


def news_update_or_last_published() -> Column:
    """``metadata.timestamp`` when truthy, else last published."""
    return F.coalesce(iso_utc(F.col("metadata.timestamp")), last_published())


# ---------------------------------------------------------------------------
# B8-B12 text fields
# ---------------------------------------------------------------------------
def headline() -> Column:
    return F.nullif(F.col("promo.headlines.headline"), F.lit(""))


def short_headline() -> Column:
    return F.nullif(F.col("promo.headlines.shortHeadline"), F.lit(""))


def summary() -> Column:
    return F.nullif(F.col("promo.summary"), F.lit(""))


def _block_texts() -> Column:
    blocks = F.coalesce(F.col("content.blocks"), F.array())
    return F.transform(blocks, lambda b: F.coalesce(b.getField("text"), F.lit("")))


def body_raw() -> Column:
    """Block texts joined with no separator, markup kept (what keyword
    labelling sees); never null."""
    return F.array_join(_block_texts(), "")


def body_clean(tags_to_remove: Iterable[str] = ()) -> Column:
    """Block texts joined with a space, markup stripped, entities
    decoded, whitespace collapsed; empty -> null."""
    joined = F.array_join(_block_texts(), " ")
    return F.nullif(clean_html(joined, tags_to_remove), F.lit(""))


def combined_text(body: Column | None = None) -> Column:
    """Headline + summary + clean body, nulls skipped."""
    body = body_clean() if body is None else body
    return F.nullif(F.concat_ws(" ", headline(), summary(), body), F.lit(""))


# ---------------------------------------------------------------------------
# B13 flags
# ---------------------------------------------------------------------------
def has_content_warning() -> Column:
    return F.coalesce(F.col("metadata.options.hasContentWarning"), F.lit(False))


def is_breaking_news() -> Column:
    return F.coalesce(F.col("metadata.options.isBreakingNews"), F.lit(False))


def is_match_report() -> Column:
    return F.coalesce(F.col("metadata.isOppm"), F.lit(False))


def ad_campaign() -> Column:
    return F.nullif(F.col("metadata.adCampaignKeyword"), F.lit("")).isNotNull()


# ---------------------------------------------------------------------------
# B14-B16, B20 tags
# ---------------------------------------------------------------------------
def _about() -> Column:
    return F.coalesce(F.col("metadata.tags.about"), F.array())


def _normalise_label(c: Column) -> Column:
    return F.lower(F.replace(c, F.lit(" "), F.lit("-")))


def tags(level1: Column | None = None, level2: Column | None = None) -> Column:
    """``{id, label}`` per tag, dropping tags whose normalised label
    equals category level 1 or 2 (normalised likewise); none -> null."""
    level1 = category_level(0) if level1 is None else level1
    level2 = category_level(1) if level2 is None else level2
    drop = F.array_compact(F.array(_normalise_label(level1), _normalise_label(level2)))
    pairs = F.transform(_about(), lambda t: F.struct(
        t.getField("thingId").alias("id"), t.getField("thingLabel").alias("label")))
    kept = F.filter(pairs, lambda p: ~F.coalesce(
        F.array_contains(drop, _normalise_label(p.getField("label"))), F.lit(False)))
    return F.when(F.size(kept) > 0, kept)


def tags_text(tag_col: Column | None = None) -> Column:
    """Labels with space -> ``_``, space-joined; empty -> null."""
    tag_col = tags() if tag_col is None else tag_col
    labels = F.transform(F.coalesce(tag_col, F.array()),
                         lambda t: F.replace(t.getField("label"), F.lit(" "), F.lit("_")))
    return F.nullif(F.array_join(labels, " "), F.lit(""))


def tags_competition_text() -> Column:
    """Competition tags only (no redundancy filter)."""
    comp = F.filter(_about(), lambda t: F.coalesce(
        F.array_contains(t.getField("thingType"), COMPETITION_TYPE), F.lit(False)))
    text = F.array_join(F.transform(comp, lambda t: F.replace(
        t.getField("thingLabel"), F.lit(" "), F.lit("_"))), " ")
    return F.when(F.size(comp) > 0, text)


def tag_labels() -> Column:
    """Every ``about`` label, no redundancy filter, nulls skipped."""
    return F.filter(F.transform(_about(), lambda t: t.getField("thingLabel")),
                    lambda x: x.isNotNull())


# ---------------------------------------------------------------------------
# B17 camelCase renaming (schema only, no data pass)
# ---------------------------------------------------------------------------
def underscore_to_camel(name: str) -> str:
    """First non-empty token lowercased, later ones capitalised (rest
    lowercased); empty token -> ``_``."""
    tokens = name.split("_")
    first = next((i for i, tok in enumerate(tokens) if tok), -1)
    return "".join("_" if not tok else tok.lower() if i == first else tok.capitalize() for i, tok in enumerate(tokens))


def camel_type(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(underscore_to_camel(f.name),
                                           camel_type(f.dataType), f.nullable)
                             for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(camel_type(dtype.elementType), dtype.containsNull)
    if isinstance(dtype, T.MapType):
        return T.MapType(dtype.keyType, camel_type(dtype.valueType), dtype.valueContainsNull)
    return dtype


def camel_case_columns(df: DataFrame) -> DataFrame:
    """Rename snake_case -> camelCase through nested structs and arrays with a
    cast to the renamed type (metadata only)."""
    return df.select([F.col(f"`{f.name}`").cast(camel_type(f.dataType))
                      .alias(underscore_to_camel(f.name)) for f in df.schema.fields])
