"""Keyword and entity labelling.

Article fields (tags, headline, summary, raw body) are lowercased and
space-joined once per article, so a keyword may span two fields.  Tagger
output arrives as mention rows; each label is matched on its own row and
the per-article result is an OR-aggregation (partial aggregation before the
shuffle, so a hot article never gathers its mentions into one list).
Mention rows without an order cannot be joined; where they have one,
``keyword_automaton.boolean_categories_spanning`` also finds keywords that span
labels."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.config import CATEGORY_KEYWORDS, FOOTBALL_TEAMS, THINGS_URI_PREFIX
from inkwell.functions import fields as B
from inkwell.functions.predicates import joined_lower

TAGGER_A, TAGGER_B = "tagger_a", "tagger_b"


# ---------------------------------------------------------------------------
# C15 tagger projections
# ---------------------------------------------------------------------------
def tagger_labels(mentions: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Per mention row: the label each tagger contributes (A: ``label`` with
    ``''`` default; B: ``label``, nulls skipped) and the URIs (A: ``uri``;
    B: every ``same_as`` under the topic prefix plus ``#id``), with the
    ``carried`` columns."""
    src = F.col("source")
    things = F.transform(
        F.filter(F.coalesce(F.col("same_as"), F.array().cast("array<string>")),
                 lambda u: u.startswith(THINGS_URI_PREFIX)),
        lambda u: F.concat(u, F.lit("#id")))
    return mentions.select(
        "article_key", "source", *carried,
        F.when(src == TAGGER_A, F.coalesce(F.col("label"), F.lit("")))
         .when(src == TAGGER_B, F.col("label")).alias("tag_label"),
        F.when(src == TAGGER_A, F.array(F.coalesce(F.col("uri"), F.lit(""))))
         .when(src == TAGGER_B, things).alias("tag_uris"))


# ---------------------------------------------------------------------------
# C13 boolean categories
# ---------------------------------------------------------------------------
def _category_flags(text_lower: Column, categories: Mapping[str, Mapping[str, Sequence[str]]],
                    prefix: str) -> list[Column]:
    """Two flags per category of a lowered text, which is best a column of its
    own: it is read once per keyword."""
    def found(terms: Sequence[str]) -> Column:
        hits = [text_lower.contains(t.lower()) for t in terms]
        return F.coalesce(functools.reduce(Column.__or__, hits, F.lit(False)), F.lit(False))
    return [found(spec.get(kind, [])).alias(f"{prefix}{name}__{suffix}")
            for name, spec in categories.items() for kind, suffix in (("should", "s"), ("should_not", "n"))]


def article_text(use_tags: bool = True, use_headline: bool = True,
                 use_summary: bool = True, use_body: bool = True) -> Column:
    """The lowered article-side text the keyword labeller scans."""
    segs: list[Column] = []
    if use_tags:
        segs.append(B.tag_labels())
    if use_headline:
        segs.append(F.coalesce(F.col("promo.headlines.headline"), F.lit("")))
    if use_summary:
        segs.append(F.coalesce(F.col("promo.summary"), F.lit("")))
    if use_body:
        segs.append(B.body_raw())
    return joined_lower(segs) if segs else F.lit("")


def boolean_categories(articles: DataFrame, mentions: DataFrame | None = None,
                       categories: Mapping[str, Mapping[str, Sequence[str]]] = CATEGORY_KEYWORDS,
                       use_tags: bool = True, use_headline: bool = True,
                       use_summary: bool = True, use_body: bool = True,
                       use_tagger_a: bool = True, use_tagger_b: bool = True,
                       key: str = "article_key") -> DataFrame:
    """One boolean column per category over the selected sources.
    Returns ``key`` plus one column per category name."""
    text = article_text(use_tags, use_headline, use_summary, use_body)
    art = articles.select(F.col(key), text.alias("_text")).select(key, *_category_flags(F.col("_text"), categories, ""))
    names = list(categories)
    if mentions is not None and (use_tagger_a or use_tagger_b):
        sources = [s for s, on in ((TAGGER_A, use_tagger_a), (TAGGER_B, use_tagger_b)) if on]
        lab = tagger_labels(mentions).where(F.col("source").isin(sources)) \
            .where(F.col("tag_label").isNotNull())
        per_row = lab.select(F.col("article_key").alias(key), F.lower("tag_label").alias("_label")) \
            .select(key, *_category_flags(F.col("_label"), categories, "m_"))
        agg = per_row.groupBy(key).agg(*[F.max(f"m_{n}__{k}").alias(f"m_{n}__{k}")
                                         for n in names for k in ("s", "n")])
        art = art.join(agg, key, "left")
        cols = []
        for n in names:
            s = F.col(f"{n}__s") | F.coalesce(F.col(f"m_{n}__s"), F.lit(False))
            m = F.col(f"{n}__n") | F.coalesce(F.col(f"m_{n}__n"), F.lit(False))
            cols.append((~m & s).alias(n))
        return art.select(key, *cols)
    return art.select(key, *[(~F.col(f"{n}__n") & F.col(f"{n}__s")).alias(n) for n in names])


# ---------------------------------------------------------------------------
# C14 entity URI labels
# ---------------------------------------------------------------------------
def entity_uri_labels(articles: DataFrame, mentions: DataFrame,
                      entities: Sequence[tuple[str, str]] = FOOTBALL_TEAMS,
                      key: str = "article_key") -> DataFrame:
    """C14: for each entity, does the article's tagger URI output contain its
    URI (case-insensitive).  Entities are a bounded literal list, so the test
    is a per-row expression (no join); the per-article OR is a partial
    aggregation.  Returns ``key``, one boolean per entity, the ordered array
    ``entity_flags`` and a name -> boolean map ``entity_map``."""
    uris = tagger_labels(mentions).select(
        "article_key", F.lower(F.concat_ws(" ", "tag_uris")).alias("u"))
    flags = [F.max(F.col("u").contains(uri.lower())).alias(name) for name, uri in entities]
    agg = uris.groupBy(F.col("article_key").alias(key)).agg(*flags)
    names = [n for n, _ in entities]
    out = articles.select(key).join(agg, key, "left")
    filled = [F.coalesce(F.col(n), F.lit(False)).alias(n) for n in names]
    out = out.select(key, *filled)
    return out.select(
        "*", F.array(*[F.col(n) for n in names]).alias("entity_flags"),
        F.map_from_arrays(F.array(*[F.lit(n) for n in names]),
                          F.array(*[F.col(n) for n in names])).alias("entity_map"))


# ---------------------------------------------------------------------------
# One pass over tagger output for every per-article label (used by H1)
# ---------------------------------------------------------------------------
def mention_label_aggregates(mentions: DataFrame,
                             categories: Mapping[str, Mapping[str, Sequence[str]]] = CATEGORY_KEYWORDS,
                             entities: Sequence[tuple[str, str]] = FOOTBALL_TEAMS,
                             key: str = "article_key") -> DataFrame:
    """Keyword hits (should / should_not per category) over tagger labels
    and entity URI hits, in a single partial aggregation per article."""
    agg, flags = mention_label_bits(mentions, categories, entities, key)
    return agg.select(key, *[flag.alias(name) for name, flag in flags.items()])


#: Flags that one long holds.
BITS = 62


def mention_label_bits(mentions: DataFrame, categories: Mapping[str, Mapping[str, Sequence[str]]],
                       entities: Sequence[tuple[str, str]], key: str) -> tuple[DataFrame, dict[str, Column]]:
    """The same flags as bits of long columns, so that a mention or an article
    costs a few longs on its way: one row per article, and the flag each name
    stands for (null for an article without mentions)."""
    low = tagger_labels(mentions).select(F.col("article_key").alias(key), F.lower("tag_label").alias("_label"),
                                         F.lower(F.concat_ws(" ", "tag_uris")).alias("_uris"))
    names = [f"m_{n}__{k}" for n in categories for k in ("s", "n")] + [name for name, _ in entities]
    flags = _category_flags(F.col("_label"), categories, "m_") + [F.col("_uris").contains(uri.lower()) for _, uri in entities]

    def bits(some: Sequence[Column]) -> Column:
        ones = [F.when(flag, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, flag in enumerate(some)]
        return functools.reduce(Column.bitwiseOR, ones)

    groups = {f"_bits{i}": bits(flags[i:i + BITS]) for i in range(0, len(flags), BITS)}
    agg = low.select(key, *[c.alias(name) for name, c in groups.items()]).groupBy(key).agg(
        *[F.bit_or(name).alias(name) for name in groups])
    return agg, {name: F.col(f"_bits{i - i % BITS}").bitwiseAND(F.lit(1 << i % BITS).cast("long")) != 0
                 for i, name in enumerate(names)}
