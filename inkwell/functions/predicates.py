"""Filters and predicates (C1-C12) as Column expressions.

Keyword lists are literals folded into the expression tree (tens of terms);
everything stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.config import (COMPETITION_DRAW_IDS, LEGAL_INDICATORS, LEGAL_TAGS,
                            NATIONS, PERIODICAL_INDICATORS,
                            PRESS_REVIEW_INDICATORS, RANKINGS_INDICATORS,
                            RED_BUTTON_MARKER, SQUAD_INDICATORS)
from inkwell.functions import fields as B
from inkwell.functions.text import bind


def contains_any(text: Column, terms: Iterable[str], case_insensitive: bool = True) -> Column:
    """True when ``text`` contains any term; null text -> null."""
    terms = [t.lower() if case_insensitive else t for t in terms]
    if not terms:
        return F.when(text.isNotNull(), F.lit(False))
    hay = F.lower(text) if case_insensitive else text

    def any_term(h: Column) -> Column:
        out = None
        for t in terms:
            c = h.contains(F.lit(t))
            out = c if out is None else (out | c)
        return out
    # several terms: evaluate the (lowered) text once, not once per term
    return bind(hay, any_term) if len(terms) > 1 else any_term(hay)


def keyword_match(text_lower: Column, should: Sequence[str],
                  should_not: Sequence[str] = ()) -> Column:
    """C12 over an already-lowercased, space-joined text: false if any
    ``should_not`` term occurs; else true if any ``should`` term occurs."""
    text_lower = F.coalesce(text_lower, F.lit(""))
    should_not = [s.lower() for s in should_not]
    hit_not = contains_any(text_lower, should_not, case_insensitive=False) if should_not else F.lit(False)
    hit = contains_any(text_lower, [s.lower() for s in should], case_insensitive=False) \
        if should else F.lit(False)
    return F.when(hit_not, F.lit(False)).otherwise(hit)


def joined_lower(segments: Sequence[Column]) -> Column:
    """Lowercase, space-join all segments (null segments skipped) so a
    keyword may span two segments.  Array segments contribute each element."""
    return F.lower(F.concat_ws(" ", *segments))


# ---------------------------------------------------------------------------
# Sport predicates (lists are parameters)
# ---------------------------------------------------------------------------
def is_periodical(indicators: Iterable[str] = PERIODICAL_INDICATORS) -> Column:
    """Headline contains an indicator (case-insensitive); no headline -> false."""
    return F.coalesce(contains_any(B.headline(), indicators), F.lit(False))


def is_red_button_content() -> Column:
    """Summary contains the marker (case-sensitive); null summary -> false."""
    return F.coalesce(B.summary().contains(RED_BUTTON_MARKER), F.lit(False))


def is_rankings(titles: Iterable[str] = RANKINGS_INDICATORS) -> Column:
    """Short headline equals a listed title; null when no short headline."""
    sh = B.short_headline()
    titles = list(titles)
    return F.when(sh.isNotNull(), sh.isin(titles) if titles else F.lit(False))


def is_squad(titles: Iterable[str] = SQUAD_INDICATORS) -> Column:
    """C4: like C3 with the squad list."""
    return is_rankings(titles)


def is_competition_draw(ids: Iterable[str] = COMPETITION_DRAW_IDS) -> Column:
    """Last URI segment in the id list; empty segment -> null."""
    seg = F.nullif(B.last_segment(), F.lit(""))
    ids = list(ids)
    return F.when(seg.isNotNull(), seg.isin(ids) if ids else F.lit(False))


# ---------------------------------------------------------------------------
# News predicates
# ---------------------------------------------------------------------------
def is_uk_news(category: Column | None = None) -> Column:
    """Category contains ``uk``; null without a category."""
    category = B.article_category_name() if category is None else category
    return category.contains("uk")


def nation(category: Column | None = None, nations: Sequence[str] = NATIONS) -> Column:
    """First listed nation contained in the category."""
    category = B.article_category_name() if category is None else category
    out = None
    for n in reversed(list(nations)):
        out = F.when(category.contains(n), F.lit(n)) if out is None else \
            F.when(category.contains(n), F.lit(n)).otherwise(out)
    return out if out is not None else F.lit(None).cast("string")


def is_press_review(indicators: Iterable[str] = PRESS_REVIEW_INDICATORS) -> Column:
    """Headline or short headline contains an indicator; else false."""
    indicators = list(indicators)
    return (F.coalesce(contains_any(B.headline(), indicators), F.lit(False))
            | F.coalesce(contains_any(B.short_headline(), indicators), F.lit(False)))


def is_legal(combined: Column | None = None, tag_text: Column | None = None,
             indicators: Iterable[str] = LEGAL_INDICATORS,
             legal_tags: Iterable[str] = LEGAL_TAGS) -> Column:
    """Combined text contains a legal term, or the tags text contains a
    legal tag; case-insensitive; nulls -> false."""
    combined = B.combined_text() if combined is None else combined
    tag_text = B.tags_text() if tag_text is None else tag_text
    return (F.coalesce(contains_any(combined, indicators), F.lit(False))
            | F.coalesce(contains_any(tag_text, legal_tags), F.lit(False)))


def is_politics(category: Column | None = None) -> Column:
    """C10."""
    category = B.article_category_name() if category is None else category
    return category.contains("politics")


def is_elections(category: Column | None = None) -> Column:
    """C11."""
    category = B.article_category_name() if category is None else category
    return category.contains("election")
