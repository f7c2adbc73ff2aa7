"""Sentiment operators (E1-E5) over DataFrames.

Scoring is a projection of each row (see ``inkwell.functions.sentiment``);
only the per-group mean over many rows (``sentiment_mean``) aggregates, and
it does so with a partial ``avg``."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions import sentiment as S
from inkwell.functions.text import explode_indexed, split_on_period, split_sentences


def sentences(df: DataFrame, text: str, keys: list[str],
              splitter: Callable[[Column], Column] = split_sentences) -> DataFrame:
    """One row per sentence (``sent_idx`` 0-based).  ``splitter`` may be
    ``split_on_period`` (literal ``.``, blanks kept) or any Column function
    returning array<string>."""
    return explode_indexed(df, keys, splitter(F.col(text)), "sent_idx", "sentence")


def lexicon_sentiment(df: DataFrame, text: str, keys: list[str],
                      lexicon: Mapping[str, float] | DataFrame | None = None) -> DataFrame:
    """Compound score per sentence."""
    lex = S.lexicon_map(lexicon)
    return explode_indexed(df, keys, S.sentence_scores(F.col(text), lex), "sent_idx", "_e") \
        .select(*keys, "sent_idx", F.col("_e.sentence").alias("sentence"),
                F.col("_e.compound").alias("compound"))


def sentiment_mean(df: DataFrame, text: str, group: list[str], lexicon=None) -> DataFrame:
    """E3 over rows: each row's text is one scored segment; mean per group
    (partial aggregation, so a hot group costs one partial row per task)."""
    lex = S.lexicon_map(lexicon)
    return df.select(*group, S.sentence_compound(F.col(text), lex).alias("compound")) \
        .groupBy(*group).agg(F.avg("compound").alias("sentiment_score"),
                             F.count("*").alias("n_segments"))


def article_sentiment(df: DataFrame, text: str, keys: list[str], convert_to_sents: bool = True,
                      aggregate_scores: bool = True, lexicon=None,
                      splitter: Callable[[Column], Column] = split_sentences,
                      scorer: Callable[[Column], Column] | None = None,
                      normaliser: Callable[[Column], Column] | None = S.sentiment_label) -> DataFrame:
    """E5: text -> sentences -> scores -> mean -> label, as one projection.
    ``aggregate_scores=False`` returns per-sentence rows instead.  ``scorer``
    is another sentiment model: array of sentences -> array of scores (a
    Column expression or a pandas UDF)."""
    scorer = scorer or (lambda texts: S.list_scores(texts, S.lexicon_map(lexicon)))
    segs = splitter(F.col(text)) if convert_to_sents else F.array(F.col(text))
    scores = scorer(segs)
    if not aggregate_scores:
        out = explode_indexed(df, keys, scores, "sent_idx", "sentiment_score")
        if normaliser is not None:
            out = out.withColumn("sentiment_label", normaliser(F.col("sentiment_score")))
        return out
    staged = df.select(*keys, scores.alias("_sc"))
    sc = F.col("_sc")
    out = staged.select(*keys, F.when(sc.isNull(), 0).otherwise(F.size(sc)).alias("n_sentences"),
                        S.mean_of(sc).alias("sentiment_score"))
    if normaliser is not None:
        out = out.withColumn("sentiment_label", normaliser(F.col("sentiment_score")))
    return out


__all__ = ["sentences", "lexicon_sentiment", "sentiment_mean", "article_sentiment",
           "split_on_period", "split_sentences"]
