"""Vocabulary counts and top-k terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import explode_indexed

WORD_SPLIT = r"[^\p{L}]+"


def spaced_words(text: Column) -> Column:
    """Lowercased letter runs with one space between them (and perhaps around)."""
    return F.regexp_replace(F.lower(text), WORD_SPLIT, " ")


def words(text: Column) -> Column:
    """Lowercased letter runs (non-letters normalised to one space with a
    once-compiled pattern, then a plain single-character split)."""
    return F.filter(F.split(spaced_words(text), " "), lambda t: t != "")


def vocab_counts(df: DataFrame, text: str) -> DataFrame:
    """``(term, n)`` over all texts; the count is partially aggregated per
    task, so frequent terms never gather raw rows in one place."""
    return explode_indexed(df, [], words(F.col(text)), "pos", "term").groupBy("term").agg(
        F.count("*").alias("n"))


def top_vocab(df: DataFrame, text: str, k: int = 10000) -> DataFrame:
    """Top-k terms by frequency, ties broken by term (a top-k report: the
    limit is the feature; Spark plans it as a per-partition take-ordered)."""
    return vocab_counts(df, text).orderBy(F.col("n").desc(), F.col("term")).limit(k)


def top_vocab_from_table(word_vectors: DataFrame, k: int = 10000) -> DataFrame:
    """Top-k of a ``(term, count, vector)`` table."""
    return word_vectors.select("term", F.col("count").alias("n")) \
        .orderBy(F.col("n").desc(), F.col("term")).limit(k)
