"""Corpus pipeline: language ID, SimHash near-dedup, PII, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs; all but the last return
the columns of ``documents``.

* ``language_id`` drops documents whose language is undetermined (no letter)
  or scores under ``MIN_LANGUAGE_SCORE``.
* ``simhash`` keeps one document, the one with the smallest doc_id, of every
  group of near duplicates.
* ``pii`` replaces personal data in the texts by its kind.
* ``mixing`` keeps every document and lays the files out in the order of the
  mixed stream.
* ``packing`` returns the pieces of all documents; sequences follow the mixed
  stream, and only the documents of one run of it are ordered along the curve.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import language_id, mixing, packing, pii, simhash
from inkwell.llm.common import table, written
from inkwell.llm.settings import (MIN_LANGUAGE_SCORE, OTHER_WEIGHT, SIMHASH_BITS, SIMHASH_WORDS, TARGET_WEIGHTS,
                                  tokenizer_path)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.train(docs), MIN_LANGUAGE_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs, SIMHASH_WORDS, SIMHASH_BITS)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, TARGET_WEIGHTS, OTHER_WEIGHT)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(mixing.runs(docs, ["doc_id", "text"]), tokenizer_path(), run_col="run")


STAGES = [("language_id", identify_language), ("simhash", drop_near_duplicates), ("pii", redact_pii),
          ("mixing", mix_sources), ("packing", pack)]

#: Language scores, fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
