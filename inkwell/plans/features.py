"""H1/H2: the per-article feature record and corpus enrichment.

One scan of the articles computes every in-row feature (article-side
keyword text, entailment, sentiment, sarcasm); tagger output contributes one
partial aggregation per article (keyword and entity hits); knowledge-base
scores contribute per-article aggregates.  Everything meets in left joins on
the article key, so every article gets a record."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.config import (BOOLEAN_FEATURES, CATEGORY_KEYWORDS, ENTAILMENT_MAX_CHARS,
                            ENTAILMENT_THRESHOLD, ENTAILMENT_TOPICS, FOOTBALL_TEAMS)
from inkwell.functions import fields as B
from inkwell.functions import sentiment as S
from inkwell.functions.text import split_sentences
from inkwell.operators.classifier import article_sarcasm, rule_scorer, sarcasm_score
from inkwell.operators.entailment import best_probability, premises, term_share_scorer
from inkwell.operators.entities import Enrichment
from inkwell.operators.labelling import _category_flags, article_text, mention_label_bits
from inkwell.sources.document_sink import relative_path, write_documents
from inkwell.sources.sinks import sink_enriched


def article_features(articles: DataFrame, mentions: DataFrame | None = None,
                     kb_facts: DataFrame | None = None, name_gender: DataFrame | None = None,
                     key: str = "article_key",
                     categories: Mapping[str, Mapping[str, Sequence[str]]] = CATEGORY_KEYWORDS,
                     entities: Sequence[tuple[str, str]] = FOOTBALL_TEAMS,
                     topics: Mapping[str, Sequence[str]] = ENTAILMENT_TOPICS,
                     entail_scorer=term_share_scorer,
                     sarcasm_scorer: Callable[[Column], Column] | None = None, sarcasm_model=None,
                     lexicon=None, materialize_kb: bool = False,
                     with_party_scores: bool = True, max_chars: int = ENTAILMENT_MAX_CHARS,
                     source: str | None = None) -> DataFrame:
    """H1, a row for each row of ``articles``, also where a key repeats: ``key``, score features (when mentions and KB are given), one
    boolean per category, ``premierLeagueTeams`` (ordered booleans) and
    ``n_teams``, entailment booleans, ``sentiment_label`` and
    ``sarcasm_score`` (the last three only where combined text exists), which
    a Column ``sarcasm_scorer`` or a fitted ``sarcasm_model`` gives.  ``source``
    names a struct in which the article's own columns come along."""
    carried = [source] if source else []
    if source:
        articles = articles.select("*", F.struct(*articles.columns).alias(source))
    lex = S.lexicon_map(lexicon)
    # clean body once; combined text and premise derive from it (the
    # optimizer keeps an expensive column that is used twice in one place)
    staged = articles.select(F.col(key), *carried, article_text().alias("_text"),
                             B.headline().alias("_h"), B.summary().alias("_s"), B.body_clean().alias("_body"))
    base = staged.select(key, *carried, *_category_flags(F.col("_text"), categories, ""),
                         F.nullif(F.concat_ws(" ", "_h", "_s", "_body"), F.lit("")).alias("_combined"),
                         premises(F.col("_body"), entail_scorer, max_chars).alias("_premises"))

    has_text = F.col("_combined").isNotNull()
    ent = [(best_probability(F.col("_premises"), terms, entail_scorer) >= ENTAILMENT_THRESHOLD).alias(name)
           for name, terms in topics.items()]
    sent = F.when(has_text, S.sentiment_label(S.mean_of(S.list_scores(split_sentences(F.col("_combined")), lex))))
    sarc = F.when(has_text, sarcasm_score(F.col("_combined"), sarcasm_scorer or rule_scorer(["!"])))
    kept = [c for c in base.columns if c not in ("_combined", "_premises")]
    inrow = base.select(*kept, *ent, sent.alias("sentiment_label"), sarc.alias("sarcasm_score"))
    if sarcasm_model is not None:
        scores = article_sarcasm(base.select(key, "_combined"), key, "_combined", model=sarcasm_model)
        inrow = inrow.drop("sarcasm_score").join(scores.select(key, "sarcasm_score"), key, "left")

    names = list(categories)
    team_names = [n for n, _ in entities]
    if mentions is not None:
        agg, flags = mention_label_bits(mentions, categories, entities, key)
        out = inrow.join(agg, key, "left")
        cats = [(~(F.col(f"{n}__n") | F.coalesce(flags[f"m_{n}__n"], F.lit(False)))
                 & (F.col(f"{n}__s") | F.coalesce(flags[f"m_{n}__s"], F.lit(False)))).alias(n) for n in names]
        teams = [F.coalesce(flags[t], F.lit(False)) for t in team_names]
    else:
        out = inrow
        cats = [(~F.col(f"{n}__n") & F.col(f"{n}__s")).alias(n) for n in names]
        teams = [F.lit(False) for _ in team_names]
    team_arr = F.array(*teams)
    cols = [F.col(key), *carried, *cats, team_arr.alias("premierLeagueTeams"),
            F.size(F.filter(team_arr, lambda x: x)).alias("n_teams"),
            *[F.col(n) for n in topics], F.col("sentiment_label"), F.col("sarcasm_score")]
    result = out.select(*cols)
    if mentions is not None and kb_facts is not None and name_gender is not None:
        enr = Enrichment(mentions, kb_facts, name_gender, materialize_kb=materialize_kb)
        wanted = ["political_score", "female_proportion", *(["partyScore"] if with_party_scores else [])]
        result = enr.attach(result, key, wanted).withColumnRenamed("female_proportion", "gender_score")
    return result


def enrich_corpus(articles: DataFrame, out_path: str, fmt: str = "json", **feature_args) -> DataFrame:
    """H2: articles -> H1 features -> sink (one job).  Each article carries its
    own columns through the features, so n articles give n documents, repeated
    keys or not, and nothing is joined on the key once more.  Returns the
    written DataFrame definition (the write has already run)."""
    key = feature_args.get("key", "article_key")
    feats = article_features(articles.withColumn("site", B.site()), source="_source", **feature_args)
    own = [c for c in feats.columns if c not in (key, "_source")]
    enriched = feats.select("_source.*", F.struct(*own).alias("features"))
    sink_enriched(enriched, out_path, fmt=fmt, partition_by="site")
    return enriched


def enrich_files(articles: DataFrame, root: str, target: str, overwrite: bool = False, **feature_args) -> None:
    """H2 file by file: every article scanned from ``root`` (``path_key`` is its
    file) becomes one JSON file at the same relative path below ``target``: the
    document and its features."""
    feats = article_features(articles, key="path_key", source="_source", **feature_args)
    own = [c for c in feats.columns if c not in ("path_key", "_source")]
    source = [f"_source.{c}" for c in articles.columns if c not in ("path_key", "file_name")]
    content = F.to_json(F.struct(*source, F.struct(*own).alias("features")))
    write_documents(feats.select(relative_path(F.col("path_key"), root).alias("path"), content.alias("content")),
                    target, overwrite=overwrite)


__all__ = ["enrich_files", "article_features", "enrich_corpus", "BOOLEAN_FEATURES"]
