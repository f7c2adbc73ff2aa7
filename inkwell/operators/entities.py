"""Entity enrichment (D1-D14): mentions joined with knowledge-base facts and
name dictionaries, then per-article algebraic aggregates.

Mentions are read once: the KB is first reduced to one row per subject with
everything a mention of it needs (gender, party, the party's position and its
own), so each mention meets the KB in one join and the name dictionaries in
another; broadcast or shuffle, and the splitting of a hot URI or name, is
AQE's choice from real sizes.  Per-article results come from one aggregate per
article with partial aggregation before the shuffle, so an article holding a
third of all mentions costs one more partial row per task, not one giant group.  Repeated mentions are a weight column,
never materialised repeats."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.config import (PARTY_COLUMNS, PERSON_TYPE, POLITICAL_PARTIES,
                            POLITICAL_PARTY_TYPE, POLITICAL_POSITION_SCORES,
                            POLITICIAN_TYPE)
from inkwell.functions.text import bind

KB_PREDICATES = ["party", "gender", "position", "successor", "wikiPageRedirects"]


# ---------------------------------------------------------------------------
# D1 type filters
# ---------------------------------------------------------------------------
def mentions_by_type(mentions: DataFrame) -> DataFrame:
    """Person / party / politician flags per mention row; politicians
    are the subset of people."""
    types = F.coalesce(F.col("types"), F.array().cast("array<string>"))
    person = F.array_contains(types, PERSON_TYPE)
    return mentions.select(
        "*", person.alias("is_person"),
        F.array_contains(types, POLITICAL_PARTY_TYPE).alias("is_party"),
        (person & F.array_contains(types, POLITICIAN_TYPE)).alias("is_politician"))


# ---------------------------------------------------------------------------
# D2 KB lookup
# ---------------------------------------------------------------------------
def join_uri(left: DataFrame, right: DataFrame, key: str, spread: str | None = None) -> DataFrame:
    """Left join on a URI.  URIs begin alike, so a sort of them compares them
    whole; by their hash first, two longs settle nearly every comparison.  Rows
    without the URI match nothing and are dealt out by ``spread``, if given."""
    by = F.xxhash64(key)
    dealt = by if spread is None else F.when(F.col(key).isNotNull(), by).otherwise(F.xxhash64(spread))
    return left.select("*", dealt.alias("_hash")).join(right.select("*", by.alias("_hash")), ["_hash", key], "left").drop("_hash")


def kb_lookup(kb_facts: DataFrame, predicates: Sequence[str] = KB_PREDICATES) -> DataFrame:
    """One row per subject, one column per predicate holding the first
    binding (deterministic: the smallest value)."""
    facts = kb_facts.where(F.col("predicate").isin(list(predicates)))
    return facts.groupBy(F.xxhash64("subject").alias("_hash"), "subject").agg(*[     # as in join_uri
        F.min(F.when(F.col("predicate") == p, F.col("value"))).alias(p) for p in predicates]).drop("_hash")


# ---------------------------------------------------------------------------
# D3 gender
# ---------------------------------------------------------------------------
def first_name(label: Column) -> Column:
    return F.get(F.split(label, " "), 0)


def name_dictionary(name_gender: DataFrame) -> DataFrame:
    """One row per first name with both providers' genders."""
    return name_gender.where(F.col("first_name").isNotNull()).groupBy("first_name").agg(
        F.min(F.when(F.col("provider") == "detector", F.col("gender"))).alias("det_gender"),
        F.min(F.when(F.col("provider") == "genderize", F.col("gender"))).alias("gz_gender"))


def gender_resolution(people: DataFrame, kb_wide: DataFrame, name_gender: DataFrame) -> DataFrame:
    """D3: KB gender; if absent, the first dictionary (``mostly_*`` folded);
    if still not male/female, the second dictionary.  Adds ``first_name``,
    the KB's other columns (``party``) and ``gender``."""
    kb = kb_wide.withColumnsRenamed({"subject": "uri", "gender": "kb_gender"})
    p = join_uri(people, kb, "uri").withColumn("first_name", first_name(F.col("label")))
    p = p.join(name_dictionary(name_gender), "first_name", "left")
    det = (F.when(F.col("det_gender") == "mostly_female", "female")
           .when(F.col("det_gender") == "mostly_male", "male")
           .otherwise(F.coalesce(F.col("det_gender"), F.lit("unknown"))))
    g1 = F.when(F.col("first_name").isNotNull(), F.coalesce(F.col("kb_gender"), det)) \
        .otherwise(F.col("kb_gender"))
    gender = F.when(g1.isin("male", "female"), g1).otherwise(F.col("gz_gender"))
    return p.withColumn("gender", gender).drop("kb_gender", "det_gender", "gz_gender")


# ---------------------------------------------------------------------------
# D4-D7 parties
# ---------------------------------------------------------------------------
def kb_profile(kb_wide: DataFrame) -> DataFrame:
    """What a mention needs to know of its subject: ``gender``, ``party``,
    ``party_position`` and, as a party itself, ``own_position``, with the
    positions' scores, which are found once a subject and not once a mention."""
    positions = party_position(kb_wide).withColumn("score", position_score(F.col("position")))

    def of(prefix: str, key: str) -> DataFrame:
        return positions.select(F.col("party_uri").alias(key), *[F.col(c).alias(f"{prefix}_{c}") for c in ("position", "score")])

    return join_uri(join_uri(kb_wide.select("subject", "gender", "party"), of("own", "subject"), "subject"),
                    of("party", "party"), "party", "subject") \
        .select("subject", "gender", "party", "party_position", "party_score", "own_position", "own_score")


def with_entries(resolved: DataFrame) -> DataFrame:
    """One row per resolved mention and party entry: a politician's party and
    a mentioned party, with their weight (missing count -> 1), position and its
    score; a mention without an entry stays as one row.  ``entry`` numbers the rows of
    a mention from 0.  ``party_uri`` may be null for a politician without a
    party."""
    weight = F.coalesce(F.col("count"), F.lit(1)).cast("long")

    def entry(uri: str, whose: str, kind: str) -> Column:
        return F.struct(F.col(uri).alias("party_uri"), weight.alias("weight"), F.col(f"{whose}_position").alias("position"),
                        F.col(f"{whose}_score").alias("score"), F.lit(kind).alias("kind"))

    politician, party = entry("party", "party", "politician"), entry("uri", "own", "party")
    entries = F.when(F.col("is_politician") & F.col("is_party"), F.array(politician, party)) \
        .when(F.col("is_politician"), F.array(politician)).when(F.col("is_party"), F.array(party))
    out = resolved.select("*", F.posexplode_outer(entries).alias("entry", "e"))
    return out.select(*resolved.columns, F.coalesce("entry", F.lit(0)).alias("entry"),
                      "e.party_uri", "e.weight", "e.position", "e.score", "e.kind")


def party_references(entries: DataFrame) -> DataFrame:
    """Distinct non-null party URIs per article."""
    return entries.where(F.col("party_uri").isNotNull()).select("article_key", "party_uri") \
        .dropDuplicates(["article_key", "party_uri"])


def party_position(kb_wide: DataFrame) -> DataFrame:
    """Own position, else the successor's, else the redirect target's.
    Only subjects with a position, successor or redirect take part, so the
    self-joins run on a slice of the KB."""
    pos = kb_wide.where(F.col("position").isNotNull() | F.col("successor").isNotNull()
                        | F.col("wikiPageRedirects").isNotNull()) \
        .select("subject", "position", "successor", "wikiPageRedirects")
    succ = pos.select(F.col("subject").alias("successor"), F.col("position").alias("s_position"))
    redir = pos.select(F.col("subject").alias("wikiPageRedirects"), F.col("position").alias("r_position"))
    j = join_uri(join_uri(pos, succ, "successor", "subject"), redir, "wikiPageRedirects", "subject")
    return j.select(F.col("subject").alias("party_uri"), F.coalesce("position", "s_position", "r_position").alias("position"))


def position_score(position: Column,
                   scores: Sequence[tuple[str, int]] = POLITICAL_POSITION_SCORES) -> Column:
    """Non-letters -> space, lowercase, first contained phrase wins."""
    def first(norm: Column) -> Column:
        out = F.lit(None).cast("int")
        for phrase, score in reversed(list(scores)):
            out = F.when(norm.contains(phrase), F.lit(score)).otherwise(out)
        return out
    return bind(F.lower(F.regexp_replace(position, "[^a-zA-Z]", " ")), first)


def position_expansion(entries: DataFrame) -> DataFrame:
    """One weighted row per entry with a party; entries whose party has
    no position keep a null position."""
    return entries.where(F.col("party_uri").isNotNull()).withColumn("score", position_score(F.col("position")))


def party_slug(uri: Column, slugs: Sequence[str] = POLITICAL_PARTIES) -> Column:
    def first(low: Column) -> Column:
        out = F.lit(None).cast("string")
        for s in reversed(list(slugs)):
            out = F.when(low.contains(s), F.lit(s)).otherwise(out)
        return out
    return bind(F.lower(uri), first)


# ---------------------------------------------------------------------------
# Per-article aggregates
# ---------------------------------------------------------------------------
#: Per-article columns that are 0 for an article without mentions.
ZERO_COLUMNS = ["num_political_references", "num_political_reference_entries", "num_people_mentioned", "num_politicians",
                *PARTY_COLUMNS]


def article_aggregates(rows: DataFrame) -> DataFrame:
    """D8-D13 per article from ``with_entries`` rows, in one aggregate: what it
    sums and lists is worked out row by row before."""
    person = F.col("is_person") & (F.col("entry") == 0)
    count = F.coalesce(F.col("count"), F.lit(0)).cast("long")

    def counted(condition: Column, value: Column = F.lit(1)) -> Column:
        return F.when(condition, value).otherwise(0).cast("long")

    referred = F.col("party_uri").isNotNull()
    nz = referred & F.col("score").isNotNull() & (F.col("score") != 0)
    slug = party_slug(F.col("party_uri"))
    listed = F.struct(F.coalesce("label", "surface_form").alias("name"), "position",
                      F.when(slug.isNotNull(), 1).otherwise(0).alias("score"))
    staged = rows.select(
        "article_key", "party_uri", slug.alias("slug"),
        F.when(nz, F.col("score") * F.col("weight")).alias("scored"), F.when(nz, F.col("weight")).alias("scoring"),
        counted(referred, F.col("weight")).alias("references"),
        counted(person & (F.col("gender") == "female"), count).alias("female"),
        counted(person & F.col("gender").isin("female", "male"), count).alias("known"),
        counted(person).alias("people"), counted(person & F.col("is_politician")).alias("politicians"),
        F.when(F.col("kind") == "party", listed).alias("listed"))
    return staged.groupBy("article_key").agg(
        (F.sum("scored") / F.nullif(F.sum("scoring"), F.lit(0))).alias("political_score"),
        F.sum("references").alias("num_political_reference_entries"),
        F.size(F.collect_set("party_uri")).cast("long").alias("num_political_references"),
        *[F.max(F.when(F.col("slug") == s, 1).otherwise(0)).alias(c) for s, c in zip(POLITICAL_PARTIES, PARTY_COLUMNS)],
        (F.sum("female") / F.nullif(F.sum("known"), F.lit(0))).alias("female_proportion"),
        F.sum("people").alias("num_people_mentioned"), F.sum("politicians").alias("num_politicians"),
        F.array_sort(F.collect_list("listed")).alias("partyScore"))


class Enrichment:
    """All D-operators over one mentions / KB / dictionary input; each
    property is a lazily composed DataFrame (Catalyst plans each use)."""

    def __init__(self, mentions: DataFrame, kb_facts: DataFrame, name_gender: DataFrame,
                 source: str | None = "tagger_b", materialize_kb: bool = False):
        m = mentions if source is None else mentions.where(F.col("source") == source)
        self.typed = mentions_by_type(m)
        self.kb_wide = kb_lookup(kb_facts)
        if materialize_kb:
            # one row per subject, read by the self-joins: aggregate it once
            from inkwell.session import materialize_table
            self.kb_wide = materialize_table(self.kb_wide, "kb")
        self.name_gender = name_gender

    @cached_property
    def resolved(self) -> DataFrame:
        """People and parties mentioned, with KB and dictionary columns."""
        return gender_resolution(self.typed.where("is_person or is_party"), kb_profile(self.kb_wide), self.name_gender)

    @cached_property
    def people(self) -> DataFrame:
        return self.resolved.where("is_person")

    @cached_property
    def entries(self) -> DataFrame:
        return with_entries(self.resolved).where(F.col("kind").isNotNull())

    @cached_property
    def references(self) -> DataFrame:
        return party_references(self.entries)

    @cached_property
    def positions(self) -> DataFrame:
        return party_position(self.kb_wide)

    @cached_property
    def expanded(self) -> DataFrame:
        return position_expansion(self.entries)

    @cached_property
    def per_article(self) -> DataFrame:
        """D8-D13 for each article with a mention of a person or party."""
        return article_aggregates(with_entries(self.resolved))

    def party_scores(self) -> DataFrame:
        """Per mentioned party: name, resolved position and 0/1 score
        (1 when its URI carries a known party slug)."""
        return self.resolved.where("is_party").select(
            "article_key", F.coalesce(F.col("label"), F.col("surface_form")).alias("name"),
            F.col("own_position").alias("position"),
            F.when(party_slug(F.col("uri")).isNotNull(), 1).otherwise(0).alias("score"))

    def attach(self, articles: DataFrame, key: str = "article_key", columns: Sequence[str] | None = None) -> DataFrame:
        """``articles``, row by row, with the per-article columns (no mentions
        -> counts 0, scores null)."""
        found = self.per_article.withColumnRenamed("article_key", key)
        wanted = list(columns) if columns is not None else [c for c in found.columns if c != key]
        return articles.join(found.select(key, *wanted), key, "left").fillna(0, [c for c in wanted if c in ZERO_COLUMNS])

    def article_features(self, articles: DataFrame, key: str = "article_key") -> DataFrame:
        """D8-D12 per article."""
        return self.attach(articles.select(key), key, [c for c in self.per_article.columns if c not in ("article_key", "partyScore")])
