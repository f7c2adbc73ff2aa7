"""Stand-in inputs derived from the driver tables.

The behaviour we reproduce reads raw article JSON, tagger output, a
knowledge base and name dictionaries.  None of those ship with the driver
data, so each is derived deterministically from a driver table with plain
column expressions (no row is dropped or sampled):

* ``articles``    F1 documents, one per ``documents`` row
* ``mentions``    F2 tagger topics, one per ``lineitem`` row (+ a second tagger
                  on first line items), topic facts from ``part``
* ``kb_facts``    F3 (subject, predicate, value) from ``part``
* ``name_gender`` F4 first-name dictionaries from ``part`` names

The DuckDB oracle texts in ``inkwell.plans.oracles`` build the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.config import (FOOTBALL_TEAMS, PERSON_TYPE, POLITICAL_PARTIES,
                            POLITICAL_PARTY_TYPE, POLITICIAN_TYPE,
                            THINGS_URI_PREFIX)
from inkwell.schema import TAG
from inkwell.session import read_table

EPOCH0 = 1276763088
URI_SLUGS = POLITICAL_PARTIES + ["independent_group"]


def article_uri(doc_id: Column) -> Column:
    site = F.when(doc_id % 5 == 0, F.lit("/sport/football/")).otherwise(F.lit("/news/"))
    prefix = (F.when(doc_id % 8 == 0, "uk-england-london-")
              .when(doc_id % 8 == 1, "uk-politics-")
              .when(doc_id % 8 == 2, "world-europe-")
              .when(doc_id % 8 == 3, "election-2019-")
              .when(doc_id % 8 == 4, "uk-scotland-")
              .when(doc_id % 8 == 5, "business-")
              .when(doc_id % 8 == 6, "uk-northern-ireland-politics-")
              .otherwise(""))
    return F.concat(site, prefix, F.lpad(doc_id.cast("string"), 8, "0"))


def _tag(thing_id: Column, label: Column, kind: Column) -> Column:
    return F.struct(thing_id.alias("thingId"), label.alias("thingLabel"),
                    F.concat(F.lit(THINGS_URI_PREFIX), thing_id, F.lit("#id")).alias("thingUri"),
                    kind.alias("thingType"))


def articles_from_documents(documents: DataFrame) -> DataFrame:
    """F1-shaped articles: ``article_key``, ``doc_id``, ``lang``, ``source``
    plus the ``metadata`` / ``promo`` / ``content`` structs."""
    d = F.col("doc_id")
    lines = F.split(F.col("text"), "\n", -1)
    para = F.transform(lines, lambda ln: F.struct(
        F.lit("paragraph").alias("type"), ln.alias("text"), F.lit("markup").alias("markupType")))
    image = F.array(F.struct(F.lit("image").alias("type"), F.lit(None).cast("string").alias("text"),
                             F.lit(None).cast("string").alias("markupType")))
    blocks = F.when(d % 6 == 0, F.concat(image, para)).otherwise(para)

    topic_label = (F.when(d % 3 == 0, "News").when(d % 3 == 1, "Football")
                   .otherwise("Premier League"))
    topic_kind = F.when(d % 3 == 2, F.array(F.lit("sport:Competition"))) \
        .otherwise(F.array(F.lit("core:Theme")))
    tag_list = F.array(
        _tag(F.concat(F.lit("t-"), F.col("lang")), topic_label, topic_kind),
        _tag(F.col("source"), F.concat(F.lit("Source "), F.col("source")),
             F.array(F.lit("core:Organisation"))))
    legal = F.array(_tag(F.lit("legal-case"), F.lit("Alex Salmond case"),
                         F.array(F.lit("core:Event"))))
    about = (F.when(d % 10 == 9, F.array().cast(T.ArrayType(TAG)))
             .when(d % 50 == 0, F.concat(tag_list, legal))
             .otherwise(tag_list))

    first_line = F.get(lines, 0)
    metadata = F.struct(
        F.struct(article_uri(d).alias("assetUri")).alias("locators"),
        ((F.lit(EPOCH0) + d * 3600 + 59) * 1000 + d % 1000).alias("lastUpdated"),
        ((F.lit(EPOCH0) + d * 3600 - 86400)
         * F.when(d % 3 == 0, 1000).otherwise(1)).alias("firstPublished"),
        ((F.lit(EPOCH0) + d * 3600) * F.when(d % 2 == 1, 1000).otherwise(1)).alias("lastPublished"),
        F.when(d % 4 == 0, F.lit(EPOCH0) + d * 1800)
         .when(d % 4 == 2, F.lit(0).cast("long")).alias("timestamp"),
        F.when(d % 17 == 0, F.concat(F.lit("campaign-"), F.col("source")))
         .when(d % 17 == 1, F.lit("")).alias("adCampaignKeyword"),
        F.when(d % 5 == 0, d % 10 == 0).alias("isOppm"),
        F.struct((d % 11 == 0).alias("hasContentWarning"),
                 F.when(d % 13 == 0, True).when(d % 13 == 1, F.lit(None).cast("boolean"))
                 .otherwise(False).alias("isBreakingNews")).alias("options"),
        F.struct(about.alias("about")).alias("tags"),
    )
    promo = F.struct(
        F.struct(first_line.alias("headline"),
                 F.when(d % 3 != 0, F.substring(first_line, 1, 30)).alias("shortHeadline"))
        .alias("headlines"),
        F.get(lines, 1).alias("summary"),
    )
    return documents.select(
        d.cast("string").alias("article_key"), d.alias("doc_id"), "lang", "source",
        metadata.alias("metadata"), promo.alias("promo"),
        F.struct(blocks.alias("blocks")).alias("content"))


def load_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles_from_documents(
        read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


# ---------------------------------------------------------------------------
# Knowledge-base stand-ins
# ---------------------------------------------------------------------------
def kb_uri(key: Column) -> Column:
    slugs = F.array(*[F.lit(s) for s in URI_SLUGS])
    return F.concat(F.lit("http://dbpedia.org/resource/"),
                    F.element_at(slugs, (key % len(URI_SLUGS) + 1).cast("int")),
                    F.lit("_"), key.cast("string"))


def _team_same_as(brand: Column) -> Column:
    """Brand#n -> the n-th team's topic URI (without ``#id``) when n <= 27."""
    n = F.substring(brand, 7, 4).cast("int")
    teams = F.array(*[F.lit(uri[:-3]) for _, uri in FOOTBALL_TEAMS])
    return F.when(n.between(1, len(FOOTBALL_TEAMS)), F.element_at(teams, n)) \
        .otherwise(F.concat(F.lit(THINGS_URI_PREFIX + "brand-"), n.cast("string")))


def mentions_from_lineitem(lineitem: DataFrame, part: DataFrame, positions: bool = False) -> DataFrame:
    """F2 rows: every line item is a ``tagger_b`` topic of order ``l_orderkey``;
    first line items are also reported by ``tagger_a``.  ``positions`` keeps
    their order in the tagger's output."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    pt = part.select("p_partkey", "p_name", "p_brand", "p_type")
    j = li.join(pt, li.l_partkey == pt.p_partkey)
    types = (F.when(F.col("p_type") == "PROMO", F.array(F.lit(POLITICAL_PARTY_TYPE)))
             .when(F.col("p_type").isin("ECONOMY", "STANDARD"),
                   F.array(F.lit(PERSON_TYPE), F.lit(POLITICIAN_TYPE)))
             .otherwise(F.array(F.lit(PERSON_TYPE))))
    same_as = F.array(F.concat(F.lit("http://dbpedia.org/resource/"),
                               F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))),
                      _team_same_as(F.col("p_brand")))
    sources = F.when(F.col("l_linenumber") == 1, F.array(F.lit("tagger_b"), F.lit("tagger_a"))).otherwise(F.array(F.lit("tagger_b")))
    both = j.select(
        F.col("l_orderkey").cast("string").alias("article_key"),
        F.explode(sources).alias("source"),
        kb_uri(F.col("p_partkey")).alias("uri"),
        F.col("p_name").alias("label"),
        F.col("p_brand").alias("surface_form"),
        types.alias("types"),
        F.when(F.col("l_linenumber") == 3, F.lit(None).cast("int"))
         .otherwise(F.col("l_quantity").cast("int")).alias("count"),
        same_as.alias("same_as"),
        F.col("l_linenumber")).withColumn(
        "label", F.when(F.col("source") == "tagger_a", F.initcap("label")).otherwise(F.col("label")))
    return both.withColumnRenamed("l_linenumber", "position") if positions else both.drop("l_linenumber")


def load_mentions(spark: SparkSession, sf_dir: str, positions: bool = False) -> DataFrame:
    return mentions_from_lineitem(read_table(spark, sf_dir, "lineitem"),
                                  read_table(spark, sf_dir, "part"), positions)


def kb_facts_from_part(part: DataFrame) -> DataFrame:
    """F3 facts.  A sixth of the subjects lacks a position; some reach one
    through a successor or a redirect; every seventh has a second position
    binding (first binding = smallest value)."""
    k = F.col("p_partkey")
    subj = kb_uri(k)
    position = (F.when(k % 6 == 0, "Left-wing").when(k % 6 == 1, "Centre-left")
                .when(k % 6 == 2, "Centrism").when(k % 6 == 3, "Center-right")
                .when(k % 6 == 4, "Right-wing politics"))
    gender = F.when(F.col("p_type") != "PROMO",
                    F.when(F.col("p_size") % 3 == 0, "male").when(F.col("p_size") % 3 == 1, "female"))
    party = F.when(F.col("p_type").isin("ECONOMY", "STANDARD"), kb_uri(k % 40))
    def fact(pred: str, value: Column) -> Column:
        return F.struct(F.lit(pred).alias("predicate"), value.cast("string").alias("value"))

    facts = F.array(
        fact("position", position),
        fact("position", F.when(k % 7 == 0, F.lit("Far-right"))),
        fact("gender", gender),
        fact("party", party),
        fact("successor", F.when(k % 18 == 5, kb_uri(k + 1))),
        fact("wikiPageRedirects", F.when(k % 18 == 11, kb_uri(k + 2))),
    )
    return (part.select(subj.alias("subject"), F.inline(facts))
            .where(F.col("value").isNotNull()))


def load_kb_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kb_facts_from_part(read_table(spark, sf_dir, "part"))


def name_gender_from_part(part: DataFrame) -> DataFrame:
    """F4 first-name dictionaries for two providers, keyed by the first word
    of ``p_name``."""
    first = F.split(F.col("p_name"), " ").getItem(0)
    names = part.select(first.alias("first_name")).distinct()
    n = F.length("first_name")
    detector = names.select(
        "first_name",
        (F.when(n % 4 == 0, "mostly_female").when(n % 4 == 1, "male")
         .when(n % 4 == 2, "andy").otherwise("unknown")).alias("gender"),
        F.lit("detector").alias("provider"))
    genderize = names.select(
        "first_name",
        F.when(n % 2 == 0, "female").when(n == 3, "male").alias("gender"),
        F.lit("genderize").alias("provider"))
    return detector.unionByName(genderize).where(F.col("gender").isNotNull())


def load_name_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_gender_from_part(read_table(spark, sf_dir, "part"))
