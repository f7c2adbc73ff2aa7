"""Sources and sinks, each a round trip through files written under
the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.config import CATEGORY_KEYWORDS
from inkwell.functions import fields as B
from inkwell.operators.labelling import boolean_categories
from inkwell.plans import oracles as O
from inkwell.plans.catalog import register
from inkwell.plans.catalog.labels import ARTICLE_TEXT_SQL, _kw_sql
from inkwell.plans.standins import load_articles
from inkwell.schema import ARTICLE
from inkwell.session import read_table, scratch_path
from inkwell.sources import articles as SA
from inkwell.sources import files as SF
from inkwell.sources.document_sink import relative_path, write_documents
from inkwell.sources.sinks import attach_features, sink_enriched
from inkwell.sources.snapshot import topic_snapshot_refresh

KEYED_ARTICLE = T.StructType([T.StructField("doc_id", T.LongType())] + ARTICLE.fields)

FOLDERS = 1024

ROUND_TRIP_SQL = O.with_articles(
    f"SELECT doc_id, {O.URI} AS asset_uri, {O.HEADLINE} AS headline, "
    f"{O.iso_sql('ts_last_published')} AS last_published, CAST(len(block_texts) AS INTEGER) AS n_blocks, "
    f"{O.TAGS_TEXT} AS tags_text FROM articles")


def _written_articles(spark, sf) -> str:
    """One JSON document per file, the files dealt into folders.  They are
    committed by one rename; Spark's writer would move each of them on the driver."""
    path = scratch_path(spark, "articles-json")
    arts = load_articles(spark, sf).drop("article_key", "lang", "source")
    numbered = arts.select(F.monotonically_increasing_id().alias("_id"), F.to_json(F.struct("*")).alias("content"))
    write_documents(numbered.select(F.concat(F.xxhash64("_id").bitwiseAND(FOLDERS - 1), F.lit("/"), F.col("_id"), F.lit(".json")).alias("path"),
                                    "content"), path)
    return path


def _round_trip_projection(df):
    return df.select("doc_id", B.asset_uri().alias("asset_uri"), B.headline().alias("headline"),
                     B.last_published().alias("last_published"),
                     F.size("content.blocks").alias("n_blocks"), B.tags_text().alias("tags_text"))


@register("scan_articles", ROUND_TRIP_SQL)
def scan_articles_q(spark, sf):
    path = _written_articles(spark, sf)
    return _round_trip_projection(SA.scan_articles(spark, path, KEYED_ARTICLE))


@register("scan_articles_filtered", ROUND_TRIP_SQL + " WHERE doc_id % 3 <> 0")
def scan_articles_filtered_q(spark, sf):
    """A third of the documents is in files of another extension."""
    path = scratch_path(spark, "articles-mixed")
    arts = load_articles(spark, sf).drop("article_key", "lang", "source")
    arts.where("doc_id % 3 <> 0").write.json(f"{path}/a")
    arts.where("doc_id % 3 = 0").select(F.to_json(F.struct("*")).alias("value")).write.text(f"{path}/b")
    df = SA.scan_articles_filtered(spark, path, extension_filter=".JSON", schema=KEYED_ARTICLE, multi_line=False)
    return _round_trip_projection(df)


@register("scan_ndjson", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def scan_ndjson_q(spark, sf):
    path = scratch_path(spark, "events-ndjson")
    ev = read_table(spark, sf, "events")
    ev.select(F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "props": '),
                       F.col("props"), F.lit("}")).alias("value")).write.mode("overwrite").text(path)
    back = SF.scan_ndjson(spark, path, "event_id bigint, props struct<k: bigint>")
    return back.select("event_id", F.col("props.k").alias("k"))


@register("scan_csv", """
SELECT d.doc_id, d.text AS review, CASE WHEN l.quality = 1 THEN 'positive' ELSE 'negative' END AS sentiment
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def scan_csv_q(spark, sf):
    path = scratch_path(spark, "reviews-csv")
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    lab = read_table(spark, sf, "labels").select("doc_id", "quality")
    rows = docs.join(lab, "doc_id").select(
        "doc_id", F.col("text").alias("review"),
        F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("sentiment"))
    SF.write_csv(rows, path)
    return SF.scan_csv(spark, path, "doc_id bigint, review string, sentiment string")


@register("scan_word_vectors", """
SELECT 'v' || CAST(vec_id AS VARCHAR) AS term, CAST(len(embedding) AS INTEGER) AS n_dims,
  round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS vsum FROM embeddings""")
def scan_word_vectors_q(spark, sf):
    path = scratch_path(spark, "word2vec-text")
    emb = read_table(spark, sf, "embeddings").select(
        F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("term"), F.col("embedding").alias("vector"))
    SF.write_word2vec_text(emb, path)
    wv = SF.scan_word_vectors(spark, path, fmt="word2vec")
    total = F.aggregate(F.transform("vector", lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return wv.select("term", F.size("vector").alias("n_dims"), F.round(total, 4).alias("vsum"))


_SINK_COLS = ["headline"]
for _name, _spec in CATEGORY_KEYWORDS.items():
    _s, _n = _kw_sql("t", _spec)
    _SINK_COLS.append(f"(NOT {_n} AND {_s}) AS \"{_name}\"")


def _sink_sql() -> str:
    return O.with_articles(f"SELECT article_key, site, {', '.join(_SINK_COLS)} FROM (SELECT article_key, {O.SITE} AS site, "
                           f"headline_raw AS headline, {ARTICLE_TEXT_SQL} AS t FROM articles)")


@register("sink_enriched", _sink_sql())
def sink_enriched_q(spark, sf):
    path = scratch_path(spark, "enriched")
    arts = load_articles(spark, sf)
    feats = boolean_categories(arts)
    out = attach_features(arts.withColumn("site", B.site()), feats)
    sink_enriched(out, path, fmt="json", partition_by="site")
    back = spark.read.schema(out.schema).json(path)
    return back.select("article_key", "site", F.col("promo.headlines.headline").alias("headline"), "features.*")


@register("sink_documents", O.with_articles(
    f"SELECT site || '/' || doc_id || '/article.json' AS path, {', '.join(_SINK_COLS)} "
    f"FROM (SELECT doc_id, {O.SITE} AS site, headline_raw AS headline, {ARTICLE_TEXT_SQL} AS t FROM articles)"))
def sink_documents_q(spark, sf):
    """One file per article, all of one name, each in a folder of its own."""
    target = scratch_path(spark, "documents")
    arts = load_articles(spark, sf).withColumn("site", B.site())
    rows = attach_features(arts, boolean_categories(arts)).select(
        F.concat_ws("/", "site", F.col("doc_id").cast("string"), F.lit("article.json")).alias("path"),
        F.to_json(F.struct(F.col("promo.headlines.headline").alias("headline"), "features")).alias("content"))
    write_documents(rows, target)
    features = T.StructType([T.StructField(c, T.BooleanType()) for c in CATEGORY_KEYWORDS])
    back = SA.scan_articles(spark, target, T.StructType([T.StructField("headline", T.StringType()),
                                                         T.StructField("features", features)]))
    return back.select(relative_path(F.col("path_key"), target).alias("path"), "headline", "features.*")


@register("topic_snapshot_refresh", """
SELECT CAST(o_orderkey AS VARCHAR) AS article_key, CAST(o_orderkey % 3 AS INTEGER) AS n_topics FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def topic_snapshot_refresh_q(spark, sf):
    orders = read_table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("article_key"))
    snap = read_table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("article_key"))

    def client_factory():
        return lambda keys: [[{"uri": f"{k}/{i}"} for i in range(int(k) % 3)] for k in keys]
    return topic_snapshot_refresh(orders, snap, client_factory=client_factory, partitions=4).select("article_key", "n_topics")
