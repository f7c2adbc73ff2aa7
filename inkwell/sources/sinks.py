"""Enriched-article sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_features(articles: DataFrame, features: DataFrame, key: str = "article_key",
                    name: str = "features") -> DataFrame:
    """The source document plus one nested feature struct (left join: every
    input article is written, with or without features)."""
    feat_cols = [c for c in features.columns if c != key]
    packed = features.select(key, F.struct(*feat_cols).alias(name))
    return articles.join(packed, key, "left")


def sink_enriched(df: DataFrame, path: str, fmt: str = "json", partition_by: str | None = "site",
                  mode: str = "overwrite") -> None:
    """Write enriched documents; the target folder is created if missing.
    Partitioned by site (one folder per site) when the column exists.  Spark
    writes through task commit, so a lost executor's partial files never
    become visible."""
    w = df.write.mode(mode)
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.format(fmt).save(path)
