"""Incremental topic snapshot.

Only article URIs not yet in the snapshot are fetched: ``distinct`` +
``left_anti`` against the existing snapshot, then an injected client runs
per partition in ``mapInPandas`` (the number of partitions bounds client
concurrency).  The keys in the written snapshot are its manifest: a rerun with
the same arguments, after a run that failed or was killed before, during or
after its append, fetches only what is still missing and appends no key twice
(one run at a time)."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.session import materialize_table, ship_package

Client = Callable[[list[str]], list[list[dict]]]

SNAPSHOT_SCHEMA = "article_key string, topics_json string, n_topics int"


def empty_client(uris: list[str]) -> list[list[dict]]:
    """Default client: no network here, every URI returns no topics."""
    return [[] for _ in uris]


def missing_keys(articles: DataFrame, snapshot: DataFrame, key: str = "article_key") -> DataFrame:
    """Article keys not in the snapshot (distinct)."""
    return articles.select(key).distinct().join(snapshot.select(key).distinct(), key, "left_anti")


def fetch_topics(keys: DataFrame, client_factory: Callable[[], Client] = lambda: empty_client,
                 key: str = "article_key", batch_size: int = 100, partitions: int | None = None) -> DataFrame:
    """Call the client for each key (batches of ``batch_size`` per call)."""
    ship_package(keys.sparkSession)
    if partitions is not None:
        keys = keys.repartition(partitions, key)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        for pdf in it:
            ks = pdf[key].astype(str).tolist()
            out = []
            for i in range(0, len(ks), batch_size):
                chunk = ks[i:i + batch_size]
                out.extend(client(chunk))
            yield pd.DataFrame({"article_key": ks, "topics_json": [json.dumps(t) for t in out],
                                "n_topics": [len(t) for t in out]})

    # filter before mapInPandas: Catalyst does not push filters through it
    return keys.select(F.col(key).cast("string").alias(key)).mapInPandas(run, SNAPSHOT_SCHEMA)


def written_keys(like: DataFrame, path: str, key: str = "article_key") -> DataFrame:
    """The keys in the files of a snapshot; none if there is no such folder."""
    spark = like.sparkSession
    schema = f"{key} string"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def topic_snapshot_refresh(articles: DataFrame, snapshot: DataFrame, key: str = "article_key",
                           client_factory: Callable[[], Client] = lambda: empty_client,
                           append_to: str | None = None, partitions: int | None = None) -> DataFrame:
    """Fetch topics for articles missing from the snapshot, at most
    ``partitions`` clients at a time, and append them (parquet) to
    ``append_to`` or to a table in the shared folder.  What ``append_to`` holds
    already is not fetched, whether ``snapshot`` shows it or not.  Null keys are
    left out.  Returns the fetched rows as written, so actions on them call no
    client again."""
    known = snapshot.select(F.col(key).cast("string").alias(key))
    if append_to:
        known = known.unionByName(written_keys(articles, append_to, key))
    wanted = materialize_table(missing_keys(articles.where(F.col(key).isNotNull()), known, key), "missing-topics")
    fetched = materialize_table(fetch_topics(wanted, client_factory, key, partitions=partitions), "fetched-topics")
    if append_to:
        fetched.write.mode("append").parquet(append_to)
    return fetched
