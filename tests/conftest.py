import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("inkwell-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="inkwell-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="inkwell-test-")


def article_row(uri=None, headline=None, short=None, summary=None, blocks=None, about=None,
                last_published=None, timestamp=None, last_updated=None, first_published=None,
                content_warning=None, breaking=None, oppm=None, ad=None, key="k"):
    """One F1 row as nested tuples (None for missing)."""
    return (key,
            ((uri,), last_updated, first_published, last_published, timestamp, ad, oppm,
             (content_warning, breaking), (about,)),
            ((headline, short), summary),
            (blocks,))


def articles_df(spark, rows):
    from pyspark.sql import types as T
    from inkwell.schema import ARTICLE
    schema = T.StructType([T.StructField("article_key", T.StringType())] + ARTICLE.fields)
    return spark.createDataFrame(rows, schema)
