"""A1/A2: article JSON corpora.

One JSON document per file (no extension needed), read recursively with the
declared F1 schema so the reader skips every other field; the file path is
the document key.  Files on a path that all executors open are listed and read by
tasks (``small_files``); Spark's reader lists those of other file systems, and files
of JSON lines, on the driver.  For large corpora of small files, compact once to
parquet after the first scan: listing, not parsing, dominates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.functions.text import explode_indexed
from inkwell.schema import ARTICLE
from inkwell.sources.small_files import TASKS, list_files, local_roots, read_small

#: A scan by Spark's reader with more tasks than ``TASKS`` has up to ``FILE_GROUPS``
#: times fewer: Spark packs about 30 small files into a partition.
FILE_GROUPS = 32


def scan_articles(spark: SparkSession, path: str | list[str], schema: T.StructType = ARTICLE,
                  multi_line: bool = True, path_glob: str | None = None) -> DataFrame:
    """A1: ``path_key`` (full file path), ``file_name`` and the F1 columns.

    ``multi_line=True`` reads one document per file; ``False`` reads JSON
    lines (one document per line)."""
    roots = local_roots(spark, path) if multi_line else None
    if roots is None:
        return _scan_listed_by_driver(spark, path, schema, multi_line, path_glob)
    listed = list_files(spark, roots)
    if path_glob:
        name = spark._jvm.org.apache.hadoop.fs.GlobPattern(path_glob).compiled().pattern()
        listed = listed.where(F.substring_index("path", "/", -1).rlike(rf"(?s)\A(?:{name})\z"))
    contents, large = read_small(listed)
    parsed = contents.withColumn("_rows", F.from_json("content", T.ArrayType(schema)))
    # a document is one row, one that cannot be read a row of nulls, an array a row per element
    rows = F.when(F.exists("_rows", lambda r: r.isNull()), None).otherwise(F.col("_rows"))
    rows = F.coalesce(rows, F.array(F.lit(None).cast(schema)))
    found = explode_indexed(parsed, ["path_key", "file_name"], rows, "_i", "_row") \
        .select("path_key", "file_name", *[F.col("_row")[f.name].alias(f.name) for f in schema.fields])
    return found.unionByName(_scan_listed_by_driver(spark, large, schema, multi_line, path_glob)) if large else found


def _scan_listed_by_driver(spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool,
                           path_glob: str | None) -> DataFrame:
    reader = spark.read.schema(schema).option("multiLine", multi_line) \
        .option("recursiveFileLookup", True).option("mode", "PERMISSIVE")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    df = reader.json(path)
    found = df.select(F.col("_metadata.file_path").alias("path_key"),
                      F.col("_metadata.file_name").alias("file_name"), *[F.col(f.name) for f in schema.fields])
    n = found.rdd.getNumPartitions()
    return found.coalesce(max(TASKS, -(-n // FILE_GROUPS))) if n > TASKS else found


def _ci_glob(suffix: str) -> str:
    """Case-insensitive glob for a suffix: ``.json`` -> ``*.[jJ][sS][oO][nN]``."""
    out = []
    for ch in suffix:
        out.append(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch)
    return "*" + "".join(out)


def scan_articles_filtered(spark: SparkSession, path: str, extension_filter: str = "",
                           limit: int | None = None, schema: T.StructType = ARTICLE,
                           multi_line: bool = True) -> DataFrame:
    """A2: same as A1 restricted to files whose name ends with
    ``extension_filter`` (case-insensitive) and, when ``limit`` is given, to
    the first ``limit`` files in path order (deterministic)."""
    glob = _ci_glob(extension_filter) if extension_filter else None
    if limit is None:
        return scan_articles(spark, path, schema, multi_line, glob)
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        listing = listing.option("pathGlobFilter", glob)
    # the listing alone: no file is opened for its path
    files = [r["path"] for r in listing.load(path).select("path").orderBy("path").limit(limit).collect()]
    return scan_articles(spark, files, schema, multi_line, glob)
