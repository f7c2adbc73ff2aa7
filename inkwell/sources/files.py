"""A3-A5: line-delimited JSON, labelled CSV, word-vector tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.schema import WORD_VECTORS


def scan_ndjson(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A3: one JSON object per line, declared schema."""
    return spark.read.schema(schema).json(path)


def parse_ndjson_column(col: Column, schema: T.StructType | str) -> Column:
    """A3 for JSON text already in a column."""
    return F.from_json(col, schema)


CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A4: labelled CSV with a header; quoted fields may span lines and
    double their quotes (RFC 4180)."""
    reader = spark.read.options(**CSV_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def scan_word_vectors(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A5: ``term, count, vector``.  ``fmt='parquet'`` reads the F6 table;
    ``fmt='word2vec'`` reads word2vec *text* files (header ``N D`` then
    ``term v1 .. vD`` per line; no counts, so ``count`` is null).  The header
    is the line whose N is the number of the other lines; with its D, terms may
    hold spaces and vectors may have one dimension."""
    if fmt == "parquet":
        return spark.read.schema(WORD_VECTORS).parquet(path)
    if fmt != "word2vec":
        raise ValueError(fmt)
    lines = spark.read.text(path).select(F.trim("value").alias("line")).where("line <> ''")
    n = max(lines.count() - 1, 0)
    header = lines.where(F.col("line").rlike(f"^{n} [0-9]+$")).first()
    if header is None:
        raise ValueError(f"{path} has no header line for its {n} vectors")
    d = int(header["line"].split(" ")[1])
    body = lines.where(F.col("line") != header["line"]).select(F.split("line", " +").alias("p"))
    return body.select(F.array_join(F.slice("p", F.lit(1), F.size("p") - d), " ").alias("term"),
                       F.lit(None).cast("long").alias("count"),
                       F.transform(F.slice("p", F.size("p") - (d - 1), F.lit(d)), lambda x: x.cast("float")).alias("vector"))


def write_word2vec_text(df: DataFrame, path: str, term: str = "term", vector: str = "vector") -> None:
    """Write ``term v1 .. vD`` lines plus the ``N D`` header (the header is
    written as its own file; readers take every file of the folder)."""
    lines = df.select(F.concat_ws(" ", F.col(term), F.array_join(
        F.transform(vector, lambda x: x.cast("string")), " ")).alias("value"))
    lines.write.mode("overwrite").text(path)
    stats = df.agg(F.count("*").alias("n"), F.max(F.size(vector)).alias("d"))
    stats.select(F.concat_ws(" ", F.col("n").cast("string"), F.col("d").cast("string")).alias("value")) \
        .write.mode("append").text(path)
