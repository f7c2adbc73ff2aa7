"""Small document tables for the operator tests."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                          T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                          T.StructField("n_chars", T.LongType())])


def documents(spark, rows, **extra):
    """rows: (doc_id, text) or (doc_id, text, lang) or (doc_id, text, lang, source); extra: a string column each."""
    full = [tuple([*r, *[None] * (4 - len(r))]) + (None if r[1] is None else len(r[1]),) for r in rows]
    df = spark.createDataFrame(full, DOCUMENTS)
    from pyspark.sql import functions as F
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def save(spark, folder, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
