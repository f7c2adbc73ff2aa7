"""E7, E9 on sentence vectors: a Gaussian-kernel SVM by random Fourier features.

Texts are encoded once (``encode_texts``) and written.  A unit vector ``x``
becomes ``sqrt(2 / n) cos(W x + b)``, whose products approximate
``exp(-|x - y|^2 / (2 width^2))``, so a linear SVM on these columns, which Spark
ML fits over the partitions, is a kernel SVM whose size is the number of columns
and not that of the data.  ``W`` and ``b`` follow from a seed: each task draws
them again.  Rows with a null label train nothing; a null text is an empty one."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.operators.classifier import split_bucket, train_test_split
from inkwell.operators.embeddings import HashingEncoder, encode_texts
from inkwell.session import materialize_table, ship_package

EncoderFactory = Callable[[], Callable[[list[str]], np.ndarray]]


@dataclass(frozen=True)
class FourierFeatures:
    """``n`` random features of a Gaussian kernel of a width."""
    width: float
    n: int = 256
    seed: int = 7

    def __call__(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        w = rng.standard_normal((x.shape[1], self.n)) / self.width
        length = np.linalg.norm(x, axis=1, keepdims=True)
        return np.sqrt(2 / self.n) * np.cos(x / np.where(length > 0, length, 1) @ w + rng.uniform(0, 2 * np.pi, self.n))

    def attach(self, df: DataFrame, vector: str, out: str) -> DataFrame:
        ship_package(df.sparkSession)

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def mapped(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for s in batches:
                yield pd.Series(list(self(np.stack(s.to_list()))) if len(s) else [], dtype=object)
        return df.withColumn(out, array_to_vector(mapped(F.col(vector))))


@dataclass
class KernelClassifier:
    features: FourierFeatures
    svm: LinearSVCModel
    encoder_factory: EncoderFactory = HashingEncoder

    def transform_vectors(self, df: DataFrame, vector: str) -> DataFrame:
        return self.svm.transform(self.features.attach(df, vector, "_features")).drop("_features")

    def transform(self, df: DataFrame, text: str = "text") -> DataFrame:
        """``df`` with ``prediction`` (and the SVM's ``rawPrediction``)."""
        return self.transform_vectors(encode_texts(df, text, "_vector", self.encoder_factory), "_vector").drop("_vector")

    def save(self, spark: SparkSession, path: str) -> None:
        self.svm.write().overwrite().save(f"{path}/svm")
        spark.createDataFrame([(json.dumps(asdict(self.features)),)], "value string") \
            .coalesce(1).write.mode("overwrite").text(f"{path}/features")

    @classmethod
    def load(cls, spark: SparkSession, path: str, encoder_factory: EncoderFactory = HashingEncoder) -> KernelClassifier:
        features = FourierFeatures(**json.loads(spark.read.text(f"{path}/features").first()[0]))
        return cls(features, LinearSVCModel.load(f"{path}/svm"), encoder_factory)


def _fit(rows: DataFrame, features: FourierFeatures, reg: float, encoder_factory: EncoderFactory,
         max_iter: int) -> KernelClassifier:
    svm = LinearSVC(featuresCol="_features", labelCol="label", regParam=reg, maxIter=max_iter)
    return KernelClassifier(features, svm.fit(features.attach(rows, "vector", "_features")), encoder_factory)


def encoded(df: DataFrame, key: str, text: str, label: str, encoder_factory: EncoderFactory) -> DataFrame:
    """``key, label, vector`` of the labelled rows, written."""
    rows = df.where(F.col(label).isNotNull()).select(key, F.col(label).cast("double").alias("label"), F.col(text).alias("_t"))
    return materialize_table(encode_texts(rows, "_t", "vector", encoder_factory).drop("_t"), "encoded-labels")


def report(model: KernelClassifier, rows: DataFrame, split: str) -> DataFrame:
    """``split, n, accuracy, majority``: the share of right predictions beside
    that of the commoner class."""
    positive = F.avg((F.col("label") == 1).cast("double"))
    return model.transform_vectors(rows, "vector").agg(
        F.lit(split).alias("split"), F.count("*").alias("n"),
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
        F.greatest(positive, 1 - positive).alias("majority"))


def train_kernel_classifier(df: DataFrame, key: str, text: str, label: str, width: float = 1.0, reg: float = 1e-4,
                            n_features: int = 256, train_pct: int = 67, max_iter: int = 20,
                            encoder_factory: EncoderFactory = HashingEncoder) -> tuple[KernelClassifier, DataFrame]:
    """Fit on the training side, report both sides."""
    train, test = train_test_split(encoded(df, key, text, label, encoder_factory), key, train_pct)
    model = _fit(train, FourierFeatures(width, n_features), reg, encoder_factory, max_iter)
    return model, report(model, train, "train").unionByName(report(model, test, "test"))


def kernel_grid_search(df: DataFrame, key: str, text: str, label: str, widths: Sequence[float] = (0.5, 2.0),
                       regs: Sequence[float] = (1e-4, 1e-2), folds: int = 2, n_features: int = 256,
                       train_pct: int = 67, max_iter: int = 20, encoder_factory: EncoderFactory = HashingEncoder
                       ) -> tuple[KernelClassifier, DataFrame, DataFrame]:
    """Cross-validation over kernel width and regularisation on the training
    side, in folds by key.  Returns the best point's model, refit on the whole
    training side, ``width, reg, accuracy, best`` for every point (a tie goes to
    the first), and the report of the best on both sides.  The grid is a
    parameter; its points are fitted one after the other."""
    train, test = train_test_split(encoded(df, key, text, label, encoder_factory), key, train_pct)
    fold = split_bucket(F.col(key)) % folds
    points = [(w, r) for w in widths for r in regs]
    means = []
    for w, r in points:
        right = n = 0
        for k in range(folds):
            held = train.where(fold == k)
            model = _fit(train.where(fold != k), FourierFeatures(w, n_features), r, encoder_factory, max_iter)
            row = model.transform_vectors(held, "vector").agg(
                F.count_if(F.col("prediction") == F.col("label")), F.count("*")).first()
            right, n = right + row[0], n + row[1]
        means.append(right / max(n, 1))
    best = max(range(len(points)), key=lambda i: means[i])
    model = _fit(train, FourierFeatures(points[best][0], n_features), points[best][1], encoder_factory, max_iter)
    grid = df.sparkSession.createDataFrame(
        [(float(w), float(r), float(m), i == best) for i, ((w, r), m) in enumerate(zip(points, means))],
        "width double, reg double, accuracy double, best boolean")
    return model, grid, report(model, train, "train").unionByName(report(model, test, "test"))
