"""E7, E9 on sentence vectors: random Fourier features and the SVM on them."""

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import functions as F

from inkwell.operators.kernel import FourierFeatures, KernelClassifier, kernel_grid_search, train_kernel_classifier

cloudpickle.register_pickle_by_value(sys.modules[__name__])      # workers cannot import this file


def plane():
    """Encodes texts ``x y`` as the vector (x, y)."""
    def encode(texts):
        import numpy
        return numpy.array([[float(v) for v in (t or "0 0").split()] for t in texts])
    return encode


def test_products_approximate_the_kernel():
    x = np.random.default_rng(0).standard_normal((30, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = FourierFeatures(0.8, n=20_000)(x)
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * 0.8 ** 2))
    assert np.abs(z @ z.T - want).max() < 0.05
    assert np.isfinite(FourierFeatures(1.0)(np.zeros((2, 8)))).all()


def _rings(spark):
    """Directions: every other sixth of the circle is positive, so no line through it tells them apart."""
    angle = F.col("id") * 0.37
    return spark.range(600).select("id", F.concat_ws(" ", F.cos(angle), F.sin(angle)).alias("t"),
                                   (F.floor(F.pmod(angle, F.lit(2 * np.pi)) / (np.pi / 3)) % 2).alias("y"))


def test_separates_what_no_line_does_and_reloads(spark, tmpdir_path):
    model, report = train_kernel_classifier(_rings(spark), "id", "t", "y", width=0.3, encoder_factory=plane)
    rows = {r["split"]: r for r in report.collect()}
    assert rows["test"]["accuracy"] > 0.9 > 0.6 > rows["test"]["majority"]
    assert rows["train"]["n"] + rows["test"]["n"] == 600
    model.save(spark, tmpdir_path)
    again = KernelClassifier.load(spark, tmpdir_path, plane)
    odd = spark.createDataFrame([(1, "1 0"), (2, None), (3, "0.2 0.9")], "id int, t string")
    assert [r["prediction"] for r in model.transform(odd, "t").orderBy("id").collect()] \
        == [r["prediction"] for r in again.transform(odd, "t").orderBy("id").collect()]
    assert model.transform(odd.limit(0), "t").count() == 0


def test_grid_prefers_the_fitting_width(spark):
    _model, grid, report = kernel_grid_search(_rings(spark), "id", "t", "y", widths=(0.3, 30.0), regs=(1e-4,),
                                              encoder_factory=plane)
    rows = {r["width"]: r for r in grid.collect()}
    assert rows[0.3]["best"] and not rows[30.0]["best"] and rows[0.3]["accuracy"] > rows[30.0]["accuracy"] + 0.2
    assert {r["split"] for r in report.collect()} == {"train", "test"}
