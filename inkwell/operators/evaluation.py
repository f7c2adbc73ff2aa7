"""Evaluation and profiling.

All metrics are conditional sums over one scored DataFrame: predictions are
computed once, thresholds (a bounded literal list) are attached in-row and
exploded, and the confusion counts are partial aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.config import THRESHOLD_SWEEP
from inkwell.operators.ranking import exact_quantiles, with_running_sums
from inkwell.session import materialize_table


def encode_labels(label: Column, mapping: Mapping[str, int] | None = None) -> Column:
    """G1: label string -> int (positive 1, negative 0 by default)."""
    mapping = mapping or {"positive": 1, "negative": 0}
    out = F.lit(None).cast("int")
    for k, v in mapping.items():
        out = F.when(label == k, F.lit(v)).otherwise(out)
    return out


def encode_score(score: Column) -> Column:
    """G1: score < 0 -> 0 else 1."""
    return F.when(score < 0, 0).otherwise(1)


def label_accuracy(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """``matches, n, accuracy_pct`` (accuracy over all rows, repeated)."""
    m = df.select((F.col(truth) == F.col(pred)).alias("matches"))
    counts = m.groupBy("matches").agg(F.count("*").alias("n"))
    # the window spans the (at most three) match groups
    everything = Window.partitionBy(F.lit(1))
    hits = F.sum(F.when(F.col("matches"), F.col("n")).otherwise(0)).over(everything)
    return counts.select("matches", "n", (hits * 100.0 / F.sum("n").over(everything)).alias("accuracy_pct"))


def profile(df: DataFrame, value: str, klass: str | None = None, approx: bool = True) -> DataFrame:
    """Class counts and descriptive statistics (count, mean, std, min,
    quartiles, max) as ``stat, value`` rows.  Quartiles come from a sketch of
    fixed size; ``approx=False`` selects and interpolates exactly, by running
    counts over ranges of the distinct values (jobs run when the plan is built);
    then values and classes are written once, so that ``df`` is computed once."""
    if not approx:
        df = materialize_table(df.select(*{value: None, **({klass: None} if klass else {})}), "profiled")
    v = F.col(value).cast("double")
    quartiles = [0.25, 0.5, 0.75]
    if approx:
        q1, q2, q3 = (F.percentile_approx(v, q, 100000).cast("double") for q in quartiles)
    else:
        q1, q2, q3 = (F.lit(x).cast("double") for x in exact_quantiles(df, value, quartiles))
    stats = df.agg(
        F.count(v).cast("double").alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), q1.alias("25%"), q2.alias("50%"), q3.alias("75%"), F.max(v).alias("max"))
    names = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    long = stats.select(F.explode(F.array(*[F.struct(F.lit(n).alias("stat"), F.col(f"`{n}`").alias("value"))
                                            for n in names])).alias("s")).select("s.stat", "s.value")
    if klass is None:
        return long
    classes = df.groupBy(klass).agg(F.count("*").cast("double").alias("value")) \
        .select(F.concat(F.lit("count_"), F.col(klass).cast("string")).alias("stat"), "value")
    return long.unionByName(classes)


def class_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, class, n`` for each listed column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("class")) for c in columns])
    return df.select(F.inline(pairs)).groupBy("column", "class").agg(F.count("*").alias("n"))


def classifier_accuracy(df: DataFrame, truth: str, pred: str, split: str) -> DataFrame:
    """``split, n, accuracy`` (train and test accuracy)."""
    return df.groupBy(split).agg(F.count("*").alias("n"),
                                 F.avg((F.col(truth) == F.col(pred)).cast("double")).alias("accuracy"))


def threshold_sweep(df: DataFrame, truth: str, prob: str,
                    thresholds: Sequence[float] = THRESHOLD_SWEEP) -> DataFrame:
    """For each threshold TN/FP/FN/TP, TPR, FPR of ``prob >= t`` against
    boolean ``truth``.  Missing classes give zero counts and null ratios."""
    ts = F.array(*[F.lit(float(t)) for t in thresholds])
    x = df.select(F.col(truth).cast("boolean").alias("_y"), F.col(prob).alias("_p")) \
        .select("_y", "_p", F.explode(ts).alias("threshold"))
    pred = F.col("_p") >= F.col("threshold")
    y = F.col("_y")

    def cnt(c):
        return F.sum(F.when(c, 1).otherwise(0)).cast("long")
    agg = x.groupBy("threshold").agg(cnt(~y & ~pred).alias("tn"), cnt(~y & pred).alias("fp"),
                                     cnt(y & ~pred).alias("fn"), cnt(y & pred).alias("tp"))
    # every threshold appears even on empty input
    grid = df.sparkSession.createDataFrame([(float(t),) for t in thresholds], "threshold double")
    out = F.broadcast(grid).join(agg, "threshold", "left").fillna(0, ["tn", "fp", "fn", "tp"])
    return out.select("threshold", "tn", "fp", "fn", "tp",
                      (F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))).alias("tpr"),
                      (F.col("fp") / F.nullif(F.col("tn") + F.col("fp"), F.lit(0))).alias("fpr"))


def roc_points(sweep: DataFrame) -> DataFrame:
    """Ordered (fpr, tpr) points plus the trapezoid area under the curve
    from (0, 0) through them to (1, 1) (the window spans the threshold grid, a
    bounded literal list)."""
    w = Window.orderBy(F.col("fpr"), F.col("tpr"), F.asc_nulls_first("threshold"))
    pts = sweep.select("threshold", "fpr", "tpr").where(F.col("fpr").isNotNull() & F.col("tpr").isNotNull())
    ends = sweep.sparkSession.createDataFrame([(None, 0.0, 0.0), (None, 1.0, 1.0)], "threshold double, fpr double, tpr double")
    seg = pts.unionByName(ends).select("*", ((F.col("fpr") - F.lag("fpr").over(w))
                                             * (F.col("tpr") + F.lag("tpr").over(w)) / 2.0).alias("_area"))
    auc = F.sum("_area").over(Window.partitionBy(F.lit(1)))
    return seg.select("threshold", "fpr", "tpr", auc.alias("auc")).where(F.col("threshold").isNotNull())


def roc_curve(df: DataFrame, truth: str, score: str) -> DataFrame:
    """G7 over every distinct score: ``threshold, tp, fp, tpr, fpr, auc`` of
    ``score >= threshold``, the highest threshold first.  Rows are counted per
    score, and the counts run over ranges of scores; the area is exact (the
    rank statistic, ties half).  Rows with a null are left out; a missing class
    gives null ratios and area."""
    y = F.col(truth).cast("boolean")
    counted = df.select(y.alias("_y"), F.col(score).cast("double").alias("threshold")) \
        .where("_y is not null and threshold is not null") \
        .groupBy("threshold").agg(F.count_if("_y").alias("_pos"), F.count_if(~F.col("_y")).alias("_neg"))
    run = with_running_sums(counted, [F.desc("threshold")], {"tp": "_pos", "fp": "_neg"})
    # trapezoids in half units: a step to the right under the middle of its rise
    area = F.sum(F.col("_neg").cast("decimal(19,0)") * (2 * F.col("tp") - F.col("_pos")).cast("decimal(19,0)"))
    pos, neg, halves = run.agg(F.sum("_pos"), F.sum("_neg"), area).first()
    auc = float(halves) / (2.0 * pos * neg) if pos and neg else None
    return run.select("threshold", "tp", "fp", (F.col("tp") / F.lit(pos or None).cast("long")).alias("tpr"),
                      (F.col("fp") / F.lit(neg or None).cast("long")).alias("fpr"),
                      F.lit(auc).cast("double").alias("auc"))


def sample_articles(df: DataFrame, key: str, n: int = 1, seed: str = "") -> DataFrame:
    """Repeatable sample of ``n`` rows ordered by ``md5(seed || key)``
    (a sampling operator: the limit is the feature)."""
    return df.orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), F.col(key)).limit(n)
