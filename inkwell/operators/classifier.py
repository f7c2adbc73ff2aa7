"""Text classifiers (E7-E9, A8) with Spark ML.

Training is a distributed ``Pipeline``; the split is a repeatable hash rule
on the key (no ``rand()``); scoring a corpus is ``PipelineModel.transform``
over exploded fragments followed by a partial ``avg`` per article.  A
deterministic rule scorer (a Column function) stands in where no trained
model is wanted, and keeps the per-article mean in-row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import bind, explode_indexed, split_on_period


def split_bucket(key: Column) -> Column:
    """Repeatable 0..99 bucket of an integer key."""
    return ((key % 1000003) * 7919 + 13) % 100


def train_test_split(df: DataFrame, key: str, train_pct: int = 67) -> tuple[DataFrame, DataFrame]:
    b = split_bucket(F.col(key))
    return df.where(b < train_pct), df.where(b >= train_pct)


def text_pipeline(text: str = "text", label: str = "label", num_features: int = 1 << 14,
                  reg_param: float = 0.0, max_iter: int = 20) -> Pipeline:
    """Tokenise -> hashed term frequencies -> IDF -> linear SVM."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"[^\p{L}\p{N}]+", toLowercase=True),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="features"),
        LinearSVC(featuresCol="features", labelCol=label, regParam=reg_param, maxIter=max_iter),
    ])


def train_text_classifier(df: DataFrame, key: str, text: str, label: str, train_pct: int = 67,
                          max_rows: int | None = None, **pipeline_args
                          ) -> tuple[PipelineModel, DataFrame]:
    """Split, fit on the training side (on its ``max_rows`` lowest rows by
    hash bucket and key, if given), report ``split, n, accuracy`` over the
    fitted rows and the whole test side."""
    data = df.select(key, F.col(text).alias("text"), F.col(label).cast("double").alias("label"))
    train, test = train_test_split(data, key, train_pct)
    if max_rows is not None:
        train = train.orderBy(split_bucket(F.col(key)), key).limit(max_rows)
    model = text_pipeline("text", "label", **pipeline_args).fit(train)
    acc = classifier_report(model, train, test)
    return model, acc


def classifier_report(model: PipelineModel, train: DataFrame, test: DataFrame) -> DataFrame:
    def part(df, name):
        p = model.transform(df)
        return p.agg(F.count("*").alias("n"),
                     F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy")) \
            .select(F.lit(name).alias("split"), "n", "accuracy")
    return part(train, "train").unionByName(part(test, "test"))


def grid_search(df: DataFrame, key: str, text: str, label: str, reg_params: Sequence[float] = (0.01, 0.1),
                max_iters: Sequence[int] = (10,), folds: int = 2, parallelism: int = 2
                ) -> tuple[PipelineModel, DataFrame]:
    """Cross-validated search over regularisation and iterations.  Returns
    the best model, refit on the whole training side, and one row per grid
    point with its mean metric and a ``best`` flag."""
    data = df.select(key, F.col(text).alias("text"), F.col(label).cast("double").alias("label"))
    train, _ = train_test_split(data, key)
    pipe = text_pipeline("text", "label", num_features=1 << 12)
    svc = pipe.getStages()[-1]
    grid = ParamGridBuilder().addGrid(svc.regParam, list(reg_params)).addGrid(svc.maxIter, list(max_iters)).build()
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, numFolds=folds, parallelism=parallelism,
                        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"), seed=7)
    fitted = cv.fit(train)
    best = max(range(len(grid)), key=lambda i: fitted.avgMetrics[i])
    rows = [(float(g[svc.regParam]), int(g[svc.maxIter]), float(m), i == best)
            for i, (g, m) in enumerate(zip(grid, fitted.avgMetrics))]
    return fitted.bestModel, df.sparkSession.createDataFrame(rows, "reg_param double, max_iter int, accuracy double, best boolean")


# ---------------------------------------------------------------------------
# E8 per-article mean of fragment predictions
# ---------------------------------------------------------------------------
def rule_scorer(terms: Sequence[str]) -> Callable[[Column], Column]:
    """Fragment -> 1 if it contains any term (case-insensitive) else 0."""
    def score(fragment: Column) -> Column:
        low = F.lower(fragment)
        hit = F.lit(False)
        for t in terms:
            hit = hit | low.contains(t.lower())
        return F.when(hit, 1.0).otherwise(0.0)
    return score


def sarcasm_score(text: Column, scorer: Callable[[Column], Column]) -> Column:
    """In-row mean of fragment scores over the ``.``-split text."""
    return bind(F.transform(split_on_period(text), scorer),
                lambda preds: F.aggregate(preds, F.lit(0.0), lambda a, x: a + x) / F.size(preds))


def article_sarcasm(df: DataFrame, key: str, text: str, scorer: Callable[[Column], Column] | None = None,
                    model: PipelineModel | None = None, drop_blank: bool = False) -> DataFrame:
    """``.``-split fragments (blanks kept unless ``drop_blank``), one 0/1
    prediction each, article score = mean.  With a Column ``scorer`` the
    mean stays in-row; with a fitted ``model`` fragments are exploded,
    transformed and averaged per article (partial aggregation)."""
    frags = split_on_period(F.col(text))
    if drop_blank:
        frags = F.filter(frags, lambda s: F.trim(s) != "")
    base = df.where(F.col(text).isNotNull())
    if model is None:
        scorer = scorer or rule_scorer(["!"])
        preds = F.transform(frags, scorer)
        staged = base.select(key, preds.alias("_p"))
        return staged.select(key, F.size("_p").cast("long").alias("n_fragments"), (F.aggregate(
            "_p", F.lit(0.0), lambda a, x: a + x) / F.size("_p")).alias("sarcasm_score"))
    rows = explode_indexed(base, [key], frags, "frag_idx", "text")
    pred = model.transform(rows)
    return pred.groupBy(key).agg(F.count("*").alias("n_fragments"),
                                 F.avg("prediction").alias("sarcasm_score"))


def save_model(model: PipelineModel, path: str) -> None:
    """Persist (overwrite) a fitted pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
