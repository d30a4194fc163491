"""Classifiers per segment (M9-M14, K3, K4) and curve metrics.

Model fitting is MLlib's distributed optimisation (executors compute
gradients, the driver updates a feature-sized vector).  Training data is
persisted before the iterative fit.  ROC/PR/AUC for any ``(score, label)``
table are exact: counts per distinct score, cumulated range by range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from churnlens.operators.sampling import key_hash
from churnlens.plans.features import assembler

SEGMENTS = ("company", "high", "low")


def logistic(max_iter: int = 50, reg: float = 0.03, weight_col: str | None = None,
             threshold: float = 0.5) -> LogisticRegression:
    """L2 logistic regression; optional class weights and threshold."""
    lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter,
                            regParam=reg, threshold=threshold)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


def gbt(max_iter: int = 50, seed: int = 1) -> GBTClassifier:
    """Gradient-boosted trees."""
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=max_iter, seed=seed)


def random_forest(num_trees: int = 20, seed: int = 1) -> RandomForestClassifier:
    """M11 (alternative): random forest."""
    return RandomForestClassifier(featuresCol="features", labelCol="label",
                                  numTrees=num_trees, seed=seed)


def fit_classifier(train: DataFrame, features: Sequence[str], estimator=None) -> PipelineModel:
    """M3+M9: assembler + estimator as one pipeline, fitted on ``train``."""
    est = estimator or logistic()
    data = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=[assembler(list(features)), est]).fit(data)
    finally:
        data.unpersist()


def fit_segment_models(data: DataFrame, features: Sequence[str], estimator_factory=logistic,
                       segments: Sequence[str] = SEGMENTS) -> dict[str, PipelineModel]:
    """One model per segment (the segment set is fixed and small).

    The fits are independent distributed jobs, submitted concurrently from
    driver threads so the cluster runs them side by side.
    """
    from concurrent.futures import ThreadPoolExecutor

    def fit(s):
        return s, fit_classifier(data.where(F.col("segment") == s), features, estimator_factory())

    with ThreadPoolExecutor(max_workers=max(1, len(segments))) as pool:
        return dict(pool.map(fit, segments))


def coefficient_table(spark: SparkSession, model: PipelineModel,
                      features: Sequence[str]) -> DataFrame:
    """Feature -> weight (LR coefficients or tree importances), by weight desc."""
    m = model.stages[-1]
    vals = (m.coefficients.toArray() if hasattr(m, "coefficients")
            else m.featureImportances.toArray())
    rows = [(f, float(v)) for f, v in zip(features, vals)]
    return (spark.createDataFrame(rows, "feature string, weight double")
            .orderBy(F.desc("weight"), F.col("feature")))


# The grids searched by the reference (elasticNet x regParam x maxIter).
GRID_FULL = {"elasticNetParam": [0.0, 0.8, 0.08], "regParam": [0.0, 0.3, 0.003], "maxIter": [50, 100]}
GRID_BALANCED = {"elasticNetParam": [0.0, 0.8, 0.08], "regParam": [0.3, 0.03], "maxIter": [50, 100]}


def cross_validate(train: DataFrame, features: Sequence[str], grid: str = "full",
                   folds: int = 5, seed: int = 2018, key: str = "login", threads: int = 4):
    """K-fold CV by area under ROC; returns (best PipelineModel, avg metrics).

    ``grid``: "full" (18 candidates, plain LR), "balanced" (12 candidates,
    class-weighted LR, needs ``class_weight``) or "none" (weighted LR,
    maxIter 150, empty grid: 5-fold estimate of one setting).

    Vectors are assembled and stored once.  A row's fold depends on its key
    and the seed only.  Fits run side by side in a few driver threads, each
    with local properties of its own.
    """
    from concurrent.futures import ThreadPoolExecutor
    if grid == "full":
        lr, values = logistic(), GRID_FULL
    elif grid == "balanced":
        lr, values = logistic(weight_col="class_weight"), GRID_BALANCED
    else:
        lr, values = logistic(max_iter=150, weight_col="class_weight"), {}
    pb = ParamGridBuilder()
    for name, vals in values.items():
        pb = pb.addGrid(lr.getParam(name), vals)
    maps = pb.build()
    vectors = assembler(list(features))
    weight = ["class_weight"] if grid != "full" else []
    fold = F.pmod(key_hash(key, seed), F.lit(folds)).cast("int")
    data = vectors.transform(train).select("features", "label", *weight, fold.alias("fold"))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    judge = BinaryClassificationEvaluator(labelCol="label")

    def one(job):
        held, params = job
        model = lr.copy(params).fit(data.where(F.col("fold") != held))
        return judge.evaluate(model.transform(data.where(F.col("fold") == held)))

    try:
        data.count()
        with ThreadPoolExecutor(max_workers=threads) as pool:
            found = list(pool.map(one, [(h, m) for m in maps for h in range(folds)]))
        metrics = [sum(found[i * folds:(i + 1) * folds]) / folds for i in range(len(maps))]
        best = lr.copy(maps[max(range(len(maps)), key=lambda i: metrics[i])]).fit(data)
    finally:
        data.unpersist()
    return PipelineModel(stages=[vectors, best]), metrics


# ------------------------------------------------------------------ curves

# Ranges of scores that the curve is cumulated in; each is a task of its own.
_RANGES = 64


def _cumulated(df: DataFrame, score: str | Column, label: str | Column, by: Sequence[str] = ()) -> DataFrame:
    """(*by, threshold, pos, neg, tp, fp, P, N) per distinct score of each group, exact.

    Rows are counted per distinct score first.  Distinct scores are cut into
    ranges at approximate quantiles, the same for all groups; counts are
    cumulated inside each range of a group, and the totals of the group's
    ranges above (at most ``_RANGES`` rows a group) are added.  So no window
    holds a whole group.  Null scores are left out; a null group is a group.
    """
    s = (F.col(score) if isinstance(score, str) else score).cast("double")
    y = F.col(label) if isinstance(label, str) else label
    counts = df.groupBy(*by, s.alias("threshold")).agg(
        F.count(F.when(y == 1, 1)).alias("pos"), F.count(F.when(y != 1, 1)).alias("neg")).where("threshold IS NOT NULL")
    cuts = counts.approxQuantile("threshold", [i / _RANGES for i in range(1, _RANGES)], 1 / (4 * _RANGES))
    cuts = sorted(set(cuts)) or [0.0]
    above = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c > F.col("threshold")))
    counts = counts.withColumn("range", above)
    total = counts.groupBy(*by, "range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    before = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # at most _RANGES rows
    whole = Window.partitionBy(*by)
    first = total.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("range").alias("__range"),
                         F.coalesce(F.sum("p").over(before), F.lit(0)).alias("p0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
                         F.sum("p").over(whole).alias("P"), F.sum("n").over(whole).alias("N"))
    inside = Window.partitionBy(*by, "range").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    match = F.col("range") == F.col("__range")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"__{c}"))
    ran = counts.withColumns({"tp": F.sum("pos").over(inside), "fp": F.sum("neg").over(inside)})
    return ran.join(first if by else F.broadcast(first), match).select(
        *by, "threshold", "pos", "neg", (F.col("p0") + F.col("tp")).alias("tp"), (F.col("n0") + F.col("fp")).alias("fp"), "P", "N")


def roc_curve(df: DataFrame, score: str | Column = "p_active", label: str | Column = "label", by: Sequence[str] = ()) -> DataFrame:
    """ROC points (*by, threshold, fpr, tpr), one per distinct score, and
    the start point (infinity, 0, 0) of each group."""
    points = _cumulated(df, score, label, by).select(
        *by, "threshold", F.try_divide(F.col("fp").cast("double"), F.col("N")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("P")).alias("tpr"))
    if by:
        start = points.select(*by).distinct().select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    else:
        start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], points.schema)
    return start.unionByName(points)


def pr_curve(df: DataFrame, score: str | Column = "p_active", label: str | Column = "label", by: Sequence[str] = ()) -> DataFrame:
    """(*by, threshold, recall, precision), one point per distinct score."""
    tp, fp = F.col("tp").cast("double"), F.col("fp")
    return _cumulated(df, score, label, by).select(*by, "threshold", F.try_divide(tp, F.col("P")).alias("recall"),
                                                   F.try_divide(tp, tp + fp).alias("precision"))


def auc(df: DataFrame, score: str | Column = "p_active", label: str | Column = "label", by: Sequence[str] = ()) -> DataFrame:
    """Exact area under ROC (trapezoids, ties as one step) and under PR, of each group if ``by`` is given."""
    tp, pos, neg = F.col("tp").cast("double"), F.col("pos").cast("double"), F.col("neg").cast("double")
    areas = [F.sum(F.try_divide(neg, F.col("N")) * F.try_divide(2 * tp - pos, 2 * F.col("P"))).alias("auc_roc"),
             F.sum(F.try_divide(pos, F.col("P")) * F.try_divide(tp, tp + F.col("fp"))).alias("auc_pr")]
    points = _cumulated(df, score, label, by)
    return points.groupBy(*by).agg(*areas) if by else points.agg(*areas)
