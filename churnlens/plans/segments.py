"""User segmentation.

K-means (k=2) on two scaled activity features of non-company users.  The
cluster index is relabelled so ``high_low_user = 1`` is always the cluster
with the larger first-feature centre (the index Spark assigns is arbitrary).
Segment = ``company`` | ``high`` | ``low``; scoring routes on it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.plans.features import assembler, segment_inputs
from churnlens.plans.routing import Centres, centres_of


def fit_segments(features: DataFrame, k: int = 2, seed: int = 1, original: bool = False,
                 max_iter: int = 20) -> PipelineModel:
    """M4: fit assembler + K-means on non-company users."""
    train = features.where(F.col("company") == 0)
    stages = [assembler(segment_inputs(original), "KMeans_features"),
              KMeans(featuresCol="KMeans_features", predictionCol="cluster", k=k, seed=seed,
                     maxIter=max_iter)]
    return Pipeline(stages=stages).fit(train)


def cluster_summary(model: PipelineModel) -> dict:
    """Centres and within-set cost (WSSSE) of a fitted segment model."""
    km = model.stages[-1]
    return {"centers": [list(map(float, c)) for c in km.clusterCenters()],
            "wssse": float(km.summary.trainingCost)}


def assign_segments(model: PipelineModel | Centres, features: DataFrame) -> DataFrame:
    """M5: add ``high_low_user`` (1 = high activity) and ``segment``; rows with
    a null input are skipped (F9)."""
    centres = model if isinstance(model, Centres) else centres_of(model)
    out = features.withColumns({"high_low_user": centres.is_high().cast("int"), "segment": centres.segment()})
    return out.where("segment IS NOT NULL")


# ------------------------------------------------------------------ weighted Lloyd (M4)

_UNITS = 10 ** 9  # coordinates are kept in billionths, so that their sums are exact in any order


@dataclass(frozen=True)
class Clusters:
    """Centres after some rounds of Lloyd's algorithm, the weight of each, and the within-set cost of the last assignment."""
    centres: Centres
    sizes: tuple[int, ...]
    cost: float
    rounds: int


def compressed_points(features: DataFrame, inputs: Sequence[str], where: Column | None = None) -> DataFrame:
    """(u0, u1, ..., weight): the distinct points of the inputs in units of 1 / ``_UNITS``, with their number of rows.

    Activity counts and days repeat: there are far fewer points than users.
    Rows with a null input are skipped (F9).
    """
    rows = features if where is None else features.where(where)
    units = [F.round(F.col(c).cast("double") * _UNITS).cast("long").alias(f"u{i}") for i, c in enumerate(inputs)]
    return rows.select(*units).na.drop().groupBy(*[f"u{i}" for i in range(len(inputs))]).agg(F.count(F.lit(1)).alias("weight"))


def weighted_lloyd(points: DataFrame, inputs: Sequence[str], start: Sequence[Sequence[float]], rounds: int = 20, until_stable: bool = True) -> Clusters:
    """M4: K-means over weighted points from declared centres, one aggregation a round.

    Sums are exact integers, so the centres depend neither on partitions nor on
    the order of rows.  Ties go to the first centre; a centre without points
    stays where it is.  Only the centres come to the driver.
    """
    k, d = len(start), len(inputs)
    at = [tuple(map(float, p)) for p in start]
    done, sizes, cost = 0, (0,) * k, 0.0

    def assigned(at) -> DataFrame:
        far = [sum(((F.col(f"u{i}") / F.lit(float(_UNITS)) - F.lit(p[i])) * (F.col(f"u{i}") / F.lit(float(_UNITS)) - F.lit(p[i])) for i in range(d)),
                   F.lit(0.0)) for p in at]
        nearest, best = F.lit(0), far[0]
        for i in range(1, k):
            nearest, best = F.when(far[i] < best, F.lit(i)).otherwise(nearest), F.least(far[i], best)
        return points.select("*", nearest.alias("cluster"), best.alias("far"))

    for done in range(1, rounds + 1):
        sums = [F.sum(F.col(f"u{i}").cast("decimal(38,0)") * F.col("weight")).alias(f"s{i}") for i in range(d)]
        got = {r["cluster"]: r for r in assigned(at).groupBy("cluster").agg(F.sum("weight").alias("n"), *sums).collect()}  # k rows
        new = [tuple(float(got[c][f"s{i}"]) / (float(got[c]["n"]) * _UNITS) for i in range(d)) if c in got else at[c] for c in range(k)]
        stable, at = new == at, new
        if stable and until_stable:
            break
    for r in assigned(at).groupBy("cluster").agg(F.sum("weight").alias("n"), F.sum(F.col("far") * F.col("weight")).alias("cost")).collect():
        sizes = tuple(int(r["n"]) if c == r["cluster"] else s for c, s in enumerate(sizes))
        cost += r["cost"]
    return Clusters(Centres(tuple(inputs), tuple(at)), sizes, cost, done)
