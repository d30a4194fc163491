"""Segment routing and linear scores as column expressions.

A fitted K-means and the segments' logistic regressions are a few numbers.
Read out of the models (or declared), they turn scoring into one projection:
no join, no second scan, no model transform per segment.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlens.functions.columns import log1p_scaled, row_sum


@dataclass(frozen=True)
class Linear:
    """One segment's logistic regression: intercept, weight per feature, threshold."""
    intercept: float
    weights: tuple[tuple[str, float], ...]
    threshold: float = 0.5

    def probability(self) -> Column:
        """P(active); null when a feature is null (F9: such rows are not scored)."""
        margin = row_sum([F.lit(self.intercept), *[F.col(f).cast("double") * F.lit(w) for f, w in self.weights]])
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


@dataclass(frozen=True)
class Centres:
    """Two K-means centres over scaled inputs; ``high`` is the index of the active one."""
    inputs: tuple[str, ...]
    points: tuple[tuple[float, ...], ...]

    @property
    def high(self) -> int:
        return max(range(len(self.points)), key=lambda i: (self.points[i][0], -i))

    def is_high(self, raw: bool = False) -> Column:
        """Whether the active centre is the nearest; null where an input is null.  ``raw``: inputs are not scaled yet."""
        cols = [log1p_scaled(c) if raw else F.col(c) for c in self.inputs]
        far = [row_sum([(c - F.lit(x)) * (c - F.lit(x)) for c, x in zip(cols, p)]) for p in self.points]
        nearest = F.lit(0)
        for i in range(1, len(far)):
            nearest = F.when(far[i] < F.least(*far[:i]) if i > 1 else far[i] < far[0], F.lit(i)).otherwise(nearest)
        known = row_sum([F.when(c.isNull(), 1).otherwise(0) for c in cols]) == 0
        return F.when(known, nearest == self.high)

    def segment(self, raw: bool = False) -> Column:
        """``company`` | ``high`` | ``low``; null where an input is null."""
        high = self.is_high(raw)
        return F.when(high.isNotNull(), F.when(F.col("company") == 1, "company").when(high, "high").otherwise("low"))


def linear_of(model: PipelineModel) -> Linear | None:
    """The numbers of an assembler + logistic regression pipeline; None for another classifier."""
    last = model.stages[-1]
    if not isinstance(last, LogisticRegressionModel):
        return None
    inputs = model.stages[0].getInputCols()
    return Linear(float(last.intercept), tuple(zip(inputs, map(float, last.coefficients))), float(last.getThreshold()))


def centres_of(model: PipelineModel) -> Centres:
    """The numbers of an assembler + K-means pipeline."""
    return Centres(tuple(model.stages[0].getInputCols()), tuple(tuple(map(float, c)) for c in model.stages[-1].clusterCenters()))


def inputs_of(models: Mapping[str, Linear]) -> list[str]:
    """The features of all models, each once, in the order in which they come up."""
    return list(dict.fromkeys(f for m in models.values() for f, _ in m.weights))


def _by_segment(models: Mapping[str, Linear], value, segment: str) -> Column:
    """One value per model, looked up by the row's segment; null without a model."""
    table = F.create_map(*[x for name, m in models.items() for x in (F.lit(name), value(m))])
    return F.try_element_at(table, F.col(segment))


def scorable(models: Mapping[str, Linear], segment: str = "segment") -> Column:
    """Whether the row has a model and all of that model's features (F9: other rows are not scored)."""
    every = inputs_of(models)
    shared = [f for f in every if all(f in dict(m.weights) for m in models.values())]
    cond = F.col(segment).isin(*models)
    for f in shared:
        cond = cond & F.col(f).isNotNull()
    for name, m in models.items():
        for f, _ in m.weights:
            if f not in shared:
                cond = cond & ((F.col(segment) != name) | F.col(f).isNotNull())
    return cond


def routed(models: Mapping[str, Linear], segment: str = "segment") -> Column:
    """P(active) by the model of the row's segment; null without one.

    Every feature stands in the expression once, whatever the number of
    models: the weights of the row's segment are one array, and the margin adds
    up its products from the intercept on.
    """
    every = inputs_of(models)
    weights = _by_segment(models, lambda m: F.array(*[F.lit(dict(m.weights).get(f)).cast("double") for f in every]), segment)
    values = F.array(*[F.col(f).cast("double") for f in every])
    products = F.zip_with(values, weights, lambda x, w: F.when(w.isNotNull(), x * w).otherwise(F.lit(0.0)))
    margin = F.aggregate(products, _by_segment(models, lambda m: F.lit(float(m.intercept)), segment), lambda total, x: total + x)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def routed_threshold(models: Mapping[str, Linear], segment: str = "segment") -> Column:
    return _by_segment(models, lambda m: F.lit(float(m.threshold)), segment)


def needed(models: Sequence[Linear]) -> list[str]:
    """The features that the models read."""
    return sorted({f for m in models for f, _ in m.weights})
