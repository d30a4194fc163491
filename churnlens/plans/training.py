"""End-to-end training of the churn models.

churn table -> feature table (one projection) -> K-means segments -> one
classifier per segment.  The feature table is checkpointed once (reliable
checkpoint in the cluster's checkpoint dir) because K-means and three
classifier fits each iterate over it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from churnlens.config import DEFAULT_SPEC, ChurnSpec
from churnlens.operators.merge import churn_table
from churnlens.plans.features import feature_columns, feature_table
from churnlens.plans.models import SEGMENTS, fit_segment_models, logistic
from churnlens.plans.segments import assign_segments, fit_segments
from churnlens.session import checkpoint_dir
from churnlens.sources.tables import data_version, event_log, stored_user_profiles


@dataclass
class ChurnModels:
    segment_model: PipelineModel
    models: dict[str, PipelineModel]
    features: list[str]
    data: DataFrame          # feature table with segment, checkpointed


def segmented_features(spark: SparkSession, sf_dir: str, spec: ChurnSpec = DEFAULT_SPEC,
                       segment_model: PipelineModel | None = None):
    """Feature table with ``segment``; fits the segment model when not given."""
    churn = churn_table(stored_user_profiles(spark, sf_dir), event_log(spark, sf_dir, spec), spec)
    checkpoint_dir(spark)
    ft = feature_table(churn, spec).checkpoint(eager=True)
    seg = segment_model or fit_segments(ft, seed=spec.seed)
    return seg, assign_segments(seg, ft)


def train_churn_models(spark: SparkSession, sf_dir: str, spec: ChurnSpec = DEFAULT_SPEC,
                       estimator_factory=logistic) -> ChurnModels:
    seg, data = segmented_features(spark, sf_dir, spec)
    feats = feature_columns(data, spec)
    models = fit_segment_models(data, feats, estimator_factory, SEGMENTS)
    return ChurnModels(seg, models, feats, data)


# Train once, score many: the fitted artefacts of one (session, data, spec) are
# kept for the life of the session, like models saved once and loaded by every
# scoring request.  Feature tables are reliable checkpoints, so reuse is safe
# after executor loss.
_MEMO: dict = {}


def _key(spark: SparkSession, *parts):
    """``parts`` holds the folder second: its files' state is part of the key."""
    sc = spark.sparkContext
    return (sc.applicationId, id(sc), *parts, data_version(spark, parts[1]))


def cached_segmented_features(spark: SparkSession, sf_dir: str, spec: ChurnSpec = DEFAULT_SPEC):
    k = _key(spark, "seg", sf_dir, spec)
    if k not in _MEMO:
        _MEMO[k] = segmented_features(spark, sf_dir, spec)
    return _MEMO[k]


def cached_churn_models(spark: SparkSession, sf_dir: str, spec: ChurnSpec = DEFAULT_SPEC) -> ChurnModels:
    k = _key(spark, "models", sf_dir, spec)
    if k not in _MEMO:
        seg, data = cached_segmented_features(spark, sf_dir, spec)
        feats = feature_columns(data, spec)
        _MEMO[k] = ChurnModels(seg, fit_segment_models(data, feats, logistic, SEGMENTS), feats, data)
    return _MEMO[k]


def memoized(spark: SparkSession, key: tuple, build):
    """Generic session-scoped memo for other fitted artefacts (e.g. BG/NBD)."""
    k = _key(spark, *key)
    if k not in _MEMO:
        _MEMO[k] = build()
    return _MEMO[k]
