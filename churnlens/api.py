"""End-to-end calls for users coming from the reference's notebooks and app.

    spec   = ChurnSpec()                      # or ChurnSpec.for_year(2016)
    churn  = build_churn_table(spark, users, events, spec)
    models = train(spark, churn, spec)
    scored = score(models, churn, spec)
    report = repo_report(scored, contributors, "Brand#13")      # at-risk top 25 + histogram
    whatif = user_whatif(models, churn, login=42, spec=spec)      # 5 scenarios for one user

Everything stays a DataFrame; the per-repo / per-user calls are filters on
the all-repos / all-users jobs, so a serving layer can also precompute them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.config import DEFAULT_SPEC, ChurnSpec
from churnlens.operators.activity import user_activity
from churnlens.operators.merge import churn_table, merge_profiles
from churnlens.plans.features import feature_columns, feature_table
from churnlens.plans.models import SEGMENTS, fit_segment_models, logistic
from churnlens.plans.scoring import (at_risk_report, probability_histogram, score_by_segment,
                                     whatif_scores)
from churnlens.plans.segments import assign_segments, fit_segments
from churnlens.session import checkpoint_dir


@dataclass
class TrainedModels:
    segment_model: PipelineModel
    models: dict[str, PipelineModel]
    features: list[str]

    def save(self, path: str) -> None:
        """K3: every model under ``path`` (overwriting)."""
        self.segment_model.write().overwrite().save(f"{path}/segments")
        for seg, m in self.models.items():
            m.write().overwrite().save(f"{path}/model_{seg}")

    @classmethod
    def load(cls, path: str, features: list[str], segments=SEGMENTS) -> "TrainedModels":
        """K4: models saved by :meth:`save`."""
        return cls(PipelineModel.load(f"{path}/segments"),
                   {s: PipelineModel.load(f"{path}/model_{s}") for s in segments}, features)


def build_churn_table(spark: SparkSession, users: DataFrame, events: DataFrame,
                      spec: ChurnSpec = DEFAULT_SPEC, keep_inactive: bool = False,
                      public_only: bool = True) -> DataFrame:
    """Users (login, profile fields) and an event log (actor, type,
    created_at, public) -> the merged churn table."""
    return churn_table(users, events, spec, keep_inactive=keep_inactive, public_only=public_only)


def train(spark: SparkSession, churn: DataFrame, spec: ChurnSpec = DEFAULT_SPEC,
          estimator_factory=logistic) -> TrainedModels:
    """Segment model + one classifier per segment, on a checkpointed feature table."""
    checkpoint_dir(spark)
    ft = feature_table(churn, spec).checkpoint(eager=True)
    seg = fit_segments(ft, seed=spec.seed)
    data = assign_segments(seg, ft)
    feats = feature_columns(data, spec)
    return TrainedModels(seg, fit_segment_models(data, feats, estimator_factory), feats)


def score(models: TrainedModels, churn: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """(login, segment, p_active, prediction, verdict) for every user."""
    data = assign_segments(models.segment_model, feature_table(churn, spec))
    return score_by_segment(models.models, data)


def repo_report(scored: DataFrame, contributors: DataFrame, repo: str, k: int = 25):
    """M16 for one repo: (at-risk top k, 10-bin probability histogram)."""
    mine = contributors.where(F.col("repo") == repo)
    return at_risk_report(scored, mine, k), probability_histogram(scored, mine, 10)


def live_user(users: DataFrame, events: DataFrame, login, spec: ChurnSpec = DEFAULT_SPEC, fill_ts=None,
              public_only: bool = True) -> DataFrame:
    """One user's profile with its activity as of now (the whole log),
    missing parts filled: a row of the serving table."""
    mine = users.where(F.col("login") == F.lit(login))
    now = user_activity(events, login, spec, public_only=public_only)
    counts = [F.coalesce(F.col(c), F.lit(0)) for c in spec.count_columns]
    row = now.select(F.lit(login).alias("actor"), "event_count", "last_event", "first_event",
                     *[c.alias(n) for c, n in zip(counts, spec.count_columns)], F.lit(0).cast("long").alias("second_period_event_count"))
    return merge_profiles(mine, row, spec, keep_inactive=True, fill_ts=fill_ts)


def live_user_whatif(models: TrainedModels, users: DataFrame, events: DataFrame, login,
                     spec: ChurnSpec = DEFAULT_SPEC, fill_ts=None) -> DataFrame:
    """M17 for one live user: profile, activity, routing and the five scenarios."""
    return whatif_scores(models.models, models.segment_model, live_user(users, events, login, spec, fill_ts), spec)


def user_whatif(models: TrainedModels, churn: DataFrame, login, spec: ChurnSpec = DEFAULT_SPEC):
    """M17 for one user: P(active) now and after each suggested change."""
    one = churn.where(F.col("login") == F.lit(login))
    return whatif_scores(models.models, models.segment_model, one, spec)
