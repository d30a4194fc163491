"""Segment-routed scoring, reports and what-if analysis.

Routing and linear scores are column expressions (``plans.routing``).  Reports for every
repo are computed at once (grouped histogram, skew-safe per-repo top-k)
instead of one job per repo.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.config import DEFAULT_SPEC, ChurnSpec
from churnlens.functions.columns import vector_element, verdict
from churnlens.operators.ranking import top_k_per_group
from churnlens.operators.stats import bin_index
from churnlens.plans.features import feature_table
from churnlens.plans.routing import Centres, Linear, centres_of, linear_of, routed, routed_threshold, scorable


def score_by_segment(models: Mapping[str, PipelineModel | Linear], data: DataFrame,
                     keep: Sequence[str] = ("login",)) -> DataFrame:
    """Route each row to its segment's model; p_active = P(label = 1).

    Logistic regressions (fitted, or declared as :class:`Linear`) are one
    projection; other classifiers are transformed segment by segment.
    """
    linear = {s: m if isinstance(m, Linear) else linear_of(m) for s, m in models.items()}
    if all(m is not None for m in linear.values()):
        # Rows are left out by their inputs: a test of the probability would carry its whole expression into the filter.
        scored = data.where(scorable(linear)).select(*keep, "segment", routed(linear).alias("p_active"), routed_threshold(linear).alias("__t"))
        return scored.select(*keep, "segment", "p_active", (F.col("p_active") > F.col("__t")).cast("int").alias("prediction"),
                          verdict("p_active").alias("verdict"))
    parts = []
    for seg, model in models.items():
        scored = model.transform(data.where(F.col("segment") == seg))
        parts.append(scored.select(
            *keep, "segment",
            vector_element("probability", 1).alias("p_active"),
            F.col("prediction").cast("int").alias("prediction")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("verdict", verdict("p_active"))


def at_risk_report(scored: DataFrame, contributors: DataFrame, k: int = 25) -> DataFrame:
    """Per repo, the k contributors least likely to stay active.

    Ties broken by login; probability rounded to 4 decimals for display only
    after ranking.
    """
    j = contributors.join(scored, "login")
    top = top_k_per_group(j, ["repo"], [F.col("p_active").asc(), F.col("login").asc()], k,
                          salt_key="login")
    return top.select("repo", "rank", "login", "segment",
                      F.round("p_active", 4).alias("probability"), "repo_contributions_count")


def probability_histogram(scored: DataFrame, contributors: DataFrame, bins: int = 10) -> DataFrame:
    """Per repo, ``bins`` bins of p_active on [0, 1], last bin
    right-closed, empty bins 0 — one grouped aggregation of conditional
    counts, exploded to rows (no cross join with a bin table)."""
    j = contributors.join(scored, "login")
    b = bin_index("p_active", bins, 0.0, 1.0)
    counts = F.array(*[F.count(F.when(b == i, 1)) for i in range(bins)])
    per_repo = j.groupBy("repo").agg(counts.alias("__c"))
    return per_repo.select("repo", F.posexplode("__c").alias("bin", "count")).select(
        "repo", F.col("bin").cast("int").alias("bin"), "count")


# ------------------------------------------------------------------ what-if

def whatif_fields(segment: str, has_blog: bool, spec: ChurnSpec = DEFAULT_SPEC) -> list[str]:
    """B5 pinned: the three fields nudged per segment, by blog presence."""
    watch, fork, comment = (spec.whatif_column(r) for r in ("watch", "fork", "comment"))
    if segment == "company":
        return [watch, "followers_count", fork]
    if segment == "low":
        return (["following_count", "followers_count", comment] if has_blog
                else ["blog", "followers_count", comment])
    return ([watch, "followers_count", fork] if has_blog
            else [watch, "blog", "followers_count"])


def scenarios(churn_with_segment: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Explode each user into 5 scenario rows: nochange, +1 on each of the
    three fields of its segment, and +1 on all three (B7: +1 on the RAW value,
    ``blog`` set to 1)."""
    df = churn_with_segment
    has_blog = F.col("blog") == 1
    seg = F.col("segment")

    def fields_expr(i: int):
        def pick(segment, blog):
            return F.lit(whatif_fields(segment, blog, spec)[i])
        return (F.when(seg == "company", pick("company", True))
                .when((seg == "low") & has_blog, pick("low", True))
                .when(seg == "low", pick("low", False))
                .when(has_blog, pick("high", True)).otherwise(pick("high", False)))

    f = [fields_expr(i) for i in range(3)]
    scen = F.array(
        F.struct(F.lit("nochange").alias("change"), F.array().cast("array<string>").alias("bump")),
        *[F.struct(f[i].alias("change"), F.array(f[i]).alias("bump")) for i in range(3)],
        F.struct(F.lit("all").alias("change"), F.array(*f).alias("bump")),
    )
    ex = df.withColumn("__s", F.explode(scen))
    typed = [spec.whatif_column(r) for r in ("watch", "fork", "comment")]
    bumped = {}
    for c in ["followers_count", "following_count", "blog", *typed]:
        hit = F.array_contains(F.col("__s.bump"), c)
        if c == "blog":
            bumped[c] = F.when(hit, F.lit(1)).otherwise(F.col(c))
        else:
            bumped[c] = F.when(hit, F.col(c) + 1).otherwise(F.col(c))
    if "frequency" in df.columns:
        # frequency is the row sum of the type counts: keep it consistent
        extra = sum(F.array_contains(F.col("__s.bump"), c).cast("int") for c in typed)
        bumped["frequency"] = F.col("frequency") + extra
    return ex.withColumns(bumped).withColumn("change", F.col("__s.change")).drop("__s")


def whatif_scores(models: Mapping[str, PipelineModel | Linear], segment_model: PipelineModel | Centres,
                  churn: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """P(active) per user under each scenario, all users in one job.

    The segment is fixed from the unchanged profile, then the scenario rows
    are rescaled and scored with that segment's model: projections over one
    read of the churn table.
    """
    centres = segment_model if isinstance(segment_model, Centres) else centres_of(segment_model)
    raw = churn.withColumn("segment", centres.segment(raw=True)).where("segment IS NOT NULL")
    feats = feature_table(scenarios(raw, spec), spec)
    return score_by_segment(models, feats, keep=("login", "change"))


def validate_by_segment(models: Mapping[str, PipelineModel], data: DataFrame) -> DataFrame:
    """Score later data with earlier models; metrics overall and per segment."""
    from churnlens.operators.stats import confusion_metrics
    scored = score_by_segment(models, data, keep=("login", "label"))
    per_seg = confusion_metrics(scored, "prediction", "label", by=["segment"])
    overall = confusion_metrics(scored, "prediction", "label").withColumn("segment", F.lit("all"))
    return per_seg.unionByName(overall)
