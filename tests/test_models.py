"""Model plans: invariants rather than exact numbers (MLlib optimisers)."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from churnlens.config import DEFAULT_SPEC
from churnlens.operators.merge import churn_table
from churnlens.plans import models as mdl
from churnlens.plans.features import feature_columns, feature_table
from churnlens.plans.scoring import (at_risk_report, probability_histogram, scenarios,
                                     score_by_segment, whatif_fields, whatif_scores)
from churnlens.plans.segments import assign_segments, fit_segments
from churnlens.plans.training import train_churn_models
from churnlens.sources.tables import event_log, repo_contributors, user_profiles
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def trained(spark):
    return train_churn_models(spark, SF_MID, DEFAULT_SPEC)


def test_feature_list_is_declared(trained):
    assert trained.features == ["followers_count", "following_count", "blog", "hireable", "recency",
                                "click_count", "view_count", "purchase_count", "signup_count_bin",
                                "error_count_bin"]


def test_segments_partition_users(trained):
    segs = {r.segment: r["count"] for r in trained.data.groupBy("segment").count().collect()}
    assert set(segs) <= {"company", "high", "low"} and sum(segs.values()) == trained.data.count()
    # high segment has the larger mean scaled frequency among non-company users
    m = {r.segment: r.f for r in trained.data.groupBy("segment").agg(F.avg("frequency").alias("f")).collect()}
    assert m["high"] > m["low"]


def test_kmeans_seeded_repeatable(spark, trained):
    again = fit_segments(trained.data.drop("segment", "high_low_user"), seed=DEFAULT_SPEC.seed)
    c1 = sorted(map(tuple, trained.segment_model.stages[-1].clusterCenters()))
    c2 = sorted(map(tuple, again.stages[-1].clusterCenters()))
    assert all(a == pytest.approx(b) for a, b in zip(c1, c2))


def test_routing_scores_every_row_once(trained):
    scored = score_by_segment(trained.models, trained.data)
    assert scored.count() == trained.data.count()
    assert scored.select("login").distinct().count() == trained.data.count()
    r = scored.agg(F.min("p_active").alias("lo"), F.max("p_active").alias("hi")).first()
    assert 0.0 <= r.lo <= r.hi <= 1.0


def test_whatif_baseline_equals_plain_score(spark, trained):
    churn = churn_table(user_profiles(spark, SF_MID), event_log(spark, SF_MID))
    w = whatif_scores(trained.models, trained.segment_model, churn)
    base = w.where(F.col("change") == "nochange").select("login", F.col("p_active").alias("w"))
    plain = score_by_segment(trained.models, trained.data).select("login", "p_active")
    j = base.join(plain, "login")
    assert j.count() == plain.count()
    assert j.where(F.abs(F.col("w") - F.col("p_active")) > 1e-12).count() == 0
    assert w.groupBy("login").count().where("count != 5").count() == 0


def test_scenarios_bump_raw_values(spark):
    df = spark.createDataFrame(
        [(1, "company", 1, 3, 5, 7, 2, 4, 11)],
        "login long, segment string, blog int, click_count long, followers_count int, purchase_count long, "
        "following_count int, view_count long, frequency long")
    rows = {r.change: r for r in scenarios(df).collect()}
    assert set(rows) == {"nochange", "click_count", "followers_count", "purchase_count", "all"}
    assert rows["click_count"].click_count == 4 and rows["click_count"].frequency == 12
    assert rows["all"].followers_count == 6 and rows["all"].purchase_count == 8 and rows["all"].frequency == 13
    assert rows["nochange"].click_count == 3
    assert whatif_fields("low", False) == ["blog", "followers_count", "view_count"]


def test_at_risk_report_and_histogram(spark, trained):
    scored = score_by_segment(trained.models, trained.data)
    contrib = repo_contributors(spark, SF_MID)
    rep = at_risk_report(scored, contrib, k=25)
    per_repo = rep.groupBy("repo").agg(F.max("rank").alias("m"), F.count("*").alias("n")).collect()
    assert all(r.m == r.n <= 25 for r in per_repo)
    h = probability_histogram(scored, contrib, 10)
    tot = h.groupBy("repo").agg(F.sum("count").alias("n"), F.count("*").alias("bins")).collect()
    members = {r.repo: r["count"] for r in contrib.join(scored, "login").groupBy("repo").count().collect()}
    assert all(r.bins == 10 and r.n == members[r.repo] for r in tot)


def test_auc_perfect_and_reversed(spark):
    df = spark.createDataFrame([(i / 10.0, 1 if i >= 5 else 0) for i in range(10)], "s double, label int")
    assert mdl.auc(df, "s", "label").first().auc_roc == pytest.approx(1.0)
    assert mdl.auc(df.withColumn("s", -F.col("s")), "s", "label").first().auc_roc == pytest.approx(0.0)
    ties = spark.createDataFrame([(0.5, 1), (0.5, 0)], "s double, label int")
    assert mdl.auc(ties, "s", "label").first().auc_roc == pytest.approx(0.5)


def test_auc_and_curves_do_not_round_scores(spark):
    df = spark.range(20000).selectExpr("id * 1e-9 as s", "cast(id >= 10000 as int) as label")
    a = mdl.auc(df, "s", "label").first()
    assert a.auc_roc == pytest.approx(1.0) and a.auc_pr == pytest.approx(1.0)
    roc = mdl.roc_curve(df, "s", "label")
    assert roc.count() == 20001
    points = [(r.fpr, r.tpr) for r in roc.orderBy(F.desc("threshold")).collect()]
    assert points[0] == (0.0, 0.0) and points[10000] == (0.0, 1.0) and points[-1] == (1.0, 1.0)
    assert points == sorted(points)
    pr = mdl.pr_curve(df, "s", "label").orderBy(F.desc("threshold")).collect()
    assert (pr[0].recall, pr[0].precision) == (1e-4, 1.0) and pr[-1].precision == pytest.approx(0.5)


def test_full_grid_and_best_model(spark, trained):
    best, metrics = mdl.cross_validate(trained.data, trained.features, grid="full", folds=2)
    assert len(metrics) == 18 and all(0.4 < m <= 1.0 for m in metrics)
    again = mdl.cross_validate(trained.data.repartition(5), trained.features, grid="full", folds=2)[1]
    assert again == pytest.approx(metrics, abs=1e-3)  # folds don't depend on the layout
    assert best.transform(trained.data).count() > 0


def test_expressions_equal_model_transforms(spark, trained):
    from churnlens.plans.routing import centres_of, linear_of
    from pyspark.ml.functions import vector_to_array
    for seg, model in trained.models.items():
        part = trained.data.where(F.col("segment") == seg)
        both = model.transform(part).select(vector_to_array("probability")[1].alias("p"), "prediction",
                                            linear_of(model).probability().alias("q"))
        assert both.where("abs(p - q) > 1e-9 OR (prediction = 1) <> (q > 0.5)").count() == 0
    km = trained.segment_model.transform(trained.data)
    c = centres_of(trained.segment_model)
    assert km.where((F.col("cluster") == c.high) != c.is_high()).count() == 0


def test_model_save_load_roundtrip(spark, trained, scratch):
    path = f"{scratch}/model_company"
    trained.models["company"].write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = trained.models["company"].transform(trained.data).select("login", "probability").collect()
    b = back.transform(trained.data).select("login", "probability").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


def test_cross_validation_grids(spark, trained):
    from churnlens.operators.sampling import class_weights
    train = class_weights(trained.data.where(F.col("segment") != "company"), "label")
    best, metrics = mdl.cross_validate(train, trained.features, grid="balanced", folds=2)
    assert len(metrics) == 12 and isinstance(best, PipelineModel)
    _, one = mdl.cross_validate(train, trained.features, grid="none", folds=2)
    assert len(one) == 1 and 0.0 <= one[0] <= 1.0


def test_api_end_to_end(spark, scratch):
    from churnlens import api
    from churnlens.config import ChurnSpec
    from churnlens.sources.tables import stored_user_profiles
    churn = api.build_churn_table(spark, stored_user_profiles(spark, SF_MID), event_log(spark, SF_MID))
    tm = api.train(spark, churn)
    tm.save(f"{scratch}/models")
    back = api.TrainedModels.load(f"{scratch}/models", tm.features)
    scored = api.score(back, churn)
    assert scored.count() == churn.count()
    top, hist = api.repo_report(scored, repo_contributors(spark, SF_MID), "Brand#13")
    assert 0 < top.count() <= 25 and hist.count() == 10
    login = churn.select("login").orderBy("login").first().login
    w = api.user_whatif(back, churn, login)
    assert w.count() == 5
    spec = ChurnSpec.for_year(2016)
    assert spec.outlier_limit == 200 and ChurnSpec.for_year(2017).outlier_limit == 600
    assert len(spec.count_columns) == 14 and spec.count_columns[0] == "CommitCommentEvent_count"


def test_gbt_metrics_fit_as_many_trees_as_the_scores(spark, monkeypatch):
    from churnlens import catalog
    monkeypatch.setattr(catalog, "_tree_metrics", lambda spark, sf, estimator: estimator)
    assert catalog.m11_gbt_metrics(spark, None).getMaxIter() == 50  # the reference's maxIter
