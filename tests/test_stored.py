"""Stored daily profiles and sketches, shared-scan grid search, weighted Lloyd, curves by group, stable correlations."""

import datetime as dt
import re

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

import __spark_entry__ as entry
from churnlens.config import DEFAULT_SPEC as SPEC
from churnlens.operators import activity, daily, stats
from churnlens.plans import gridsearch, models, segments
from churnlens.plans.features import assembler
from churnlens.sources.tables import USER_SCHEMA, event_log, read_users_export, stored_user_profiles, write_csv
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


# ---------------------------------------------------------------- day table

def test_a_refresh_reads_and_replaces_only_its_days(spark, scratch):
    events = event_log(spark, SF_SMALL, SPEC)
    path, day, gone = f"{scratch}/days", dt.date(2024, 1, 5), dt.date(2024, 1, 9)
    before = events.where(F.to_date("created_at") != F.lit(day))
    daily.store_days(before, path, spec=SPEC)
    after = events.where(F.to_date("created_at") != F.lit(gone))
    changed = daily.changed_days(daily.day_marks(before), daily.day_marks(after))
    assert changed == [day, gone]
    files = {r.f for r in spark.read.parquet(path).where(~F.col("day").isin(changed)).select(F.input_file_name().alias("f")).distinct().collect()}
    daily.store_days(after, path, changed, SPEC)
    daily.store_days(after, path, changed, SPEC)  # a refresh that is repeated changes nothing
    daily.store_days(after, path, [], SPEC)
    days = daily.read_days(spark, path, events, SPEC)
    assert files == {r.f for r in days.where(~F.col("day").isin(changed)).select(F.input_file_name().alias("f")).distinct().collect()}
    columns = daily.day_profiles(after, SPEC).columns
    assert rows(days.select(columns)) == rows(daily.day_profiles(after, SPEC))
    assert rows(daily.two_periods(days, SPEC, True)) == rows(activity.two_period_profile(after, SPEC, True).select(*daily.two_periods(days, SPEC, True).columns))


def test_the_churn_table_reads_day_rows_of_its_periods_only(spark, scratch):
    events, path = event_log(spark, SF_SMALL, SPEC), f"{scratch}/days"
    daily.store_days(events, path, spec=SPEC)
    table = daily.churn_table_from_days(stored_user_profiles(spark, SF_SMALL), daily.read_days(spark, path, events, SPEC), SPEC)
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan(table)) and not any("events.parquet" in f for f in table.inputFiles())
    assert rows(table) == rows(entry.queries()["m24_churn_table"](spark, SF_SMALL))


def test_periods_of_day_rows_are_whole_days(spark, scratch):
    events, path = event_log(spark, SF_SMALL, SPEC), f"{scratch}/days"
    daily.store_days(events, path, spec=SPEC)
    with pytest.raises(ValueError):
        daily.period_profile(daily.read_days(spark, path, events, SPEC), dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 2), SPEC)


def test_a_day_is_few_files_however_many_tasks(spark, scratch):
    events, path = event_log(spark, SF_SMALL, SPEC).repartition(16), f"{scratch}/days"
    daily.store_days(events, path, spec=SPEC, files=2)
    per_day = spark.read.parquet(path).select("day", F.input_file_name().alias("f")).distinct().groupBy("day").count()
    assert per_day.agg(F.max("count")).first()[0] <= 2


# ---------------------------------------------------------------- grid search

@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(12)
    n = 600
    x = rng.standard_normal((n, 4)) * [1.0, 5.0, 0.1, 1.0] + [0.0, 300.0, -2.0, 0.0]  # a feature far from zero
    x[:, 3] = x[:, 0] + 0.1 * x[:, 3]  # and one that goes along with another
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] + 0.1 * (x[:, 1] - 300) - 1)))).astype(float)
    data = [(i, *map(float, r), 7.0, float(t), 1.0 + (i % 3)) for i, (r, t) in enumerate(zip(x, y))]
    data += [(9001, None, 1.0, 1.0, 1.0, 7.0, 1.0, 1.0), (9002, float("nan"), 1.0, 1.0, 1.0, 7.0, 0.0, 1.0)]  # skipped
    return spark.createDataFrame(data, "login long, a double, b double, c double, d double, flat double, label double, w double").repartition(5)


FEATURES = ["a", "b", "c", "d", "flat"]


@pytest.mark.parametrize("weight", [None, "w"])
def test_all_candidates_equal_single_fits(labelled, weight):
    cands = [gridsearch.Candidate(reg, mix) for reg in (0.0, 0.003, 0.3) for mix in (0.0, 0.8)]
    found = gridsearch.search(labelled, FEATURES, cands, folds=3, weight=weight)
    assert found.residuals.shape == (6, 4) and found.residuals.max() <= 1e-9 and found.passes < 20
    data = assembler(FEATURES).transform(labelled.na.drop())
    for c, m in zip(cands, found.models):
        lr = LogisticRegression(maxIter=2000, tol=1e-14, regParam=c.reg, elasticNetParam=c.elastic_net)
        one = (lr.setWeightCol(weight) if weight else lr).fit(data)
        assert np.allclose([m.intercept, *(w for _, w in m.weights)], [one.intercept, *one.coefficients], atol=2e-6, rtol=2e-6)


def test_areas_are_those_of_held_rows(labelled):
    from churnlens.operators.sampling import key_hash
    c = gridsearch.Candidate(0.03, 0.5)
    found = gridsearch.search(labelled, FEATURES, [c], folds=3)
    data = labelled.na.drop().withColumn("fold", F.pmod(key_hash("login", 2018), F.lit(3)))
    areas = []
    for f in range(3):
        own = gridsearch.search(data.where(F.col("fold") != f), FEATURES, [c], folds=3).models[0]
        held = data.where(F.col("fold") == f).select(own.probability().alias("p"), "label")
        areas.append(models.auc(held, "p", "label").first()["auc_roc"])
    assert abs(found.areas[0] - sum(areas) / 3) < 1e-9


def test_separable_classes_end(spark):
    data = spark.createDataFrame([(i, float(i), float(i >= 20)) for i in range(40)], "login long, a double, label double")
    found = gridsearch.search(data, ["a"], [gridsearch.Candidate(0.0), gridsearch.Candidate(0.1)], folds=2)
    assert found.passes <= 100 and found.areas == [1.0, 1.0] and found.residuals[1].max() <= 1e-9


# ---------------------------------------------------------------- Lloyd

def test_lloyd_is_the_same_for_any_partitions(spark):
    rng = np.random.default_rng(1)
    pts = [(float(np.log1p(a)), float(np.log1p(b))) for a, b in zip(rng.poisson(5, 800), rng.poisson(200, 800))]
    pts += [(None, 1.0), (2.0, None)]
    start, got = ((1.0, 5.0), (2.0, 5.5), (50.0, 50.0)), []
    for parts in (1, 32):
        df = spark.createDataFrame(pts, "frequency double, recency double").repartition(parts)
        got.append(segments.weighted_lloyd(segments.compressed_points(df, ("frequency", "recency")), ("frequency", "recency"), start, 8))
    assert got[0].centres == got[1].centres and got[0].sizes == got[1].sizes and abs(got[0].cost - got[1].cost) < 1e-9
    x, at = np.round(np.array(pts[:-2]) * 1e9) / 1e9, np.array(start)
    for _ in range(got[0].rounds):
        k = ((x[:, None] - at[None]) ** 2).sum(axis=2).argmin(axis=1)
        at = np.array([x[k == c].mean(axis=0) if (k == c).any() else at[c] for c in range(3)])
    assert np.allclose(got[0].centres.points, at, atol=1e-9) and sum(got[0].sizes) == 800 and got[0].sizes[2] == 0


# ---------------------------------------------------------------- curves, correlations, exports

def test_curves_by_group_equal_the_curves_of_each(spark):
    rng = np.random.default_rng(3)
    data = [("abc"[i % 3] if i % 10 else None, round(float(rng.random()), 2), int(rng.integers(0, 2))) for i in range(500)] + [("only", 0.5, 1), ("a", None, 1)]
    df = spark.createDataFrame(data, "g string, p_active double, label int")
    for curve in (models.roc_curve, models.pr_curve):
        every = curve(df, by=("g",))
        for g in ("a", "b", "c", None, "only"):
            one = curve(df.where(F.col("g").eqNullSafe(F.lit(g))))
            assert rows(every.where(F.col("g").eqNullSafe(F.lit(g))).drop("g")) == rows(one)
    areas = {r.g: r for r in models.auc(df, by=("g",)).collect()}
    assert len(areas) == 5 and areas["only"].auc_roc is None
    for g in ("a", None):
        one = models.auc(df.where(F.col("g").eqNullSafe(F.lit(g)))).first()
        assert abs(areas[g].auc_roc - one.auc_roc) < 1e-12 and abs(areas[g].auc_pr - one.auc_pr) < 1e-12


def test_correlation_of_large_means(spark):
    rng = np.random.default_rng(5)
    s = 1.7e9 + rng.integers(0, 1500, 3000)
    data = [(float(a), float(1e12 + 3 * (a - 1.7e9) + e), 1.7e9, None if i % 7 else 2.0) for i, (a, e) in enumerate(zip(s, rng.normal(0, 50, 3000)))]
    df = spark.createDataFrame(data, "a double, b double, flat double, few double").repartition(9)
    got = {(r.c1, r.c2): r.r for r in stats.correlation_pairs(df, ["a", "b", "flat", "few"]).collect()}
    x = np.array([r[:2] for r in data])
    assert abs(got["a", "b"] - np.corrcoef(x[:, 0] - 1.7e9, x[:, 1] - 1e12)[0, 1]) < 1e-9
    assert got["a", "flat"] is None and got["flat", "few"] is None and got["a", "few"] is None and len(got) == 6
    none = stats.correlation_pairs(df.limit(0), ["a", "b"]).collect()
    assert [r.r for r in none] == [None]


def test_users_export_keeps_the_latest_row_of_a_login(spark, scratch):
    t = [dt.datetime(2020, 1, d) for d in (1, 2)]
    made = [("x", 1, t[0]), ("x", 2, t[1]), ("x", 3, None), ("y", 5, None), ("z", 7, t[0]), ("z", 8, t[0])]
    data = [(a, n, 0, 0, 0, None, None, None, None, None, u) for a, n, u in made]
    write_csv(spark.createDataFrame(data, USER_SCHEMA), scratch + "/u")
    got = read_users_export(spark, scratch + "/u")
    assert {r.login: r.followers_count for r in got.collect()} == {"x": 2, "y": 5, "z": 8}
    assert got.columns == [f.name for f in USER_SCHEMA]


# ---------------------------------------------------------------- ledger, registry, payloads, layouts

def test_a_batch_that_was_committed_stays(spark, scratch):
    from churnlens.operators.ledger import committed, fetch_batch
    path = scratch + "/ledger"
    users = spark.createDataFrame([(i,) for i in range(20)] + [(3,), (None,)], "actor int")
    known = spark.createDataFrame([(0,), (1,)], "actor int")
    one = fetch_batch(users, known, "actor", 5, "a/b c", path).collect()
    two = fetch_batch(users, known, "actor", 5, "second", path).collect()
    spark.createDataFrame([(7, 0)], "actor int, place int").write.parquet(path + "/batch=third")
    import os
    os.remove(path + "/batch=third/_SUCCESS")  # a writer died
    again = fetch_batch(users.where("actor > 15"), known, "actor", 5, "a/b c", path).collect()
    third = fetch_batch(users, known, "actor", 50, "third", path).collect()
    assert again == one and [r.place for r in sorted(one, key=lambda r: r.place)] == list(range(5)) and len(committed(spark, path)) == 3
    taken = [r.actor for r in one + two + third]
    assert sorted(taken) == list(range(2, 20))


def test_registry_versions(spark, scratch):
    from churnlens import catalog_stored as cs
    from churnlens.api import TrainedModels
    from churnlens.plans import registry
    segments_, models_ = cs._declared_pipelines(spark)
    trained = TrainedModels(segments_, models_, ["blog", "recency"])
    with pytest.raises(FileNotFoundError):
        registry.load(spark, scratch + "/r")
    assert [registry.publish(spark, scratch + "/r", trained, SPEC, "s1"), registry.publish(spark, scratch + "/r", trained, SPEC, "s2")] == [1, 2]
    held = registry.load(spark, scratch + "/r")
    assert held.number == 2 and held.data_state == "s2" and held.spec == SPEC and held.trained.features == ["blog", "recency"]
    assert registry.load(spark, scratch + "/r", 1).data_state == "s1" and set(held.trained.models) == {"company", "high", "low"}
    import os
    os.makedirs(scratch + "/r/.incoming-dead")  # what a crash leaves is no version
    assert registry.versions(spark, scratch + "/r") == [1, 2]
    with pytest.raises(ValueError, match="recency"):
        registry.check_features(held, spark.createDataFrame([(1,)], "blog int"))


def test_plans_of_stored_layouts(spark):
    merged = entry.queries()["m24_colocated_merge"](spark, SF_SMALL)
    assert "Exchange" not in plan(merged) and "SortMergeJoin" in plan(merged)
    periods = entry.queries()["s2_profiles_of_periods"](spark, SF_SMALL)
    assert "dynamicpruning" in plan(periods).lower()
    fields = entry.queries()["a5_variant_fields"](spark, SF_SMALL)
    assert fields._jdf.queryExecution().optimizedPlan().toString().count("parse_json") <= 1


def test_at_risk_reports_plan_quickly(spark):
    import time
    for name in ("m16_at_risk_declared", "m16_histogram_declared"):
        entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan()
        df = entry.queries()[name](spark, SF_SMALL)
        start = time.perf_counter()
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert time.perf_counter() - start < 5 and text.lower().count("log1p") <= 60
