"""Edge cases of the relational operators on small literal frames (FIXTURES §3)."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from churnlens.config import ChurnSpec
from churnlens.functions.columns import (log1p_scaled, narrow_bigints, parse_ts, presence_flag,
                                         row_sum, try_int)
from churnlens.operators import activity as act
from churnlens.operators import stats
from churnlens.operators.membership import members_only, not_yet_known
from churnlens.operators.activity import two_period_profile
from churnlens.operators.merge import churn_table, merge_period_profiles
from churnlens.operators.ranking import top_k, top_k_per_group
from churnlens.operators.sampling import (class_weights, hash_split, key_hash, next_batch, seeded_shuffle,
                                          undersample_majority)

SPEC = ChurnSpec(event_types=("a", "b"), first_period=(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 10)),
                 second_period=(dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11)), outlier_limit=100,
                 private_types=("b",))


def ts(d, h=0):
    return dt.datetime(2024, 1, d, h)


def events(spark, rows):
    return spark.createDataFrame(
        [(u, t, c, None, True if t != "b" else False) for u, t, c in rows],
        "actor long, type string, created_at timestamp_ntz, payload string, public boolean")


def users(spark, logins):
    return spark.createDataFrame(
        [(u, 1, 2, 3, 4, None, "x" if u % 2 else None, None, True, dt.datetime(2023, 12, 1),
          dt.datetime(2023, 12, 2)) for u in logins],
        "login long, followers_count int, following_count int, public_repos_count int, "
        "public_gists_count int, bio string, blog string, company string, hireable boolean, "
        "created_at timestamp_ntz, updated_at timestamp_ntz")


def test_row_sum_null_semantics(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    r = df.select(row_sum(["a", "b"]).alias("s"), row_sum(["a", "b"], null_safe=True).alias("z")).collect()
    assert [(x.s, x.z) for x in r] == [(None, 1), (5, 5)]


def test_presence_and_try_cast(spark):
    df = spark.createDataFrame([(None, "12"), ("b", "zz"), ("", "99999999999")], "t string, n string")
    r = df.select(presence_flag("t").alias("p"), try_int("n").alias("i")).collect()
    assert [(x.p, x.i) for x in r] == [(0, 12), (1, None), (1, None)]


def test_narrow_bigints_overflow_is_null(spark):
    df = spark.createDataFrame([(1, 5), (2, 1 << 40)], "k long, v long")
    out = narrow_bigints(df)
    assert [f.dataType.typeName() for f in out.schema.fields] == ["integer", "integer"]
    assert [r.v for r in out.collect()] == [5, None]


def test_parse_timestamp_text(spark):
    df = spark.createDataFrame([("2016-05-31 23:59:59 UTC",), (None,), ("zzz",)], "s string")
    r = [x.t for x in df.select(parse_ts("s").alias("t")).collect()]
    assert r[0] == dt.datetime(2016, 5, 31, 23, 59, 59) and r[1] is None and r[2] is None


def test_log_scaling_nulls_below_minus_one(spark):
    df = spark.createDataFrame([(0,), (-1,), (-5,), (3,)], "x int")
    r = [x.y for x in df.select(log1p_scaled("x").alias("y")).collect()]
    assert r[0] == 0.0 and r[1] is None and r[2] is None and abs(r[3] - 1.3862943611198906) < 1e-12


def test_activity_profile_zero_counts_and_public(spark):
    ev = events(spark, [(1, "a", ts(1)), (1, "a", ts(2)), (2, "b", ts(3)), (1, "b", ts(20))])
    p = {r.actor: r for r in act.activity_profile(ev, *SPEC.first_period, spec=SPEC).collect()}
    assert p[1].event_count == 2 and p[1].a_count == 2 and p[1].b_count == 0
    assert p[2].a_count == 0 and p[2].b_count == 1 and p[2].first_event == ts(3)
    pub = act.activity_profile(ev, *SPEC.first_period, spec=SPEC, public_only=True).collect()
    assert [r.actor for r in pub] == [1]


def test_user_activity_always_one_row(spark):
    ev = events(spark, [(1, "a", ts(1))])
    r = act.user_activity(ev, 99, SPEC).collect()
    assert len(r) == 1 and r[0].event_count == 0 and r[0].last_event is None


def test_churn_table_join_and_fill_semantics(spark):
    # user 1: both periods; 2: first only; 3: second only; 4: none
    ev = events(spark, [(1, "a", ts(1)), (1, "a", ts(10, 5)), (2, "b", ts(2)), (3, "a", ts(10, 6))])
    u = users(spark, [1, 2, 3, 4])
    pinned = {r.login: r for r in churn_table(u, ev, SPEC, public_only=False).collect()}
    assert set(pinned) == {1, 2}                         # B1: no first-period row -> dropped
    assert pinned[1].second_period_event_count == 1 and pinned[2].second_period_event_count == 0
    assert pinned[1].frequency == 1 and pinned[2].frequency == 1
    assert pinned[1].blog == 1 and pinned[2].blog == 0 and pinned[1].company == 0
    assert pinned[1].recency == 31                         # 2023-12-01 -> 2024-01-01
    kept = {r.login: r for r in churn_table(u, ev, SPEC, keep_inactive=True, public_only=False).collect()}
    public = {r.login for r in churn_table(u, ev, SPEC).collect()}
    assert public == {1}                                 # user 2 has private events only
    assert set(kept) == {1, 2, 3, 4} and kept[3].frequency == 0 and kept[3].second_period_event_count == 1


def test_outlier_filter_limit(spark):
    spec = ChurnSpec(**{**SPEC.__dict__, "outlier_limit": 2})
    ev = events(spark, [(1, "a", ts(1)), (1, "a", ts(2)), (2, "a", ts(2))])
    out = churn_table(users(spark, [1, 2]), ev, spec).collect()
    assert [r.login for r in out] == [2]


def test_fixed_histogram_edges_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.9999,), (1.0,), (1.5,)], "p double")
    h = {r.bin: r["count"] for r in stats.fixed_histogram(df, "p", 10).collect()}
    assert len(h) == 10 and h[0] == 1 and h[1] == 1 and h[9] == 2 and h[5] == 0
    assert sum(h.values()) == 4


def test_histogram_observed_range(spark):
    df = spark.createDataFrame([(float(x),) for x in range(10)], "v double")
    h = stats.histogram(df, "v", 3).orderBy("bin").collect()
    assert [r["count"] for r in h] == [3, 3, 4] and h[0].lower == 0.0 and h[2].upper == 9.0


def test_confusion_metrics_degenerate(spark):
    df = spark.createDataFrame([(0, 1), (0, 1)], "prediction int, label int")
    r = stats.confusion_metrics(df).collect()[0]
    assert (r.tp, r.fn, r.fp, r.tn) == (0, 2, 0, 0)
    assert r.precision is None and r.recall == 0.0 and r.f1 is None and r.accuracy == 0.0
    empty = stats.confusion_metrics(df.limit(0)).collect()[0]
    assert empty.accuracy is None


def test_confusion_metrics_grouped(spark):
    df = spark.createDataFrame([("x", 1, 1), ("x", 0, 1), ("y", 1, 0)], "g string, prediction int, label int")
    r = {x.g: x for x in stats.confusion_metrics(df, by=["g"]).collect()}
    assert r["x"].tp == 1 and r["x"].fn == 1 and r["y"].fp == 1


def test_correlation_and_summary(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 3.0), (3.0, 6.0, 1.0)], "a double, b double, c double")
    r = {(x.c1, x.c2): x.r for x in stats.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert r[("a", "b")] == pytest.approx(1.0) and r[("a", "c")] == pytest.approx(-1.0)
    s = {x.column: x for x in stats.summary_stats(df, ["a"], quartiles=True).collect()}
    assert s["a"].mean == 2.0 and s["a"].p50 == 2.0 and s["a"]["count"] == 3


def test_churn_rate_and_balance(spark):
    df = spark.createDataFrame([(0,), (0,), (3,)], "second_period_event_count int")
    assert stats.churn_rate(df).collect()[0].churn_pct == 66.67
    b = stats.class_balance(df.select((F.col("second_period_event_count") > 0).cast("int").alias("label"))).collect()[0]
    assert (b.n_positive, b.n_rows) == (1, 3) and b.balancing_ratio == pytest.approx(2 / 3)


def test_membership_empty_duplicates_quotes(spark):
    ev = spark.createDataFrame([(1, "a", True), (2, "a", True), (3, "a", False)],
                               "actor long, type string, public boolean")
    none = spark.createDataFrame([], "login long")
    assert members_only(ev, none).count() == 0
    dup = spark.createDataFrame([(1,), (1,), (3,)], "login long")
    assert sorted(r.actor for r in members_only(ev, dup).collect()) == [1]  # 3 is not public
    names = spark.createDataFrame([("o'brien",), ("x",)], "actor string")
    known = spark.createDataFrame([("o'brien",)], "actor string")
    assert [r.actor for r in not_yet_known(names, known, "actor").collect()] == ["x"]


def test_key_hash_matches_python(spark):
    df = spark.createDataFrame([(k,) for k in (0, 1, 12345, 1 << 40, 9_000_000_000)], "k long")
    got = [r.h for r in df.select(key_hash("k", 7).alias("h")).collect()]
    want = [int(hashlib.md5(f"{k}:7".encode()).hexdigest()[:8], 16) for k in (0, 1, 12345, 1 << 40, 9_000_000_000)]
    assert got == want


def test_seeds_are_independent_and_text_keys_work(spark):
    # undersampling with one seed and splitting with another must not pick the same rows
    df = spark.range(20000).selectExpr("cast(id as string) as login", "cast(id % 4 = 0 as int) as churned")
    kept = undersample_majority(df, "churned", "login", seed=0, minority_value=1).where("churned = 0")
    train, _ = hash_split(kept, "login", 0.7, 2018)
    assert 0.65 < train.count() / kept.count() < 0.75
    named = spark.createDataFrame([("octocat",), ("o'brien",), (None,)], "login string")
    a, b = hash_split(named, "login")
    assert a.count() + b.count() == 3
    assert next_batch(named, named.where("login = 'octocat'"), "login", 5).count() == 2
    assert seeded_shuffle(named, "login").count() == 3


def test_yearly_periods_include_their_last_days(spark):
    spec = ChurnSpec.for_year(2016)
    at = ["2016-01-01 00:00:00", "2016-06-01 23:59:59", "2016-06-02 00:00:00", "2016-11-01 12:00:00", "2016-11-02 00:00:00"]
    ev = spark.createDataFrame([("u", "PushEvent", True, t) for t in at], "actor string, type string, public boolean, t string").selectExpr(
        "actor", "type", "public", "cast(t as timestamp_ntz) as created_at")
    r = two_period_profile(ev, spec).first()
    assert (r.PushEvent_count, r.second_period_event_count) == (2, 2)


def test_bins_follow_one_rule(spark):
    import numpy as np
    values = [0.0, 0.1, 0.3, 0.6, 0.7, 0.95, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    got = [r.b for r in df.select(stats.bin_index("p", 10, 0.0, 1.0).alias("b")).collect()]
    assert np.bincount(got, minlength=10).tolist() == np.histogram(values, bins=10, range=(0, 1))[0].tolist()
    assert spark.createDataFrame([(1.5,)], "p double").select(stats.bin_index("p", 10, 0.0, 1.0).alias("b")).first().b is None


def test_exact_quartiles_beyond_the_sketch(spark):
    df = spark.range(100_001).selectExpr("cast(id * id % 100003 as double) as v", "cast(null as double) as w")
    got = {r["column"]: (r.p25, r.p50, r.p75) for r in stats.exact_quartiles(df, ["v", "w"], accuracy=100).collect()}
    values = sorted(i * i % 100003 for i in range(100_001))
    assert got["v"] == tuple(float(values[-(-len(values) * k // 4) - 1]) for k in (1, 2, 3))
    assert "w" not in got or got["w"] == (None, None, None)


def test_churn_table_from_period_profiles(spark):
    spec = ChurnSpec()
    when = "cast('2024-01-03 10:00:00' as timestamp_ntz)"
    counts = ", ".join(f"cast({i + 1} as bigint) as {c}" for i, c in enumerate(spec.count_columns))
    first = spark.sql(f"select cast(1 as bigint) as actor, cast(15 as bigint) as event_count, {when} as last_event, {when} as first_event, {counts}")
    second = first.withColumn("actor", F.lit(2).cast("long"))
    users = spark.sql(f"select id as login, 1 as followers_count, 1 as following_count, 1 as public_repos_count, 1 as public_gists_count, "
                      f"'b' as blog, 'c' as company, true as hireable, {when} as created_at, {when} as updated_at from range(1, 4)")
    rows = {r.login: r for r in merge_period_profiles(users, first, second, spec).collect()}
    assert set(rows) == {1} and (rows[1].frequency, rows[1].second_period_event_count) == (15, 0)
    kept = {r.login: r.second_period_event_count for r in merge_period_profiles(users, first, second, spec, keep_inactive=True).collect()}
    assert kept == {1: 0, 2: 15, 3: 0}


def test_hash_split_stable_under_repartition(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a, _ = hash_split(df, "k", 0.7, 1)
    b, _ = hash_split(df.repartition(13), "k", 0.7, 1)
    assert sorted(r.k for r in a.collect()) == sorted(r.k for r in b.collect())
    assert 600 < a.count() < 800


def test_next_batch_resumable(spark):
    cand = spark.range(100).withColumnRenamed("id", "actor")
    first = next_batch(cand, spark.createDataFrame([], "actor long"), "actor", 10, seed=3)
    second = next_batch(cand, first, "actor", 10, seed=3)
    a, b = {r.actor for r in first.collect()}, {r.actor for r in second.collect()}
    assert len(a) == len(b) == 10 and not (a & b)


def test_undersample_clamps_fraction(spark):
    # more minority than majority: fraction clamps to 1, all rows kept
    df = spark.createDataFrame([(i, 1 if i < 8 else 0) for i in range(10)], "k long, churned int")
    assert undersample_majority(df, "churned", "k", minority_value=1).count() == 10


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (0,)], "label int")
    w = sorted(r.class_weight for r in class_weights(df).collect())
    # ratio = (N - P) / N = 0.25: positives get 0.25, negatives 0.75
    assert w == pytest.approx([0.25, 0.25, 0.25, 0.75])


def test_top_k_ties_deterministic(spark):
    df = spark.createDataFrame([(i, 0.5) for i in range(40)] + [(100, 0.1)], "login long, p double")
    r = top_k(df, [F.col("p"), F.col("login")], 25).collect()
    assert [x.login for x in r] == [100] + list(range(24))


def test_top_k_per_group_exact_with_hot_group(spark):
    rows = [("hot", i, float(i % 97)) for i in range(3000)] + [("cold", i, float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "repo string, login long, p double")
    want = sorted(((i % 97, i) for i in range(3000)))[:25]
    for salts in (1, 8):
        got = top_k_per_group(df, ["repo"], [F.col("p"), F.col("login")], 25, salt_key="login", salt_buckets=salts)
        hot = [(r.login, r["rank"]) for r in got.where("repo = 'hot'").orderBy("rank").collect()]
        assert [x[0] for x in hot] == [w[1] for w in want]
        assert [x[1] for x in hot] == list(range(1, 26))
        assert got.where("repo = 'cold'").count() == 5


def test_assembler_skips_invalid_rows(spark):
    from churnlens.plans.features import assembler
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (float("nan"), 3.0)], "a double, b double")
    out = assembler(["a", "b"]).transform(df)
    assert out.count() == 1


def test_serving_fill(spark):
    from churnlens.operators.merge import serving_fill
    df = spark.createDataFrame([(1, None, None, None, None)],
                               "login long, event_count long, click_count long, followers_count int, "
                               "last_event timestamp_ntz")
    r = serving_fill(df, ChurnSpec(), dt.datetime(2018, 8, 1, 1)).collect()[0]
    assert (r.frequency, r.click_count, r.followers_count, r.last_event) == (0, 0, 0, dt.datetime(2018, 8, 1, 1))
    two = ChurnSpec(event_types=("click", "view"))
    df = spark.createDataFrame([(9, 4, 1), (9, None, 2)], "event_count long, click_count long, view_count long")
    assert [x.frequency for x in serving_fill(df, two).collect()] == [5, 2]  # the declared types' sum, not all events


def test_hot_user_third_of_rows(spark):
    """One user holds a third of all events: results stay exact and whole."""
    rows = [(1, "a" if i % 3 else "b", ts(1 + i % 9, i % 24)) for i in range(3000)]
    rows += [(2 + i % 500, "a", ts(1 + i % 9, 5)) for i in range(6000)]
    ev = events(spark, rows).repartition(16)
    prof = {r.actor: r for r in act.activity_profile(ev, *SPEC.first_period, spec=SPEC).collect()}
    assert len(prof) == 501 and prof[1].event_count == 3000 and prof[1].b_count == 1000
    spec = ChurnSpec(**{**SPEC.__dict__, "outlier_limit": 10_000})
    churn = {r.login: r for r in churn_table(users(spark, [1, 2, 3]), ev, spec, public_only=False).collect()}
    assert churn[1].frequency == 3000 and churn[2].frequency == 12
    fresh = not_yet_known(spark.range(600).withColumnRenamed("id", "actor"), ev, "actor")
    assert fresh.count() == 600 - 501 - 1 + 1  # ids 0 and 501..599 were never seen


def test_sql_entry_binds_parameters(spark):
    from churnlens import sql as ssql
    from tests.conftest import SF_SMALL
    ssql.register_views(spark, SF_SMALL)
    quoted = ssql.user_events(spark, 7).collect()
    assert len(quoted) == 1
    via_df = act.user_activity(event_log_small(spark), 7).collect()[0]
    assert quoted[0].asDict() == via_df.asDict()


def event_log_small(spark):
    from churnlens.sources.tables import event_log
    from tests.conftest import SF_SMALL
    return event_log(spark, SF_SMALL)


def test_archive_event_log_with_yearly_spec(spark):
    from churnlens.sources.logs import archive_event_log
    raw = spark.createDataFrame(
        [("PushEvent", True, ("a/b",), ("alice",), dt.datetime(2016, 2, 1), '{"action": "x"}'),
         ("WatchEvent", True, ("a/b",), ("alice",), dt.datetime(2016, 7, 1), None),
         ("PushEvent", False, ("c/d",), ("bob",), dt.datetime(2016, 3, 1), None)],
        "type string, public boolean, repo struct<name:string>, actor struct<login:string>, "
        "created_at timestamp, payload string")
    spec = ChurnSpec.for_year(2016)
    ev = archive_event_log(raw)
    p = {r.actor: r for r in act.activity_profile(ev, *spec.first_period, spec=spec, public_only=True).collect()}
    assert set(p) == {"alice"} and p["alice"].PushEvent_count == 1 and p["alice"].WatchEvent_count == 0
    two = {r.actor: r for r in act.two_period_profile(ev, spec).collect()}
    assert two["alice"].second_period_event_count == 1


def test_multi_histogram_matches_single(spark):
    df = spark.createDataFrame([(float(i), float(i * i % 7), None if i % 5 == 0 else float(i % 3))
                                for i in range(40)], "a double, b double, c double")
    multi = {(r.column, r.bin): (r["count"], round(r.lower, 9)) for r in stats.histograms(df, ["a", "b", "c"], 6).collect()}
    for c in ("a", "b", "c"):
        for r in stats.histogram(df, c, 6).collect():
            assert multi[(c, r.bin)] == (r["count"], round(r.lower, 9))
    assert len(multi) == 18


def test_correlation_constant_column_is_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 0, 2.0), (2.0, 0, None), (3.0, 0, 6.0), (4.0, 0, 8.0)],
                               "a double, k int, b double")
    r = {(x.c1, x.c2): x.r for x in stats.correlation_pairs(df, ["a", "k", "b"]).collect()}
    assert r[("a", "k")] is None and r[("a", "b")] == pytest.approx(1.0)
    assert stats.pearson_rmse(df, "k", "k").first().pearson_r is None


def test_mean_se_all_null_group(spark):
    df = spark.createDataFrame([("x", None), ("y", 1.0), ("y", 3.0)], "g string, v double")
    r = {x.group: x for x in stats.mean_se_by_group(df, "g", "v").collect()}
    assert r["x"].n == 0 and r["x"].se is None and r["y"].se == pytest.approx(1.0)
