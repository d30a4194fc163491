"""Registered queries over stored, mergeable tables: daily profiles, sketches, shared-scan fits, curves per segment.

They are added to the ``QUERIES`` and ``ORACLE`` of ``churnlens.catalog``.
"""

from __future__ import annotations

import datetime as dt
import itertools
import uuid

from pyspark.sql import functions as F

from churnlens import catalog as cat
from churnlens import sql_twins as sq
from churnlens.catalog import CHURN, PUBLIC, SPEC, q
from churnlens.operators import activity as act
from churnlens.operators import daily, stats
from churnlens.operators.ledger import fetch_batch
from churnlens.operators.merge import colocated_churn_table, store_by_user
from churnlens.operators.sampling import class_weights, hash_split
from churnlens.plans import gridsearch as grid
from churnlens.plans import models as mdl
from churnlens.plans.features import feature_columns, feature_table
from churnlens.plans.scoring import score_by_segment
from churnlens.plans.segments import compressed_points, weighted_lloyd
from churnlens.plans.training import cached_segmented_features, memoized
from churnlens.sources.tables import read_table, stored_table, stored_user_profiles, tasks_for, write_parquet

_r = cat._r

# ====================================================================== daily partial aggregates

_REWRITTEN = dt.date(2024, 1, 10)


def _day_table(spark, sf):
    """The day table of the events, one day of which was stored when half of its events had not come yet, then stored anew."""
    events, path = cat._ev(spark, sf), cat._file(spark, "days")
    late = F.to_date("created_at") == F.lit(_REWRITTEN)
    early = events.where(~late | (F.col("event_id") % 2 == 0))
    daily.store_days(early, path, spec=SPEC)
    days = daily.changed_days(daily.day_marks(early), daily.day_marks(events))
    daily.store_days(events, path, days, SPEC)
    return daily.read_days(spark, path, events, SPEC)


def _days(spark, sf):
    return memoized(spark, ("days", sf), lambda: _day_table(spark, sf))


@q("m24_incremental_churn_table", cat.ORACLE["m24_churn_table"])
def m24_incremental_churn_table(spark, sf):
    """The churn table from the stored day rows, after one day was rewritten."""
    return daily.churn_table_from_days(stored_user_profiles(spark, sf), _days(spark, sf), SPEC)


@q("a2_profile_from_days", cat.ORACLE["a2_activity_profile"])
def a2_profile_from_days(spark, sf):
    got = daily.period_profile(_days(spark, sf), *SPEC.first_period, SPEC)
    return got.select(*cat.QUERIES["a2_activity_profile"](spark, sf).columns)


@q("s5_changed_days", f"SELECT '{_REWRITTEN}' AS day")
def s5_changed_days(spark, sf):
    """Which days have changed between two states of the log (here: events of one day came late)."""
    events = cat._ev(spark, sf)
    early = events.where((F.to_date("created_at") != F.lit(_REWRITTEN)) | (F.col("event_id") % 2 == 0))
    days = daily.changed_days(daily.day_marks(early), daily.day_marks(events))
    return spark.createDataFrame([(str(d),) for d in days], "day string")


@q("a4_sketched_active_users", f"""
WITH e AS (SELECT CAST(ts AS DATE) AS day, user_id FROM events WHERE {PUBLIC}),
p AS (SELECT 'week' AS unit, CAST(date_trunc('week', day) AS DATE) AS period, user_id FROM e
      UNION ALL SELECT 'month', CAST(date_trunc('month', day) AS DATE), user_id FROM e
      UNION ALL SELECT 'year', CAST(date_trunc('year', day) AS DATE), user_id FROM e)
SELECT unit, CAST(period AS VARCHAR) AS period, count(*) AS n_events, count(DISTINCT user_id) AS exact_users, TRUE AS within_3_percent FROM p GROUP BY 1, 2""")
def a4_sketched_active_users(spark, sf):
    """Distinct public users per week, month and year from one stored table of daily sketches, next to the exact numbers."""
    events = cat._ev(spark, sf).where("public")
    sketches, _ = stored_table(daily.user_sketches(events), "sketches")
    out = None
    for unit in ("week", "month", "year"):
        exact = events.groupBy(F.trunc("created_at", unit).alias("p")).agg(F.count_distinct("actor").alias("exact_users"))
        rolled = daily.distinct_users(sketches, unit)
        near = F.abs(F.col("number_active_users") - F.col("exact_users")) <= F.lit(0.03) * F.col("exact_users")
        part = rolled.join(exact, F.col("period") == F.col("p")).select(F.lit(unit).alias("unit"), F.col("period").cast("string").alias("period"), "n_events", "exact_users", near.alias("within_3_percent"))
        out = part if out is None else out.unionByName(part)
    return out


# ====================================================================== curves of each segment

_SEGMENT_CURVE_SQL = CHURN + "," + cat._features_sql("churn", ", CAST(second_period_event_count > 0.5 AS INTEGER) AS label") + cat._SCORED_SQL + """,
b AS (SELECT segment, round(p, 9) AS threshold, count(CASE WHEN label = 1 THEN 1 END) AS pos, count(CASE WHEN label <> 1 THEN 1 END) AS neg
      FROM scored WHERE p IS NOT NULL GROUP BY 1, 2),
cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY segment) AS P, sum(neg) OVER (PARTITION BY segment) AS N
        FROM b WINDOW w AS (PARTITION BY segment ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _segment_scores(spark, sf):
    scored = score_by_segment(cat._DECLARED, cat._declared_data(spark, sf), keep=("login", "label"))
    return scored.select("segment", F.round("p_active", 9).alias("p_active"), F.col("label").cast("int").alias("label"))


@q("m12_roc_by_segment", _SEGMENT_CURVE_SQL + """
SELECT segment, CAST('Infinity' AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr FROM (SELECT DISTINCT segment FROM b)
UNION ALL SELECT segment, round(threshold, 6), CASE WHEN N > 0 THEN round(fp * 1.0 / N, 6) END, CASE WHEN P > 0 THEN round(tp * 1.0 / P, 6) END FROM cum""")
def m12_roc_by_segment(spark, sf):
    """The ROC curve of each segment's own model, all in one job."""
    r = mdl.roc_curve(_segment_scores(spark, sf), by=("segment",))
    finite = F.when(F.col("threshold") == float("inf"), F.col("threshold")).otherwise(F.round("threshold", 6))
    return r.select("segment", finite.alias("threshold"), _r("fpr").alias("fpr"), _r("tpr").alias("tpr"))


@q("m12_pr_by_segment", _SEGMENT_CURVE_SQL + """
SELECT segment, round(threshold, 6) AS threshold, CASE WHEN P > 0 THEN round(tp * 1.0 / P, 6) END AS recall,
       round(tp * 1.0 / (tp + fp), 6) AS precision FROM cum""")
def m12_pr_by_segment(spark, sf):
    r = mdl.pr_curve(_segment_scores(spark, sf), by=("segment",))
    return r.select("segment", _r("threshold").alias("threshold"), _r("recall").alias("recall"), _r("precision").alias("precision"))


@q("m12_auc_by_segment", _SEGMENT_CURVE_SQL + """
SELECT segment, round(sum(CASE WHEN P > 0 AND N > 0 THEN neg * 1.0 / N * (2.0 * tp - pos) / (2.0 * P) END), 6) AS auc_roc,
       round(sum(CASE WHEN P > 0 THEN pos * 1.0 / P * tp / (tp + fp) END), 6) AS auc_pr FROM cum GROUP BY segment""")
def m12_auc_by_segment(spark, sf):
    a = mdl.auc(_segment_scores(spark, sf), by=("segment",))
    return a.select("segment", _r("auc_roc").alias("auc_roc"), _r("auc_pr").alias("auc_pr"))


# ====================================================================== weighted Lloyd

_ROUNDS = 6
_START = ((2.0, 5.0), (3.2, 7.0))


def _lloyd_sql() -> str:
    far = [" + ".join(f"(u{i} / 1e9 - {{c}}.x{p}{i}) * (u{i} / 1e9 - {{c}}.x{p}{i})" for i in range(2)) for p in range(2)]
    steps = ["c0 AS (SELECT " + ", ".join(f"CAST({_START[p][i]} AS DOUBLE) AS x{p}{i}" for p in range(2) for i in range(2)) + ")"]
    for t in range(1, _ROUNDS + 1):
        before = f"c{t - 1}"
        steps.append(f"a{t} AS (SELECT pts.*, CASE WHEN ({far[1].format(c=before)}) < ({far[0].format(c=before)}) THEN 1 ELSE 0 END AS k FROM pts, {before})")
        new = ", ".join(f"coalesce(CAST(sum(u{i} * weight) FILTER (k = {p}) AS DOUBLE) / (CAST(sum(weight) FILTER (k = {p}) AS DOUBLE) * 1e9), any_value({before}.x{p}{i})) AS x{p}{i}"
                        for p in range(2) for i in range(2))
        steps.append(f"c{t} AS (SELECT {new} FROM a{t}, {before})")
    last = f"c{_ROUNDS}"
    return CHURN + f""",
pts AS (SELECT CAST(round(ln(frequency + 1) * 1e9) AS HUGEINT) AS u0, CAST(round(ln(recency + 1) * 1e9) AS HUGEINT) AS u1, count(*) AS weight
        FROM churn WHERE company = 0 AND recency > -1 GROUP BY 1, 2),
{", ".join(steps)},
f AS (SELECT pts.*, CASE WHEN ({far[1].format(c=last)}) < ({far[0].format(c=last)}) THEN 1 ELSE 0 END AS k,
             least({far[0].format(c=last)}, {far[1].format(c=last)}) AS far FROM pts, {last}),
s AS (SELECT k AS cluster, CAST(sum(weight) AS BIGINT) AS n_users FROM f GROUP BY k)
SELECT CAST(p AS INTEGER) AS cluster, round(CASE p WHEN 0 THEN x00 ELSE x10 END, 6) AS frequency, round(CASE p WHEN 0 THEN x01 ELSE x11 END, 6) AS recency,
       coalesce(n_users, 0) AS n_users, (SELECT round(sum(far * weight), 6) FROM f) AS wssse
FROM {last}, range(2) r(p) LEFT JOIN s ON s.cluster = p"""


def _lloyd(spark, sf, rounds: int = _ROUNDS):
    feats = feature_table(cat._churn(spark, sf), SPEC)
    points, _ = stored_table(compressed_points(feats, ("frequency", "recency"), F.col("company") == 0), "points")
    return weighted_lloyd(points, ("frequency", "recency"), _START, rounds, until_stable=False)


@q("m4_weighted_lloyd", _lloyd_sql())
def m4_weighted_lloyd(spark, sf):
    """K-means of the non-company users by exact rounds over distinct (frequency, recency) points, from declared centres."""
    got = _lloyd(spark, sf)
    rows = [(c, *(round(x, 6) for x in p), n, round(got.cost, 6)) for c, (p, n) in enumerate(zip(got.centres.points, got.sizes))]
    return spark.createDataFrame(rows, "cluster int, frequency double, recency double, n_users long, wssse double")


# ====================================================================== shared-scan grid search

def _candidates(values: dict) -> list[grid.Candidate]:
    """The grid in the order of its parameters; the numbers of iterations make candidates of their own with the same optimum."""
    return [grid.Candidate(reg, mix) for mix, reg, _ in itertools.product(values["elasticNetParam"], values["regParam"], values["maxIter"])]


def _searched(spark, sf) -> grid.Search:
    def build():
        _, data = cached_segmented_features(spark, sf, SPEC)
        train, _ = hash_split(data, "login", 0.7, 2018)
        return grid.search(train, feature_columns(data, SPEC), _candidates(mdl.GRID_FULL))
    return memoized(spark, ("grid", sf), build)


def _searched_weighted(spark, sf) -> grid.Search:
    def build():
        _, data = cached_segmented_features(spark, sf, SPEC)
        train, _ = hash_split(class_weights(data, "label"), "login", 0.7, 2018)
        return grid.search(train, feature_columns(data, SPEC), [*_candidates(mdl.GRID_BALANCED), grid.Candidate(0.03)], weight="class_weight")
    return memoized(spark, ("grid-weighted", sf), build)


def _cv_rows(spark, found: grid.Search):
    return spark.createDataFrame([(i, float(a)) for i, a in enumerate(found.areas)], "candidate int, avg_auc double")


@q("m14_cross_validation")
def m14_cross_validation(spark, sf):
    """18 candidates, 5 folds: mean area under ROC of each candidate, all fitted in the same passes."""
    return _cv_rows(spark, _searched(spark, sf))


@q("m14_weighted_cross_validation")
def m14_weighted_cross_validation(spark, sf):
    """12 class-weighted candidates, then the one setting of the unsearched fit, 5 folds."""
    return _cv_rows(spark, _searched_weighted(spark, sf))


@q("m14_best_on_test")
def m14_best_on_test(spark, sf):
    """The best model of the search, fitted on all training rows, on the test side."""
    _, data = cached_segmented_features(spark, sf, SPEC)
    _, test = hash_split(data, "login", 0.7, 2018)
    return mdl.auc(test.select(_searched(spark, sf).best.probability().alias("p"), "label"), "p", "label")


@q("m14_optimality", "SELECT CAST(c.range AS INTEGER) AS candidate, CAST(h.range AS INTEGER) AS held_fold, TRUE AS optimal FROM range(18) c, range(6) h")
def m14_optimality(spark, sf):
    """Whether each fit meets the optimality conditions of its convex problem to 1e-8 (held_fold 5: none held out)."""
    got = _searched(spark, sf).residuals
    return spark.createDataFrame([(i, f, bool(got[i, f] <= 1e-8)) for i in range(got.shape[0]) for f in range(got.shape[1])],
                                 "candidate int, held_fold int, optimal boolean")


# ====================================================================== correlation of large values

_LARGE = ("first_s", "last_s", "id", "frequency")


@q("a8_correlation_large_means", CHURN + """,
x AS (SELECT 1.0 * date_diff('second', TIMESTAMP '1970-01-01', first_event) AS first_s, 1.0 * date_diff('second', TIMESTAMP '1970-01-01', last_event) AS last_s,
             login + 1e12 AS id, 1.0 * frequency AS frequency FROM churn),
c AS (SELECT first_s - (SELECT avg(first_s) FROM x) AS first_s, last_s - (SELECT avg(last_s) FROM x) AS last_s,
             id - (SELECT avg(id) FROM x) AS id, frequency - (SELECT avg(frequency) FROM x) AS frequency FROM x)
""" + "\nUNION ALL\n".join(f"SELECT '{a}' AS c1, '{b}' AS c2, round(corr({a}, {b}), 6) AS r FROM c" for a, b in itertools.combinations(_LARGE, 2)))
def a8_correlation_large_means(spark, sf):
    """Correlations of epoch seconds and large ids, whose means are far larger than their spread."""
    seconds = [F.floor(F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000).cast("double").alias(n) for c, n in (("first_event", "first_s"), ("last_event", "last_s"))]
    x = cat._churn(spark, sf).select(*seconds, (F.col("login") + F.lit(1e12)).alias("id"), F.col("frequency").cast("double").alias("frequency"))
    return stats.correlation_pairs(x, _LARGE).select("c1", "c2", _r("r").alias("r"))


# ====================================================================== batch ledger

@q("o7_batch_ledger", f"""
WITH c AS (SELECT DISTINCT user_id AS actor FROM events WHERE {cat.FIRST}),
r AS (SELECT actor, row_number() OVER (ORDER BY {cat._hash_sql('actor', 7)}, actor) - 1 AS n FROM c
      WHERE actor NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD'))
SELECT CAST(n // 4 AS INTEGER) AS batch, actor, CAST(n % 4 AS INTEGER) AS place, run FROM r, (VALUES (1), (2)) t(run)
WHERE n < 12 AND (run = 1 OR n // 4 = 1)""")
def o7_batch_ledger(spark, sf):
    """Three fetch batches, the second asked for again at the end."""
    cand = act.activity_profile(cat._ev(spark, sf), *SPEC.first_period, spec=SPEC).select("actor")
    known = read_table(spark, sf, "customer").where(F.col("c_mktsegment") == "HOUSEHOLD").select(F.col("c_custkey").alias("actor"))
    path, out = cat._file(spark, "ledger"), None
    for batch, run in ((0, 1), (1, 1), (2, 1), (1, 2)):
        got = fetch_batch(cand, known, "actor", 4, f"hour {batch}", path, seed=7)
        got = got.select(F.lit(batch).alias("batch"), "actor", "place", F.lit(run).alias("run"))
        out = got if out is None else out.unionByName(got)
    return out


# ====================================================================== payload as VARIANT

_PAYLOAD = """CASE WHEN event_id % 11 = 0 THEN substr(props, 1, 3)
    ELSE '{"k": ' || json_extract_string(props, '$.k') || ', "tags": ["' || event_type || '", "x"], "by": {"id": ' || user_id || '}}' END"""


def _payloads(spark, sf):
    """The log with nested payloads, some of them cut off."""
    k = F.get_json_object("payload", "$.k")
    text = F.concat(F.lit('{"k": '), k, F.lit(', "tags": ["'), F.col("type"), F.lit('", "x"], "by": {"id": '), F.col("actor").cast("string"), F.lit("}}"))
    cut = F.when(F.col("event_id") % 11 == 0, F.substring("payload", 1, 3)).otherwise(text)
    return act.with_payload(cat._ev(spark, sf).select("event_id", cut.alias("payload")))


@q("a5_variant_fields", f"""
WITH e AS (SELECT event_id, {_PAYLOAD} AS payload FROM events),
v AS (SELECT event_id, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS j FROM e)
SELECT event_id, CAST(json_extract_string(j, '$.k') AS BIGINT) AS k, json_extract_string(j, '$.tags[0]') AS tag,
       CAST(json_extract_string(j, '$.by.id') AS BIGINT) AS by_id, json_extract_string(j, '$.none') AS missing FROM v""")
def a5_variant_fields(spark, sf):
    """Several paths of the payload from one parse, malformed payloads and nested arrays included."""
    fields = {"k": ("$.k", "bigint"), "tag": ("$.tags[0]", "string"), "by_id": ("$.by.id", "bigint"), "missing": ("$.none", "string")}
    return act.payload_fields(_payloads(spark, sf), fields).select("event_id", *fields)


@q("a5_variant_schema", f"""
WITH e AS (SELECT {_PAYLOAD} AS payload FROM events)
SELECT 'OBJECT<by: OBJECT<id: BIGINT>, k: BIGINT, tags: ARRAY<STRING>>' AS schema, count(CASE WHEN json_valid(payload) THEN 1 END) AS n_parsed FROM e""")
def a5_variant_schema(spark, sf):
    return act.payload_schema(_payloads(spark, sf))


# ====================================================================== co-located merge

@q("m24_colocated_merge", cat.ORACLE["m24_churn_table"])
def m24_colocated_merge(spark, sf):
    """The churn table from profiles and period profiles that are stored bucketed by user."""
    def build():
        mark = uuid.uuid4().hex
        profiles = stored_user_profiles(spark, sf)
        buckets = tasks_for(profiles, least=8)
        users = store_by_user(profiles, f"users_{mark}", "login", buckets)
        return users, store_by_user(act.two_period_profile(cat._ev(spark, sf), SPEC, public_only=True), f"periods_{mark}", "actor", buckets)
    users, periods = memoized(spark, ("colocated", sf), build)
    return colocated_churn_table(users, periods, SPEC)


# ====================================================================== days from a period table

_PERIODS = {"first": SPEC.first_period, "second": SPEC.second_period, "week": (dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 22))}


@q("s2_profiles_of_periods", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS period, user_id AS actor, {sq.profile_select_sql(SPEC)} FROM events WHERE {sq.in_period_sql(p)} GROUP BY user_id"
    for name, p in _PERIODS.items()))
def s2_profiles_of_periods(spark, sf):
    """Profiles of three overlapping periods in one pass over a log laid out by day; the periods' days prune the scan."""
    def build():
        path = cat._file(spark, "events-by-day")
        write_parquet(cat._ev(spark, sf).withColumn("day", F.to_date("created_at")).repartition("day"), path, ["day"])
        return spark.read.parquet(path)
    by_day = memoized(spark, ("by-day", sf), build)
    every = act.period_days(spark, {**_PERIODS, "unused": (dt.datetime(2024, 1, 25), dt.datetime(2024, 1, 31))})
    return act.profiles_of_periods(by_day, every.where(F.col("period") != "unused"), SPEC)


# ====================================================================== joint density

@q("a11_joint_density", CHURN + """,
b AS (SELECT CAST(least(floor(frequency / CAST(4 AS DOUBLE)), 9) AS INTEGER) AS x_bin, CAST(least(floor((recency - 8000) / CAST(300 AS DOUBLE)), 9) AS INTEGER) AS y_bin
      FROM churn WHERE frequency BETWEEN 0 AND 40 AND recency BETWEEN 8000 AND 11000),
g AS (SELECT CASE grouping(x_bin, y_bin) WHEN 0 THEN 'joint' WHEN 1 THEN 'x' ELSE 'y' END AS part, x_bin, y_bin, count(*) AS n
      FROM b GROUP BY GROUPING SETS ((x_bin, y_bin), (x_bin), (y_bin))),
t AS (SELECT * FROM (VALUES (-1, CAST(0.25 AS DOUBLE)), (0, CAST(0.5 AS DOUBLE)), (1, CAST(0.25 AS DOUBLE))) v(d, w)),
s1 AS (SELECT part, x_bin + d AS x_bin, y_bin, n * w AS s FROM g, t WHERE x_bin IS NOT NULL UNION ALL SELECT part, x_bin, y_bin, n FROM g WHERE x_bin IS NULL),
s2 AS (SELECT part, x_bin, y_bin + d AS y_bin, s * w AS s FROM s1, t WHERE y_bin IS NOT NULL AND (x_bin IS NULL OR x_bin BETWEEN 0 AND 9)
       UNION ALL SELECT part, x_bin, y_bin, s FROM s1 WHERE y_bin IS NULL AND x_bin BETWEEN 0 AND 9),
k AS (SELECT part, x_bin, y_bin, sum(s) AS s FROM s2 WHERE y_bin IS NULL OR y_bin BETWEEN 0 AND 9 GROUP BY ALL)
SELECT k.part, k.x_bin, k.y_bin, coalesce(g.n, 0) AS n, round(s, 6) AS smoothed
FROM k LEFT JOIN g ON k.part = g.part AND k.x_bin IS NOT DISTINCT FROM g.x_bin AND k.y_bin IS NOT DISTINCT FROM g.y_bin""")
def a11_joint_density(spark, sf):
    """Joint grid of frequency and recency with both margins and a smoothed density, counted in one pass."""
    d = stats.joint_density(cat._churn(spark, sf), "frequency", "recency", (0.0, 40.0), (8000.0, 11000.0), bins=10)
    return d.select("part", "x_bin", "y_bin", "n", _r("smoothed").alias("smoothed"))


# ====================================================================== registry, E14 on real probability vectors

def _declared_pipelines(spark):
    """The declared numbers as fitted pipelines: an assembler with a logistic regression, and one with K-means."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.clustering import KMeansModel
    from pyspark.ml.common import _py2java
    from pyspark.ml.linalg import Vectors
    from churnlens.plans.features import assembler
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm
    models = {}
    for name, m in cat._DECLARED.items():
        java = jvm.org.apache.spark.ml.classification.LogisticRegressionModel(f"declared_{name}", _py2java(sc, Vectors.dense([w for _, w in m.weights])), m.intercept)
        lr = LogisticRegressionModel(java)
        lr._resetUid(java.uid())
        lr._transfer_params_from_java()
        models[name] = PipelineModel(stages=[assembler([f for f, _ in m.weights]), lr.setFeaturesCol("features").setThreshold(m.threshold)])
    centres = jvm.java.util.ArrayList()
    for p in cat._CENTRES.points:
        centres.add(jvm.org.apache.spark.mllib.linalg.Vectors.dense(p[0], sc._gateway.new_array(jvm.double, 0) if len(p) == 1 else _doubles(sc, p[1:])))
    java = jvm.org.apache.spark.ml.clustering.KMeansModel("declared_kmeans", jvm.org.apache.spark.mllib.clustering.KMeansModel(centres))
    km = KMeansModel(java)
    km._resetUid(java.uid())
    km._transfer_params_from_java()
    segments = PipelineModel(stages=[assembler(list(cat._CENTRES.inputs), "KMeans_features"), km.setFeaturesCol("KMeans_features").setPredictionCol("cluster")])
    return segments, models


def _doubles(sc, values):
    out = sc._gateway.new_array(sc._jvm.double, len(values))
    for i, v in enumerate(values):
        out[i] = float(v)
    return out


@q("k3_k4_e14_registry_round_trip", cat.ORACLE["m15_e14_e15_scores_declared"])
def k3_k4_e14_registry_round_trip(spark, sf):
    """Models published to a registry, loaded without anything else, and applied to the churn table: P(active) is the
    second element of each model's probability vector."""
    from churnlens.api import TrainedModels
    from churnlens.functions.columns import vector_element, verdict
    from churnlens.plans import registry
    from churnlens.plans.routing import inputs_of
    from churnlens.plans.segments import assign_segments
    root = cat._file(spark, "registry")
    segments, models = _declared_pipelines(spark)
    registry.publish(spark, root, TrainedModels(segments, models, inputs_of(cat._DECLARED)), SPEC, data_state=sf)
    held = registry.load(spark, root)
    table = registry.check_features(held, feature_table(cat._churn(spark, sf), held.spec))
    data, out = assign_segments(held.trained.segment_model, table), None
    for name, model in held.trained.models.items():
        part = model.transform(data.where(F.col("segment") == name)).select(
            "login", "segment", vector_element("probability", 1).alias("p"), F.col("prediction").cast("int").alias("prediction"))
        out = part if out is None else out.unionByName(part)
    return out.select("login", "segment", _r("p").alias("p_active"), "prediction", verdict("p").alias("verdict"))


def _declared_weights_sql() -> str:
    rows = ", ".join(f"('{name}', '{f}', CAST({w} AS DOUBLE))" for name, m in cat._DECLARED.items() for f, w in m.weights)
    return f"(VALUES {rows}) t(segment, feature, weight)"


@q("m13_o4_o5_declared_coefficients", f"""
SELECT segment, feature, weight, CAST(row_number() OVER (PARTITION BY segment ORDER BY weight DESC, feature) AS INTEGER) AS from_top,
       CAST(row_number() OVER (PARTITION BY segment ORDER BY weight, feature) AS INTEGER) AS from_bottom FROM {_declared_weights_sql()}""")
def m13_o4_o5_declared_coefficients(spark, sf):
    """The coefficient table of each segment's pipeline, with the place of each feature from both ends."""
    from pyspark.sql import Window
    out = None
    for name, model in _declared_pipelines(spark)[1].items():
        part = mdl.coefficient_table(spark, model, model.stages[0].getInputCols()).withColumn("segment", F.lit(name))
        out = part if out is None else out.unionByName(part)
    by = Window.partitionBy("segment")
    return out.select("segment", "feature", "weight", F.row_number().over(by.orderBy(F.desc("weight"), "feature")).alias("from_top"),
                      F.row_number().over(by.orderBy("weight", "feature")).alias("from_bottom"))


# ====================================================================== optimality of the lifetime fit

@q("m20_k5_fit_is_optimal", "SELECT TRUE AS converged, TRUE AS optimal_or_boundary, TRUE AS positive")
def m20_k5_fit_is_optimal(spark, sf):
    """The stored parameters, reloaded: the gradient at the returned point is flat, or a parameter ran to its boundary."""
    path = cat._file(spark, "bgnbd")
    cat.QUERIES["m20_bgnbd_fit"](spark, sf).write.parquet(path)
    p = spark.read.parquet(path)
    return p.select("converged", ((F.col("gradient") < 1e-6) | F.col("at_boundary")).alias("optimal_or_boundary"),
                    ((F.least("r", "alpha", "a", "b") > 0)).alias("positive"))
