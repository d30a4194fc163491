"""Lifetime model: special functions, BG/NBD likelihood/gradient, predictions, summary."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.functions.special import digamma, digamma_np, hyp2f1_np, lgamma, lgamma_np
from churnlens.plans.lifetime import (BGNBDParams, _objectives, bgnbd_terms, compress,
                                      expected_purchases_np, fit_bgnbd, lifetime_summary, p_alive,
                                      score_lifetime)

ZS = [0.01, 0.3, 1.0, 2.5, 7.0, 40.0, 250.0]


def test_lgamma_digamma_numpy():
    for z in ZS:
        assert lgamma_np(z) == pytest.approx(math.lgamma(z), abs=1e-10)
        h = 1e-4 * z
        num = (math.lgamma(z + h) - math.lgamma(z - h)) / (2 * h)
        assert digamma_np(z) == pytest.approx(num, rel=1e-7, abs=1e-7)
    assert digamma_np(1.0) == pytest.approx(-0.5772156649015329, abs=1e-11)


def test_lgamma_digamma_columns(spark):
    df = spark.createDataFrame([(z,) for z in ZS], "z double")
    r = df.select("z", lgamma(F.col("z")).alias("lg"), digamma(F.col("z")).alias("dg")).collect()
    for row in r:
        assert row.lg == pytest.approx(math.lgamma(row.z), abs=1e-10)
        assert row.dg == pytest.approx(float(digamma_np(row.z)), abs=1e-12)


def test_hyp2f1_closed_forms():
    z = np.array([0.0, 0.2, 0.7, 0.95, 0.995])
    got = hyp2f1_np(1.0, 1.0, 2.0, z)
    want = np.where(z == 0, 1.0, -np.log1p(-z) / np.where(z == 0, 1, z))
    assert np.allclose(got, want, rtol=1e-10)
    # (1 - z)^-a = 2F1(a, b; b; z)
    assert np.allclose(hyp2f1_np(2.5, 3.0, 3.0, z[:4]), (1 - z[:4]) ** -2.5, rtol=1e-10)


def _ll_plain(r, al, a, b, x, tx, T):
    lg = math.lgamma
    a1 = lg(r + x) - lg(r) + r * math.log(al)
    a2 = lg(a + b) + lg(b + x) - lg(b) - lg(a + b + x)
    a3 = -(r + x) * math.log(al + T)
    s = math.exp(a3)
    if x > 0:
        s += math.exp(math.log(a) - math.log(b + x - 1) - (r + x) * math.log(al + tx))
    return a1 + a2 + math.log(s)


CASES = [(0, 0.0, 5.0), (1, 2.0, 5.0), (3, 4.5, 6.0), (12, 30.0, 38.0), (40, 51.0, 52.0)]
PARAMS = [(0.25, 4.0, 0.8, 2.5), (2.0, 10.0, 1.7, 0.6)]


@pytest.mark.parametrize("params", PARAMS)
def test_likelihood_matches_plain_python(params):
    x, tx, T = map(np.array, zip(*CASES))
    ll, _ = bgnbd_terms(params, x, tx, T)
    for i, (xi, txi, Ti) in enumerate(CASES):
        assert ll[i] == pytest.approx(_ll_plain(*params, xi, txi, Ti), abs=1e-9)


@pytest.mark.parametrize("params", PARAMS)
def test_gradient_matches_finite_differences(params):
    x, tx, T = map(np.array, zip(*CASES))
    _, g = bgnbd_terms(params, x, tx, T)
    for j in range(4):
        h = 1e-6 * params[j]
        up, dn = list(params), list(params)
        up[j] += h
        dn[j] -= h
        fd = (bgnbd_terms(up, x, tx, T)[0] - bgnbd_terms(dn, x, tx, T)[0]) / (2 * h)
        assert np.allclose(g[j], fd, rtol=1e-5, atol=1e-7)


def _quadrature_expectation(t, r, al, a, b, x, tx, T, n=400_000):
    """E[X(t)|x,tx,T] = P(alive) * ∫ (1/p)[1-((α+T)/(α+T+pt))^(r+x)] Beta(p; a, b+x) dp."""
    u = (np.arange(n) + 0.5) / n
    k = 4.0
    d = u ** k + (1 - u) ** k       # concentrate nodes near both ends of [0, 1]
    p = u ** k / d
    q = (1 - u) ** k / d            # 1 - p without cancellation
    jac = k * u ** (k - 1) * (1 - u) ** (k - 1) / d ** 2
    logb = math.lgamma(a) + math.lgamma(b + x) - math.lgamma(a + b + x)
    dens = np.exp((a - 1) * np.log(p) + (b + x - 1) * np.log(q) - logb)
    inner = (1 - ((al + T) / (al + T + p * t)) ** (r + x)) / p
    integral = np.sum(inner * dens * jac) / n
    odds = a / (b + x - 1) * ((al + T) / (al + tx)) ** (r + x) if x > 0 else 0.0
    return integral / (1 + odds)


@pytest.mark.parametrize("params", PARAMS)
@pytest.mark.parametrize("case", CASES)
def test_expected_purchases_vs_quadrature(params, case):
    x, tx, T = case
    got = expected_purchases_np(22.0, *params, np.array([x]), np.array([tx]), np.array([T]))[0]
    want = _quadrature_expectation(22.0, *params, x, tx, T)
    assert got == pytest.approx(want, rel=2e-4)


def test_p_alive_column(spark):
    prm = BGNBDParams(0.25, 4.0, 0.8, 2.5)
    df = spark.createDataFrame([(float(x), tx, T) for x, tx, T in CASES], "frequency double, recency double, T double")
    got = [r.p for r in df.select(p_alive(prm).alias("p")).collect()]
    for (x, tx, T), g in zip(CASES, got):
        want = 1.0 if x == 0 else 1 / (1 + 0.8 / (2.5 + x - 1) * ((4 + T) / (4 + tx)) ** (0.25 + x))
        assert g == pytest.approx(want, rel=1e-12)
        assert 0.0 <= g <= 1.0


def _simulate(rng, n, r, al, a, b, T):
    lam = rng.gamma(r, 1.0 / al, n)
    p = rng.beta(a, b, n)
    xs, txs = np.zeros(n), np.zeros(n)
    for i in range(n):
        t, x, tx = 0.0, 0, 0.0
        while True:
            t += rng.exponential(1.0 / lam[i])
            if t > T:
                break
            x, tx = x + 1, t
            if rng.random() < p[i]:
                break
        xs[i], txs[i] = x, tx
    return xs, txs


def test_parameter_recovery(spark):
    rng = np.random.default_rng(42)
    true = (0.6, 3.0, 0.9, 2.4)
    x, tx = _simulate(rng, 4000, *true, T=40.0)
    rows = [(i, float(a), float(round(b, 1)), 40.0) for i, (a, b) in enumerate(zip(x, tx))]
    summ = spark.createDataFrame(rows, "login long, frequency double, recency double, T double")
    fit = fit_bgnbd(summ)
    assert fit.converged
    table = compress(summ)
    f_fit = _objectives(table, [np.log([fit.r, fit.alpha, fit.a, fit.b])], 1e-8)[0][0]
    f_true = _objectives(table, [np.log(true)], 1e-8)[0][0]
    assert f_fit <= f_true + 1e-9
    for got, want in zip((fit.r, fit.alpha, fit.a, fit.b), true):
        assert want / 2 < got < want * 2
    scored = score_lifetime(summ, fit, 22.0).agg(F.min("probability_alive").alias("lo"),
                                                 F.max("probability_alive").alias("hi"),
                                                 F.min("predicted_purchases").alias("e")).first()
    assert 0 <= scored.lo <= scored.hi <= 1 and scored.e >= 0


def test_lifetime_summary_cleaning(spark):
    end, fill = dt.datetime(2017, 6, 1, 23, 59, 59), dt.datetime(2017, 1, 1, 1, 1, 1)
    cohort = spark.createDataFrame([
        (1, dt.datetime(2016, 1, 1)),    # active
        (2, dt.datetime(2016, 1, 1)),    # frequency 0 with recency > 0 -> recency 0
        (3, dt.datetime(2018, 1, 1)),    # T < 0 -> dropped
        (4, dt.datetime(2016, 1, 1)),    # absent from activity -> zeros
        (5, dt.datetime(2017, 5, 1))],   # last event before creation -> recency < 0 dropped
        "login long, created_at timestamp_ntz")
    activity = spark.createDataFrame([
        (1, dt.datetime(2017, 1, 2), dt.datetime(2017, 3, 1), 5, 2),
        (2, dt.datetime(2017, 1, 2), dt.datetime(2017, 3, 1), 0, 0),
        (3, dt.datetime(2017, 1, 2), dt.datetime(2017, 3, 1), 4, 1),
        (5, dt.datetime(2017, 1, 2), dt.datetime(2017, 3, 1), 4, 1)],
        "login long, first_event timestamp_ntz, last_event timestamp_ntz, frequency long, "
        "second_period_event_count long")
    out = {r.login: r for r in lifetime_summary(activity, cohort, end, fill, keep_absent=True).collect()}
    assert set(out) == {1, 2, 4}
    assert out[2].recency == 0.0 and out[4].frequency == 0.0 and out[4].recency == 0.0
    assert out[1].recency == pytest.approx(425 / 7) and out[1].T == pytest.approx(518 / 7)


@pytest.mark.parametrize("params", PARAMS)
def test_log_likelihood_column_matches_numpy(spark, params):
    from churnlens.plans.lifetime import log_likelihood
    df = spark.createDataFrame([(float(x), tx, T) for x, tx, T in CASES],
                               "frequency double, recency double, T double")
    got = [r.ll for r in df.select(log_likelihood(BGNBDParams(*params)).alias("ll")).collect()]
    want, _ = bgnbd_terms(params, *map(np.array, zip(*CASES)))
    assert np.allclose(got, want, atol=1e-9)


def test_series_that_does_not_settle_is_nan():
    assert np.isnan(hyp2f1_np(np.array([1.0]), np.array([1.0]), np.array([1.0]), np.array([0.999999]), max_terms=50)).all()


def test_expected_purchases_at_a_equal_one():
    from churnlens.plans.lifetime import expected_purchases_np
    x, tx, T = [0, 2, 9], [0.0, 5.0, 20.0], [8.0, 9.0, 22.0]
    at = expected_purchases_np(10.0, 0.5, 4.0, 1.0, 2.5, x, tx, T)
    near = [expected_purchases_np(10.0, 0.5, 4.0, a, 2.5, x, tx, T) for a in (0.999, 1.001)]
    assert np.isfinite(at).all() and np.allclose(at, (near[0] + near[1]) / 2, rtol=1e-5)


def test_absent_users_are_dropped_unless_kept(spark):
    when = dt.datetime(2024, 1, 1)
    cohort = spark.createDataFrame([(1, when), (2, when)], "login long, created_at timestamp_ntz")
    activity = spark.createDataFrame([(1, when, dt.datetime(2024, 1, 20), 3, 1)],
                                     "login long, first_event timestamp_ntz, last_event timestamp_ntz, frequency long, second_period_event_count long")
    end, fill = dt.datetime(2024, 2, 1), dt.datetime(2024, 1, 1, 1)
    assert [r.login for r in lifetime_summary(activity, cohort, end, fill).collect()] == [1]
    kept = {r.login: r.frequency for r in lifetime_summary(activity, cohort, end, fill, keep_absent=True).collect()}
    assert kept == {1: 3.0, 2: 0.0}
