"""Customer lifetime model: summary, BG/NBD fit, predictions.

BG/NBD (Fader, Hardie & Lee 2005).  Per customer with x repeat events, last
event at t_x and age T (weeks):

    ln L = lnΓ(r+x) - lnΓ(r) + r ln α
         + lnΓ(a+b) + lnΓ(b+x) - lnΓ(b) - lnΓ(a+b+x)
         + ln[ (α+T)^-(r+x) + [x>0] a/(b+x-1) (α+t_x)^-(r+x) ]

The fit compresses customers to distinct ``(x, t_x, T)`` with a weight,
checkpoints that table, and evaluates the likelihood AND its analytic
gradient as one Spark job per optimiser step (numpy per partition, one
partial row per task and point).  Only the 4 parameters live on the driver
(damped Newton with a finite-difference Hessian and back-tracking).
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from churnlens.functions.columns import frac_days
from churnlens.functions.special import digamma_np, hyp2f1_np, lgamma, lgamma_np


# ------------------------------------------------------------------ summary

def lifetime_summary(activity: DataFrame, cohort: DataFrame, end: dt.datetime,
                     fill_ts: dt.datetime, keep_absent: bool = False) -> DataFrame:
    """(login, frequency, recency, T, second_period_event_count), weeks.

    ``cohort`` (login, created_at) is the earlier analysis, ``activity``
    (login, first_event, last_event, frequency, second_period_event_count)
    the later one.  Cohort users without later activity are dropped, as the
    reference's null ``login`` makes it do; ``keep_absent`` keeps them with 0
    events and a filler timestamp.  T is rounded half-even, recency floored, recency = 0 when frequency = 0, rows with
    T < 0 or recency < 0 dropped.
    """
    coh = cohort.select("login", "created_at").dropDuplicates(["login"])
    act = activity.select("login", "first_event", "last_event", "frequency",
                          "second_period_event_count")
    j = coh.join(act, "login", "left" if keep_absent else "inner")
    last = F.coalesce(F.col("last_event"), F.lit(fill_ts))
    freq = F.coalesce(F.col("frequency"), F.lit(0)).cast("double")
    sec = F.coalesce(F.col("second_period_event_count"), F.lit(0)).cast("double")
    t_days = F.bround(frac_days(F.lit(end), F.col("created_at")), 0)
    rec_days = F.floor(frac_days(last, F.col("created_at"))).cast("double")
    base = j.select("login", freq.alias("frequency"), rec_days.alias("recency"),
                    t_days.alias("T"), sec.alias("second_period_event_count"))
    base = base.dropna(how="any")
    rec = F.when(F.col("frequency") == 0, F.lit(0.0)).otherwise(F.col("recency"))
    return (base.where(F.col("T") >= 0)
            .withColumn("recency", rec)
            .where(F.col("recency") >= 0)
            .select("login", "frequency", (F.col("recency") / 7.0).alias("recency"),
                    (F.col("T") / 7.0).alias("T"), "second_period_event_count"))


# ------------------------------------------------------------------ fit

@dataclass
class BGNBDParams:
    r: float
    alpha: float
    a: float
    b: float
    neg_mean_log_lik: float = float("nan")
    iterations: int = 0
    converged: bool = False
    # Largest gradient component (log-parameters) at the end, and whether a
    # parameter has run to 0 or infinity, so that the optimum is not interior.
    gradient: float = float("nan")
    at_boundary: bool = False

    def as_row(self):
        return (self.r, self.alpha, self.a, self.b, self.neg_mean_log_lik, self.iterations,
                self.converged, self.gradient, self.at_boundary)


PARAMS_SCHEMA = ("r double, alpha double, a double, b double, neg_mean_log_lik double, "
                 "iterations int, converged boolean, gradient double, at_boundary boolean")


def bgnbd_terms(params, x, tx, T):
    """Per-row log-likelihood and its gradient w.r.t. (r, alpha, a, b) (numpy)."""
    r, al, a, b = (float(v) for v in params)
    x, tx, T = (np.asarray(v, dtype="float64") for v in (x, tx, T))
    pos = x > 0
    a3 = -(r + x) * np.log(al + T)
    bx1 = np.where(pos, b + x - 1, 1.0)
    a4 = np.where(pos, np.log(a) - np.log(bx1) - (r + x) * np.log(al + tx), -np.inf)
    m = np.maximum(a3, a4)
    w3, w4 = np.exp(a3 - m), np.exp(a4 - m)
    s = w3 + w4
    ll = (lgamma_np(r + x) - lgamma_np(r) + r * np.log(al)
          + lgamma_np(a + b) + lgamma_np(b + x) - lgamma_np(b) - lgamma_np(a + b + x)
          + m + np.log(s))
    g_r = (digamma_np(r + x) - digamma_np(r) + np.log(al)
           + (w3 * -np.log(al + T) + w4 * -np.log(al + tx)) / s)
    g_al = r / al + (w3 * (-(r + x) / (al + T)) + w4 * (-(r + x) / (al + tx))) / s
    g_a = digamma_np(a + b) - digamma_np(a + b + x) + (w4 / a) / s
    g_b = (digamma_np(a + b) + digamma_np(b + x) - digamma_np(b) - digamma_np(a + b + x)
           + (w4 * -(1.0 / bx1)) / s)
    return ll, (g_r, g_al, g_a, g_b)


def compress(summary: DataFrame) -> DataFrame:
    """Distinct (x, t_x, T) with their weight: the fit's working table."""
    return summary.groupBy(F.col("frequency").alias("x"), F.col("recency").alias("tx"),
                           F.col("T")).agg(F.count(F.lit(1)).cast("double").alias("n"))


_PARTIAL_SCHEMA = "w double, ll double, g0 double, g1 double, g2 double, g3 double"


def _objectives(table: DataFrame, thetas: list[np.ndarray], penalizer: float):
    """Objective and gradient (log-parameters) at several points in ONE job.

    Each partition of the compressed table returns one row of weighted sums
    per point (numpy inside the task; parameters travel in the closure, so
    nothing is re-compiled per step); Spark adds the partial rows.  The
    objective is the mean negative log-likelihood plus ``penalizer * Σ p²``.
    """
    ps = [np.exp(t) for t in thetas]
    k = len(ps)

    def partial_sums(batches):
        acc = np.zeros((k, 6))
        for pdf in batches:
            if len(pdf) == 0:
                continue
            n = pdf["n"].to_numpy()
            for i, p in enumerate(ps):
                with np.errstate(all="ignore"):
                    ll, grads = bgnbd_terms(p, pdf["x"], pdf["tx"], pdf["T"])
                acc[i] += [n.sum(), n @ ll, *[n @ g for g in grads]]
        yield pd.DataFrame({"point": np.arange(k, dtype="int32"),
                            **{c: acc[:, j] for j, c in enumerate(("w", "ll", "g0", "g1", "g2", "g3"))}})

    names = ("w", "ll", "g0", "g1", "g2", "g3")
    parts = table.mapInPandas(partial_sums, "point int, " + _PARTIAL_SCHEMA)
    tot = np.zeros((k, 6))
    for row in parts.groupBy("point").agg(*[F.sum(c).alias(c) for c in names]).collect():  # k rows
        tot[row["point"]] = [row[c] for c in names]
    out = []
    for i, p in enumerate(ps):
        w, ll = tot[i, 0], tot[i, 1]
        if not w or not math.isfinite(ll):
            out.append((float("inf"), np.zeros(4)))
            continue
        f = -ll / w + penalizer * float(np.sum(p ** 2))
        g = -tot[i, 2:] / w + 2 * penalizer * p
        out.append((f, g * p) if np.all(np.isfinite(g)) else (float("inf"), np.zeros(4)))
    return out


_STEPS = [2.0 ** -i for i in range(8)]
# A log-parameter beyond this (p < 1e-4 or p > 1e4) counts as run off to the boundary.
_FAR = math.log(1e4)
_H = 1e-4   # finite-difference step in log-parameter space


def _with_probes(theta: np.ndarray) -> list[np.ndarray]:
    """A point and its 8 central-difference probes (± h on each log-parameter)."""
    pts = [theta]
    for j in range(4):
        e = np.zeros(4)
        e[j] = _H
        pts += [theta + e, theta - e]
    return pts


def _hessian(res: list) -> np.ndarray:
    """Symmetrised finite-difference Hessian from the probes' gradients."""
    H = np.empty((4, 4))
    for j in range(4):
        H[:, j] = (res[1 + 2 * j][1] - res[2 + 2 * j][1]) / (2 * _H)
    return (H + H.T) / 2


def _newton_direction(g: np.ndarray, H: np.ndarray) -> np.ndarray:
    """Newton step on |H| (eigenvalues made positive), a descent direction
    even near saddles and flat ridges."""
    if not np.all(np.isfinite(H)):
        return -g
    w, V = np.linalg.eigh(H)
    w = np.maximum(np.abs(w), 1e-8 * max(1.0, np.max(np.abs(w))))
    return -(V @ ((V.T @ g) / w))


def fit_bgnbd(summary: DataFrame, penalizer: float = 1e-8, max_iter: int = 100,
              tol: float = 1e-7, ftol: float = 1e-10, init=(1.0, 1.0, 1.0, 1.0)) -> BGNBDParams:
    """Maximum-likelihood BG/NBD fit; the data never leaves the executors.

    Damped Newton on log-parameters with a finite-difference Hessian.  Each
    iteration is ONE Spark job that evaluates the objective and gradient at
    the 8 back-tracking step sizes and, for each, the 8 probes of its
    Hessian (72 points per pass over the compressed table).  The compressed
    table is checkpointed (reliable, in the cluster's checkpoint directory)
    so each step re-reads it instead of recomputing the summary lineage.
    """
    table = compress(summary).checkpoint(eager=True)
    theta = np.log(np.asarray(init, dtype=float))
    res = _objectives(table, _with_probes(theta), penalizer)
    f, g = res[0]
    H = _hessian(res)
    it, converged = 0, False
    for it in range(1, max_iter + 1):
        if np.linalg.norm(g, np.inf) < tol:
            converged = True
            break
        d = _newton_direction(g, H)
        if not g @ d < 0:
            d = -g
        chosen = None
        for scale in (1.0, 2.0 ** -8, 2.0 ** -16):
            steps = [scale * s for s in _STEPS]
            pts = [p for s in steps for p in _with_probes(theta + s * d)]
            res = _objectives(table, pts, penalizer)
            for i, s in enumerate(steps):
                fc, gc = res[9 * i]
                if fc <= f + 1e-4 * s * (g @ d):
                    chosen = (s, fc, gc, _hessian(res[9 * i: 9 * i + 9]))
                    break
            if chosen:
                break
        if chosen is None:
            converged = np.linalg.norm(g, np.inf) < 1e-4
            break
        s_, fc, gc, Hc = chosen
        f_prev = f
        theta, f, g, H = theta + s_ * d, fc, gc, Hc
        # No further improvement: also ends at a boundary optimum (a parameter
        # drifting towards 0 or infinity along a flat ridge).
        if abs(f_prev - f) <= ftol * max(1.0, abs(f)):
            converged = True
            break
    p = np.exp(theta)
    return BGNBDParams(*map(float, p), neg_mean_log_lik=float(f), iterations=it,
                       converged=bool(converged), gradient=float(np.linalg.norm(g, np.inf)),
                       at_boundary=bool(np.any(np.abs(theta) > _FAR)))


def params_frame(spark, params: BGNBDParams) -> DataFrame:
    """K5: the fitted parameters as a 1-row table (save with ``write_parquet``)."""
    return spark.createDataFrame([params.as_row()], PARAMS_SCHEMA)


# ------------------------------------------------------------------ predictions

def p_alive(params: BGNBDParams, x: str = "frequency", tx: str = "recency", T: str = "T") -> Column:
    """P(alive | x, t_x, T) — native column arithmetic."""
    r, al, a, b = (F.lit(v) for v in (params.r, params.alpha, params.a, params.b))
    xc, txc, Tc = F.col(x), F.col(tx), F.col(T)
    odds = F.exp(F.log(a) - F.log(b + xc - 1) + (r + xc) * (F.log(al + Tc) - F.log(al + txc)))
    return F.when(xc > 0, F.lit(1.0) / (F.lit(1.0) + odds)).otherwise(F.lit(1.0))


def log_likelihood(params: BGNBDParams, x: str = "frequency", tx: str = "recency",
                   T: str = "T") -> Column:
    """Per-customer BG/NBD log-likelihood at fixed parameters (column
    expression, codegen'd; model diagnostics and the exactness check of the
    column ``lgamma``)."""
    r, al, a, b = (F.lit(float(v)) for v in (params.r, params.alpha, params.a, params.b))
    xc, txc, Tc = F.col(x).cast("double"), F.col(tx).cast("double"), F.col(T).cast("double")
    a3 = -(r + xc) * F.log(al + Tc)
    a4 = F.log(a) - F.log(b + xc - 1) - (r + xc) * F.log(al + txc)
    mix = F.when(xc > 0, F.when(a4 > a3, a4 + F.log1p(F.exp(a3 - a4)))
                 .otherwise(a3 + F.log1p(F.exp(a4 - a3)))).otherwise(a3)
    return (lgamma(r + xc) - lgamma(r) + r * F.log(al)
            + lgamma(a + b) + lgamma(b + xc) - lgamma(b) - lgamma(a + b + xc) + mix)


def expected_purchases_np(t: float, r: float, al: float, a: float, b: float,
                          x, tx, T) -> np.ndarray:
    """E[X(t) | x, t_x, T] via the Gauss series (numpy, vectorised).

    a = 1 is a removable singularity: the value there is the mean of those
    beside it.
    """
    if abs(a - 1.0) < 1e-5:
        return (expected_purchases_np(t, r, al, 1.0 - 1e-4, b, x, tx, T)
                + expected_purchases_np(t, r, al, 1.0 + 1e-4, b, x, tx, T)) / 2
    x, tx, T = (np.asarray(v, dtype=float) for v in (x, tx, T))
    z = t / (al + T + t)
    A, B, C = r + x, b + x, a + b + x - 1
    euler = (a - 1 - r - x) < 0
    # Euler: (1-z)^(r+x) 2F1(A,B;C;z) = (1-z)^(a-1) 2F1(C-A, C-B; C; z)
    fa = np.where(euler, C - A, A)
    fb = np.where(euler, C - B, B)
    series = hyp2f1_np(fa, fb, C, z)
    log_pref = np.where(euler, (a - 1) * np.log1p(-z), (r + x) * np.log1p(-z))
    term = np.exp(log_pref) * series
    num = (a + b + x - 1) / (a - 1) * (1.0 - term)
    odds = np.where(x > 0, a / np.maximum(b + x - 1, 1e-300)
                    * np.exp((r + x) * (np.log(al + T) - np.log(al + tx))), 0.0)
    return num / (1.0 + odds)


def expected_purchases(params: BGNBDParams, t: float, x: str = "frequency",
                       tx: str = "recency", T: str = "T") -> Column:
    """Expected events in the next ``t`` weeks (vectorised pandas_udf)."""
    r, al, a, b = params.r, params.alpha, params.a, params.b

    @F.pandas_udf(DoubleType())
    def _ep(xs: pd.Series, txs: pd.Series, Ts: pd.Series) -> pd.Series:
        return pd.Series(expected_purchases_np(t, r, al, a, b, xs.to_numpy(), txs.to_numpy(),
                                               Ts.to_numpy()))

    return _ep(F.col(x).cast("double"), F.col(tx).cast("double"), F.col(T).cast("double"))


def score_lifetime(summary: DataFrame, params: BGNBDParams, horizon: float) -> DataFrame:
    """M21+M22+F8: predicted events, P(alive) and the alive flag per customer."""
    return summary.select("*", expected_purchases(params, horizon).alias("predicted_purchases"),
                          p_alive(params).alias("probability_alive")).withColumn(
        "alive", F.col("probability_alive") > 0.5)
