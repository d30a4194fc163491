"""Special functions for the lifetime model.

``lgamma`` and ``digamma`` are plain column expressions (shift by 8, then the
asymptotic series) for evaluating the BG/NBD likelihood of fixed parameters
inside whole-stage codegen; ``lgamma_np``/``digamma_np`` are the same
formulas in numpy, used by the fit per partition (an optimiser step changes
the parameters, and literals in a column expression would force new
generated code every step).  ``hyp2f1_np`` sums the Gauss series for the vectorised
``pandas_udf`` of expected purchases.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_SHIFT = 8
_HALF_LN_2PI = 0.5 * math.log(2.0 * math.pi)


def _lit(x):
    return x if isinstance(x, Column) else F.lit(float(x))


def lgamma(z) -> Column:
    """ln Γ(z) for z > 0, absolute error below 1e-11."""
    z = _lit(z).cast("double")
    w = z + F.lit(float(_SHIFT))
    w2 = w * w
    stirling = ((w - 0.5) * F.log(w) - w + F.lit(_HALF_LN_2PI)
                + (F.lit(1.0) / 12.0 - (F.lit(1.0) / 360.0 - (F.lit(1.0) / 1260.0
                   - F.lit(1.0) / (1680.0 * w2)) / w2) / w2) / w)
    prod = z
    for k in range(1, _SHIFT):
        prod = prod * (z + float(k))
    return stirling - F.log(prod)


def digamma(z) -> Column:
    """ψ(z) = d ln Γ(z)/dz for z > 0, absolute error below 1e-11."""
    z = _lit(z).cast("double")
    w = z + F.lit(float(_SHIFT))
    iw2 = F.lit(1.0) / (w * w)
    asym = (F.log(w) - F.lit(0.5) / w
            - iw2 * (F.lit(1.0 / 12) - iw2 * (F.lit(1.0 / 120) - iw2 * (F.lit(1.0 / 252)
                     - iw2 * F.lit(1.0 / 240)))))
    shift = F.lit(0.0)
    for k in range(_SHIFT):
        shift = shift + F.lit(1.0) / (z + float(k))
    return asym - shift


def lgamma_np(z) -> np.ndarray:
    """numpy twin of :func:`lgamma` (same shift and series)."""
    z = np.asarray(z, dtype="float64")
    w = z + _SHIFT
    w2 = w * w
    stirling = ((w - 0.5) * np.log(w) - w + _HALF_LN_2PI
                + (1.0 / 12.0 - (1.0 / 360.0 - (1.0 / 1260.0 - 1.0 / (1680.0 * w2)) / w2) / w2) / w)
    prod = z.copy()
    for k in range(1, _SHIFT):
        prod = prod * (z + k)
    return stirling - np.log(prod)


def digamma_np(z) -> np.ndarray:
    """numpy twin of :func:`digamma`."""
    z = np.asarray(z, dtype="float64")
    w = z + _SHIFT
    iw2 = 1.0 / (w * w)
    asym = np.log(w) - 0.5 / w - iw2 * (1.0 / 12 - iw2 * (1.0 / 120 - iw2 * (1.0 / 252 - iw2 / 240)))
    shift = np.zeros_like(z)
    for k in range(_SHIFT):
        shift = shift + 1.0 / (z + k)
    return asym - shift


def hyp2f1_np(a, b, c, z, tol: float = 1e-15, max_terms: int = 500_000) -> np.ndarray:
    """Gauss ₂F₁(a, b; c; z) for 0 <= z < 1, elementwise on numpy arrays.

    NaN where the series has not settled after ``max_terms`` terms.
    """
    a, b, c, z = (np.asarray(v, dtype="float64") for v in np.broadcast_arrays(a, b, c, z))
    total = np.ones_like(z)
    term = np.ones_like(z)
    active = np.ones(z.shape, dtype=bool)
    n = 0
    while active.any() and n < max_terms:
        idx = np.nonzero(active)[0] if z.ndim else None
        if z.ndim == 0:
            term = term * (a + n) * (b + n) / ((c + n) * (n + 1)) * z
            total = total + term
            active = np.asarray(abs(term) > tol * abs(total))
        else:
            t = term[idx] * (a[idx] + n) * (b[idx] + n) / ((c[idx] + n) * (n + 1)) * z[idx]
            term[idx] = t
            total[idx] += t
            # a term can be exactly 0 when a or b is a non-positive integer: series ends
            active[idx] = np.abs(t) > tol * np.abs(total[idx])
        n += 1
    return np.where(active, np.nan, total)
