"""Sums of normal quantiles over runs of ranks, in closed form.

The plot position of rank r among n is u(r) = (r - 0.3175) / (n + 0.365), with a
position of its own for the first and the last rank. A value that occurs many
times holds a run of ranks, and what is wanted is the sum of their quantiles z(u)
and of their squares. No rank of a long run is spelled out:

* **The outermost ``TAIL`` ranks** at either end, where quantiles change fastest, are
  added one by one.
* **Long runs** are integrals with an end correction (Euler and Maclaurin, midpoints):
  the integral of z du is -phi(z), that of z^2 du is u - z phi(z).
* **Short runs**, whose integral would be a small difference of large numbers, are
  expanded around their middle rank; powers of the distances have closed sums.

Both use the derivatives by u, which are polynomials of z over powers of phi(z):
d(P / phi^k) / du = (P' + k z P) / phi^(k + 1).
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlint.functions.normal import normal_quantile

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ranks at either end that are added one by one.
TAIL = 32
#: A run is short if it has at most this share of the ranks between it and the nearer end.
SHORT = 0.03125
#: phi(0)
PEAK = 1.0 / math.sqrt(2.0 * math.pi)
#: Euler and Maclaurin's coefficients for midpoints, for odd derivatives.
CORRECTION = ((1, -1 / 24), (3, 7 / 5760), (5, -31 / 967680))


def derivatives(polynomial: list[float], order: int) -> list[list[float]]:
    """Numerators of the first derivatives of a polynomial of z by u, constant term first."""
    out, p = [], polynomial
    for k in range(order):
        slope = [i * c for i, c in enumerate(p)][1:]
        raised = [0.0] + [k * c for c in p]
        p = [
            (slope[i] if i < len(slope) else 0.0) + (raised[i] if i < len(raised) else 0.0)
            for i in range(max(len(slope), len(raised)))
        ]
        while len(p) > 1 and p[-1] == 0.0:
            p = p[:-1]
        out.append(p)
    return out


QUANTILE, SQUARE = [0.0, 1.0], [0.0, 0.0, 1.0]


def plot_position(rank: np.ndarray, n: int) -> np.ndarray:
    """Filliben's medians of the order statistics of ranks among ``n`` uniform values."""
    last = 0.5 ** (1.0 / n)
    return np.where(rank == n, last, np.where(rank == 1, 1.0 - last, (rank - 0.3175) / (n + 0.365)))


def _poly(coefficients: list[float], z: np.ndarray) -> np.ndarray:
    return np.polyval(coefficients[::-1], z)


def _around_middle(polynomial: list[float], z: np.ndarray, step: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The sum over ``w`` ranks in steps of ``step`` around the middle one's z."""
    n2, square = w * w, step * step
    # Sums of the 2nd, 4th and 6th powers of the distances from the middle.
    moments = ((2, 1 / 24, 1.0), (4, 1 / 5760, n2 * 3.0 - 7.0), (6, 1 / 967680, n2 * n2 * 3.0 - n2 * 18.0 + 31.0))
    terms, inner = derivatives(polynomial, 6), 0.0
    for k, factor, moment in reversed(moments):
        inner = (inner + factor * _poly(terms[k - 1], z) * moment) * square
    return w * (_poly(polynomial, z) + (n2 - 1.0) * inner)


def _end_correction(polynomial: list[float], z: np.ndarray, step: np.ndarray) -> np.ndarray:
    terms, out = derivatives(polynomial, 5), 0.0
    for k, factor in CORRECTION:
        out = out + factor * _poly(terms[k - 1], z) * step**k
    return out


def _tail_sums(first: np.ndarray, last: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the ranks of each run that are among the outermost."""
    ranks = np.unique(np.r_[np.arange(1, min(TAIL, n) + 1), np.arange(max(1, n - TAIL + 1), n + 1)])
    z = normal_quantile(plot_position(ranks, n))
    low, high = np.searchsorted(ranks, first, side="left"), np.searchsorted(ranks, last, side="right")
    sums = (np.r_[0.0, np.cumsum(x)] for x in (z, z * z))
    t, tt = (x[high] - x[low] for x in sums)
    return t, tt


def quantile_sums(first: np.ndarray, last: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the quantiles, and of their squares, of the ranks from ``first`` to ``last`` among ``n``."""
    t, tt = _tail_sums(first, last, n)
    low, high = np.maximum(first, TAIL + 1), np.minimum(last, n - TAIL)
    some = high >= low
    low, high = low[some].astype(np.float64), high[some].astype(np.float64)
    w, whole = high - low + 1.0, n + 0.365
    short = w <= SHORT * np.minimum(low, n + 1.0 - high)

    def z_and_step(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = normal_quantile((rank - 0.3175) / whole)
        phi = PEAK * np.exp(-0.5 * z * z)
        return z, phi, 1.0 / (whole * phi)

    sums = np.empty((2, len(w)))
    z, _, step = z_and_step(0.5 * (low + high)[short])
    za, pa, sa = z_and_step(low[~short] - 0.5)
    zb, pb, sb = z_and_step(high[~short] + 0.5)
    integrals = whole * (pa - pb), w[~short] - whole * (zb * pb - za * pa)
    for out, polynomial, integral in zip(sums, (QUANTILE, SQUARE), integrals):
        out[short] = _around_middle(polynomial, z, step, w[short])
        out[~short] = integral + _end_correction(polynomial, zb, sb) - _end_correction(polynomial, za, sa)
    t[some] += sums[0]
    tt[some] += sums[1]
    return t, tt


def _summed(first: pd.Series, last: pd.Series, n: pd.Series) -> pd.DataFrame:
    out = pd.DataFrame({"t": np.zeros(len(n)), "tt": np.zeros(len(n))})
    a, b, sizes = (x.to_numpy(np.int64) for x in (first, last, n))
    for size in np.unique(sizes):  # one for each variable
        rows = sizes == size
        t, tt = quantile_sums(a[rows], b[rows], int(size))
        out.loc[rows, "t"], out.loc[rows, "tt"] = t, tt
    return out


def sums_of_quantiles(first: str, last: str, n: str) -> Column:
    """The sums ``t`` of quantiles and ``tt`` of their squares over each run of ranks.

    ``first`` and ``last`` name the run's ranks, ``n`` the number of all values. The
    formulas are evaluated for whole batches: as one column expression they make a
    method too long to be compiled.
    """
    return F.pandas_udf(_summed, "t double, tt double")(first, last, n)
