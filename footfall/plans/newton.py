"""No-intercept logit by Newton steps on a weighted triangular factor (M2).

At a point b every task reduces its rows to the triangular factor of [√w x, (y - p) / √w],
with p the fitted probability and w = p (1 - p); merged, this is the whole step: the least-length
solution of min |√w X d - (y - p) / √w|.  The factor has the condition of the weighted design
itself, where the normal matrix XᵀWX has its square, and a singular design (columns that are sums
of others) has a step all the same.  A step that lowers the likelihood is halved.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from footfall.plans.diagnostics import pseudo_solve
from footfall.plans.qr import packed_rows, triangular_factor

# Fitted log-odds beyond which every row is told apart with certainty.
SURE = 30.0


@dataclass
class Logit:
    coefficients: np.ndarray
    loglik: float
    steps: int
    converged: bool
    separated: bool         # the classes can be told apart exactly: no finite maximum
    rank: int


def _design(p: int, b: np.ndarray):
    """Rows [x, y] as rows of the weighted least-squares step, and what is summed beside."""
    def rows(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, y = z[:, :p], z[:, p]
        odds = x @ b
        fitted = 1.0 / (1.0 + np.exp(-np.clip(odds, -700, 700)))
        # the same root on both sides keeps the gradient exact where weights vanish
        root = np.maximum(np.sqrt(fitted * (1.0 - fitted)), 1e-8)
        loglik = -np.logaddexp(0.0, np.where(y > 0.5, -odds, odds)).sum()
        sure = (np.where(y > 0.5, odds, -odds) > SURE).sum()
        return np.column_stack([x * root[:, None], (y - fitted) / root]), np.array([loglik, sure])
    return rows


def fit_logit(df: DataFrame, features: list[str], label: str, max_steps: int = 35,
              tolerance: float = 1e-8) -> Logit:
    """The maximum-likelihood coefficients; rows with a null are skipped."""
    p, b = len(features), np.zeros(len(features))
    step, steps, last, rank = np.zeros(p), 0, -np.inf, 0
    separated = converged = False
    rows = packed_rows(df, [*features, label])
    while True:
        f = triangular_factor(rows, [*features, label], design=_design(p, b), sums=2)
        loglik, sure = f.sums
        if not f.n:
            return Logit(b, 0.0, 0, False, False, 0)
        if loglik < last - 1e-9 * abs(last) and np.abs(step).max() > 1e-12:
            step = step / 2         # too far
            b = b - step
            continue
        separated = bool(sure == f.n)
        if converged or separated or steps == max_steps:
            return Logit(b, float(loglik), steps, converged, separated, rank)
        last = loglik
        step, _, rank = pseudo_solve(f.r[:, :p], f.r[:, p])
        b = b + step
        steps += 1
        # the change of the fitted log-odds, which the length of the columns doesn't sway
        converged = bool(np.linalg.norm(f.r[:, :p] @ step) <= tolerance * np.sqrt(f.n))
