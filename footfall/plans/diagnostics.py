"""Regression diagnostics: OLS inference table (M3), VIF (M4).

Both are solved from the triangular factor R of the design (``plans.qr``), one
distributed pass.  R has the design's own condition number; the normal matrix
would square it and lose the small directions beside a ``yyyymmdd`` column.

Columns are scaled to unit length to tell exact collinearity from nearly
collinear columns; the solution is then the one of least length in the original
coordinates, as a pseudo-inverse of the design gives.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.operators.folds import ORDERS
from footfall.plans.qr import triangular_factor
from footfall.session import cut_lineage

# Singular values of the unit-length design below this share of the largest are zero.
RANK_TOLERANCE = 1e-10
# A residual below this share of the column's length is zero: the column is collinear.
COLLINEAR_TOLERANCE = 1e-7


def pseudo_solve(r: np.ndarray, target: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray, int]:
    """Least-length solution of min ||r b - target||, pinv(rᵀr), and the rank."""
    length = np.linalg.norm(r, axis=0)
    scale = np.where(length > 0, length, 1.0)
    u, sv, vt = np.linalg.svd(r / scale)
    rank = int((sv > RANK_TOLERANCE * sv[0]).sum()) if len(sv) and sv[0] > 0 else 0
    v = vt[:rank].T / scale[:, None]
    beta = v @ ((u[:, :rank].T @ target) / sv[:rank])
    inverse = (v / sv[:rank] ** 2) @ v.T
    null = vt[rank:].T / scale[:, None]
    if null.shape[1]:
        basis, _ = np.linalg.qr(null)
        inside = np.eye(len(scale)) - basis @ basis.T
        beta, inverse = inside @ beta, inside @ inverse @ inside
    return beta, inverse, rank


def vif(df: DataFrame, features: list[str]) -> DataFrame:
    """(features, vif_factor): statsmodels' ``variance_inflation_factor`` for every column
    of a design without an added constant.

    VIFᵢ = xᵢᵀxᵢ / SSRᵢ, with SSRᵢ the residual sum of squares of xᵢ regressed on the other
    columns.  A column that the others give exactly has an infinite factor.
    """
    r = triangular_factor(df, features).r
    vals = []
    for i in range(len(features)):
        rest = np.delete(r, i, axis=1)
        left = r[:, i] - rest @ pseudo_solve(rest, r[:, i])[0] if rest.shape[1] else r[:, i]
        share = np.linalg.norm(left) / max(np.linalg.norm(r[:, i]), 1e-300)
        vals.append(float(share ** -2) if share > COLLINEAR_TOLERANCE else float("inf"))
    schema = T.StructType([T.StructField("features", T.StringType()),
                           T.StructField("vif_factor", T.DoubleType())])
    return df.sparkSession.createDataFrame(list(zip(features, vals)), schema)


def rounded(df: DataFrame, col: str = "vif_factor", digits: int = 1) -> DataFrame:
    """Half-even display rounding."""
    return df.withColumn(col, F.bround(col, digits))


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny, qab, qap, qam = 1e-300, a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10_000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < 1e-15:
            break
    return h


def _betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def t_two_sided_p(t: float, dof: float) -> float:
    """P(|T| >= |t|) for Student's t with ``dof`` degrees of freedom."""
    if not math.isfinite(t):
        return 0.0 if not math.isnan(t) else float("nan")
    return _betainc(dof / 2.0, 0.5, dof / (dof + t * t))


def t_quantile(share: float, dof: float) -> float:
    """The value that Student's t stays below with probability ``share``, by bisection of the
    incomplete beta function."""
    if share == 0.5 or not dof > 0:
        return 0.0 if share == 0.5 else float("nan")
    tail = 2.0 * min(share, 1.0 - share)
    low, high = 0.0, 1.0
    while t_two_sided_p(high, dof) > tail:
        high *= 2.0
    while high - low > 1e-14 * high:
        middle = (low + high) / 2.0
        if middle in (low, high):
            break
        low, high = (middle, high) if t_two_sided_p(middle, dof) > tail else (low, middle)
    return math.copysign((low + high) / 2.0, share - 0.5)


def f_upper_p(f: float, df_model: float, dof: float) -> float:
    """P(F >= f)."""
    if not (f >= 0 and df_model > 0 and dof > 0):
        return float("nan")
    return _betainc(dof / 2.0, df_model / 2.0, dof / (dof + df_model * f))


def omnibus(skew: float, kurt: float, n: int) -> float:
    """D'Agostino's K²: the sum of squares of the normal transforms of skew and kurtosis."""
    if n < 8 or not (math.isfinite(skew) and math.isfinite(kurt)):
        return float("nan")
    y = skew * math.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / (
        (n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    w2 = math.sqrt(2.0 * (beta2 - 1)) - 1
    z_skew = math.asinh(y * math.sqrt((w2 - 1) / 2.0)) / math.sqrt(0.5 * math.log(w2))
    mean = 3.0 * (n - 1) / (n + 1)
    var = 24.0 * n * (n - 2) * (n - 3) / ((n + 1.0) ** 2 * (n + 3) * (n + 5))
    x = (kurt - mean) / math.sqrt(var)
    third = 6.0 * (n * n - 5 * n + 2) / ((n + 7.0) * (n + 9)) * math.sqrt(
        6.0 * (n + 3) * (n + 5) / (n * (n - 2.0) * (n - 3)))
    a = 6.0 + 8.0 / third * (2.0 / third + math.sqrt(1 + 4.0 / third ** 2))
    root = (1 - 2.0 / a) / (1 + x * math.sqrt(2.0 / (a - 4)))
    z_kurt = (1 - 2.0 / (9 * a) - math.copysign(abs(root) ** (1 / 3), root)) / math.sqrt(
        2.0 / (9 * a))
    return z_skew ** 2 + z_kurt ** 2


def ols(df: DataFrame, features: list[str], label: str = "log_visitors",
        fit_intercept: bool = False, order: str = "store", residual_stats: bool = True):
    """M3: least squares with the inference table of a regression summary.

    Returns ``(coefficient table, statistics dict, coefficients dict)``.  The fit is one
    pass for the triangular factor of [design, label]; residual moments are one
    aggregate; Durbin-Watson takes the residuals in row order (``order``) from one
    range sort.  ``residual_stats=False`` skips the last two.
    """
    data = df.dropna(subset=features + [label])
    names = (["const"] if fit_intercept else []) + list(features)
    factor = triangular_factor(data, [*features, label], constant=fit_intercept)
    p, n = len(names), factor.n
    x, qty = factor.r[:, :p], factor.r[:, p]
    beta, inv, rank = pseudo_solve(x, qty)
    sse = float(np.sum((qty - x @ beta) ** 2))
    dof = n - rank
    sigma2 = sse / dof if dof > 0 else float("nan")
    se = np.sqrt(np.maximum(np.diag(inv), 0.0) * sigma2)
    tv = np.divide(beta, se, out=np.full_like(beta, np.nan), where=se > 0)
    pv = [t_two_sided_p(float(t), dof) for t in tv]
    reach = t_quantile(0.975, dof) if dof > 0 else float("nan")
    table = df.sparkSession.createDataFrame(
        [(nm, float(c), float(e), float(t), float(p), float(c - reach * e), float(c + reach * e))
         for nm, c, e, t, p in zip(names, beta, se, tv, pv)],
        "feature string, coef double, std_err double, t_value double, p_value double, "
        "ci_low double, ci_high double")
    sizes = np.linalg.svd(x, compute_uv=False)

    coefs = dict(zip(names, (float(x) for x in beta)))
    fitted = F.lit(coefs.get("const", 0.0))
    for c in features:
        fitted = fitted + F.lit(coefs[c]) * F.col(c).cast("double")
    resid = data.select(*ORDERS[order], (F.col(label) - fitted).alias("e"))
    if residual_stats:
        resid = cut_lineage(resid)
    a = (resid.agg(F.skewness("e").alias("skew"), F.kurtosis("e").alias("kurt")).first()
         if residual_stats else {"skew": None, "kurt": None})
    tss = float(qty @ qty)
    if fit_intercept:       # the constant comes first: its row holds the mean's part
        tss -= float(qty[0] ** 2)
    r2 = 1.0 - sse / tss if tss else float("nan")
    loglik = -n / 2.0 * (math.log(2 * math.pi) + math.log(sse / n) + 1.0)
    kurt = float(a["kurt"]) + 3.0 if a["kurt"] is not None else float("nan")
    skew = float(a["skew"]) if a["skew"] is not None else float("nan")
    df_model = rank - (1 if fit_intercept else 0)
    k2 = omnibus(skew, kurt, n)
    jb = n / 6.0 * (skew ** 2 + (kurt - 3.0) ** 2 / 4.0)
    f_stat = (r2 / df_model) / ((1 - r2) / dof) if df_model and r2 < 1 and dof > 0 \
        else float("nan")
    stats = {
        "n": int(n), "rank": rank, "r2": r2,
        "adj_r2": 1 - (1 - r2) * (n - (1 if fit_intercept else 0)) / dof if dof > 0 else float("nan"),
        "f_stat": f_stat, "prob_f": f_upper_p(f_stat, df_model, dof),
        "loglik": loglik, "aic": -2 * loglik + 2 * rank, "bic": -2 * loglik + rank * math.log(n),
        "skew": skew, "kurtosis": kurt,
        "jarque_bera": jb, "prob_jb": math.exp(-jb / 2.0),
        "omnibus": k2, "prob_omnibus": math.exp(-k2 / 2.0),
        "condition_number": float(sizes[0] / sizes[-1]) if len(sizes) and sizes[-1] > 0
        else float("inf"),
        "durbin_watson": durbin_watson(resid, order) if residual_stats else float("nan"),
    }
    return table, stats, coefs


def durbin_watson(resid: DataFrame, order: str = "store") -> float:
    """Σ(eₜ - eₜ₋₁)² / Σeₜ² in row order: neighbours inside range partitions, then the borders
    (one first and last residual per partition)."""
    cols = ORDERS[order]

    def run(batches):
        first = last = None
        num = den = 0.0
        for batch in batches:
            e = batch["e"].to_numpy(float)
            if not len(e):
                continue
            if last is None:
                first = e[0]
                num += float(np.sum(np.diff(e) ** 2))
            else:
                num += float(np.sum(np.diff(np.r_[last, e]) ** 2))
            den += float(np.sum(e ** 2))
            last = e[-1]
        if last is not None:
            task = TaskContext.get().partitionId()
            yield pd.DataFrame({"task": [task], "num": [num], "den": [den], "first": [first],
                                "last": [last]})

    parts = sorted(resid.select(*cols, "e").repartitionByRange(*cols)
                        .sortWithinPartitions(*cols).select("e")
                        .mapInPandas(run, "task int, num double, den double, first double, "
                                          "last double").collect())
    num = sum(p["num"] for p in parts) + sum(
        (b["first"] - a["last"]) ** 2 for a, b in zip(parts, parts[1:]))
    den = sum(p["den"] for p in parts)
    return num / den if den else float("nan")
