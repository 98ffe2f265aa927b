"""Lasso fits and the regularisation path under ordered CV (M6, M7).

Objective (as scikit-learn's ``Lasso`` and MLlib's ``LinearRegression`` with
``elasticNetParam=1, standardization=False``):
    (1 / 2n) ||y - b - Xw||² + alpha ||w||₁

The path needs 200 alphas x 5 folds = 1000 fits.  Instead of 1000 distributed
fits, one pass computes per-fold-block sufficient statistics (``gram_by`` keyed
by fold); a training split's statistics are the sum of the blocks before it,
and each fit is cyclic coordinate descent with covariance updates (Friedman,
Hastie & Tibshirani 2010) on the p x p centred Gram matrix — exact for the
objective above, independent of the row count.  Test-fold RMSE is evaluated
from the test block's statistics the same way.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.folds import ORDERS, with_fold
from footfall.plans.gram import Gram, first_row_shift, gram_by
from footfall.session import ship_package


def reference_alphas() -> list[float]:
    """0.001, 0.006, ..., 0.996 (200)."""
    return [round(0.001 + 0.005 * i, 3) for i in range(200)]


def _centred(g: Gram):
    n = g.n
    mx, my = g.sx / n, g.sy / n
    C = g.xtx - n * np.outer(mx, mx)
    c = g.xty - n * mx * my
    return C, c, mx, my


def coordinate_descent(C: np.ndarray, c: np.ndarray, n: float, alpha: float,
                       w0: np.ndarray | None = None, tol: float = 1e-12,
                       max_sweeps: int = 100_000) -> np.ndarray:
    """argmin (1/2n) wᵀCw - (1/n) cᵀw + alpha ||w||₁ (covariance updates)."""
    p = len(c)
    w = np.zeros(p) if w0 is None else w0.astype(float).copy()
    diag = np.diag(C).copy()
    r = c - C @ w                      # r_j = c_j - (Cw)_j
    thr = n * alpha
    cols = [C[:, j].copy() for j in range(p)]
    live = [j for j in range(p) if diag[j] > 0]

    def sweep(idx):
        big = 0.0
        for j in idx:
            wj = w[j]
            rho = r[j] + diag[j] * wj
            new = (rho - thr if rho > thr else rho + thr if rho < -thr else 0.0) / diag[j]
            d = new - wj
            if d != 0.0:
                r[:] -= cols[j] * d
                w[j] = new
                big = max(big, abs(d) * np.sqrt(diag[j]))
        return big

    scale = np.sqrt(max(float(np.max(diag)) if p else 1.0, 1e-300))

    def done(big):
        return big <= tol * scale * max(1.0, float(np.max(np.abs(w))) if p else 1.0)

    sweeps = 0
    while not done(sweep(live)):             # full sweep: KKT over every coordinate
        active = [j for j in live if w[j] != 0.0]
        while not done(sweep(active)):       # then settle the active set
            sweeps += 1
            if sweeps > max_sweeps:
                raise RuntimeError(f"no convergence in {max_sweeps} sweeps at alpha {alpha}")
        sweeps += 1
        if sweeps > max_sweeps:
            raise RuntimeError(f"no convergence in {max_sweeps} sweeps at alpha {alpha}")
    return w


def fit_from_gram(g: Gram, alpha: float, w0=None) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) in the statistics' (shifted) coordinates."""
    C, c, mx, my = _centred(g)
    w = coordinate_descent(C, c, g.n, alpha, w0)
    return w, float(my - mx @ w)


def sse_from_gram(g: Gram, w: np.ndarray, b: float) -> float:
    """Σ (y - b - xᵀw)² over the rows summarised by ``g``."""
    return float(g.yty - 2 * b * g.sy - 2 * w @ g.xty + g.n * b * b
                 + 2 * b * (w @ g.sx) + w @ g.xtx @ w)


def split_grams(folds: DataFrame, features: list[str], label: str, n_splits: int
                ) -> list[tuple[Gram, Gram]]:
    """The statistics of each split's training and test rows, from one pass over ``folds``."""
    shift = first_row_shift(folds, features, label)
    blocks = gram_by(folds, features, label, key="fold", shift=shift)
    zero = Gram(list(features), np.zeros((len(features) + 2,) * 2))
    train, splits = zero, []
    for i in range(1, n_splits + 1):
        train = train + blocks.get(str(i - 1), zero)
        splits.append((train, blocks.get(str(i), zero)))
    return splits


def fold_scores(folds: DataFrame, features: list[str], label: str, alpha: float,
                n_splits: int = 5) -> list[float]:
    """RMSE of each test fold of a Lasso fitted on the rows before it."""
    scores = []
    for train, test in split_grams(folds, features, label, n_splits):
        if not (train.n and test.n):
            scores.append(float("nan"))
            continue
        w, b = fit_from_gram(train, alpha)
        scores.append(float(np.sqrt(max(sse_from_gram(test, w, b), 0.0) / test.n)))
    return scores


def lasso_path(df: DataFrame, features: list[str], label: str = "log_visitors",
               alphas: list[float] | None = None, order: str = "time", n_splits: int = 5,
               folds: DataFrame | None = None) -> DataFrame:
    """M7: (lambda, rmsle) — mean test RMSE over the ordered folds per alpha.

    ``folds`` (from ``with_folds``) is used as it is and stays persisted.
    """
    alphas = alphas or reference_alphas()
    if folds is None:
        keys = [c for c in ORDERS[order] if c not in features]
        # one pass over the rows needs no copy of them
        folds = with_fold(df.select(*features, label, *keys), order, n_splits)
    splits = [(i, train.m.tobytes(), test.m.tobytes()) for i, (train, test) in enumerate(
        split_grams(folds, features, label, n_splits), 1) if train.n and test.n]
    size, names = len(features) + 2, list(features)
    grid = sorted(map(float, alphas), reverse=True)

    def solve(batches):
        """The whole path of each split, warm-started from the largest alpha down."""
        for batch in batches:
            for train, test in zip(batch["train"], batch["test"]):
                train, test = (Gram(names, np.frombuffer(m).reshape(size, size))
                               for m in (train, test))
                w, rows = None, []
                for a in grid:
                    w, b = fit_from_gram(train, a, w)
                    sse = max(sse_from_gram(test, w, b), 0.0)
                    rows.append((a, float(np.sqrt(sse / test.n))))
                yield pd.DataFrame(rows, columns=["lambda", "rmse"])

    spark = df.sparkSession
    ship_package(spark)
    # one task per split, of p x p numbers each
    statistics = spark.createDataFrame(splits, "split int, train binary, test binary")
    paths = statistics.repartitionByRange(max(1, len(splits)), "split").mapInPandas(
        solve, "lambda double, rmse double")
    grid_rows = spark.createDataFrame([(a,) for a in grid], "lambda double")
    return grid_rows.join(F.broadcast(paths.groupBy("lambda").agg(   # one row per alpha
        F.avg("rmse").alias("rmsle"))), "lambda", "left")


@dataclass
class LinearScorer:
    """A fitted line: ``transform`` adds ``prediction``."""
    features: list[str]
    coefficients: np.ndarray
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        terms = F.lit(self.intercept)
        for c, w in zip(self.features, self.coefficients):
            if w:
                terms = terms + F.lit(float(w)) * F.col(c).cast("double")
        return df.withColumn("prediction", terms)

    def as_pipeline(self) -> PipelineModel:
        """The line as an MLlib model, which can be saved."""
        terms = "".join(f" + {float(w)!r}D * double(`{c}`)"
                        for c, w in zip(self.features, self.coefficients) if w)
        return PipelineModel([SQLTransformer(
            statement=f"SELECT *, {float(self.intercept)!r}D{terms} AS prediction FROM __THIS__")])


def lasso_fit(df: DataFrame, features: list[str], label: str = "log_visitors",
              alpha: float = 0.001) -> LinearScorer:
    """M6: the objective above, solved exactly from one pass of sufficient statistics."""
    shift = first_row_shift(df, features, label)
    g = gram_by(df, features, label, shift=shift).get(None)
    if g is None:
        raise ValueError("no complete row to fit on")
    w, b = fit_from_gram(g, alpha)
    # back from the shifted coordinates
    return LinearScorer(list(features), w, float(b + shift[-1] - w @ np.array(shift[:-1])))
