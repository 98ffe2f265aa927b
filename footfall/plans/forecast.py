"""Recursive multi-step forecast.

The original predicts *every* row N times (N = distinct test days),
re-deriving lag/diff features of the whole panel after each pass.  Lags are
positional within a store, so a test row at step j depends only on the <= 7
rows before it.  Two exact strategies:

``mode="step"`` (default; exact when the model reads lags and static columns,
not diffs of the row's own target): step j of every store is predicted once.

A line or boosted trees are small, so they go to the tasks: the test rows are dealt out by
store, in order of the days, and each task runs through its rows batch by batch, all stores of
a batch side by side, with the last values of a store as its only state.  That is one
shuffle and one job, whatever the number of steps.  Any other model is applied by Spark step by
step: the state is one row per store holding the last ``n_lags`` values (newest
first); each step joins the step's rows to the state, predicts, and pushes the
prediction: ``slice(concat(array(p), state), 1, n_lags)``.  Only stores that
still have steps stay in the state, so a step costs one row per active store.

``mode="fixed_point"`` (parity with the original when diff features are in
the model, trap T1): N passes, each re-deriving lags/diffs with the window —
but over the *frontier* only (test rows + the last ``n_lags`` train rows per
store), never the whole history.

The step-by-step ways keep their state in tables bucketed by store under the checkpoint
directory (``spark.checkpoint.dir``): every step is a reliable lineage cut (a
lost executor re-reads the previous step), and the per-step join or window
finds its input already partitioned by store, so no step shuffles.  Any MLlib
``Transformer`` works as the model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from footfall.functions import numeric as num
from footfall.operators import series
from footfall.plans.boosting import BoostedTrees, bin_codes
from footfall.plans.lasso import LinearScorer
from footfall.session import cut_lineage, materialize_bucketed, ship_package

# Bytes of one bucket of the forecast's tables (one row per store and step).
BUCKET_BYTES = 64 << 20
STORE, DAY, TARGET = "air_store_id", "visit_date", "log_visitors"


def _lag_name(k: int) -> str:
    return f"{series.LAG_PREFIX}{k}"


def _diff_name(k: int) -> str:
    return f"{series.DIFF_PREFIX}{k}"


def _predict(model, rows: DataFrame, fill_value: float | None, lag_cols: list[str],
             clip: bool, prediction: str) -> DataFrame:
    feats = rows
    if fill_value is not None:
        # the model was trained on filled features (P12); fill the lag inputs
        # the same way, but keep the raw lags on the output rows
        feats = rows.withColumns({f"__raw_{c}": F.col(c) for c in lag_cols}).na.fill(
            fill_value, subset=lag_cols)
    out = model.transform(feats)
    if fill_value is not None:
        out = out.withColumns({c: F.col(f"__raw_{c}") for c in lag_cols}).drop(
            *[f"__raw_{c}" for c in lag_cols])
    p = num.clip_negative(prediction) if clip else F.col(prediction).cast("double")
    return out.withColumn("__p", p)


Score = Callable[[np.ndarray], np.ndarray]


def in_task_scorer(model) -> tuple[list[str], Score] | None:
    """The model's features and a function of their values (rows x features), if it is a line
    or boosted trees; a missing value gives a missing prediction of a line."""
    if isinstance(model, PipelineModel) and len(model.stages) == 2:
        assembler, fitted = model.stages
        if isinstance(assembler, VectorAssembler) and isinstance(fitted, LinearRegressionModel):
            model = LinearScorer(assembler.getInputCols(), fitted.coefficients.toArray(),
                                 fitted.intercept)
    if isinstance(model, LinearScorer):
        weights, constant = np.asarray(model.coefficients, float), float(model.intercept)
        used = np.flatnonzero(weights)
        return list(model.features), lambda x: constant + x[:, used] @ weights[used]
    if isinstance(model, BoostedTrees):
        def trees(x: np.ndarray) -> np.ndarray:
            codes = bin_codes(x, model.borders)
            return model.start + sum((t.value[t.leaf_of(codes)] for t in model.trees),
                                     np.zeros(len(x)))
        return list(model.features), trees
    return None


def _in_tasks(test_rows: DataFrame, features: list[str], score: Score, n_lags: int, clip: bool,
              fill_value: float | None) -> DataFrame:
    """``test_rows`` with ``__p`` and the lags that each prediction was made from."""
    lag_cols = [_lag_name(k) for k in range(1, n_lags + 1)]
    rows = test_rows.withColumns({c: F.col(c).cast("double") for c in lag_cols})
    schema = StructType([*rows.schema.fields, StructField("__p", DoubleType())])
    place = {c: i for i, c in enumerate(features)}
    own = [(place[c], k) for k, c in enumerate(lag_cols) if c in place]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, state = None, None       # of the last row so far
        for batch in batches:
            if not len(batch):
                continue
            names = batch[STORE].to_numpy(object)
            begins = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
            sizes = np.diff(np.r_[begins, len(names)])
            lags = batch[lag_cols].to_numpy(float)
            x = np.column_stack([pd.to_numeric(batch[c]).to_numpy(float) for c in features]) \
                if features else np.zeros((len(batch), 0))
            out = np.full(len(batch), np.nan)
            if names[0] == store:
                lags[0] = state
            for j in range(int(sizes.max())):
                at = begins[sizes > j] + j
                if j:
                    lags[at, 1:] = lags[at - 1, :-1]
                    lags[at, 0] = out[at - 1]
                inputs = x[at]
                for f, k in own:
                    value = lags[at, k]
                    inputs[:, f] = value if fill_value is None else np.where(
                        np.isnan(value), fill_value, value)
                p = score(inputs)
                out[at] = np.where(p < 0, 0.0, p) if clip else p
            store, state = names[-1], np.r_[out[-1], lags[-1, :-1]]
            done = batch.copy()
            done[lag_cols] = lags
            done["__p"] = out
            yield done

    ordered = rows.repartition(STORE).sortWithinPartitions(STORE, DAY)
    return ordered.mapInPandas(run, schema)


def recursive_forecast(test_rows: DataFrame, model, n_lags: int = 7, clip: bool = True,
                       fill_value: float | None = -1.0, mode: str = "step",
                       train_rows: DataFrame | None = None, prediction: str = "prediction",
                       num_partitions: int | None = None) -> DataFrame:
    """Forecast ``test_rows`` (panel test rows carrying ``visitors_lag1..n``
    computed over train + test, i.e. step 1 sees its true history).

    Returns the test rows with ``log_visitors`` = forecast, ``visitors`` =
    exp(forecast), lags as used and diffs recomputed.
    """
    if mode == "fixed_point":
        if train_rows is None:
            raise ValueError("fixed_point mode needs train_rows")
        return _fixed_point(train_rows, test_rows, model, n_lags, clip, fill_value,
                            prediction, num_partitions)
    spark = test_rows.sparkSession
    lag_cols = [_lag_name(k) for k in range(1, n_lags + 1)]
    diff_cols = [c for c in test_rows.columns if c.startswith(series.DIFF_PREFIX)]
    base = test_rows.drop(prediction, *diff_cols) if prediction in test_rows.columns \
        else test_rows.drop(*diff_cols)
    scorer = in_task_scorer(model)
    if scorer and set(scorer[0]) <= set(base.columns):
        ship_package(spark)
        return _finish(_in_tasks(base, *scorer, n_lags, clip, fill_value), lag_cols, diff_cols,
                       prediction)
    # Step rows and the per-step state are tables bucketed by store with the
    # same bucket count, so each step's join runs without a shuffle, and each
    # step is a reliable lineage cut.  The step rows lie in one directory per step, so
    # that a step reads its own rows only.
    numbered = cut_lineage(
        base.withColumn("__step", F.row_number().over(series.store_window())))
    n_rows, n_steps = numbered.agg(F.count(F.lit(1)), F.max("__step")).first()
    n_steps = n_steps or 0
    parts = num_partitions or _buckets(spark, n_rows // max(n_steps, 1), len(base.columns))
    steps = materialize_bucketed(numbered, STORE, "forecast_steps", parts,
                                 partition_by="__step")

    # state after step 0: the true history of step 1, newest first
    state = materialize_bucketed(steps.where(F.col("__step") == 1)
                                 .select(STORE, F.array(*lag_cols).alias("__state")),
                                 STORE, "forecast_state", parts)
    outputs = []
    for j in range(1, n_steps + 1):
        rows = (steps.where(F.col("__step") == j).drop(*lag_cols)
                .join(state, STORE, "left")
                .withColumns({c: F.try_element_at(F.col("__state"), F.lit(k))
                              for k, c in enumerate(lag_cols, start=1)}))
        done = materialize_bucketed(
            _predict(model, rows, fill_value, lag_cols, clip, prediction)
            .withColumn("__state", F.slice(F.concat(F.array("__p"), F.col("__state")),
                                           1, n_lags)),
            STORE, "forecast_step", parts)
        outputs.append(done)
        state = done.select(STORE, "__state")
    if not outputs:
        return base.withColumn("visitors", F.lit(None).cast("double"))
    out = outputs[0]
    for o in outputs[1:]:
        out = out.unionByName(o)
    return _finish(out, lag_cols, diff_cols, prediction)


def _buckets(spark, rows: int, columns: int) -> int:
    """Buckets of about ``BUCKET_BYTES``, at most one per shuffle partition."""
    size = rows * columns * 16
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                      -(-size // BUCKET_BYTES)))


def _finish(out: DataFrame, lag_cols, diff_cols, prediction) -> DataFrame:
    res = out.withColumns({TARGET: F.col("__p"), "visitors": F.exp("__p")})
    res = res.withColumns({d: F.col(TARGET) - F.col(_lag_name(int(d[len(series.DIFF_PREFIX):])))
                           for d in diff_cols if _lag_name(int(d[len(series.DIFF_PREFIX):])) in lag_cols})
    drop = [c for c in res.columns if c.startswith("__") or c in (prediction, "features",
                                                                  "rawPrediction", "probability")]
    return res.drop(*drop)


def _fixed_point(train_rows, test_rows, model, n_lags, clip, fill_value, prediction,
                 num_partitions) -> DataFrame:
    spark = test_rows.sparkSession
    lag_cols = [_lag_name(k) for k in range(1, n_lags + 1)]
    diff_cols = [c for c in test_rows.columns if c.startswith(series.DIFF_PREFIX)]
    w_desc = Window.partitionBy(STORE).orderBy(F.col(DAY).desc())
    tail = (train_rows.withColumn("__rk", F.row_number().over(w_desc))
            .where(F.col("__rk") <= n_lags).drop("__rk"))
    n_pass = test_rows.select(DAY).distinct().count()
    frontier = (tail.withColumn("__test", F.lit(False))
                .unionByName(test_rows.withColumn("__test", F.lit(True)), allowMissingColumns=True)
                .select(*[c for c in test_rows.columns if c not in (prediction,)], "__test"))
    frontier = cut_lineage(frontier)
    parts = num_partitions or _buckets(spark, frontier.count(), len(frontier.columns))
    frontier = materialize_bucketed(frontier, STORE, "forecast_frontier", parts)
    for _ in range(n_pass):
        lagged = series.add_lags(frontier.drop(*lag_cols, *diff_cols), lags=range(1, n_lags + 1),
                                 diffs=bool(diff_cols))
        is_test = F.col("__test")
        scored = _predict(model, lagged.where(is_test), fill_value, lag_cols, clip, prediction)
        keep = [c for c in lagged.columns]
        # P10: the prediction replaces the target on test rows only
        updated = (scored.withColumn(TARGET, num.masked_update(is_test, "__p", TARGET))
                   .select(*keep)
                   .unionByName(lagged.where(~is_test)))
        frontier = materialize_bucketed(updated, STORE, "forecast_frontier", parts)
    final = series.add_lags(frontier.drop(*lag_cols, *diff_cols), lags=range(1, n_lags + 1),
                            diffs=bool(diff_cols))
    res = final.where(F.col("__test")).withColumn("visitors", F.exp(TARGET))
    return res.drop(*[c for c in res.columns if c.startswith("__")])
