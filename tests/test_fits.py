"""Fits of the large-party logit, the location clusters and the in-task forecast."""

import datetime

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from footfall import catalog
from footfall.functions import numeric as num
from footfall.operators import series
from footfall.plans import boosting, cluster, forecast, models, newton, scoring
from footfall.plans.diagnostics import pseudo_solve
from footfall.plans.features import LARGE_PARTY_FEATURES
from footfall.plans.lasso import LinearScorer
from footfall.sources import standin

from conftest import SF001


@pytest.fixture(scope="module")
def wide(spark):
    train, _ = catalog._wide(spark, SF001)
    rows = train.withColumn("large_party", num.threshold_flag("visitors", 40)).select(
        *LARGE_PARTY_FEATURES, "large_party").dropna()
    return rows.cache()


def row_level_newton(x, y, steps=60):
    """Newton with the pseudo-inverse of the whole weighted design."""
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ b))
        root = np.sqrt(p * (1 - p))
        step, _, _ = pseudo_solve(x * root[:, None], (y - p) / root)
        b = b + step
        if np.abs(x @ step).max() < 1e-12:
            break
    return b


def test_logit_on_all_27_inputs_equals_row_level_newton(wide):
    """The totals are sums of other inputs, so the design is singular."""
    m = models.large_party_classifier(wide, LARGE_PARTY_FEATURES)
    pdf = wide.toPandas()
    x, y = pdf[LARGE_PARTY_FEATURES].to_numpy(float), pdf["large_party"].to_numpy(float)
    want = row_level_newton(x, y)
    assert len(want) == 27 and m.fit.rank < 27 and m.fit.converged and not m.fit.separated
    assert np.allclose(m.coefficients, want, rtol=1e-6, atol=1e-6)
    p = 1 / (1 + np.exp(-x @ m.coefficients))
    assert np.abs(x.T @ (y - p)).max() / np.abs(x).sum(axis=0).max() < 1e-9


def test_separated_classes_are_told(spark):
    df = spark.createDataFrame([(float(v), 1.0 if v > 0 else 0.0) for v in range(-9, 10) if v],
                               "x double, y double")
    fit = newton.fit_logit(df, ["x"], "y")
    assert fit.separated and not fit.converged
    nothing = newton.fit_logit(df.where("x > 100"), ["x"], "y")
    assert nothing.steps == 0 and nothing.coefficients.tolist() == [0.0]


def test_batched_restarts_are_as_good_as_single_fits(spark):
    stores = standin.load(spark, SF001).store_info
    mine = cluster.fit_location_clusters(stores, k=8, restarts=25, seed=0)
    points = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(
        cluster._points(stores, "air_store_id")).cache()
    best = min(KMeans(k=8, maxIter=1000, seed=s).fit(points).summary.trainingCost
               for s in range(25))
    assert mine.cost <= best * (1 + 1e-6)
    again = cluster.fit_location_clusters(stores.repartition(5), k=8, restarts=25, seed=0)
    assert again.cost == pytest.approx(mine.cost)


def test_clusters_of_few_and_of_no_points(spark):
    def frame(rows):
        return spark.createDataFrame(rows, "air_store_id string, longitude double, latitude double")
    few = frame([("a", 1.0, 2.0), ("b", 3.0, 4.0), ("c", None, 4.0), ("a", 1.0, 2.0)])
    out = {r["air_store_id"]: r["cluster"] for r in cluster.add_location_cluster(few).collect()}
    assert out["c"] is None and out["a"] != out["b"] and None not in (out["a"], out["b"])
    none = cluster.add_location_cluster(frame([("c", None, None)])).collect()
    assert [r["cluster"] for r in none] == [None]


@pytest.fixture(scope="module")
def test_rows(spark):
    t = standin.load(spark, SF001)
    return series.split(series.build_panel(t.visits, t.submission))[1].cache()


@pytest.mark.parametrize("fill,batch", [(None, "10000"), (-1.0, "3")])
def test_in_task_forecast_equals_the_steps_of_spark(spark, test_rows, fill, batch):
    """Also where a store's rows are parted by batches."""
    c0, *ws = catalog.AR_WEIGHTS
    line = LinearScorer([f"visitors_lag{k}" for k in (1, 2, 3)], np.array(ws), c0)
    steps = forecast.recursive_forecast(test_rows, catalog.ar_model(), fill_value=fill)
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        tasks = forecast.recursive_forecast(test_rows, line, fill_value=fill).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    want = {r["id"]: r for r in steps.collect()}
    assert len(tasks) == len(want) == test_rows.count()
    for r in tasks:
        for c in r.asDict():
            a, b = r[c], want[r["id"]][c]
            assert a == b or (isinstance(a, float) and b is not None and abs(a - b) < 1e-9), c


def test_trees_forecast_in_tasks(spark, test_rows):
    """Equal to a plain walk over each store's days."""
    rows = [(float(v), v * 0.5) for v in range(200)]
    train = spark.createDataFrame(rows, "visitors_lag1 double, log_visitors double")
    model = boosting.LeafwiseBoosting(rounds=5, rate=0.9, leaves=4).fit(train, ["visitors_lag1"])
    got = {r["id"]: r["log_visitors"] for r in forecast.recursive_forecast(
        test_rows, model, fill_value=-1.0).collect()}
    _, score = forecast.in_task_scorer(model)
    last = {}
    for r in sorted(test_rows.collect(), key=lambda r: (r["air_store_id"], r["visit_date"])):
        lag = last.get(r["air_store_id"], r["visitors_lag1"])
        p = max(0.0, float(score(np.array([[-1.0 if lag is None else lag]]))[0]))
        last[r["air_store_id"]] = p
        assert got[r["id"]] == pytest.approx(p)


def test_no_test_rows(test_rows):
    line = LinearScorer(["visitors_lag1"], np.array([0.5]), 0.1)
    assert forecast.recursive_forecast(test_rows.limit(0), line).count() == 0


def test_scores_of_negative_and_missing_predictions(spark):
    """A negative prediction counts as zero; an id without one has no visitors, or no row."""
    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    day = datetime.date(2020, 1, 1)
    pred = spark.createDataFrame([("a", -2.0, day), ("b", 1.0, day), ("c", None, day),
                                  ("e", 1.0, day)], "id string, prediction double, day date")
    left = {r["id"]: r["visitors"] for r in scoring.score_predictions(pred, ids).collect()}
    assert left == {"a": 1.0, "b": pytest.approx(np.e), "c": None, "d": None}
    inner = scoring.score_predictions(pred.where(F.col("prediction").isNotNull()), ids, how="inner")
    assert {r["id"] for r in inner.collect()} == {"a", "b"}
