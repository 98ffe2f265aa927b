"""Model jobs: invariants and brute-force checks on the sf0.001 tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from footfall.operators import series
from footfall.operators.folds import assign_folds
from footfall.plans import diagnostics, forecast, lasso, models, ordered_cv, search
from footfall.plans.gram import gram
from footfall.sources import standin

FEATS = ["visitors_lag1", "visitors_lag2", "visitors_lag3", "dow", "month"]


@pytest.fixture(scope="module")
def panel(spark):
    t = standin.load(spark, SF001)
    p = series.build_panel(t.visits, t.submission).cache()
    return p


@pytest.fixture(scope="module")
def design(panel):
    tr, _ = series.split(panel)
    return tr.dropna(subset=FEATS + ["log_visitors"]).cache()


def _np(design):
    pdf = design.select(*FEATS, "log_visitors").toPandas()
    return pdf[FEATS].to_numpy(float), pdf["log_visitors"].to_numpy(float)


def _cd_objective(X, y, w, b, a):
    return ((y - b - X @ w) ** 2).mean() / 2 + a * np.abs(w).sum()


def test_gram_equals_numpy(design):
    X, y = _np(design)
    g = gram(design, FEATS, "log_visitors")
    assert np.allclose(g.xtx, X.T @ X) and np.allclose(g.xty, X.T @ y) and g.n == len(y)


@pytest.mark.parametrize("alpha", [0.001, 0.05])
def test_lasso_gram_matches_mllib(design, alpha):
    X, y = _np(design)
    g = gram(design, FEATS, "log_visitors")
    w, b = lasso.fit_from_gram(g, alpha)
    m = models.regression_pipeline(models.lasso(alpha), FEATS).fit(design).stages[-1]
    one = lasso.lasso_fit(design, FEATS, alpha=alpha)
    assert np.allclose(one.coefficients, w) and abs(one.intercept - b) < 1e-8
    ours = _cd_objective(X, y, w, b, alpha)
    theirs = _cd_objective(X, y, m.coefficients.toArray(), m.intercept, alpha)
    assert ours <= theirs + 1e-7  # exact optimum is never worse than MLlib's
    assert np.allclose(w, m.coefficients.toArray(), atol=1e-3)


def test_lasso_zero_above_alpha_max(design):
    X, y = _np(design)
    Xc, yc = X - X.mean(0), y - y.mean()
    amax = np.abs(Xc.T @ yc).max() / len(y)
    w, _ = lasso.fit_from_gram(gram(design, FEATS, "log_visitors"), amax * 1.01)
    assert np.all(w == 0)


def test_lasso_path_brute_force(design):
    alphas = [0.001, 0.1]
    path = {r["lambda"]: r.rmsle for r in lasso.lasso_path(design, FEATS, alphas=alphas).collect()}
    folds, n = assign_folds(design.select(*FEATS, "log_visitors", "air_store_id", "visit_date"))
    pdf = folds.toPandas().sort_values("ordinal")
    X, y, f = pdf[FEATS].to_numpy(float), pdf["log_visitors"].to_numpy(float), pdf["fold"].to_numpy()
    for a in alphas:
        scores = []
        for i in range(1, 6):
            tr, te = f < i, f == i
            w, b = lasso.fit_from_gram(gram(design.sparkSession.createDataFrame(
                pdf[tr][FEATS + ["log_visitors"]]), FEATS, "log_visitors"), a)
            scores.append(np.sqrt(((y[te] - b - X[te] @ w) ** 2).mean()))
        assert abs(path[a] - np.mean(scores)) < 1e-8


def test_vif_definition(design):
    X, _ = _np(design)
    v = {r.features: r.vif_factor for r in diagnostics.vif(design, FEATS).collect()}
    for i, c in enumerate(FEATS):
        others = np.delete(X, i, axis=1)
        beta, *_ = np.linalg.lstsq(others, X[:, i], rcond=None)
        r2u = 1 - ((X[:, i] - others @ beta) ** 2).sum() / (X[:, i] ** 2).sum()
        assert v[c] >= 1.0 and abs(v[c] - 1 / (1 - r2u)) < 1e-6 * v[c]


def test_ols_no_intercept(design):
    X, y = _np(design)
    table, stats, _ = diagnostics.ols(design, FEATS)
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    coef = {r.feature: r.coef for r in table.collect()}
    assert np.allclose([coef[c] for c in FEATS], beta, atol=1e-8)
    r2u = 1 - ((y - X @ beta) ** 2).sum() / (y ** 2).sum()
    assert abs(stats["r2"] - r2u) < 1e-9
    e = y - X @ beta
    assert stats["durbin_watson"] > 0


def test_ordered_cv_linear_brute_force(design):
    scores = ordered_cv.time_series_cv(design, models.linear_regression(True), FEATS)
    folds, _ = assign_folds(design.select(*FEATS, "log_visitors", "air_store_id", "visit_date"))
    pdf = folds.toPandas()
    X = np.c_[np.ones(len(pdf)), pdf[FEATS].to_numpy(float)]
    y, f = pdf["log_visitors"].to_numpy(float), pdf["fold"].to_numpy()
    for i, s in enumerate(scores, start=1):
        beta, *_ = np.linalg.lstsq(X[f < i], y[f < i], rcond=None)
        assert abs(s - np.sqrt(((y[f == i] - X[f == i] @ beta) ** 2).mean())) < 1e-6


def test_step_forecast_equals_fixed_point(panel):
    tr, te = series.split(panel)
    model = forecast_model()
    step = forecast.recursive_forecast(te, model, fill_value=None, mode="step")
    fixed = forecast.recursive_forecast(te, model, fill_value=None, mode="fixed_point",
                                        train_rows=tr)
    a = {r.id: r.log_visitors for r in step.collect()}
    b = {r.id: r.log_visitors for r in fixed.collect()}
    assert a.keys() == b.keys() and len(a) == te.count()
    for k in a:
        assert (a[k] is None and b[k] is None) or abs(a[k] - b[k]) < 1e-12


def forecast_model():
    from footfall.catalog import ar_model
    return ar_model()


def test_kmeans_clusters(spark, panel):
    from footfall.operators import store_dim
    from footfall.plans.cluster import add_location_cluster
    t = standin.load(spark, SF001)
    tr, te = series.split(panel)
    stores = store_dim.build_stores(tr, te, t.store_info)
    out = add_location_cluster(stores, k=8, restarts=3, max_iter=50)
    per_store = out.groupBy("air_store_id").agg(F.countDistinct("cluster").alias("n"),
                                                F.min("cluster").alias("lo"),
                                                F.max("cluster").alias("hi")).collect()
    assert all(r.n == 1 and 0 <= r.lo <= r.hi <= 7 for r in per_store)
    assert out.count() == stores.count()


def test_logit_matches_newton(design):
    df = design.withColumn("large_party", F.when(F.col("visitors") >= 60, 1.0).otherwise(0.0))
    feats = ["visitors_lag1", "dow"]
    m = models.large_party_classifier(df, feats)
    pdf = df.select(*feats, "large_party").toPandas()
    X, y = pdf[feats].to_numpy(float), pdf["large_party"].to_numpy(float)
    w = np.zeros(len(feats))
    for _ in range(100):
        p = 1 / (1 + np.exp(-X @ w))
        w += np.linalg.solve(X.T @ (X * (p * (1 - p))[:, None]), X.T @ (y - p))
    assert np.allclose(m.coefficients, w, atol=1e-5)
    flagged = m.flag(df).select("large_party").distinct().collect()
    assert {r.large_party for r in flagged} <= {0.0, 1.0}


def test_search_leaderboard_and_persistence(design, tmp_path):
    cands = [("linear", models.linear_regression(True), [{}]),
             ("lasso", models.lasso(0.01), [{"regParam": 0.01}, {"regParam": 0.5}])]
    board, leader = search.model_search(design, FEATS, candidates=cands)
    rows = board.collect()
    assert len(rows) == 3 and [r.mean_rmsle for r in rows] == sorted(r.mean_rmsle for r in rows)
    path = search.save_model(leader, str(tmp_path / "leader"))
    again = search.load_model(path)
    a = [r.prediction for r in leader.transform(design).orderBy("air_store_id", "visit_date").collect()]
    b = [r.prediction for r in again.transform(design).orderBy("air_store_id", "visit_date").collect()]
    assert np.allclose(a, b)


def test_parallel_cv_equals_serial(design):
    serial = ordered_cv.time_series_cv(design, models.linear_regression(True), FEATS)
    par = ordered_cv.time_series_cv(design, models.linear_regression(True), FEATS, parallelism=3)
    assert np.allclose(serial, par)


def test_create_train_test_with_classifier_and_clean(spark):
    from footfall.plans import features
    t = standin.load(spark, SF001)
    fs = features.import_data(t, kmeans_restarts=2, kmeans_max_iter=20)
    train, test = features.create_train_test(fs, clean=True, predict_large_party=True,
                                             large_party_threshold=75)
    assert len(features.LARGE_PARTY_FEATURES) == 27
    assert set(features.LARGE_PARTY_FEATURES) <= set(train.columns)
    with pytest.raises(Exception, match="cluster"):
        features.create_train_test(features.FeatureSet(**{**vars(fs), "stores":
                                   fs.stores.drop("cluster")}), clean=True)
    assert test.count() == t.submission.count()
    assert {r.large_party for r in test.select("large_party").distinct().collect()} <= {0.0, 1.0}
    full, _ = features.create_train_test(fs)
    assert 0 < train.count() <= full.count()
    # every kept train row's categories occur in test (conjunction clean)
    for v in ("air_genre_name", "air_area_name", "air_store_id2", "cluster"):
        assert train.join(test.select(v).distinct(), v, "left_anti").count() == 0


def test_vif_collinear_is_inf(design):
    df = design.withColumn("twice", F.col("visitors_lag1") * 2)
    v = {r.features: r.vif_factor for r in diagnostics.vif(df, ["visitors_lag1", "twice", "dow"]).collect()}
    assert v["visitors_lag1"] == float("inf") and v["twice"] == float("inf")
    assert 1.0 <= v["dow"] < float("inf")


@pytest.fixture(scope="module")
def notebook_rows(spark):
    from footfall.catalog import _wide
    train, _ = _wide(spark, SF001)
    return train.select(*set(models.OLS_FEATURES_1), "log_visitors", "air_store_id",
                        "visit_date").cache()


def test_ols_on_the_notebook_columns_equals_the_row_level_pseudo_inverse(notebook_rows):
    feats = models.OLS_FEATURES_1
    pdf = notebook_rows.dropna(subset=feats + ["log_visitors"]).toPandas()
    X, y = pdf[feats].to_numpy(float), pdf["log_visitors"].to_numpy(float)
    beta = np.linalg.pinv(X) @ y
    table, stats, _ = diagnostics.ols(notebook_rows, feats)
    coef = {r.feature: r.coef for r in table.collect()}
    assert stats["rank"] == np.linalg.matrix_rank(X) < len(feats)
    assert np.allclose([coef[c] for c in feats], beta, atol=1e-6)
    sse = ((y - X @ beta) ** 2).sum()
    assert abs(stats["r2"] - (1 - sse / (y ** 2).sum())) < 1e-9
    order = pdf.sort_values(["air_store_id", "visit_date"])
    e = order["log_visitors"].to_numpy(float) - order[feats].to_numpy(float) @ beta
    assert abs(stats["durbin_watson"] - (np.diff(e) ** 2).sum() / (e ** 2).sum()) < 1e-6


def test_vif_of_exactly_collinear_notebook_columns_is_infinite(notebook_rows):
    v = {r.features: r.vif_factor for r in
         diagnostics.vif(notebook_rows, models.OLS_FEATURES_1).collect()}
    endless = {"day", "month", "year", "date_int", "air_area_name", "air_genre_name",
               "air_genre_name0", "air_area_name0"}
    assert {c for c, x in v.items() if x == float("inf")} >= endless
    assert all(1.0 <= v[c] < 1e6 for c in ("dow", "holiday_flg", "wom", "rv1_x"))


def test_boundary_folds_equal_numbered_folds(design):
    from footfall.operators.folds import with_fold
    rows = design.select("air_store_id", "visit_date")
    for order in ("time", "store"):
        a = {(r[0], r[1]): r["fold"] for r in assign_folds(rows, order)[0].select(
            "air_store_id", "visit_date", "fold").collect()}
        b = {(r[0], r[1]): r["fold"] for r in with_fold(rows, order).collect()}
        assert a == b


def test_search_fits_one_candidate_under_any_budget(design):
    cands = [("linear", models.linear_regression(True), [{}]),
             ("lasso", models.lasso(0.01), [{}])]
    board, leader = search.model_search(design, FEATS, candidates=cands, time_budget_s=0)
    assert [r.model for r in board.collect()] == ["linear"] and leader is not None


def test_unsettled_lasso_raises():
    with pytest.raises(RuntimeError):
        lasso.coordinate_descent(np.array([[1.0, 0.999], [0.999, 1.0]]), np.array([1.0, -1.0]),
                                 1.0, 1e-6, max_sweeps=1)
