"""Operators on hand-made rows with stated answers (FIXTURES §3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from footfall.operators import folds, reservations, series, store_dim
from footfall.operators.encode import fit_label_codes
from footfall.operators.joins import semi_join_null_safe
from footfall.operators.metrics import rmse_expr
from footfall.operators.ordinal import global_ordinal

D = dt.date


def test_lag_diff_positional(spark):
    visits = spark.createDataFrame(
        [("A", D(2017, 1, 1), 10), ("A", D(2017, 1, 2), 20), ("A", D(2017, 1, 5), 5),
         ("B", D(2017, 1, 1), 7)], "air_store_id string, visit_date date, visitors long")
    df = series.add_lags(series.visit_features(visits), lags=[1])
    rows = {(r.air_store_id, r.visit_date): r for r in df.collect()}
    a3 = rows[("A", D(2017, 1, 5))]
    assert round(a3.visitors_lag1, 6) == 2.995732 and round(a3.visitors_diff1, 6) == -1.386294
    assert a3.dow == 3
    assert rows[("A", D(2017, 1, 1))].visitors_lag1 is None
    assert rows[("B", D(2017, 1, 1))].visitors_lag1 is None


def test_reservations_golden(spark):
    ts = dt.datetime
    res = spark.createDataFrame(
        [("A", ts(2017, 1, 5, 19), ts(2017, 1, 1, 23), 2),
         ("A", ts(2017, 1, 5, 12), ts(2017, 1, 4, 1), 4),
         ("A", ts(2017, 1, 6, 12), ts(2017, 1, 6, 9), 3)],
        "air_store_id string, visit_datetime timestamp_ntz, reserve_datetime timestamp_ntz, "
        "reserve_visitors long")
    out = {r.visit_date: r for r in reservations.reservation_features(res).collect()}
    assert tuple(out[D(2017, 1, 5)])[2:] == (5, 6, 2.5, 3.0)
    assert tuple(out[D(2017, 1, 6)])[2:] == (0, 3, 0.0, 3.0)


@pytest.mark.parametrize("broadcast_rows", [10, 0])
def test_hpg_relation_inner_both_paths(spark, broadcast_rows):
    ts = dt.datetime
    res = spark.createDataFrame(
        [("h1", ts(2017, 1, 5), ts(2017, 1, 1), 2), ("h1", ts(2017, 1, 5), ts(2017, 1, 3), 4),
         ("h9", ts(2017, 1, 5), ts(2017, 1, 1), 9)],
        "hpg_store_id string, visit_datetime timestamp_ntz, reserve_datetime timestamp_ntz, "
        "reserve_visitors long")
    rel = spark.createDataFrame([("A", "h1")], "air_store_id string, hpg_store_id string")
    out = reservations.reservation_features(res, rel, broadcast_max_rows=broadcast_rows).collect()
    assert len(out) == 1  # h9 has no mapping: dropped (J1)
    assert tuple(out[0])[2:] == (6, 6, 3.0, 3.0)


def test_stats_median_count_and_missing_combo(spark):
    tr = spark.createDataFrame(
        [("A", 0, 1), ("A", 0, 2), ("A", 0, None), ("A", 0, 10), ("A", 0, 4)],
        "air_store_id string, dow int, visitors long")
    te = spark.createDataFrame([("A",)], "air_store_id string")
    s = store_dim.attach_stats(store_dim.store_dow_grid(te), store_dim.store_dow_stats(tr))
    rows = {r.dow: r for r in s.collect()}
    assert len(rows) == 7
    assert rows[0].median_visitors == 3.0 and rows[0].count_observations == 4
    assert all(getattr(rows[1], c) is None for c in store_dim.STAT_COLS)  # J7


def test_label_codes_code_point_order(spark):
    df = spark.createDataFrame([(v,) for v in ["é", "b", "", "日", "B", "a"]], "v string")
    codes = {r.value: r.code for r in fit_label_codes(df, ["v"]).table.collect()}
    assert [codes[v] for v in ["", "B", "a", "b", "é", "日"]] == [0, 1, 2, 3, 4, 5]


def test_label_codes_join_path_and_unseen(spark, monkeypatch):
    from footfall.operators import encode
    monkeypatch.setattr(encode, "MAX_INLINE_CODES", 1)
    tr = spark.createDataFrame([("x",), ("y",), ("z",)], "s string")
    codes = fit_label_codes(tr, ["s"])
    out = codes.apply(spark.createDataFrame([("z",), ("x",)], "s string"), {"s": "c"})
    assert sorted((r.s, r.c) for r in out.collect()) == [("x", 0), ("z", 2)]
    bad = codes.apply(spark.createDataFrame([("q",)], "s string"), {"s": "c"})
    with pytest.raises(Exception):
        bad.collect()
    kept = codes.apply(spark.createDataFrame([("q",)], "s string"), {"s": "c"},
                       handle_invalid="keep")
    assert kept.first().c is None


def test_global_ordinal_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    num, n = global_ordinal(df, ["k"], num_partitions=7)
    assert n == 5000
    assert num.where(F.col("ordinal") != F.col("k")).count() == 0


def test_folds_small_n(spark):
    df = spark.range(13).select(F.col("id").alias("k"))
    out, n = folds.assign_folds(df, ["k"], 5)
    got = {r.k: r.fold for r in out.collect()}
    assert [got[i] for i in range(13)] == [0, 0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_fold_bounds_formula():
    b = folds.fold_bounds(53307)
    assert b[0] == (8887, 8887 + 8884) and b[-1][1] == 53307


def test_semi_join_null_matches_null(spark):
    tr = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    te = spark.createDataFrame([(None,), (3,)], "v int")
    assert sorted(r.v if r.v is not None else -9 for r in semi_join_null_safe(tr, te, "v").collect()) == [-9, 3]


def test_rmse_golden(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 4.0)], "y double, p double")
    assert round(df.agg(rmse_expr("y", "p").alias("r")).first().r, 6) == 1.414214


def test_best_arg_min(spark):
    from footfall.operators.metrics import best, mean_over
    df = spark.createDataFrame([(0.1, 1, 0.5), (0.1, 2, 0.7), (0.2, 1, 0.4), (0.2, 2, 0.6)],
                               "lambda double, fold int, rmsle double")
    m = mean_over(df, ["lambda"])
    r = best(m, "lambda", "mean_rmsle").first()
    assert r.best_lambda == 0.2 and abs(r.min_mean_rmsle - 0.5) < 1e-12


def test_score_write_and_fitted(spark, tmp_path):
    from footfall.plans.scoring import fitted_vs_actual, score_predictions, write_scores
    pred = spark.createDataFrame([("a", -0.5), ("b", 1.0)], "id string, prediction double")
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    scored = {r.id: r.visitors for r in score_predictions(pred, ids).collect()}
    assert scored["a"] == 1.0 and abs(scored["b"] - 2.718281828) < 1e-8 and scored["c"] is None
    path = write_scores(score_predictions(pred, ids), str(tmp_path), "scored_lasso.csv")
    assert path.endswith("scored_lasso")
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["id", "visitors"] and back.count() == 3

    class Ident:
        def transform(self, df):
            return df.withColumn("prediction", F.log("visitors"))
    rows = spark.createDataFrame([("s", D(2017, 1, 1), 10)], "air_store_id string, visit_date date, visitors long")
    r = fitted_vs_actual(Ident(), rows).first()
    assert abs(r.predicted_visitors - 10) < 1e-9


def test_lag_of_repeated_days_is_fixed(spark):
    """Two rows of one store and day are ordered by value, whatever their input order."""
    rows = [("A", D(2017, 1, 1), 1.0), ("A", D(2017, 1, 2), 3.0), ("A", D(2017, 1, 2), 2.0),
            ("A", D(2017, 1, 3), 4.0)]
    seen = set()
    for r in (rows, rows[::-1]):
        df = spark.createDataFrame(r, "air_store_id string, visit_date date, log_visitors double")
        out = series.add_lags(df, lags=[1], diffs=False).collect()
        seen.add(tuple(sorted((x.visit_date, x.log_visitors, x.visitors_lag1) for x in out
                              if x.visitors_lag1 is not None)))
    assert seen == {((D(2017, 1, 2), 2.0, 1.0), (D(2017, 1, 2), 3.0, 2.0),
                     (D(2017, 1, 3), 4.0, 3.0))}
