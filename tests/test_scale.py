"""Work and shares of tasks that must not grow faster than the input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall import catalog, session
from footfall.plans import cluster, lasso, models, newton, ordered_cv, qr, search, stacking
from footfall.sources import standin

from conftest import SF001


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.RandomState(3)
    x = r.normal(size=(600, 2))
    y = 1.5 * x[:, 0] - 0.2 * x[:, 1] + r.normal(size=600)
    data = [(f"s{i % 7}", i // 7, float(a), float(b), float(c), float(c > 0))
            for i, ((a, b), c) in enumerate(zip(x, y))]
    return spark.createDataFrame([*data, ("s0", 999, None, 1.0, 1.0, 1.0)],
                                 "air_store_id string, visit_date int, a double, b double, "
                                 "log_visitors double, large double").cache()


def test_partitions_grow_with_the_input(spark):
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        session.scale_partitions(spark, 10 * base * session.PARTITION_ROWS)
        assert session.shuffle_partitions(spark) == 10 * base
        session.scale_partitions(spark, 1)
        assert session.shuffle_partitions(spark) == base
        spark.conf.set(session._INITIAL, "3")       # the user's own
        session.scale_partitions(spark, 10 * base * session.PARTITION_ROWS)
        assert spark.conf.get(session._INITIAL) == "3"
    finally:
        spark.conf.unset(session._INITIAL)
        session._initial.clear()


def test_packed_rows_give_the_same_factor(rows):
    plain = qr.triangular_factor(rows, ["a", "b", "log_visitors"])
    packed = qr.triangular_factor(qr.packed_rows(rows, ["a", "b", "log_visitors"]),
                                  ["a", "b", "log_visitors"])
    assert plain.n == packed.n == 600
    assert np.allclose(plain.r.T @ plain.r, packed.r.T @ packed.r, rtol=1e-12)


def test_packed_blocks_weigh_what_their_file_weighs(spark, monkeypatch):
    """A partition's blocks are one Arrow batch: rows that pack well must be small in it."""
    monkeypatch.setattr(qr, "BLOCK_ROWS", 500)
    few = spark.range(0, 20_000, 1, 2).selectExpr("id % 7 as a", "id % 3 as b", "1 as c")
    blocks = qr.packed_rows(few, ["a", "b", "c"])
    assert blocks.agg(F.sum(F.length(qr.PACKED))).first()[0] < 20_000 * 3 * 8 / 10
    by_file = blocks.groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in by_file) <= qr.FILE_BLOCKS
    assert qr.triangular_factor(blocks, ["a", "b", "c"]).n == 20_000


def test_logit_reads_its_input_once(spark, rows):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    newton.fit_logit(rows.mapInPandas(count, rows.schema), ["a", "b"], "large")
    assert seen.value == 601


def test_large_stored_frames_are_not_kept_again(spark, rows, monkeypatch, tmp_path):
    rows.dropna().write.parquet(str(tmp_path / "frame"))
    frame = spark.read.parquet(str(tmp_path / "frame"))
    cands = [("linear", models.linear_regression(True), [{}]),
             ("lasso", models.lasso(0.05), [{"regParam": 0.05}])]
    kept = ordered_cv.with_folds(frame, stored=True)
    want, _ = search.model_search(frame, ["a", "b"], candidates=cands)
    assert kept.is_cached
    monkeypatch.setattr(ordered_cv, "KEPT_BYTES", 0)
    folds = ordered_cv.with_folds(frame, stored=True)
    assert not folds.is_cached
    assert sorted(folds.collect()) == sorted(kept.collect())
    kept.unpersist()
    board, leader = search.model_search(frame, ["a", "b"], candidates=cands, stored=True)
    assert [r[:2] for r in board.collect()] == [r[:2] for r in want.collect()]
    for a, b in zip(board.collect(), want.collect()):
        assert a["mean_rmsle"] == pytest.approx(b["mean_rmsle"], rel=1e-9)
    assert leader.transform(frame).count() == 600


def test_lasso_candidates_are_solved_from_one_pass(spark, rows, monkeypatch, tmp_path):
    """The exact optimum on every split, without a row-level fit."""
    full = rows.dropna()
    want = []
    folds = ordered_cv.with_folds(full)
    for i in range(1, 6):
        line = lasso.lasso_fit(folds.where(F.col("fold") < i), ["a", "b"], alpha=0.05)
        e = line.transform(folds.where(F.col("fold") == i)).select(
            F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("log_visitors"), 2)))).first()[0]
        want.append(e)
    folds.unpersist()
    monkeypatch.setattr(ordered_cv, "regression_pipeline", None)
    monkeypatch.setattr(stacking, "regression_pipeline", None)
    cands = [("lasso", models.lasso(0.05), [{"regParam": 0.05}, {"regParam": 5.0}])]
    board, leader = search.model_search(full, ["a", "b"], candidates=cands)
    assert board.first()["mean_rmsle"] == pytest.approx(np.mean(want), rel=1e-9)
    saved = search.load_model(search.save_model(leader, str(tmp_path / "m")))
    for a, b in zip(leader.transform(full).collect(), saved.transform(full).collect()):
        assert a["prediction"] == pytest.approx(b["prediction"])


def test_model_frames_are_columnar(spark):
    train, test = catalog._model_frames(spark, SF001)
    for df in (train, test):
        assert df.inputFiles() and all(f.endswith(".parquet") for f in df.inputFiles())


def _lineitem(spark, path, rows):
    spark.createDataFrame(rows, "l_suppkey long, l_shipdate string, l_quantity double").withColumn(
        "l_shipdate", F.to_timestamp_ntz("l_shipdate")).write.parquet(str(path / "lineitem.parquet"))
    return str(path)


def test_store_ids_are_grouped_as_their_numbers(spark, tmp_path):
    keys = [None, 0, 7, -1, 99_999_999, 100_000_000, 100_000_001, 10_000_000, 123_456_789_012,
            -9_999_999, -10_000_000, -12_345_678, -1_234_567, 2 ** 63 - 1, -(2 ** 63)]
    d = _lineitem(spark, tmp_path, [(k, day, 1.0 + i) for i, k in enumerate(keys)
                                    for day in ("2001-01-01 05:00:00", "2001-01-01 00:00:00", None)])
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    want = li.groupBy(standin._padded("air_", F.col("l_suppkey")).alias("s"),
                      F.to_date("l_shipdate").alias("d")).agg(
        F.sum("l_quantity").cast("bigint").alias("v"))
    got = standin.visits_all(spark, d)
    assert sorted(map(str, got.collect())) == sorted(
        map(str, want.toDF("air_store_id", "visit_date", "visitors").collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(air_store_id" not in plan and "lpad" not in plan.split("Exchange")[1]


def test_tasks_of_the_panel_grow_with_the_input(spark, monkeypatch):
    monkeypatch.setattr(session, "FRAME_ROWS", 250)
    want = -(-standin.rows(spark, SF001) // 250)
    assert want > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert catalog._x1_rows(spark, SF001).rdd.getNumPartitions() == want


def test_tasks_of_the_fold_statistics_grow_with_the_input(spark, monkeypatch):
    before = {tuple(r) for r in catalog.QUERIES["store_dow_stats_by_fold"](spark, SF001).collect()}
    monkeypatch.setattr(session, "FRAME_ROWS", 250)
    out = catalog.QUERIES["store_dow_stats_by_fold"](spark, SF001)
    assert out.rdd.getNumPartitions() == -(-standin.rows(spark, SF001) // 250)
    assert {tuple(r) for r in out.collect()} == before


def test_passes_of_kmeans_run_a_task_per_share_of_points(spark, monkeypatch):
    r = np.random.RandomState(5)
    stores = spark.createDataFrame(
        [(f"s{i}", float(x), float(y)) for i, (x, y) in enumerate(r.normal(size=(400, 2)))],
        "air_store_id string, longitude double, latitude double")
    seen, step = [], cluster.kmeans_step

    def kept(points, centres):
        seen.append(points.rdd.getNumPartitions())
        return step(points, centres)

    monkeypatch.setattr(cluster, "kmeans_step", kept)
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        cluster.fit_location_clusters(stores, k=3, restarts=2)
        assert set(seen) == {1}
        seen.clear()
        monkeypatch.setattr(cluster, "POINTS", 100)
        cluster.fit_location_clusters(stores, k=3, restarts=2)
        assert set(seen) == {4}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
