"""Physical-plan regression checks for the scale properties the design relies on."""

import contextlib
import io

from conftest import SF001
from footfall import catalog
from footfall.operators import series
from footfall.plans import features
from footfall.sources import standin


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_panel_scan_prunes_and_pushes_cut(spark):
    t = standin.load(spark, SF001)
    plan = plan_of(series.build_panel(t.visits, t.submission))
    assert "LessThan(l_shipdate" in plan and "GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan
    # 14 lag/diff expressions: one Window node
    assert plan.count(") Window") == 1


def test_wide_assembly_is_shuffle_free_without_broadcast(spark):
    t = standin.load(spark, SF001)
    fs = features.import_data(t, cluster_rule=catalog.cluster_rule)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        train, _ = features.create_train_test(fs, clean=False)
        plan = plan_of(train)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    main = plan.split("===== Subqueries =====")[0]
    assert "SortMergeJoin" in main
    assert "Exchange hashpartitioning" not in main.replace("\n", " ") and ") Exchange" not in main


def test_wide_assembly_is_shuffle_free_in_a_plain_session(spark):
    """The joins keep the store layout in a session without the library's settings too."""
    keys = {"spark.sql.requireAllClusterKeysForCoPartition": "true",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        plan = plan_of(catalog.QUERIES["train_wide"](spark, SF001))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    main = plan.split("===== Subqueries =====")[0]
    assert "SortMergeJoin" in main and ") Exchange" not in main


def test_forecast_step_join_is_shuffle_free(spark):
    from footfall.plans import forecast
    from footfall.session import materialize_bucketed
    from pyspark.sql import functions as F
    t = standin.load(spark, SF001)
    _, te = series.split(series.build_panel(t.visits, t.submission))
    steps = materialize_bucketed(te.select("air_store_id", "visit_date", "id"),
                                 "air_store_id", "shape_steps", 8)
    state = materialize_bucketed(te.select("air_store_id", F.array(F.lit(1.0)).alias("s"))
                                 .dropDuplicates(["air_store_id"]), "air_store_id", "shape_state", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(steps.join(state, "air_store_id", "left"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and ") Exchange" not in plan


def test_fold_frame_needs_no_shuffle_of_the_wide_rows(spark):
    from footfall.operators.folds import with_fold
    t = standin.load(spark, SF001)
    rows = series.visit_features(t.visits).cache()
    plan = plan_of(with_fold(rows))
    above = plan.split("InMemoryTableScan")[0]
    assert "Exchange" not in above
    rows.unpersist()


def test_size_check_moves_no_rows(spark):
    """The count before a broadcast shuffles one number per task."""
    df = spark.range(1000)
    plan = plan_of(df.groupBy().count())
    assert "Limit" not in plan and "partial_count" in plan


def test_queries_leave_no_tables(spark):
    from footfall.session import drop_intermediates
    catalog.QUERIES["recursive_forecast_ar"](spark, SF001).count()
    assert drop_intermediates(spark) > 0
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("footfall_")]
