"""Session helpers: checkpoint dir, bucketed materialisation, size-checked broadcast."""

import contextlib
import io

from pyspark.sql import functions as F

from footfall.operators.joins import bounded_broadcast
from footfall.session import cut_lineage, ensure_checkpoint_dir, materialize_bucketed


def test_checkpoint_dir_is_stable(spark):
    a = ensure_checkpoint_dir(spark)
    assert a and ensure_checkpoint_dir(spark) == a


def test_cut_lineage_keeps_rows(spark):
    df = cut_lineage(spark.range(100).withColumn("x", F.col("id") % 7))
    assert df.count() == 100 and df.agg(F.sum("x")).first()[0] == sum(i % 7 for i in range(100))


def test_bucketed_table_aggregates_without_shuffle(spark):
    t = materialize_bucketed(spark.range(1000).withColumn("k", F.col("id") % 13), "k", "t", 8)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        t.groupBy("k").count().explain()
    assert "Exchange" not in buf.getvalue()
    assert t.count() == 1000


def test_bounded_broadcast_flags(spark):
    df = spark.range(3)
    assert bounded_broadcast(df, 3)[1] is True
    assert bounded_broadcast(df, 2)[1] is False
