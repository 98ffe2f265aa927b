"""Prefix sums, factors per fold, quantiles, statistics per fold and reading with bad rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from footfall.operators import folds, store_dim
from footfall.plans import diagnostics
from footfall.plans.qr import factors_by, merged, triangular_factor
from footfall.sources import tables


def test_running_counts_over_many_keys(spark):
    rows = [(None, 3), *((f"k{i * 37 % 500:03d}", i % 5 + 1) for i in range(500))]
    df = spark.createDataFrame(rows, "key string, n long").repartition(7)
    got, total = folds.running_counts(df, "key")
    want, upto = {}, 0
    for k, n in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "")):
        upto += n
        want[k] = upto
    assert total == upto and {r["key"]: r["upto"] for r in got.collect()} == want
    assert folds.running_counts(df.limit(0), "key")[1] == 0


@pytest.mark.parametrize("order", ["time", "store"])
def test_no_window_without_partition(spark, order, capfd):
    df = spark.range(300).selectExpr("cast(id % 20 as string) as air_store_id",
                                     "date_add(date'2020-01-01', cast(id div 20 as int)) as visit_date")
    plan = folds.with_fold(df, order).groupBy("fold").count()
    assert sorted(r["count"] for r in plan.collect()) == [50] * 6
    assert "No Partition Defined" not in capfd.readouterr().err


def test_factors_of_folds_merge(spark):
    r = np.random.RandomState(1)
    z = r.randn(200, 3)
    df = spark.createDataFrame(pd.DataFrame(z, columns=list("abc")).assign(
        k=np.arange(200) % 3)).repartition(4)
    of = factors_by(df, ["a", "b", "c"], "k", constant=True)
    assert sorted(of) == [0, 1, 2] and sum(f.n for f in of.values()) == 200
    whole = triangular_factor(df, ["a", "b", "c"], constant=True).r
    both = merged(list(of.values())).r
    assert np.allclose(both.T @ both, whole.T @ whole)


@pytest.mark.parametrize("share,dof,want", [
    (0.975, 10, 2.2281388519649385), (0.025, 10, -2.2281388519649385), (0.995, 1, 63.65674116287),
    (0.975, 1e7, 1.9599642), (0.5, 3, 0.0)])
def test_quantiles_of_t(share, dof, want):
    assert diagnostics.t_quantile(share, dof) == pytest.approx(want, rel=1e-6)


def test_upper_tail_of_f():
    assert diagnostics.f_upper_p(4.0, 2, 10) == pytest.approx(1.8 ** -5)
    assert diagnostics.f_upper_p(2.5 ** 2, 1, 9) == pytest.approx(diagnostics.t_two_sided_p(2.5, 9))


def test_statistics_of_windows(spark):
    r = np.random.RandomState(2)
    pdf = pd.DataFrame({"air_store_id": r.choice(["a", "b"], 300), "dow": r.randint(0, 3, 300),
                        "visitors": r.randint(1, 9, 300), "fold": np.arange(300) * 6 // 300})
    got = store_dim.store_dow_stats_by_fold(spark.createDataFrame(pdf)).toPandas()
    for i in range(1, 6):
        g = pdf[pdf.fold < i].groupby(["air_store_id", "dow"]).visitors
        mine = got[got.fold == i].set_index(["air_store_id", "dow"]).sort_index()
        for name, f in (("min", g.min()), ("mean", g.mean()), ("median", g.median()),
                        ("max", g.max())):
            assert np.allclose(mine[f"{name}_visitors"], f.sort_index())
        assert (mine["count_observations"] == g.count().sort_index()).all()


def test_bad_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,n,d\nx,1,2020-01-01\ny,two,2020-01-01\nz,3\n"
                                     "w,4,2020-01-01,5\n,5,2020-02-30\nv,,\n")
    schema = spark.createDataFrame([], "a string, n int, d date").schema
    good, bad = tables.read_csv_checked(spark, str(tmp_path / "in.csv"), schema,
                                        str(tmp_path / "rejected"))
    assert sorted((r["a"], r["n"]) for r in good.collect()) == [("v", None), ("x", 1)]
    assert sorted(r["line"] for r in bad.collect()) == [
        ",5,2020-02-30", "w,4,2020-01-01,5", "y,two,2020-01-01", "z,3"]
    assert spark.read.parquet(str(tmp_path / "rejected")).agg(F.count("*")).first()[0] == 4
