"""Sources and sinks: CSV round trip with fixed schemas (S1-S4), E3, p-values."""

import math
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from footfall.plans.diagnostics import t_two_sided_p
from footfall.plans.encode import as_factors
from footfall.sources import read_csv_tables, read_submission_ids, write_csv, write_snapshot
from footfall.sources import schemas, standin


def test_csv_round_trip(spark, tmp_path):
    t = standin.load(spark, SF001)
    for name, (attr, schema) in schemas.CSV_FILES.items():
        df = getattr(t, attr)
        if "calendar_date" in df.columns:
            df = df.withColumn("calendar_date", F.col("calendar_date").cast("string"))
        write_csv(df.select(*[f.name for f in schema.fields]), str(tmp_path / name))
    back = read_csv_tables(spark, str(tmp_path))
    for name, (attr, schema) in schemas.CSV_FILES.items():
        got = getattr(back, attr)
        assert got.schema == schema
        assert got.count() == getattr(t, attr).count()
    ids = read_submission_ids(spark, str(tmp_path / "sample_submission.csv"))
    assert ids.columns == ["id"]


def test_snapshot_cuts_lineage(spark, tmp_path):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    back = write_snapshot(df, str(tmp_path / "snap"))
    assert back.count() == 10 and back.agg(F.sum("x")).first()[0] == 90


def test_t_pvalues():
    assert abs(t_two_sided_p(1.959963984540054, 1e7) - 0.05) < 1e-5
    assert abs(t_two_sided_p(2.2281388519649385, 10) - 0.05) < 1e-9
    assert t_two_sided_p(0.0, 5) == pytest.approx(1.0)


def test_as_factors(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 2.0), (3, 3.0)], "dow int, v double")
    with pytest.raises(ValueError):
        as_factors(df, ["dow", "missing_col"])
    out, model = as_factors(df, ["dow"])
    rows = sorted((r.dow, r.v) for r in out.collect())
    assert rows == [(0.0, 2.0), (1.0, 1.0), (1.0, 3.0)]
    assert out.schema["dow"].metadata["ml_attr"]["type"] == "nominal"
    with pytest.raises(ValueError):
        as_factors(df, [])
