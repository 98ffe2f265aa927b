"""The notebook and AutoML flows end to end on CSV files (small settings)."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from footfall.plans import flows, models
from footfall.sources import read_csv_tables, schemas, standin, write_csv


def _csv_tables(spark, root):
    t = standin.load(spark, SF001)
    for name, (attr, schema) in schemas.CSV_FILES.items():
        df = getattr(t, attr)
        if "calendar_date" in df.columns:
            df = df.withColumn("calendar_date", F.col("calendar_date").cast("string"))
        write_csv(df.select(*[f.name for f in schema.fields]), os.path.join(root, name))
    return read_csv_tables(spark, root)


@pytest.mark.skipif(not os.environ.get("FOOTFALL_HEAVY"), reason="~4 min; set FOOTFALL_HEAVY=1")
def test_flows_end_to_end(spark, tmp_path):
    t = _csv_tables(spark, str(tmp_path / "data"))
    out = flows.notebook_flow(t, str(tmp_path / "out"), large_party_threshold=75,
                              alphas=[0.001, 0.1], forest_trees=5, boost_rounds=3,
                              kmeans_restarts=2, kmeans_max_iter=20)
    n_ids = t.submission.count()
    for name in ("scored_lm", "scored_lasso", "scored_random_forest", "scored_lgbm"):
        back = spark.read.option("header", True).csv(out[name])
        assert back.count() == n_ids and back.where(F.col("visitors").isNull()).count() == 0
    assert out["lasso_best"].count() == 1 and len(out["gbt_cv"]) == 5

    cands = [("linear", models.linear_regression(True), [{}])]
    res = flows.automl_flow(t, str(tmp_path / "out"), str(tmp_path / "models"),
                            large_party_threshold=75, candidates=cands, kmeans_restarts=2,
                            kmeans_max_iter=20)
    back = spark.read.option("header", True).csv(res["path"])
    assert back.count() == n_ids
    assert res["leader"].first().model == "linear"
