"""Scoring and output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import numeric as num
from footfall.sources.tables import write_csv


def to_visitors(pred: DataFrame, prediction: str = "prediction", log: bool = True,
                clip: bool = True) -> DataFrame:
    """P11 then F15: clip negatives to 0, back-transform from log space."""
    p = F.col(prediction)
    if clip:
        p = num.clip_negative(p)
    return pred.withColumn("visitors", F.exp(p) if log else p.cast("double"))


def score_predictions(pred: DataFrame, submission_ids: DataFrame, prediction: str = "prediction",
                      log: bool = True, how: str = "left") -> DataFrame:
    """Predictions keyed by ``id`` attached to the submission ids by key
    (not by position, trap T9).  ``how="inner"`` is J10."""
    scored = to_visitors(pred, prediction, log).select("id", "visitors")
    return submission_ids.select("id").join(scored, "id", how)


def write_scores(scored: DataFrame, out_dir: str, name: str) -> str:
    """S3: ``<out_dir>/<name>`` as header CSV (a trailing ``.csv`` in ``name``
    is stripped, trap T10)."""
    if name.endswith(".csv"):
        name = name[:-4]
    path = f"{out_dir.rstrip('/')}/{name}"
    write_csv(scored, path)
    return path


def fitted_vs_actual(model, train: DataFrame) -> DataFrame:
    """exp(prediction) beside the observed visitors."""
    return (model.transform(train)
            .select("air_store_id", "visit_date", "visitors",
                    F.exp("prediction").alias("predicted_visitors")))
