"""The (store, day) panel: calendar features, train/test union, positional
lags and differences, split (U1, P3, P7, P9, W1, W2, F1, F2, F10-F14).

Partitioning: the panel holds one row per (store, day), so the lag Window
(partition by store, order by day) sees at most one row per calendar day of a
store — its groups are bounded by the calendar, however large the data.  The
raw rows behind it are pre-aggregated map-side before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import calendar as cal
from footfall.functions import numeric as num
from footfall.functions import text

STORE = "air_store_id"
DAY = "visit_date"
TARGET = "log_visitors"
LAG_PREFIX = "visitors_lag"
DIFF_PREFIX = "visitors_diff"


def store_window(store: str = STORE, order: str = DAY, tie: str | None = None):
    """The one window spec of the workload; ``tie`` orders rows of one store and day (trap T18)."""
    return Window.partitionBy(store).orderBy(order, *([tie] if tie else []))


def visit_features(visits: DataFrame, large_party_threshold: float = 120) -> DataFrame:
    """Train rows: log target, calendar parts and the large-party flag."""
    return (visits
            .where(F.col(STORE).isNotNull() & F.col(DAY).isNotNull())
            .withColumn(DAY, cal.to_day(DAY))
            .withColumns({TARGET: num.log_value("visitors"),
                          **cal.calendar_parts(DAY),
                          "large_party": num.threshold_flag("visitors", large_party_threshold)}))


def submission_features(submission: DataFrame, test_value: float | None = 0.0,
                        large_party_threshold: float = 120) -> DataFrame:
    """Test rows parsed from the submission ids (F1, F2).

    ``test_value`` is the placeholder target: 0.0 reproduces the original
    (trap T7); ``None`` leaves it missing, which keeps test-period lags honest.
    """
    day = cal.to_day(text.id_date_text("id"))
    placeholder = F.lit(test_value).cast("double")
    return (submission
            .withColumns({DAY: day, STORE: text.id_store("id")})
            .withColumns({TARGET: placeholder,
                          **cal.calendar_parts(DAY),
                          "large_party": num.threshold_flag("visitors", large_party_threshold)}))


def lag_columns(value: str = TARGET, lags=range(1, 8), diffs: bool = True,
                store: str = STORE, order: str = DAY) -> dict[str, Column]:
    """``lag_k`` and ``value - lag_k`` over one window spec.

    All expressions share a single Window node and a single sort.
    """
    w = store_window(store, order, tie=value)
    out = {}
    for k in lags:
        lag = F.lag(value, k).over(w)
        out[f"{LAG_PREFIX}{k}"] = lag
        if diffs:
            out[f"{DIFF_PREFIX}{k}"] = F.col(value) - lag
    return out


def add_lags(df: DataFrame, value: str = TARGET, lags=range(1, 8), diffs: bool = True,
             store: str = STORE, order: str = DAY) -> DataFrame:
    return df.withColumns(lag_columns(value, lags, diffs, store, order))


def combine(train: DataFrame, test: DataFrame) -> DataFrame:
    """U1 + P3: union by name with the ``subset`` tag; ``id`` only on test."""
    return (train.withColumn("subset", F.lit("train"))
            .unionByName(test.withColumn("subset", F.lit("test")),
                         allowMissingColumns=True))


def split(combined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P7 + P5: the two subsets, with the tag really dropped (trap T11)."""
    tr = combined.where(F.col("subset") == "train").drop("subset")
    te = combined.where(F.col("subset") == "test").drop("subset")
    return tr, te


def build_panel(visits: DataFrame, submission: DataFrame, test_value: float | None = 0.0,
                large_party_threshold: float = 120, lags=range(1, 8),
                diffs: bool = True, partitions: int | None = None) -> DataFrame:
    """Combined panel with lags/diffs and the ``subset`` tag.

    ``partitions`` pins the store partitioning (``repartition(n, store)``)
    that the window needs anyway, so later store-keyed joins and aggregates
    can reuse it instead of shuffling the panel again.
    """
    tr = visit_features(visits, large_party_threshold)
    te = submission_features(submission, test_value, large_party_threshold)
    both = combine(tr, te)
    if partitions:
        both = both.repartition(partitions, STORE)
    return add_lags(both, lags=lags, diffs=diffs)
