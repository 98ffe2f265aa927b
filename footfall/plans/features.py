"""Composite feature pipelines: C1 ``import_data`` and C2 ``create_train_test``.

Everything stays one lazy lineage except where a fit needs an action (label
codes, the location clusters, the large-party classifier).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators import assemble, reservations, series, store_dim
from footfall.plans.cluster import add_location_cluster
from footfall.session import (cut_lineage, keep_methods_compiled, keep_store_layout, materialize,
                              materialize_bucketed, shuffle_partitions)
from footfall.sources.tables import Tables


@dataclass(frozen=True)
class FeatureSet:
    train_rows: DataFrame   # panel rows of the train subset (lags, diffs)
    test_rows: DataFrame    # panel rows of the test subset (with ``id``)
    stores: DataFrame       # store x dow dimension
    hol: DataFrame          # calendar
    ar: DataFrame           # air reservations per (store, day)
    hr: DataFrame           # hpg reservations per (store, day)


def import_data(t: Tables, test_value: float | None = 0.0, large_party_threshold: float = 120,
                n_tokens: int = 10, kmeans_restarts: int = 25, kmeans_max_iter: int = 1000,
                seed: int = 0, cluster_rule: Callable[[DataFrame], DataFrame] | None = None
                ) -> FeatureSet:
    """C1.  The stores get their location cluster (M1): KMeans, or
    ``cluster_rule``, which takes the stores and adds an int column ``cluster``."""
    # The panel, calendar and reservation aggregates feed several consumers
    # (statistics, code fits, train and test assembly): materialise each once
    # instead of re-aggregating the raw tables per consumer.
    #
    # Every store-keyed intermediate is written as a table bucketed by store
    # into the same number of buckets; with
    # spark.sql.requireAllClusterKeysForCoPartition off (``keep_store_layout``)
    # the (store, dow) and (store, day) joins of the assembly then run without
    # shuffling the panel again.
    keep_methods_compiled(t.visits.sparkSession)
    keep_store_layout(t.visits.sparkSession)
    parts = shuffle_partitions(t.visits.sparkSession)
    panel = materialize_bucketed(
        series.build_panel(t.visits, t.submission, test_value=test_value,
                           large_party_threshold=large_party_threshold, partitions=parts),
        "air_store_id", "panel", parts)
    train_rows, test_rows = series.split(panel)
    stores = store_dim.build_stores(train_rows, test_rows, t.store_info, n_tokens,
                                    partitions=parts)
    clustered = cluster_rule(stores) if cluster_rule else add_location_cluster(
        stores, k=8, restarts=kmeans_restarts, max_iter=kmeans_max_iter, seed=seed)
    stores = materialize_bucketed(clustered, "air_store_id", "stores_clustered", parts)
    return FeatureSet(
        train_rows=train_rows, test_rows=test_rows, stores=stores,
        hol=assemble.holiday_table(cut_lineage(t.date_info)),
        ar=materialize_bucketed(reservations.reservation_features(t.air_reserve),
                                "air_store_id", "air_reservations", parts),
        hr=materialize_bucketed(reservations.reservation_features(t.hpg_reserve,
                                                                  t.store_relation),
                                "air_store_id", "hpg_reservations", parts),
    )


# The classifier's input columns.
LARGE_PARTY_FEATURES = [
    "dow", "wom", "year", "month", "day", "day_of_week", "holiday_flg",
    "air_genre_name", "air_area_name", "air_store_id2", "cluster",
    "min_visitors", "mean_visitors", "median_visitors", "max_visitors",
    "count_observations", "rs1_x", "rv1_x", "rs2_x", "rv2_x", "rs1_y",
    "rv1_y", "rs2_y", "rv2_y", "total_reserv_sum", "total_reserv_mean",
    "total_reserv_dt_diff_mean"]


def create_train_test(fs: FeatureSet, clean: bool = False, predict_large_party: bool = False,
                      large_party_threshold: float = 120, clean_last_only: bool = False
                      ) -> tuple[DataFrame, DataFrame]:
    """The wide train and test rows, cleaned and with a predicted ``large_party`` on demand."""
    train, test = assemble.create_train_test(fs.train_rows, fs.test_rows, fs.stores, fs.hol,
                                             fs.ar, fs.hr, clean=clean,
                                             clean_last_only=clean_last_only)
    if predict_large_party:
        from footfall.plans.models import large_party_classifier
        train = train.withColumn("large_party", F.when(F.col("visitors") >= large_party_threshold,
                                                       1.0).otherwise(0.0))
        # the fit and every model after it read the frame: assemble it once
        train = materialize(train, "train_frame")
        test = large_party_classifier(train, LARGE_PARTY_FEATURES).flag(test)
    return train, test
