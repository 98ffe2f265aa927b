"""The store x day-of-week dimension.

Rows: every store that has test rows x dow 0..6 (trap T12: train-only stores
get no statistics).  Statistics of train visitors per (store, dow) come from
one aggregate (min, mean, exact median, max, non-null count) and one left
join — a combination never seen in train has all five missing, the count too.

Scale: the grid is ``explode(sequence(0, 6))`` over distinct stores (no cross
join); the statistics aggregate is partial/final except the exact median,
which buffers one (store, dow) group — at most one value per calendar day of
that weekday, because the panel is unique on (store, day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import text
from footfall.operators.encode import fit_label_codes
from footfall.session import cut_lineage, materialize_bucketed

STORE = "air_store_id"
STAT_COLS = ["min_visitors", "mean_visitors", "median_visitors", "max_visitors",
             "count_observations"]


def store_dow_grid(test_rows: DataFrame) -> DataFrame:
    """Distinct test stores x dow 0..6."""
    return (test_rows.select(STORE).where(F.col(STORE).isNotNull()).distinct()
            .withColumn("dow", F.explode(F.sequence(F.lit(0), F.lit(6)))))


def store_dow_stats(train_rows: DataFrame) -> DataFrame:
    """A3-A7 in one aggregate; null keys and null visitors are skipped."""
    v = F.nanvl(F.col("visitors").cast("double"), F.lit(None).cast("double")) \
        if dict(train_rows.dtypes).get("visitors") in ("double", "float") else F.col("visitors")
    return (train_rows.where(F.col(STORE).isNotNull() & F.col("dow").isNotNull())
            .select(STORE, "dow", v.alias("visitors"))
            .groupBy(STORE, "dow")
            .agg(F.min("visitors").alias("min_visitors"),
                 F.avg("visitors").alias("mean_visitors"),
                 F.median("visitors").alias("median_visitors"),
                 F.max("visitors").alias("max_visitors"),
                 F.count("visitors").alias("count_observations")))


def store_dow_stats_by_fold(rows: DataFrame, n_splits: int = 5, partitions: int | None = None
                            ) -> DataFrame:
    """The statistics of each expanding window (trap T13): ``fold`` i has those of the rows of all
    folds before i, so that no test row takes part in its own inputs.

    Rows are counted once per (store, dow, fold, value); the counts of the earlier folds add
    up to those of a window, and the exact median is the one of the counted values.

    ``partitions`` deals the rows by store, which all three aggregates then reuse.
    """
    if partitions:
        rows = rows.repartition(partitions, STORE)
    counts = rows.where(F.col(STORE).isNotNull() & F.col("dow").isNotNull()
                        & F.col("visitors").isNotNull()).groupBy(
        STORE, "dow", F.col("fold").alias("__of"), "visitors").agg(F.count(F.lit(1)).alias("__n"))
    windows = counts.where(F.col("__of") < n_splits).withColumn(
        "fold", F.explode(F.sequence(F.col("__of") + 1, F.lit(n_splits))))
    summed = windows.groupBy(STORE, "dow", "fold", "visitors").agg(F.sum("__n").alias("__n"))
    return summed.groupBy(STORE, "dow", "fold").agg(
        F.min("visitors").alias("min_visitors"),
        (F.sum(F.col("visitors") * F.col("__n")) / F.sum("__n")).alias("mean_visitors"),
        F.expr("percentile(visitors, 0.5, __n)").alias("median_visitors"),
        F.max("visitors").alias("max_visitors"), F.sum("__n").alias("count_observations"))


def attach_stats(grid: DataFrame, stats: DataFrame) -> DataFrame:
    """One left join of the statistics onto the grid."""
    return grid.join(stats, [STORE, "dow"], "left")


def attach_store_info(stores: DataFrame, store_info: DataFrame) -> DataFrame:
    """J6."""
    return stores.join(store_info, STORE, "left")


def genre_area_tokens(stores: DataFrame, n_tokens: int = 10) -> DataFrame:
    """F4 + F5: normalised genre/area text and ``n_tokens`` tokens of each."""
    df = stores.withColumns({
        "air_genre_name": text.replace_char("air_genre_name", "/", " "),
        "air_area_name": text.replace_char("air_area_name", "-", " "),
    })
    toks = {}
    for name in ("air_genre_name", "air_area_name"):
        for i, c in enumerate(text.tokens(name, n_tokens)):
            toks[f"{name}{i}"] = c
    return df.withColumns(toks)


def token_columns(n_tokens: int = 10) -> list[str]:
    return ([f"air_genre_name{i}" for i in range(n_tokens)]
            + [f"air_area_name{i}" for i in range(n_tokens)])


def encode_text(stores: DataFrame, n_tokens: int = 10) -> DataFrame:
    """E1 on the token columns and the genre/area text, fitted on ``stores``."""
    cols = token_columns(n_tokens) + ["air_genre_name", "air_area_name"]
    return fit_label_codes(stores, cols).apply(stores)


def build_stores(train_rows: DataFrame, test_rows: DataFrame, store_info: DataFrame,
                 n_tokens: int = 10, encode: bool = True, partitions: int | None = None
                 ) -> DataFrame:
    """Grid + statistics + store info + tokens (+ codes)."""
    stores = attach_store_info(attach_stats(store_dow_grid(test_rows),
                                            store_dow_stats(train_rows)), store_info)
    stores = genre_area_tokens(stores, n_tokens)
    if not encode:
        return stores
    # Materialise the dimension once: the code fit and every later join read it.
    if partitions:
        # bucketed by store like the panel, so the (store, dow) join reuses it
        return encode_text(materialize_bucketed(stores, STORE, "stores", partitions), n_tokens)
    return encode_text(cut_lineage(stores), n_tokens)
