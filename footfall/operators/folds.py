"""Ordered (expanding-window) fold assignment, W3.

``TimeSeriesSplit(n_splits)`` over n rows in a fixed order: ``ts = n div
(n_splits + 1)``, the first ``base = n - n_splits * ts`` rows are only ever
trained on, and fold i (1..n_splits) tests on rows
``[base + (i-1) ts, base + i ts)`` and trains on every row before them.

Order: ``"time"`` (visit_date, air_store_id) — folds split time, the intent of
the original — or ``"store"`` (air_store_id, visit_date), the store-major
order the original actually produced (trap T8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.operators.ordinal import global_ordinal
from footfall.session import cut_lineage

ORDERS = {"time": ["visit_date", "air_store_id"], "store": ["air_store_id", "visit_date"]}


def fold_of(pos, n: int, n_splits: int = 5):
    """Fold number (0 = base, 1..n_splits = test folds) of a 0-based position."""
    ts = n // (n_splits + 1)
    base = n - n_splits * ts
    if ts == 0:
        return F.lit(0)
    return F.when(pos < base, F.lit(0)).otherwise(
        (F.lit(1) + F.floor((pos - base) / ts)).cast("int")).cast("int")


def assign_folds(df: DataFrame, order: str | list[str] = "time", n_splits: int = 5,
                 out: str = "fold") -> tuple[DataFrame, int]:
    """Add ``ordinal`` and ``out``; returns (frame, n)."""
    cols = ORDERS[order] if isinstance(order, str) else list(order)
    numbered, n = global_ordinal(df, cols, materialize_input=True)
    return numbered.withColumn(out, fold_of(F.col("ordinal"), n, n_splits)), n


def fold_starts(df: DataFrame, order: str | list[str] = "time", n_splits: int = 5
                ) -> list[tuple]:
    """The order keys of the first row of each test fold (fewer if folds are empty).

    Rows are counted per leading key (a day, or a store); the leading key that holds a
    fold's first position comes from the running counts, and only the rows of these
    at most ``n_splits`` keys are numbered to find the row itself.
    """
    lead, then = ORDERS[order] if isinstance(order, str) else order
    running, n = running_counts(df.groupBy(lead).agg(F.count(F.lit(1)).alias("n")), lead)
    size = n // (n_splits + 1)
    if not size:
        return []
    starts = [n - n_splits * size + i * size for i in range(n_splits)]
    held = running.where(F.lit(False) if not starts else F.exists(
        F.array(*[F.lit(s).cast("long") for s in starts]),
        lambda s: (s >= F.col("upto") - F.col("n")) & (s < F.col("upto")))).collect()
    rows = df.where(F.col(lead).isin([r[lead] for r in held])).select(lead, then)
    place = Window.partitionBy(lead).orderBy(F.col(then).asc_nulls_first())
    before = {r[lead]: r["upto"] - r["n"] for r in held}
    wanted = F.lit(False)
    for s in starts:
        key = next(r[lead] for r in held if before[r[lead]] <= s < r["upto"])
        wanted = wanted | ((F.col(lead) == F.lit(key)) & (F.col("i") == s - before[key]))
    found = rows.withColumn("i", F.row_number().over(place) - 1).where(wanted).collect()
    return sorted((r[lead], r[then]) for r in found)


def running_counts(counts: DataFrame, lead: str) -> tuple[DataFrame, int]:
    """``counts`` (``lead``, n) with ``upto``, the sum of n up to and with each row, and the whole sum.

    A prefix sum on two levels: the rows lie in range partitions of ``lead``; each
    partition's total (one number a partition) gives the offsets of the next ones, and the sums
    inside a partition need its rows alone.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.col(lead).asc_nulls_first()
    dealt = cut_lineage(counts.repartitionByRange(parts, key)
                        .withColumn("__part", F.spark_partition_id()))
    offsets, total = {}, 0
    for r in sorted(dealt.groupBy("__part").agg(F.sum("n").alias("n")).collect()):
        offsets[r["__part"]] = total
        total += r["n"]
    before = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in offsets.items()
                                         for x in kv]) if offsets else F.create_map(
        F.lit(0).cast("long"), F.lit(0).cast("long")), F.col("__part").cast("long"))
    inside = F.sum("n").over(Window.partitionBy("__part").orderBy(key))
    return cut_lineage(dealt.withColumn("upto", inside + before).drop("__part")), total


def with_fold(df: DataFrame, order: str | list[str] = "time", n_splits: int = 5,
              out: str = "fold") -> DataFrame:
    """Add ``out`` by comparing each row's order keys with the folds' first rows.

    No shuffle and no copy of ``df``: the comparison is a narrow expression.  ``df`` is
    read twice for the boundaries (its order keys only).
    """
    lead, then = ORDERS[order] if isinstance(order, str) else order
    fold = F.lit(0)
    for a, b in fold_starts(df, order, n_splits):
        after = (F.col(lead) > F.lit(a)) | ((F.col(lead) == F.lit(a)) & (F.col(then) >= F.lit(b)))
        fold = fold + F.coalesce(after, F.lit(False)).cast("int")
    return df.withColumn(out, fold.cast("int"))


def fold_bounds(n: int, n_splits: int = 5) -> list[tuple[int, int]]:
    """(train_end, test_end) positions of each split, for checks."""
    ts = n // (n_splits + 1)
    base = n - n_splits * ts
    return [(base + (i - 1) * ts, base + i * ts) for i in range(1, n_splits + 1)]
