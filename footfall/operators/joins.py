"""Join helpers: size-checked broadcast and the null-safe semi join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only if it has been counted and holds at most so many rows
# (a few narrow columns each); beyond, the join stays a shuffle join, which AQE may
# still turn into a broadcast from measured shuffle bytes.
DEFAULT_BROADCAST_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS
                      ) -> tuple[DataFrame, bool]:
    """Return ``(broadcast(df), True)`` if ``df`` has at most ``max_rows`` rows, else
    ``(df, False)``.

    The rows are counted where they are: one number per task is shuffled.
    """
    if df.count() <= max_rows:
        return F.broadcast(df), True
    return df, False


def semi_join_null_safe(left: DataFrame, right: DataFrame, col: str,
                        broadcast_max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Keep ``left`` rows whose ``col`` occurs in ``right`` (null matches
    null, as pandas ``isin`` does with NaN).

    Category columns have few values, so a shuffle join on them would pile a
    hot category's rows into one task: the distinct keys are broadcast after a
    size check.  Only a key set beyond the bound is shuffle-joined — in this
    workload that is the store code, and a store holds at most one panel row
    per day.
    """
    keys = right.select(F.col(col).alias("__semi_key")).distinct()
    keys, _ = bounded_broadcast(keys, broadcast_max_rows)
    return left.join(keys, left[col].eqNullSafe(keys["__semi_key"]), "left_semi")
