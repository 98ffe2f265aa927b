"""Reservation aggregates per (store, visit day): J1, F7-F9, A1, A2.

rs1 = sum of lead days, rv1 = sum of reserved visitors (all-missing -> 0, as
pandas), rs2 / rv2 = their means (missing skipped).  Sums and means come from
one aggregate (J2 is not a join in Spark).

hpg reservations are keyed by the hpg store id and mapped to air stores by the
relation (inner join: unmapped stores vanish).  The relation is broadcast only
after a row-count check; when it is too large, reservations are first
pre-aggregated per (hpg store, day) so the shuffle join moves at most one row
per store-day — a store holding a third of all reservations no longer makes
one hot join partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import calendar as cal
from footfall.operators.joins import DEFAULT_BROADCAST_ROWS, bounded_broadcast

OUT = ["air_store_id", "visit_date", "rs1", "rv1", "rs2", "rv2"]


def _lead(reserve: DataFrame, store: str) -> DataFrame:
    vd = cal.to_day("visit_datetime")
    return (reserve.select(F.col(store), vd.alias("visit_date"),
                           cal.day_diff(vd, cal.to_day("reserve_datetime")).alias("lead"),
                           F.col("reserve_visitors").cast("bigint").alias("rv"))
                   .where(F.col(store).isNotNull() & F.col("visit_date").isNotNull()))


def _finish(grouped) -> DataFrame:
    return grouped.agg(
        F.coalesce(F.sum("lead"), F.lit(0)).cast("bigint").alias("rs1"),
        F.coalesce(F.sum("rv"), F.lit(0)).cast("bigint").alias("rv1"),
        F.avg("lead").alias("rs2"),
        F.avg("rv").alias("rv2"))


def reservation_features(reserve: DataFrame, relation: DataFrame | None = None,
                         broadcast_max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    if relation is None:
        return _finish(_lead(reserve, "air_store_id").groupBy("air_store_id", "visit_date"))

    rel = (relation.select("hpg_store_id", "air_store_id")
                   .where(F.col("hpg_store_id").isNotNull() & F.col("air_store_id").isNotNull()))
    rel_side, small = bounded_broadcast(rel, broadcast_max_rows)
    lead = _lead(reserve, "hpg_store_id")
    if small:
        return _finish(lead.join(rel_side, "hpg_store_id").groupBy("air_store_id", "visit_date"))

    part = (lead.groupBy("hpg_store_id", "visit_date")
                .agg(F.sum("lead").alias("s_lead"), F.count("lead").alias("n_lead"),
                     F.sum("rv").alias("s_rv"), F.count("rv").alias("n_rv")))
    return (part.join(rel, "hpg_store_id")
                .groupBy("air_store_id", "visit_date")
                .agg(F.coalesce(F.sum("s_lead"), F.lit(0)).cast("bigint").alias("rs1"),
                     F.coalesce(F.sum("s_rv"), F.lit(0)).cast("bigint").alias("rv1"),
                     F.try_divide(F.sum("s_lead").cast("double"), F.sum("n_lead")).alias("rs2"),
                     F.try_divide(F.sum("s_rv").cast("double"), F.sum("n_rv")).alias("rv2")))
