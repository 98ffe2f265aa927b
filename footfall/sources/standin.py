"""Stand-in views: the pipeline's seven inputs derived from the parquet test
tables (``lineitem orders supplier nation region``).

Every view is a lazy DataFrame over the whole tables, so the work of every
query grows with the data.  The same definitions as DuckDB SQL (``ORACLE_CTES``)
let the oracle run the identical inputs.

Mapping (fixed values of the stand-in, shared with the oracle):
  store id      'air_' || lpad(l_suppkey / s_suppkey, 8, '0')
  hpg store id  'hpg_' || lpad(s_suppkey, 8, '0'); even suppliers only
  visits        sum(l_quantity) per (store, ship date)
  cut date      2001-10-25: earlier days are train, later days are the test ids
  air / hpg     lineitem x orders, l_linestatus 'O' / 'F'
  holiday       day of month 1 or 15
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import scale_partitions
from footfall.sources.tables import Tables

# Fixed values of the stand-in views.
CUT_DATE = "2001-10-25"
AIR_PREFIX = "air_"
HPG_PREFIX = "hpg_"
HOLIDAY_DAYS = (1, 15)


def _padded(prefix: str, key) -> F.Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), 8, "0"))


def _number(key: F.Column) -> F.Column:
    """The number that ``_padded`` shows of ``key``: keys of more than 8 characters are cut.
    Equal numbers, and only these, have equal ids."""
    cut = F.substring(key.cast("string"), 1, 8).cast("bigint")
    return F.when(key.between(-9_999_999, 99_999_999), key.cast("bigint")).otherwise(cut)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def visits_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (store, day); days without a row are real gaps."""
    li = _read(spark, sf_dir, "lineitem")
    # numbers are grouped, text is made of the groups: shorter rows to hash and to shuffle
    return (li.groupBy(_number(F.col("l_suppkey")).alias("__store"),
                       F.to_date("l_shipdate").alias("visit_date"))
              .agg(F.sum("l_quantity").cast("bigint").alias("visitors"))
              .select(_padded(AIR_PREFIX, F.col("__store")).alias("air_store_id"),
                      "visit_date", "visitors"))


def _reserve(spark: SparkSession, sf_dir: str, status: str, prefix: str,
             id_col: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == status)
    od = _read(spark, sf_dir, "orders")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
              .select(_padded(prefix, F.col("l_suppkey")).alias(id_col),
                      F.col("l_shipdate").cast("timestamp_ntz").alias("visit_datetime"),
                      F.col("o_orderdate").cast("timestamp_ntz").alias("reserve_datetime"),
                      F.col("l_quantity").cast("bigint").alias("reserve_visitors")))


def rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the largest table, from its files' footers."""
    return _read(spark, sf_dir, "lineitem").count()


def load(spark: SparkSession, sf_dir: str) -> Tables:
    scale_partitions(spark, rows(spark, sf_dir))
    va = visits_all(spark, sf_dir)
    cut = F.lit(CUT_DATE).cast("date")
    visits = va.where(F.col("visit_date") < cut)
    submission = (va.where(F.col("visit_date") >= cut)
                    .select(F.concat_ws("_", "air_store_id",
                                        F.col("visit_date").cast("string")).alias("id"),
                            F.lit(0).cast("bigint").alias("visitors")))
    sup = _read(spark, sf_dir, "supplier")
    nat = _read(spark, sf_dir, "nation")
    reg = _read(spark, sf_dir, "region")
    store_info = (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
                     .join(reg, nat.n_regionkey == reg.r_regionkey)
                     .select(_padded(AIR_PREFIX, F.col("s_suppkey")).alias("air_store_id"),
                             F.concat("r_name", F.lit("/"), "n_name").alias("air_genre_name"),
                             F.concat("r_name", F.lit("-"),
                                      F.replace("n_name", F.lit("_"), F.lit("-"))).alias("air_area_name"),
                             (F.lit(30.0) + F.col("s_nationkey") * F.lit(0.5)).cast("double").alias("latitude"),
                             (F.lit(130.0) + F.col("s_acctbal") / F.lit(1000)).cast("double").alias("longitude")))
    store_relation = (sup.where(F.col("s_suppkey") % 2 == 0)
                         .select(_padded(AIR_PREFIX, F.col("s_suppkey")).alias("air_store_id"),
                                 _padded(HPG_PREFIX, F.col("s_suppkey")).alias("hpg_store_id")))
    # The calendar: every distinct ship day (the same set of days as visits_all).
    days = (_read(spark, sf_dir, "lineitem")
            .select(F.to_date("l_shipdate").alias("calendar_date")).distinct())
    date_info = days.select(
        "calendar_date",
        F.date_format("calendar_date", "EEEE").alias("day_of_week"),
        F.when(F.dayofmonth("calendar_date").isin(*HOLIDAY_DAYS), 1).otherwise(0)
         .cast("int").alias("holiday_flg"))
    return Tables(
        visits=visits,
        store_info=store_info,
        air_reserve=_reserve(spark, sf_dir, "O", AIR_PREFIX, "air_store_id"),
        hpg_reserve=_reserve(spark, sf_dir, "F", HPG_PREFIX, "hpg_store_id"),
        store_relation=store_relation,
        submission=submission,
        date_info=date_info,
    )


# The same views for DuckDB (tables lineitem, orders, supplier, nation, region
# are registered there under those names).
ORACLE_CTES = {
    "visits_all": f"""
        select concat('{AIR_PREFIX}', lpad(cast(l_suppkey as varchar), 8, '0')) as air_store_id,
               cast(l_shipdate as date) as visit_date,
               cast(sum(l_quantity) as bigint) as visitors
        from lineitem group by 1, 2""",
    "visits": f"select * from visits_all where visit_date < date '{CUT_DATE}'",
    "submission": f"""
        select concat(air_store_id, '_', cast(visit_date as varchar)) as id,
               cast(0 as bigint) as visitors
        from visits_all where visit_date >= date '{CUT_DATE}'""",
    "store_info": f"""
        select concat('{AIR_PREFIX}', lpad(cast(s_suppkey as varchar), 8, '0')) as air_store_id,
               concat(r_name, '/', n_name) as air_genre_name,
               concat(r_name, '-', replace(n_name, '_', '-')) as air_area_name,
               cast(30 + s_nationkey * 0.5 as double) as latitude,
               cast(130 + s_acctbal / 1000 as double) as longitude
        from supplier join nation on s_nationkey = n_nationkey
                      join region on n_regionkey = r_regionkey""",
    "store_relation": f"""
        select concat('{AIR_PREFIX}', lpad(cast(s_suppkey as varchar), 8, '0')) as air_store_id,
               concat('{HPG_PREFIX}', lpad(cast(s_suppkey as varchar), 8, '0')) as hpg_store_id
        from supplier where s_suppkey % 2 = 0""",
    "air_reserve": f"""
        select concat('{AIR_PREFIX}', lpad(cast(l_suppkey as varchar), 8, '0')) as air_store_id,
               l_shipdate as visit_datetime, o_orderdate as reserve_datetime,
               cast(l_quantity as bigint) as reserve_visitors
        from lineitem join orders on l_orderkey = o_orderkey where l_linestatus = 'O'""",
    "hpg_reserve": f"""
        select concat('{HPG_PREFIX}', lpad(cast(l_suppkey as varchar), 8, '0')) as hpg_store_id,
               l_shipdate as visit_datetime, o_orderdate as reserve_datetime,
               cast(l_quantity as bigint) as reserve_visitors
        from lineitem join orders on l_orderkey = o_orderkey where l_linestatus = 'F'""",
    "date_info": f"""
        select distinct cast(l_shipdate as date) as calendar_date,
               dayname(cast(l_shipdate as date)) as day_of_week,
               cast(case when extract(day from l_shipdate) in {HOLIDAY_DAYS} then 1 else 0 end as integer)
                 as holiday_flg
        from lineitem""",
}


def oracle_with(*extra: tuple[str, str], recursive: bool = False) -> str:
    """``WITH`` clause holding all stand-in views plus ``extra`` (name, sql)."""
    parts = [f"{name} as ({sql})" for name, sql in ORACLE_CTES.items()]
    parts += [f"{name} as ({sql})" for name, sql in extra]
    return ("with recursive " if recursive else "with ") + ",\n".join(parts) + "\n"
