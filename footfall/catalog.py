"""Registered queries (Spark builders) and their DuckDB oracle SQL.

Every builder takes ``(spark, sf_dir)``, reads the whole stand-in tables and
returns a lazy DataFrame.  Computed columns carry the same alias on both
sides; floating results derived from log/exp/means are rounded to 6 places
on both sides (their last digits differ between engines).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators import series
from footfall.session import (drop_intermediates, ensure_checkpoint_dir, frame_partitions,
                              intermediates, materialize)
from footfall.sources import standin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

R = 6  # rounding digits for floating outputs


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rnd(c, digits: int = R):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# --------------------------------------------------------------------------
# Shared DuckDB fragments
# --------------------------------------------------------------------------

LAGS = range(1, 8)


def _calendar_sql(d: str) -> str:
    return (f"cast(isodow({d}) - 1 as integer) as dow, "
            f"cast((day({d}) - 1) // 7 + 1 as integer) as wom, "
            f"cast(year({d}) as integer) as year, cast(month({d}) as integer) as month, "
            f"cast(day({d}) as integer) as day")


def panel_ctes(test_value: str = "cast(0.0 as double)", threshold: float = 120) -> list[tuple[str, str]]:
    """tr / te / comb / panel CTEs, mirroring ``series.build_panel``."""
    lag_cols = ",\n".join(
        f"lag(log_visitors, {k}) over w as visitors_lag{k}, "
        f"log_visitors - lag(log_visitors, {k}) over w as visitors_diff{k}" for k in LAGS)
    return [
        ("tr", f"""
            select air_store_id, visit_date, visitors,
                   case when visitors > 0 then ln(visitors) end as log_visitors,
                   {_calendar_sql('visit_date')},
                   case when visitors >= {threshold} then cast(1 as double) else cast(0 as double) end as large_party,
                   cast(null as varchar) as id, 'train' as subset
            from visits"""),
        ("te0", """
            select id, visitors, cast(split_part(id, '_', 3) as date) as visit_date,
                   split_part(id, '_', 1) || '_' || split_part(id, '_', 2) as air_store_id
            from submission"""),
        ("te", f"""
            select air_store_id, visit_date, visitors, {test_value} as log_visitors,
                   {_calendar_sql('visit_date')},
                   case when visitors >= {threshold} then cast(1 as double) else cast(0 as double) end as large_party,
                   id, 'test' as subset
            from te0"""),
        ("comb", "select * from tr union all select * from te"),
        ("panel", f"""
            select *, {lag_cols}
            from comb window w as (partition by air_store_id order by visit_date)"""),
    ]


def _lag_select_sql() -> str:
    return ", ".join(f"round(visitors_lag{k}, {R}) as visitors_lag{k}, "
                     f"round(visitors_diff{k}, {R}) as visitors_diff{k}" for k in LAGS)


def _lag_select_spark() -> list:
    out = []
    for k in LAGS:
        out += [rnd(f"visitors_lag{k}").alias(f"visitors_lag{k}"),
                rnd(f"visitors_diff{k}").alias(f"visitors_diff{k}")]
    return out


# --------------------------------------------------------------------------
# Step 1: calendar features, lags and diffs
# --------------------------------------------------------------------------

CAL_COLS = ["dow", "wom", "year", "month", "day"]


@register("visits_calendar", standin.oracle_with(*panel_ctes()) + f"""
    select air_store_id, visit_date, visitors, round(log_visitors, {R}) as log_visitors,
           dow, wom, year, month, day, large_party
    from tr""")
def q_visits_calendar(spark, sf_dir):
    t = standin.load(spark, sf_dir)
    df = series.visit_features(t.visits)
    return df.select("air_store_id", "visit_date", "visitors",
                     rnd("log_visitors").alias("log_visitors"), *CAL_COLS, "large_party")


@register("visits_lag_diff", standin.oracle_with(*panel_ctes()) + f"""
    select air_store_id, visit_date, subset, id, visitors,
           round(log_visitors, {R}) as log_visitors, {_lag_select_sql()}
    from panel""")
def q_visits_lag_diff(spark, sf_dir):
    t = standin.load(spark, sf_dir)
    p = series.build_panel(t.visits, t.submission)
    return p.select("air_store_id", "visit_date", "subset", "id", "visitors",
                    rnd("log_visitors").alias("log_visitors"), *_lag_select_spark())


@register("combined_union_split", standin.oracle_with(*panel_ctes()) + f"""
    select id, air_store_id, visit_date, dow, wom, year, month, day, large_party,
           round(log_visitors, {R}) as log_visitors, {_lag_select_sql()}
    from panel where subset = 'test'""")
def q_combined_union_split(spark, sf_dir):
    t = standin.load(spark, sf_dir)
    _, te = series.split(series.build_panel(t.visits, t.submission))
    return te.select("id", "air_store_id", "visit_date", *CAL_COLS, "large_party",
                     rnd("log_visitors").alias("log_visitors"), *_lag_select_spark())


@register("submission_parse", standin.oracle_with() + """
    select id, cast(split_part(id, '_', 3) as date) as visit_date,
           split_part(id, '_', 1) || '_' || split_part(id, '_', 2) as air_store_id
    from submission""")
def q_submission_parse(spark, sf_dir):
    from footfall.functions import text
    t = standin.load(spark, sf_dir)
    return t.submission.select("id", F.to_date(text.id_date_text("id")).alias("visit_date"),
                               text.id_store("id").alias("air_store_id"))


# --------------------------------------------------------------------------
# Step 2-4: reservations, store x dow statistics, tokens, label codes
# --------------------------------------------------------------------------

from footfall.operators import assemble, reservations, store_dim  # noqa: E402
from footfall.operators.encode import fit_label_codes  # noqa: E402

N_TOKENS = 10


def _res_sql(src: str, relation: bool) -> str:
    join = " join store_relation using (hpg_store_id)" if relation else ""
    return f"""
        select air_store_id, visit_date,
               cast(coalesce(sum(lead), 0) as bigint) as rs1,
               cast(coalesce(sum(rv), 0) as bigint) as rv1,
               avg(lead) as rs2, avg(rv) as rv2
        from (select air_store_id, cast(visit_datetime as date) as visit_date,
                     cast(datediff('day', cast(reserve_datetime as date),
                                   cast(visit_datetime as date)) as integer) as lead,
                     reserve_visitors as rv
              from {src}{join})
        where air_store_id is not null and visit_date is not null
        group by 1, 2"""


RES_CTES = [("ar", _res_sql("air_reserve", False)), ("hr", _res_sql("hpg_reserve", True))]


def _res_select(spark_df):
    return spark_df.select("air_store_id", "visit_date", "rs1", "rv1",
                           rnd("rs2").alias("rs2"), rnd("rv2").alias("rv2"))


_RES_OUT = f"select air_store_id, visit_date, rs1, rv1, round(rs2, {R}) as rs2, round(rv2, {R}) as rv2"


@register("reservations_air", standin.oracle_with(*RES_CTES) + _RES_OUT + " from ar")
def q_reservations_air(spark, sf_dir):
    t = standin.load(spark, sf_dir)
    return _res_select(reservations.reservation_features(t.air_reserve))


@register("reservations_hpg", standin.oracle_with(*RES_CTES) + _RES_OUT + " from hr")
def q_reservations_hpg(spark, sf_dir):
    t = standin.load(spark, sf_dir)
    return _res_select(reservations.reservation_features(t.hpg_reserve, t.store_relation))


def store_ctes(n_tokens: int = N_TOKENS) -> list[tuple[str, str]]:
    """grid / st / sd (stores with text and tokens) / stores (encoded)."""
    gtok = ", ".join(f"coalesce(string_split(gtxt, ' ')[{i + 1}], '') as air_genre_name{i}"
                     for i in range(n_tokens))
    atok = ", ".join(f"coalesce(string_split(atxt, ' ')[{i + 1}], '') as air_area_name{i}"
                     for i in range(n_tokens))
    enc_cols = store_dim.token_columns(n_tokens)
    codes = [(f"code_{c}", f"""select v, cast(row_number() over (order by v) - 1 as integer) as code
                               from (select distinct {src} as v from sd where {src} is not null)""")
             for c, src in [(c, c) for c in enc_cols] + [("air_genre_name", "gtxt"),
                                                          ("air_area_name", "atxt")]]
    joins = " ".join(f"left join code_{c} on code_{c}.v = sd.{src}"
                     for c, src in [(c, c) for c in enc_cols] + [("air_genre_name", "gtxt"),
                                                                  ("air_area_name", "atxt")])
    sel = ", ".join(f"code_{c}.code as {c}" for c in enc_cols + ["air_genre_name", "air_area_name"])
    return [
        ("grid", """select air_store_id, cast(unnest(range(7)) as integer) as dow
                    from (select distinct air_store_id from te0 where air_store_id is not null)"""),
        ("st", """select air_store_id, dow, min(visitors) as min_visitors,
                         avg(visitors) as mean_visitors, median(visitors) as median_visitors,
                         max(visitors) as max_visitors, count(visitors) as count_observations
                  from tr where air_store_id is not null and dow is not null group by 1, 2"""),
        ("sd0", """select g.air_store_id, g.dow, st.min_visitors, st.mean_visitors,
                          st.median_visitors, st.max_visitors, st.count_observations,
                          si.latitude, si.longitude,
                          replace(coalesce(si.air_genre_name, 'nan'), '/', ' ') as gtxt,
                          replace(coalesce(si.air_area_name, 'nan'), '-', ' ') as atxt
                   from grid g left join st on st.air_store_id = g.air_store_id and st.dow = g.dow
                   left join store_info si on si.air_store_id = g.air_store_id"""),
        ("sd", f"select *, {gtok}, {atok} from sd0"),
        *codes,
        ("stores", f"""select sd.air_store_id, sd.dow, min_visitors, mean_visitors, median_visitors,
                              max_visitors, count_observations, latitude, longitude, {sel}
                       from sd {joins}"""),
    ]


def all_ctes(**kw) -> str:
    return standin.oracle_with(*panel_ctes(**kw), *RES_CTES, *store_ctes())


def stats_spark() -> list:
    return ["min_visitors", rnd("mean_visitors").alias("mean_visitors"),
            rnd("median_visitors").alias("median_visitors"), "max_visitors",
            "count_observations"]
STATS_SQL = (f"min_visitors, round(mean_visitors, {R}) as mean_visitors, "
             f"round(median_visitors, {R}) as median_visitors, max_visitors, count_observations")


def _train_test_rows(spark, sf_dir):
    t = standin.load(spark, sf_dir)
    parts = frame_partitions(spark, standin.rows(spark, sf_dir))
    tr, te = series.split(series.build_panel(t.visits, t.submission, partitions=parts))
    return t, tr, te


@register("store_dow_grid", all_ctes() + "select air_store_id, dow from grid")
def q_store_dow_grid(spark, sf_dir):
    _, _, te = _train_test_rows(spark, sf_dir)
    return store_dim.store_dow_grid(te)


@register("store_dow_stats", all_ctes() + f"""
    select g.air_store_id, g.dow, {STATS_SQL}
    from grid g left join st on st.air_store_id = g.air_store_id and st.dow = g.dow""")
def q_store_dow_stats(spark, sf_dir):
    _, tr, te = _train_test_rows(spark, sf_dir)
    s = store_dim.attach_stats(store_dim.store_dow_grid(te), store_dim.store_dow_stats(tr))
    return s.select("air_store_id", "dow", *stats_spark())


_STORE_CODE_COLS = store_dim.token_columns(N_TOKENS) + ["air_genre_name", "air_area_name"]


@register("store_dim", all_ctes() + f"""
    select air_store_id, dow, {STATS_SQL}, latitude, longitude, {', '.join(_STORE_CODE_COLS)}
    from stores""")
def q_store_dim(spark, sf_dir):
    t, tr, te = _train_test_rows(spark, sf_dir)
    s = store_dim.build_stores(tr, te, t.store_info, N_TOKENS)
    return s.select("air_store_id", "dow", *stats_spark(), "latitude", "longitude",
                    *_STORE_CODE_COLS)


_TOK_SQL_G = ", ".join(f"coalesce(string_split(gtxt, ' ')[{i + 1}], '') as air_genre_name{i}"
                       for i in range(N_TOKENS))
_TOK_SQL_A = ", ".join(f"coalesce(string_split(atxt, ' ')[{i + 1}], '') as air_area_name{i}"
                       for i in range(N_TOKENS))
_TOK_BASE = """select air_store_id,
                      replace(coalesce(air_genre_name, 'nan'), '/', ' ') as gtxt,
                      replace(coalesce(air_area_name, 'nan'), '-', ' ') as atxt
               from store_info"""


@register("genre_area_tokens", standin.oracle_with(("tok0", _TOK_BASE)) + f"""
    select air_store_id, gtxt as air_genre_name, atxt as air_area_name, {_TOK_SQL_G}, {_TOK_SQL_A}
    from tok0""")
def q_genre_area_tokens(spark, sf_dir):
    t = standin.load(spark, sf_dir)
    df = store_dim.genre_area_tokens(t.store_info, N_TOKENS)
    return df.select("air_store_id", "air_genre_name", "air_area_name",
                     *store_dim.token_columns(N_TOKENS))


@register("label_encode", standin.oracle_with(
    ("tok0", _TOK_BASE), ("tok", f"select *, {_TOK_SQL_G}, {_TOK_SQL_A} from tok0"),
    ("pairs", " union ".join(
        [f"select '{c}' as column_name, {c} as value from tok" for c in store_dim.token_columns(N_TOKENS)]
        + ["select 'air_genre_name' as column_name, gtxt as value from tok",
           "select 'air_area_name' as column_name, atxt as value from tok"]))) + """
    select column_name, value,
           cast(row_number() over (partition by column_name order by value) - 1 as integer) as code
    from pairs where value is not null""")
def q_label_encode(spark, sf_dir):
    t = standin.load(spark, sf_dir)
    df = store_dim.genre_area_tokens(t.store_info, N_TOKENS)
    codes = fit_label_codes(df, store_dim.token_columns(N_TOKENS) + ["air_genre_name", "air_area_name"])
    return codes.table.select(F.col("column").alias("column_name"), "value", "code")


@register("holiday_encode", standin.oracle_with() + """
    select calendar_date as visit_date,
           cast(dense_rank() over (order by day_of_week) - 1 as integer) as day_of_week,
           holiday_flg
    from date_info""")
def q_holiday_encode(spark, sf_dir):
    t = standin.load(spark, sf_dir)
    return assemble.holiday_table(t.date_info)


# --------------------------------------------------------------------------
# Step 5: wide train/test tables, totals, geo, id/date_int, clean, fill
# --------------------------------------------------------------------------

from footfall.functions import numeric as num  # noqa: E402
from footfall.plans import features as feat  # noqa: E402

LAG_COLS = [f"visitors_{k}{i}" for i in LAGS for k in ("lag", "diff")]
WIDE_COLS = (["air_store_id", "visit_date", "id", "visitors", "log_visitors", *CAL_COLS,
              "large_party", *LAG_COLS, "day_of_week", "holiday_flg",
              "min_visitors", "mean_visitors", "median_visitors", "max_visitors",
              "count_observations", "latitude", "longitude", *_STORE_CODE_COLS,
              "rs1_x", "rv1_x", "rs2_x", "rv2_x", "rs1_y", "rv1_y", "rs2_y", "rv2_y",
              "total_reserv_sum", "total_reserv_mean", "total_reserv_dt_diff_mean",
              "date_int", "var_max_lat", "var_max_long", "lon_plus_lat", "air_store_id2",
              "cluster"])
_TEXT_COLS = {"air_store_id", "visit_date", "id"}
_DOUBLE_COLS = {"log_visitors", "large_party", *LAG_COLS, "mean_visitors", "median_visitors",
                "latitude", "longitude", "rs2_x", "rv2_x", "rs2_y", "rv2_y",
                "total_reserv_mean", "total_reserv_dt_diff_mean", "var_max_lat",
                "var_max_long", "lon_plus_lat"}

HOL_CTE = ("hol", """select calendar_date as visit_date,
                     cast(dense_rank() over (order by day_of_week) - 1 as integer) as day_of_week,
                     holiday_flg from date_info""")


# A fixed rule in place of KMeans for the SQL-checked wide tables.
CLUSTER_RULE_SQL = "cast(cast(floor(s.latitude * 2) as bigint) % 8 as integer)"


def cluster_rule(stores):
    return stores.withColumn("cluster", F.pmod(F.floor(F.col("latitude") * 2), F.lit(8))
                             .cast("int"))


def _wide_ctes() -> list[tuple[str, str]]:
    lagsel = ", ".join(f"p.{c}" for c in LAG_COLS)
    storesel = ", ".join(f"s.{c}" for c in _STORE_CODE_COLS)
    w0 = f"""
        select p.air_store_id, p.visit_date, p.id, p.subset, p.visitors, p.log_visitors,
               p.dow, p.wom, p.year, p.month, p.day, p.large_party, {lagsel},
               h.day_of_week, h.holiday_flg, s.min_visitors, s.mean_visitors,
               s.median_visitors, s.max_visitors, s.count_observations, s.latitude,
               s.longitude, {storesel}, {CLUSTER_RULE_SQL} as cluster,
               ax.rs1 as rs1_x, ax.rv1 as rv1_x, ax.rs2 as rs2_x, ax.rv2 as rv2_x,
               hy.rs1 as rs1_y, hy.rv1 as rv1_y, hy.rs2 as rs2_y, hy.rv2 as rv2_y
        from panel p
        left join hol h on h.visit_date = p.visit_date
        left join stores s on s.air_store_id = p.air_store_id and s.dow = p.dow
        left join ar ax on ax.air_store_id = p.air_store_id and ax.visit_date = p.visit_date
        left join hr hy on hy.air_store_id = p.air_store_id and hy.visit_date = p.visit_date"""

    def derived(src: str) -> str:
        return f"""
        select *, rv1_x + rv1_y as total_reserv_sum,
               (rv2_x + rv2_y) / 2 as total_reserv_mean,
               (rs2_x + rs2_y) / 2 as total_reserv_dt_diff_mean,
               cast(strftime(visit_date, '%Y%m%d') as integer) as date_int,
               (select max(latitude) from {src}) - latitude as var_max_lat,
               (select max(longitude) from {src}) - longitude as var_max_long,
               longitude + latitude as lon_plus_lat
        from {src}"""
    return [
        HOL_CTE, ("w0", w0),
        ("trw", """select * replace (air_store_id || '_' || cast(visit_date as varchar) as id)
                   from w0 where subset = 'train'"""),
        ("tew", "select * from w0 where subset = 'test'"),
        ("trd", derived("trw")), ("ted", derived("tew")),
        ("sid", """select v, cast(row_number() over (order by v) - 1 as integer) as code
                   from (select distinct air_store_id as v from trw)"""),
        ("trf", "select trd.*, sid.code as air_store_id2 from trd left join sid on sid.v = trd.air_store_id"),
        ("tef", "select ted.*, sid.code as air_store_id2 from ted left join sid on sid.v = ted.air_store_id"),
    ]


def _wide_select_sql(fill: bool) -> str:
    out = []
    for c in WIDE_COLS:
        e = c if (c in _TEXT_COLS or not fill) else f"coalesce({c}, -1)"
        if c in _DOUBLE_COLS:
            e = f"round({e}, {R})"
        out.append(f"{e} as {c}")
    return ", ".join(out)


def _wide_select_spark(df):
    return df.select(*[rnd(c).alias(c) if c in _DOUBLE_COLS else F.col(c) for c in WIDE_COLS])


WIDE_SQL = all_ctes() + ", " + ",\n".join(f"{n} as ({s})" for n, s in _wide_ctes()) + "\n"


def _wide(spark, sf_dir, clean=False):
    """The wide tables with the fixed cluster rule, which SQL can follow."""
    t = standin.load(spark, sf_dir)
    fs = feat.import_data(t, cluster_rule=cluster_rule)
    return feat.create_train_test(fs, clean=clean)


@register("train_wide", WIDE_SQL + f"select {_wide_select_sql(True)} from trf")
def q_train_wide(spark, sf_dir):
    return _wide_select_spark(_wide(spark, sf_dir)[0])


@register("test_wide", WIDE_SQL + f"select {_wide_select_sql(True)} from tef")
def q_test_wide(spark, sf_dir):
    return _wide_select_spark(_wide(spark, sf_dir)[1])


@register("reservation_totals", all_ctes() + f"""
    select p.air_store_id, p.visit_date,
           ax.rv1 + hy.rv1 as total_reserv_sum,
           round((ax.rv2 + hy.rv2) / 2, {R}) as total_reserv_mean,
           round((ax.rs2 + hy.rs2) / 2, {R}) as total_reserv_dt_diff_mean
    from tr p
    left join ar ax on ax.air_store_id = p.air_store_id and ax.visit_date = p.visit_date
    left join hr hy on hy.air_store_id = p.air_store_id and hy.visit_date = p.visit_date""")
def q_reservation_totals(spark, sf_dir):
    t = standin.load(spark, sf_dir)
    tr = series.visit_features(t.visits)
    ar = reservations.reservation_features(t.air_reserve)
    hr = reservations.reservation_features(t.hpg_reserve, t.store_relation)
    df = (tr.join(assemble._suffixed(ar, "_x"), ["air_store_id", "visit_date"], "left")
            .join(assemble._suffixed(hr, "_y"), ["air_store_id", "visit_date"], "left"))
    return df.select("air_store_id", "visit_date",
                     (F.col("rv1_x") + F.col("rv1_y")).alias("total_reserv_sum"),
                     rnd((F.col("rv2_x") + F.col("rv2_y")) / 2).alias("total_reserv_mean"),
                     rnd((F.col("rs2_x") + F.col("rs2_y")) / 2).alias("total_reserv_dt_diff_mean"))


@register("geo_features", all_ctes() + f"""
    , g as (select p.air_store_id, p.visit_date, si.latitude, si.longitude
            from tr p left join store_info si on si.air_store_id = p.air_store_id)
    select air_store_id, visit_date,
           round((select max(latitude) from g) - latitude, {R}) as var_max_lat,
           round((select max(longitude) from g) - longitude, {R}) as var_max_long,
           round(longitude + latitude, {R}) as lon_plus_lat
    from g""")
def q_geo_features(spark, sf_dir):
    t = standin.load(spark, sf_dir)
    g = (series.visit_features(t.visits).select("air_store_id", "visit_date")
         .join(t.store_info.select("air_store_id", "latitude", "longitude"), "air_store_id", "left"))
    top = g.select(F.struct(F.max("latitude").alias("lat"), F.max("longitude").alias("lon"))
                   ).scalar()
    max_lat, max_lon = top.getField("lat"), top.getField("lon")
    return g.select("air_store_id", "visit_date",
                    rnd(max_lat - F.col("latitude")).alias("var_max_lat"),
                    rnd(max_lon - F.col("longitude")).alias("var_max_long"),
                    rnd(F.col("longitude") + F.col("latitude")).alias("lon_plus_lat"))


@register("id_date_int", all_ctes() + """
    select air_store_id || '_' || cast(visit_date as varchar) as id,
           cast(strftime(visit_date, '%Y%m%d') as integer) as date_int
    from tr""")
def q_id_date_int(spark, sf_dir):
    from footfall.functions import calendar as cal
    from footfall.functions import text
    t = standin.load(spark, sf_dir)
    tr = series.visit_features(t.visits)
    return tr.select(text.make_id("air_store_id", "visit_date").alias("id"),
                     cal.date_int("visit_date").alias("date_int"))


_CLEAN_SEL = "air_store_id, visit_date, air_genre_name, air_area_name, air_store_id2, cluster"


@register("train_clean_semi", WIDE_SQL + f"""
    select {_CLEAN_SEL} from trf
    where exists (select 1 from tef where tef.air_genre_name is not distinct from trf.air_genre_name)
      and exists (select 1 from tef where tef.air_area_name is not distinct from trf.air_area_name)
      and exists (select 1 from tef where tef.air_store_id2 is not distinct from trf.air_store_id2)
      and exists (select 1 from tef where coalesce(tef.cluster, -1) = coalesce(trf.cluster, -1))""")
def q_train_clean_semi(spark, sf_dir):
    train, _ = _wide(spark, sf_dir, clean=True)
    return train.select(*_CLEAN_SEL.split(", "))


@register("fill_missing", all_ctes() + f"""
    , g as (select air_store_id, cast(unnest(range(7)) as integer) as dow
            from (select distinct air_store_id from tr where air_store_id is not null))
    select g.air_store_id, g.dow, coalesce(min_visitors, -1) as min_visitors,
           round(coalesce(mean_visitors, -1), {R}) as mean_visitors,
           round(coalesce(median_visitors, -1), {R}) as median_visitors,
           coalesce(max_visitors, -1) as max_visitors,
           coalesce(count_observations, -1) as count_observations
    from g left join st on st.air_store_id = g.air_store_id and st.dow = g.dow""")
def q_fill_missing(spark, sf_dir):
    _, tr, _ = _train_test_rows(spark, sf_dir)
    grid = store_dim.store_dow_grid(tr)
    s = num.fill_missing(store_dim.attach_stats(grid, store_dim.store_dow_stats(tr)))
    return s.select("air_store_id", "dow", *stats_spark())


@register("large_party_flag", standin.oracle_with() + """
    select air_store_id,
           cast(sum(case when visitors >= 120 then 1 else 0 end) as double) as n_large_120,
           cast(sum(case when visitors >= 75 then 1 else 0 end) as double) as n_large_75
    from visits group by 1""")
def q_large_party_flag(spark, sf_dir):
    t = standin.load(spark, sf_dir)
    return (t.visits.groupBy("air_store_id")
            .agg(F.sum(num.threshold_flag("visitors", 120)).alias("n_large_120"),
                 F.sum(num.threshold_flag("visitors", 75)).alias("n_large_75")))


# --------------------------------------------------------------------------
# Step 6: ordered folds, metrics, clip/exp/score
# --------------------------------------------------------------------------

from footfall.operators import folds as fold_ops  # noqa: E402
from footfall.operators import metrics  # noqa: E402
from footfall.plans import scoring  # noqa: E402

_FOLD_SQL = """case when ordinal < n - 5 * (n // 6) then 0
                    else cast(1 + (ordinal - (n - 5 * (n // 6))) // (n // 6) as integer) end"""


def _fold_cte(src: str, where: str = "") -> tuple[str, str]:
    return ("o", f"""select *, {_FOLD_SQL} as fold from (
                 select *, row_number() over (order by visit_date, air_store_id) - 1 as ordinal,
                        count(*) over () as n
                 from {src} {where})""")


@register("ordered_folds", all_ctes() + ", " + "{} as ({})".format(*_fold_cte("tr")) + """
    select air_store_id, visit_date, ordinal, fold from o""")
def q_ordered_folds(spark, sf_dir):
    t = standin.load(spark, sf_dir)
    df, _ = fold_ops.assign_folds(series.visit_features(t.visits).select("air_store_id", "visit_date"))
    return df.select("air_store_id", "visit_date", "ordinal", "fold")


@register("fold_sizes", all_ctes() + ", " + "{} as ({})".format(*_fold_cte("tr")) + """
    select fold, count(*) as n_rows from o group by fold""")
def q_fold_sizes(spark, sf_dir):
    t = standin.load(spark, sf_dir)
    df = fold_ops.with_fold(series.visit_features(t.visits).select("air_store_id", "visit_date"))
    return df.groupBy("fold").agg(F.count("*").alias("n_rows"))


@register("store_order_folds", all_ctes() + f"""
    , o as (select *, {_FOLD_SQL} as fold from (
              select *, row_number() over (order by air_store_id, visit_date) - 1 as ordinal,
                     count(*) over () as n from tr))
    select air_store_id, visit_date, fold from o""")
def q_store_order_folds(spark, sf_dir):
    """W3 in the store-major order that the original really produced (trap T8)."""
    t = standin.load(spark, sf_dir)
    rows = series.visit_features(t.visits).select("air_store_id", "visit_date")
    return fold_ops.with_fold(rows, "store")


@register("store_dow_stats_by_fold", all_ctes() + ", " + "{} as ({})".format(*_fold_cte("tr")) + f"""
    select air_store_id, dow, cast(f as integer) as fold, min(visitors) as min_visitors,
           round(avg(visitors), {R}) as mean_visitors, round(median(visitors), {R}) as median_visitors,
           max(visitors) as max_visitors, count(visitors) as count_observations
    from o, (select unnest(range(1, 6)) as f)
    where fold < f and air_store_id is not null and visitors is not null group by 1, 2, 3""")
def q_store_dow_stats_by_fold(spark, sf_dir):
    """A3-A7 per expanding window (trap T13): no test row in its own statistics."""
    t = standin.load(spark, sf_dir)
    rows = fold_ops.with_fold(series.visit_features(t.visits).select(
        "air_store_id", "visit_date", "dow", "visitors"))
    out = store_dim.store_dow_stats_by_fold(
        rows, partitions=frame_partitions(spark, standin.rows(spark, sf_dir)))
    return out.select("air_store_id", "dow", "fold", "min_visitors",
                      rnd("mean_visitors").alias("mean_visitors"),
                      rnd("median_visitors").alias("median_visitors"), "max_visitors",
                      "count_observations")


@register("rmsle", all_ctes() + ", " + "{} as ({})".format(*_fold_cte("panel", "where subset = 'train'"))
          + f"""
    select fold, round(sqrt(avg(power(log_visitors - visitors_lag1, 2))), {R}) as rmsle
    from o where fold > 0 and visitors_lag1 is not null group by fold""")
def q_rmsle(spark, sf_dir):
    """Naive lag-1 forecast scored per ordered test fold (A12 per fold)."""
    _, tr, _ = _train_test_rows(spark, sf_dir)
    df = fold_ops.with_fold(tr.select("air_store_id", "visit_date", "log_visitors",
                                      "visitors_lag1"))
    scored = df.where((F.col("fold") > 0) & F.col("visitors_lag1").isNotNull())
    return (metrics.rmse_by(scored, ["fold"], prediction="visitors_lag1")
            .select("fold", rnd("rmsle").alias("rmsle")))


# A prediction that crosses zero.
_NAIVE_SQL = """
    , pred as (select id, visitors_lag1 - visitors_lag2 as prediction from panel
               where subset = 'test')
"""


def _naive_predictions(te):
    return te.select(
        "id", (F.col("visitors_lag1") - F.col("visitors_lag2")).alias("prediction"))


@register("clip_exp_score", standin.oracle_with(*panel_ctes()) + _NAIVE_SQL + f"""
    select s.id, round(exp(case when p.prediction < 0 then 0.0 else p.prediction end), {R}) as visitors
    from submission s left join pred p on p.id = s.id""")
def q_clip_exp_score(spark, sf_dir):
    t, _, te = _train_test_rows(spark, sf_dir)
    out = scoring.score_predictions(_naive_predictions(te), t.submission)
    return out.select("id", rnd("visitors").alias("visitors"))


@register("submission_join", standin.oracle_with(*panel_ctes()) + _NAIVE_SQL + f"""
    select s.id, round(exp(case when p.prediction < 0 then 0.0 else p.prediction end), {R}) as visitors
    from submission s join pred p on p.id = s.id where p.prediction is not null""")
def q_submission_join(spark, sf_dir):
    t, _, te = _train_test_rows(spark, sf_dir)
    pred = _naive_predictions(te).where(F.col("prediction").isNotNull())
    out = scoring.score_predictions(pred, t.submission, how="inner")
    return out.select("id", rnd("visitors").alias("visitors"))


# --------------------------------------------------------------------------
# Step 7: OLS, VIF, linear regression (1-2 feature oracles)
# --------------------------------------------------------------------------

from footfall.plans import diagnostics  # noqa: E402
from footfall.plans import models as mdl  # noqa: E402

_XY_CTE = ("xy", """select log_visitors as y, visitors_lag1 as x1, visitors_lag2 as x2
                    from panel where subset = 'train' and visitors_lag1 is not null
                      and visitors_lag2 is not null and log_visitors is not null""")


def _xy_rows(spark, sf_dir):
    _, tr, _ = _train_test_rows(spark, sf_dir)
    return tr.where(F.col("visitors_lag1").isNotNull() & F.col("visitors_lag2").isNotNull()
                    & F.col("log_visitors").isNotNull())


@register("ols_single", all_ctes() + ", " + "{} as ({})".format(*_XY_CTE) + f"""
    select 'visitors_lag1' as feature, round(sum(x1 * y) / sum(x1 * x1), {R}) as coef,
           round(sum(x1 * y) * sum(x1 * y) / (sum(x1 * x1) * sum(y * y)), {R}) as r2
    from xy""")
def q_ols_single(spark, sf_dir):
    """M3 with one feature and no constant: coefficient and uncentred R²."""
    table, stats, _ = diagnostics.ols(_xy_rows(spark, sf_dir), ["visitors_lag1"],
                                      residual_stats=False)
    return table.select("feature", rnd("coef").alias("coef"),
                        rnd(F.lit(stats["r2"])).alias("r2"))


@register("vif_pair", all_ctes() + ", " + "{} as ({})".format(*_XY_CTE) + f"""
    , s as (select sum(x1 * x2) * sum(x1 * x2) / (sum(x1 * x1) * sum(x2 * x2)) as c from xy)
    select f as features, round(1 / (1 - c), {R}) as vif_factor
    from s, (values ('visitors_lag1'), ('visitors_lag2')) v(f)""")
def q_vif_pair(spark, sf_dir):
    v = diagnostics.vif(_xy_rows(spark, sf_dir), ["visitors_lag1", "visitors_lag2"])
    return v.select("features", rnd("vif_factor").alias("vif_factor"))


@register("linear_single", all_ctes() + ", " + "{} as ({})".format(*_XY_CTE) + f"""
    select round(regr_slope(y, x1), {R}) as slope, round(regr_intercept(y, x1), {R}) as intercept
    from xy""")
def q_linear_single(spark, sf_dir):
    """M5 with one feature: MLlib least squares with an intercept."""
    df = _xy_rows(spark, sf_dir)
    model = mdl.regression_pipeline(mdl.linear_regression(True), ["visitors_lag1"]).fit(df)
    lr = model.stages[-1]
    return spark.createDataFrame([(float(lr.coefficients[0]), float(lr.intercept))],
                                 "slope double, intercept double").select(
        rnd("slope").alias("slope"), rnd("intercept").alias("intercept"))


# --------------------------------------------------------------------------
# Step 8: recursive forecast with a fixed linear AR model
# --------------------------------------------------------------------------

from pyspark.ml.feature import SQLTransformer  # noqa: E402

from footfall.plans import forecast  # noqa: E402

# Fixed AR weights of the oracle check: intercept, then lags 1..3.
AR_WEIGHTS = (0.2, 0.5, 0.3, 0.15)


def ar_model(weights=AR_WEIGHTS) -> SQLTransformer:
    c0, *ws = weights
    terms = " + ".join(f"{w} * visitors_lag{k}" for k, w in enumerate(ws, start=1))
    return SQLTransformer(statement=f"SELECT *, {c0} + {terms} AS prediction FROM __THIS__")


def _ar_sql(weights=AR_WEIGHTS) -> str:
    c0, w1, w2, w3 = weights

    def clip(e):
        return f"(case when ({e}) < 0 then 0.0 else ({e}) end)"
    first = clip(f"{c0} + {w1} * visitors_lag1 + {w2} * visitors_lag2 + {w3} * visitors_lag3")
    nxt = clip(f"{c0} + {w1} * r.p + {w2} * r.l1 + {w3} * r.l2")
    return (standin.oracle_with(*panel_ctes(), ("steps", """
        select id, air_store_id, visit_date, visitors_lag1, visitors_lag2, visitors_lag3,
               row_number() over (partition by air_store_id order by visit_date) as step
        from panel where subset = 'test'"""), recursive=True)
        + f""", rec(air_store_id, step, p, l1, l2, l3) as (
            select air_store_id, step, {first}, visitors_lag1, visitors_lag2, visitors_lag3
            from steps where step = 1
            union all
            select t.air_store_id, t.step, {nxt}, r.p, r.l1, r.l2
            from rec r join steps t on t.air_store_id = r.air_store_id and t.step = r.step + 1)
        select s.id, s.air_store_id, s.visit_date, round(r.p, {R}) as log_visitors,
               round(exp(r.p), {R}) as visitors,
               round(r.l1, {R}) as visitors_lag1, round(r.l3, {R}) as visitors_lag3
        from rec r join steps s on s.air_store_id = r.air_store_id and s.step = r.step""")


@register("recursive_forecast_ar", _ar_sql())
def q_recursive_forecast_ar(spark, sf_dir):
    t = standin.load(spark, sf_dir)
    _, te = series.split(series.build_panel(t.visits, t.submission))
    c0, *ws = AR_WEIGHTS
    line = lso.LinearScorer([f"visitors_lag{k}" for k in range(1, len(ws) + 1)], ws, c0)
    out = forecast.recursive_forecast(te, line, n_lags=7, clip=True, fill_value=None)
    return out.select("id", "air_store_id", "visit_date", rnd("log_visitors").alias("log_visitors"),
                      rnd("visitors").alias("visitors"), rnd("visitors_lag1").alias("visitors_lag1"),
                      rnd("visitors_lag3").alias("visitors_lag3"))


# --------------------------------------------------------------------------
# Step 9: model jobs (rows-only checks: no SQL equivalent)
# --------------------------------------------------------------------------

from footfall.plans import boosting, stacking  # noqa: E402
from footfall.plans import cluster as clu  # noqa: E402
from footfall.plans import lasso as lso  # noqa: E402
from footfall.plans import ordered_cv as ocv  # noqa: E402
from footfall.plans import search  # noqa: E402

# The stand-in data has few store-days at 120 visitors; FIXTURES: use 75.
LARGE_PARTY_AT = 75


@register("kmeans_cluster")
def q_kmeans_cluster(spark, sf_dir):
    """M1: 8 clusters of store locations, 25 restarts x 1000 iterations."""
    t, tr, te = _train_test_rows(spark, sf_dir)
    stores = store_dim.build_stores(tr, te, t.store_info, N_TOKENS)
    out = clu.add_location_cluster(stores, k=8, restarts=25, max_iter=1000, seed=0)
    return out.select("air_store_id", "cluster").distinct()


# Fixed centres of one k-means step in SQL.
STEP_CENTRES = ((-120.0, 30.0), (0.0, 0.0), (60.0, 45.0), (139.0, 35.0))


@register("kmeans_step", standin.oracle_with() + f"""
    , p as (select air_store_id, any_value(longitude) as x, any_value(latitude) as y
            from store_info where longitude is not null and latitude is not null
            group by air_store_id),
    c as (select * from (values {", ".join(
        f"({i}, {x}::double, {y}::double)" for i, (x, y) in enumerate(STEP_CENTRES))}) v(k, cx, cy)),
    d as (select air_store_id, x, y, k, cx, cy, power(x - cx, 2) + power(y - cy, 2) as far
          from p, c qualify row_number() over (partition by air_store_id order by far, k) = 1)
    select c.k as cluster, round(coalesce(avg(x), any_value(c.cx)), {R}) as longitude,
           round(coalesce(avg(y), any_value(c.cy)), {R}) as latitude, count(x) as n_stores,
           round(coalesce(sum(far), 0), {R}) as cost
    from c left join d on d.k = c.k group by c.k""")
def q_kmeans_step(spark, sf_dir):
    """M1: one move of the centres of all restarts (here one) from fixed centres."""
    t = standin.load(spark, sf_dir)
    points = clu._points(t.store_info, "air_store_id")
    centres = {0: np.array(STEP_CENTRES)}
    sums = clu.cluster_sums(points, centres)
    fixed = spark.createDataFrame(
        [(i, x, y) for i, (x, y) in enumerate(STEP_CENTRES)], "cluster int, cx double, cy double")
    return fixed.join(sums.drop("restart"), "cluster", "left").select(
        "cluster", rnd(F.coalesce(F.col("sx") / F.col("n"), "cx")).alias("longitude"),
        rnd(F.coalesce(F.col("sy") / F.col("n"), "cy")).alias("latitude"),
        F.coalesce("n", F.lit(0)).alias("n_stores"),
        rnd(F.coalesce("cost", F.lit(0.0))).alias("cost"))


_frames: dict[tuple, tuple] = {}


def _model_frames(spark, sf_dir):
    """C1 + C2 as the original trains on them: KMeans clusters, cleaned train rows, the
    predicted ``large_party`` on the test rows.  Written once per application and
    input; the tables they were made from are dropped."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _frames:
        before = intermediates(spark)
        t = standin.load(spark, sf_dir)
        fs = feat.import_data(t, large_party_threshold=LARGE_PARTY_AT)
        train, test = feat.create_train_test(fs, clean=True, predict_large_party=True,
                                             large_party_threshold=LARGE_PARTY_AT)
        _frames[key] = train, materialize(test, "test_frame")
        drop_intermediates(spark, before)
    return _frames[key]


@register("training_frame")
def q_training_frame(spark, sf_dir):
    """C1 + C2: the frame that every model is trained on."""
    return _model_frames(spark, sf_dir)[0]


@register("scoring_frame")
def q_scoring_frame(spark, sf_dir):
    """C1 + C2: the rows to be forecast."""
    return _model_frames(spark, sf_dir)[1]


@register("logit_large_party")
def q_logit_large_party(spark, sf_dir):
    """M2: no-intercept logit on 27 features, P >= 0.5 flags the test rows."""
    return _model_frames(spark, sf_dir)[1].select("id", "large_party")


@register("lasso_path")
def q_lasso_path(spark, sf_dir):
    """M7: 200 alphas x 5 ordered folds, mean test RMSE per alpha."""
    train, _ = _model_frames(spark, sf_dir)
    return lso.lasso_path(train, mdl.model_features(train), alphas=lso.reference_alphas())


@register("forest_cv")
def q_forest_cv(spark, sf_dir):
    """M8 + M11: 1000 trees of depth 3, sqrt features, seed 0."""
    train, _ = _model_frames(spark, sf_dir)
    scores = ocv.time_series_cv(train, mdl.random_forest(), mdl.model_features(train),
                                parallelism=5, stored=True)
    return ocv.cv_table(spark, "random_forest", scores)


@register("gbt_cv")
def q_gbt_cv(spark, sf_dir):
    """M9 + M11: 1000 leaf-wise boosting rounds at rate 0.01, five folds side by side."""
    train, _ = _model_frames(spark, sf_dir)
    scores = ocv.time_series_cv(train, boosting.LeafwiseBoosting(), mdl.model_features(train),
                                stored=True)
    return ocv.cv_table(spark, "gbt", scores)


@register("model_leaderboard")
def q_model_leaderboard(spark, sf_dir):
    """M10 + O2: candidates scored by ordered CV, ranked."""
    train, _ = _model_frames(spark, sf_dir)
    board, _ = search.model_search(train, mdl.model_features(train),
                                   stacked=("linear", "lasso"), stored=True)
    return board


# --------------------------------------------------------------------------
# Notebook and AutoML-script flows (rows-only)
# --------------------------------------------------------------------------

@register("ols_summary")
def q_ols_summary(spark, sf_dir):
    """M3: OLS without constant on the notebook's first predictor list."""
    train, _ = _model_frames(spark, sf_dir)
    table, stats, _ = diagnostics.ols(train, mdl.OLS_FEATURES_1)
    return table.withColumns({k: F.lit(v) for k, v in stats.items()})


@register("vif_table")
def q_vif_table(spark, sf_dir):
    """M4 + P14: VIF of every predictor, rounded to one place for display."""
    train, _ = _model_frames(spark, sf_dir)
    return diagnostics.rounded(diagnostics.vif(train, mdl.OLS_FEATURES_1))


@register("linear_cv")
def q_linear_cv(spark, sf_dir):
    """M5 + M11: ordered CV of least squares on the second predictor list."""
    train, _ = _model_frames(spark, sf_dir)
    return ocv.cv_table(spark, "linear", ocv.linear_cv(train, mdl.OLS_FEATURES_2))


@register("lasso_score")
def q_lasso_score(spark, sf_dir):
    """M6 + M12: Lasso (alpha 0.001) fitted on train, scored on the test ids."""
    t = standin.load(spark, sf_dir)
    train, test = _model_frames(spark, sf_dir)
    feats = mdl.model_features(train)
    model = lso.lasso_fit(train, feats, alpha=0.001)
    pred = model.transform(test).select("id", "prediction")
    return scoring.score_predictions(pred, t.submission)


@register("forecast_leader")
def q_forecast_leader(spark, sf_dir):
    """M10 + M13 + J10: leader of a model search forecast step by step over
    the test horizon, joined to the submission ids."""
    t = standin.load(spark, sf_dir)
    train, test = _model_frames(spark, sf_dir)
    feats = mdl.model_features(train)
    cands = [("linear", mdl.linear_regression(True), [{}]),
             ("lasso", mdl.lasso(0.001), [{"regParam": 0.001}, {"regParam": 0.01}])]
    _, leader = search.model_search(train, feats, candidates=cands, stored=True)
    out = forecast.recursive_forecast(test, leader, n_lags=7, clip=True, fill_value=-1.0)
    return t.submission.select("id").join(out.select("id", "visitors"), "id")




# --------------------------------------------------------------------------
# One-feature forms of the path and of ordered CV (closed form in SQL)
# --------------------------------------------------------------------------

_X1_CTE = ("x1", """select air_store_id, visit_date, log_visitors as y, visitors_lag1 as x
                    from panel where subset = 'train' and visitors_lag1 is not null
                      and log_visitors is not null""")
_X1_FOLDS = ("o", f"""select *, {_FOLD_SQL} as fold from (
                 select *, row_number() over (order by visit_date, air_store_id) - 1 as ordinal,
                        count(*) over () as n
                 from x1)""")
_SPLITS = ("splits", "select cast(unnest(range(1, 6)) as integer) as split")
_TRAIN_STATS = ("trs", """select s.split, count(*) as n, sum(x) as sx, sum(y) as sy,
                                 sum(x * x) as sxx, sum(x * y) as sxy,
                                 regr_slope(y, x) as slope, regr_intercept(y, x) as icpt
                          from splits s join o on o.fold < s.split group by s.split""")
_TEST_STATS = ("tes", """select s.split, count(*) as n, sum(x) as sx, sum(y) as sy, sum(x * x) as sxx,
                                sum(x * y) as sxy, sum(y * y) as syy
                         from splits s join o on o.fold = s.split group by s.split""")


def _x1_rows(spark, sf_dir):
    _, tr, _ = _train_test_rows(spark, sf_dir)
    return tr.where(F.col("visitors_lag1").isNotNull() & F.col("log_visitors").isNotNull())


@register("lasso_path_single", all_ctes() + ", " + ", ".join(
    f"{n} as ({s})" for n, s in [_X1_CTE, _X1_FOLDS, _SPLITS, _TRAIN_STATS, _TEST_STATS]) + f"""
    , alphas as (select cast(round(0.001 + 0.005 * k, 3) as double) as lam
                 from (select unnest(range(200)) as k))
    , fit as (
        select a.lam, t.split,
               (sxy - sx * sy / n) as c, (sxx - sx * sx / n) as cc, n, sx, sy
        from alphas a, trs t)
    , w as (
        select lam, split,
               sign(c) * greatest(abs(c) - n * lam, 0) / cc as w,
               sy / n - (sign(c) * greatest(abs(c) - n * lam, 0) / cc) * sx / n as b
        from fit)
    , r as (
        select w.lam, w.split,
               sqrt(greatest(e.syy - 2 * w.b * e.sy - 2 * w.w * e.sxy + e.n * w.b * w.b
                             + 2 * w.b * w.w * e.sx + w.w * w.w * e.sxx, 0) / e.n) as rmse
        from w join tes e on e.split = w.split)
    select lam as "lambda", round(avg(rmse), {R}) as rmsle from r group by lam""")
def q_lasso_path_single(spark, sf_dir):
    """M7 on one feature (lag 1): the full 200-alpha grid under ordered CV."""
    path = lso.lasso_path(_x1_rows(spark, sf_dir), ["visitors_lag1"],
                          alphas=lso.reference_alphas())
    return path.select("lambda", rnd("rmsle").alias("rmsle"))


@register("linear_cv_single", all_ctes() + ", " + ", ".join(
    f"{n} as ({s})" for n, s in [_X1_CTE, _X1_FOLDS, _SPLITS, _TRAIN_STATS]) + f"""
    select 'linear' as model, t.split as fold,
           round(sqrt(avg(power(o.y - (t.icpt + t.slope * o.x), 2))), {R}) as rmsle
    from trs t join o on o.fold = t.split group by t.split""")
def q_linear_cv_single(spark, sf_dir):
    """M11 + M5 on one feature: refit per expanding fold, RMSE on the next."""
    scores = ocv.time_series_cv(_x1_rows(spark, sf_dir), mdl.linear_regression(True),
                                ["visitors_lag1"])
    return ocv.cv_table(spark, "linear", scores).select("model", "fold",
                                                        rnd("rmsle").alias("rmsle"))




_X12_FOLDS = ("o", f"""select *, {_FOLD_SQL} as fold from (
                 select log_visitors as y, visitors_lag1 as x, visitors_lag2 as z,
                        row_number() over (order by visit_date, air_store_id) - 1 as ordinal,
                        count(*) over () as n
                 from panel where subset = 'train' and visitors_lag1 is not null
                   and visitors_lag2 is not null and log_visitors is not null)""")


@register("linear_cv_pair", all_ctes() + ", " + ", ".join(
    f"{n} as ({s})" for n, s in [_X12_FOLDS, _SPLITS]) + f"""
    , m as (select s.split, avg(x) as mx, avg(z) as mz, avg(y) as my, var_pop(x) as xx,
                   var_pop(z) as zz, covar_pop(x, z) as xz, covar_pop(x, y) as xy,
                   covar_pop(z, y) as zy
            from splits s join o on o.fold < s.split group by s.split)
    , b as (select *, (zz * xy - xz * zy) / (xx * zz - xz * xz) as u,
                   (xx * zy - xz * xy) / (xx * zz - xz * xz) as v from m)
    select 'linear' as model, b.split as fold,
           round(sqrt(avg(power(y - my - u * (x - mx) - v * (z - mz), 2))), {R}) as rmsle
    from b join o on o.fold = b.split group by b.split""")
def q_linear_cv_pair(spark, sf_dir):
    """M11 + M5 on two features, from one factor per fold instead of five fits."""
    scores = ocv.linear_cv(_xy_rows(spark, sf_dir), ["visitors_lag1", "visitors_lag2"])
    return ocv.cv_table(spark, "linear", scores).select("model", "fold",
                                                        rnd("rmsle").alias("rmsle"))


@register("ols_pair", all_ctes() + ", " + "{} as ({})".format(*_XY_CTE) + f"""
    , s as (select count(*) as n, sum(x1 * x1) as s11, sum(x2 * x2) as s22, sum(x1 * x2) as s12,
                   sum(x1 * y) as s1y, sum(x2 * y) as s2y, sum(y * y) as syy from xy)
    , b as (select *, s11 * s22 - s12 * s12 as det,
                   (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) as b1,
                   (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) as b2 from s)
    , e as (select *, (syy - 2 * (b1 * s1y + b2 * s2y)
                       + b1 * b1 * s11 + 2 * b1 * b2 * s12 + b2 * b2 * s22) / (n - 2) as sigma2
            from b)
    select 'visitors_lag1' as feature, round(b1, {R}) as coef,
           round(sqrt(s22 / det * sigma2), {R}) as std_err,
           round(b1 / sqrt(s22 / det * sigma2), {R}) as t_value from e
    union all
    select 'visitors_lag2', round(b2, {R}), round(sqrt(s11 / det * sigma2), {R}),
           round(b2 / sqrt(s11 / det * sigma2), {R}) from e""")
def q_ols_pair(spark, sf_dir):
    """M3 with two features, no constant: coefficients, standard errors, t."""
    table, _, _ = diagnostics.ols(_xy_rows(spark, sf_dir), ["visitors_lag1", "visitors_lag2"],
                                  residual_stats=False)
    return table.select("feature", rnd("coef").alias("coef"), rnd("std_err").alias("std_err"),
                        rnd("t_value").alias("t_value"))


# --------------------------------------------------------------------------
# SQL checks of the remaining operators
# --------------------------------------------------------------------------

_TR_PANEL = standin.oracle_with(*panel_ctes())


def _cte(*pairs) -> str:
    return "".join(f", {n} as ({q})" for n, q in pairs)


@register("ols_stats_single", _TR_PANEL + _cte(_XY_CTE) + """
    , c as (select count(*) as n, sum(x1 * y) / sum(x1 * x1) as b, sum(y * y) as syy,
                   sum(x1 * x1) as sxx from xy)
    , e as (select p.air_store_id, p.visit_date, p.log_visitors - c.b * p.visitors_lag1 as e
            from panel p, c where subset = 'train' and visitors_lag1 is not null
              and visitors_lag2 is not null and log_visitors is not null)
    , m as (select avg(e) as mean from e)
    , k as (select sum(e * e) as sse, avg(power(e - mean, 2)) as m2, avg(power(e - mean, 3)) as m3,
                   avg(power(e - mean, 4)) as m4 from e, m)
    , d as (select sum(power(e - before, 2)) as num
            from (select e, lag(e) over (order by air_store_id, visit_date) as before from e))
    , s as (select n::double as n, syy, sse, b, -n / 2.0 * (ln(2 * pi()) + ln(sse / n) + 1) as loglik,
                   m3 / power(m2, 1.5) as skew, m4 / (m2 * m2) as kurt, num / sse as dw,
                   sqrt(sse / (n - 1) / sxx) as se
            from c, k, d)
    -- normal transforms of skew and kurtosis, and Student's quantile from the normal one
    , o1 as (select *, skew * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) as y,
                    sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)
                              / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 as w2,
                    (kurt - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3)
                        / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) as x,
                    6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(
                        6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) as t,
                    1.959963984540054 as z, n - 1 as v
             from s)
    , o2 as (select *, 6 + 8 / t * (2 / t + sqrt(1 + 4 / (t * t))) as a,
                    z + (power(z, 3) + z) / (4 * v)
                      + (5 * power(z, 5) + 16 * power(z, 3) + 3 * z) / (96 * v * v) as q
             from o1)
    , o3 as (select *, power(asinh(y * sqrt((w2 - 1) / 2)) / sqrt(0.5 * ln(w2)), 2)
                    + power((1 - 2 / (9 * a) - cbrt((1 - 2 / a) / (1 + x * sqrt(2 / (a - 4)))))
                            / sqrt(2 / (9 * a)), 2) as k2 from o2)
    select round((syy - sse) / (sse / (n - 1)), 3) as f_stat, round(loglik, 4) as loglik,
           round(-2 * loglik + 2, 4) as aic, round(-2 * loglik + ln(n), 4) as bic,
           round(skew, 6) as skew, round(kurt, 6) as kurtosis,
           round(n / 6.0 * (skew * skew + power(kurt - 3, 2) / 4), 4) as jarque_bera,
           round(dw, 6) as durbin_watson, round(k2, 3) as omnibus,
           round(exp(-k2 / 2), 6) as prob_omnibus, 0.0::double as prob_f,
           round(exp(-n / 12.0 * (skew * skew + power(kurt - 3, 2) / 4)), 6) as prob_jb,
           1.0::double as condition_number,
           round(b - q * se, 6) as ci_low, round(b + q * se, 6) as ci_high
    from o3""")
def q_ols_stats_single(spark, sf_dir):
    """M3: the summary figures of a one-feature fit without a constant."""
    table, stats, _ = diagnostics.ols(_xy_rows(spark, sf_dir), ["visitors_lag1"])
    digits = {"f_stat": 3, "loglik": 4, "aic": 4, "bic": 4, "skew": 6, "kurtosis": 6,
              "jarque_bera": 4, "durbin_watson": 6, "omnibus": 3, "prob_omnibus": 6,
              "prob_f": 6, "prob_jb": 6, "condition_number": 6}
    return table.select(*[F.round(F.lit(float(stats[k])), d).alias(k) for k, d in digits.items()],
                        rnd("ci_low").alias("ci_low"), rnd("ci_high").alias("ci_high"))


@register("vif_collinear", _TR_PANEL + _cte(_XY_CTE) + f"""
    -- 1 - r² of the column and its multiple, from the rows
    , s as (select 1 - power(sum(x1 * (x1 * 2e7)), 2)
                   / (sum(x1 * x1) * sum((x1 * 2e7) * (x1 * 2e7))) as left_over from xy)
    select f as features, abs(left_over) < 1e-12 as collinear,
           case when abs(left_over) >= 1e-12 then 1 / left_over end as vif_factor
    from s, (values ('visitors_lag1'), ('twice')) v(f)""")
def q_vif_collinear(spark, sf_dir):
    """M4: a column and its double are exactly collinear, whatever their size."""
    rows = _xy_rows(spark, sf_dir).withColumn("twice", F.col("visitors_lag1") * 2e7)
    v = diagnostics.vif(rows, ["visitors_lag1", "twice"])
    endless = F.col("vif_factor") == float("inf")
    return v.select("features", endless.alias("collinear"),
                    F.when(~endless, F.col("vif_factor")).alias("vif_factor"))


@register("lasso_fit_single", _TR_PANEL + _cte(_X1_CTE) + f"""
    , s as (select count(*) as n, avg(x) as mx, avg(y) as my,
                   sum(x * y) - count(*) * avg(x) * avg(y) as c,
                   sum(x * x) - count(*) * avg(x) * avg(x) as cc from x1)
    , w as (select sign(c) * greatest(abs(c) - n * 0.01, 0) / cc as w, mx, my from s)
    select round(w, {R}) as coef, round(my - w * mx, {R}) as intercept from w""")
def q_lasso_fit_single(spark, sf_dir):
    """M6 on one feature: the soft-thresholded slope at alpha 0.01."""
    m = lso.lasso_fit(_x1_rows(spark, sf_dir), ["visitors_lag1"], alpha=0.01)
    return spark.range(1).select(F.round(F.lit(float(m.coefficients[0])), R).alias("coef"),
                                 F.round(F.lit(m.intercept), R).alias("intercept"))


_NEWTON = [("b0", "select cast(0 as double) as b")] + [
    (f"b{i}", f"""select b + sum((z - 1 / (1 + exp(-b * x))) * x)
                       / sum(x * x / (1 + exp(-b * x)) * (1 - 1 / (1 + exp(-b * x)))) as b
                  from lp, b{i - 1} group by b""") for i in range(1, 13)]


@register("logit_single", _TR_PANEL + _cte(("lp", f"""
        select visitors_lag1 as x,
               case when visitors >= {LARGE_PARTY_AT} then 1.0 else 0.0 end as z
        from panel where subset = 'train' and visitors_lag1 is not null
          and log_visitors is not null"""), *_NEWTON) + """
    select round(b, 5) as coef from b12""")
def q_logit_single(spark, sf_dir):
    """M2 on one feature: the no-intercept logit, by Newton steps in SQL."""
    rows = _x1_rows(spark, sf_dir).withColumn(
        "large_party", num.threshold_flag("visitors", LARGE_PARTY_AT))
    model = mdl.large_party_classifier(rows, ["visitors_lag1"])
    return spark.range(1).select(F.round(F.lit(float(model.coefficients[0])), 5).alias("coef"))


def _stump_sql(src: str, label: str, out: str) -> tuple[str, str]:
    """The best single split of ``label`` on dow in 0..6, as per-dow predictions."""
    return out, f"""
        select d.dow, case when d.dow <= best.t then best.lo else best.hi end as p
        from (select t, lo, hi from (
                select t, avg(case when dow <= t then {label} end) as lo,
                       avg(case when dow > t then {label} end) as hi,
                       var_pop(case when dow <= t then {label} end) * sum(case when dow <= t then 1 else 0 end)
                       + var_pop(case when dow > t then {label} end) * sum(case when dow > t then 1 else 0 end)
                         as sse
                from {src}, (select unnest(range(6)) as t) group by t)
              order by sse limit 1) best, (select unnest(range(7)) as dow) d"""


_DOW_CTE = ("dw", """select cast(dow as bigint) as dow, log_visitors as y from panel
                     where subset = 'train' and log_visitors is not null""")


def _dow_grid(spark, model):
    grid = spark.range(7).select(F.col("id").cast("int").alias("dow"))
    return model.transform(grid).select("dow", rnd("prediction").alias("prediction"))


@register("forest_stump", _TR_PANEL + _cte(_DOW_CTE, _stump_sql("dw", "y", "st1")) + f"""
    select cast(dow as integer) as dow, round(p, {R}) as prediction from st1""")
def q_forest_stump(spark, sf_dir):
    """M8 as one tree of depth one on all rows: the best split on the week day."""
    _, tr, _ = _train_test_rows(spark, sf_dir)
    tree = mdl.random_forest(num_trees=1, max_depth=1).setBootstrap(False).setFeatureSubsetStrategy(
        "all")
    model = mdl.regression_pipeline(tree, ["dow"]).fit(
        tr.where(F.col("log_visitors").isNotNull()))
    return _dow_grid(spark, model)


@register("gbt_stump", _TR_PANEL + _cte(
    _DOW_CTE, _stump_sql("dw", "y", "g1"),
    ("dw2", "select dw.dow, 2 * (y - p) as y from dw join g1 on g1.dow = dw.dow"),
    _stump_sql("dw2", "y", "g2")) + f"""
    select cast(g1.dow as integer) as dow, round(g1.p + 0.01 * g2.p, {R}) as prediction
    from g1 join g2 on g1.dow = g2.dow""")
def q_gbt_stump(spark, sf_dir):
    """M9 as two rounds of depth one: a tree, then a tree on the loss gradient at rate 0.01."""
    _, tr, _ = _train_test_rows(spark, sf_dir)
    model = mdl.regression_pipeline(mdl.gradient_boosting(max_iter=2, max_depth=1), ["dow"]).fit(
        tr.where(F.col("log_visitors").isNotNull()))
    return _dow_grid(spark, model)


_DOW_MEAN = ("dm", "select dow, y - (select avg(y) from dw) as y from dw")


@register("boosting_two_leaf", _TR_PANEL + _cte(
    _DOW_CTE, _DOW_MEAN, _stump_sql("dm", "y", "b1"),
    ("dm2", "select dm.dow, y - 0.1 * p as y from dm join b1 on b1.dow = dm.dow"),
    _stump_sql("dm2", "y", "b2")) + f"""
    select cast(b1.dow as integer) as dow,
           round((select avg(y) from dw) + 0.1 * (b1.p + b2.p), {R}) as prediction
    from b1 join b2 on b1.dow = b2.dow""")
def q_boosting_two_leaf(spark, sf_dir):
    """M9: two rounds of trees with two leaves, from the mean, at rate 0.1."""
    _, tr, _ = _train_test_rows(spark, sf_dir)
    rows = tr.where(F.col("log_visitors").isNotNull())
    model = boosting.LeafwiseBoosting(rounds=2, rate=0.1, leaves=2).fit(rows, ["dow"])
    return _dow_grid(spark, model)


_X17_CTE = ("x17", """select air_store_id, visit_date, log_visitors as y, visitors_lag1 as x,
                             visitors_lag7 as z
                      from panel where subset = 'train' and visitors_lag1 is not null
                        and visitors_lag7 is not null and log_visitors is not null""")
_X17_FOLDS = ("o", f"""select *, {_FOLD_SQL} as fold from (
                 select *, row_number() over (order by visit_date, air_store_id) - 1 as ordinal,
                        count(*) over () as n
                 from x17)""")


@register("stacked_single", _TR_PANEL + _cte(
    _X17_CTE, _X17_FOLDS, _SPLITS,
    ("fits", """select s.split, regr_slope(y, x) as a, regr_intercept(y, x) as b,
                       sign(covar_pop(y, z)) * greatest(abs(covar_pop(y, z)) - 0.01, 0)
                       / var_pop(z) as w, avg(y) as my, avg(z) as mz
                from splits s join o on o.fold < s.split group by s.split"""),
    ("oof", """select fold, y, b + a * x as p, my - w * mz + w * z as q
               from o join fits on split = fold"""),
    ("mom", """select covar_pop(p, p) as pp, covar_pop(p, q) as pq, covar_pop(q, q) as qq,
                      covar_pop(p, y) as py, covar_pop(q, y) as qy,
                      avg(p) as mp, avg(q) as mq, avg(y) as my from oof"""),
    ("pair", """select *, (qq * py - pq * qy) / (pp * qq - pq * pq) as u,
                       (pp * qy - pq * py) / (pp * qq - pq * pq) as v from mom"""),
    ("best", """select *, case when u >= 0 and v >= 0 then u when u < 0 then 0
                               else greatest(py / pp, 0) end as wp,
                       case when u >= 0 and v >= 0 then v when u < 0 then greatest(qy / qq, 0)
                            else 0 end as wq from pair""")) + f"""
    select 'line' as learner, round(wp, {R}) as weight from best
    union all select 'lasso', round(wq, {R}) from best
    union all select 'constant', round(my - wp * mp - wq * mq, {R}) from best""")
def q_stacked_single(spark, sf_dir):
    """A line on lag 1 and a Lasso on lag 7, stacked by non-negative least squares."""
    rows = _x1_rows(spark, sf_dir).where(F.col("visitors_lag7").isNotNull()).select(
        "air_store_id", "visit_date", "log_visitors", "visitors_lag1", "visitors_lag7")
    folds = ocv.with_folds(rows)
    learners = [stacking.Learner("line", mdl.linear_regression(True), ["visitors_lag1"]),
                stacking.Learner("lasso", mdl.lasso(0.01), ["visitors_lag7"])]
    found, _ = stacking.stack(folds, learners)
    folds.unpersist()
    table = [(x.name, float(w)) for x, w in zip(learners, found.weights)]
    return spark.createDataFrame([*table, ("constant", found.constant)],
                                 "learner string, weight double").select(
        "learner", rnd("weight").alias("weight"))


_LASSO_SPLITS = ("las", """
        select t.split, a.lam,
               sqrt(greatest(e.syy - 2 * b.b * e.sy - 2 * b.w * e.sxy + e.n * b.b * b.b
                             + 2 * b.b * b.w * e.sx + b.w * b.w * e.sxx, 0) / e.n) as rmse
        from (values (0.01), (0.1)) a(lam), trs t, tes e,
             lateral (select sign(t.sxy - t.sx * t.sy / t.n)
                             * greatest(abs(t.sxy - t.sx * t.sy / t.n) - t.n * a.lam, 0)
                             / (t.sxx - t.sx * t.sx / t.n) as w) w0,
             lateral (select w0.w as w, t.sy / t.n - w0.w * t.sx / t.n as b) b
        where e.split = t.split""")


@register("search_single", _TR_PANEL + _cte(
    _X1_CTE, _X1_FOLDS, _SPLITS, _TRAIN_STATS, _TEST_STATS, _LASSO_SPLITS,
    ("lin", """select t.split, sqrt(avg(power(o.y - (t.icpt + t.slope * o.x), 2))) as rmse
               from trs t join o on o.fold = t.split group by t.split""")) + """
    , board as (
        select 'linear' as model, '{}' as params, avg(rmse) as r from lin
        union all
        select 'lasso', '{"regParam": ' || cast(lam as varchar) || '}', avg(rmse) from las
        group by lam)
    select model, replace(replace(params, '0.10}', '0.1}'), '0.010}', '0.01}') as params,
           round(r, 5) as mean_rmsle,
           row_number() over (order by r, model, params) = 1 as is_leader
    from board""")
def q_search_single(spark, sf_dir):
    """M10, A10, O2 on one feature: the board of three candidates and its leader."""
    cands = [("linear", mdl.linear_regression(True), [{}]),
             ("lasso", mdl.lasso(0.01), [{"regParam": 0.01}, {"regParam": 0.1}])]
    board, _ = search.model_search(_x1_rows(spark, sf_dir), ["visitors_lag1"], candidates=cands)
    top = search.leader_row(board).select(F.col("model").alias("m"), F.col("params").alias("p"))
    return board.join(F.broadcast(top), (F.col("model") == F.col("m"))   # one row
                      & (F.col("params") == F.col("p")), "left").select(
        "model", "params", rnd("mean_rmsle", 5).alias("mean_rmsle"),
        F.col("m").isNotNull().alias("is_leader"))


_LINE_CTES = (_X1_CTE, ("line", "select regr_slope(y, x) as a, regr_intercept(y, x) as b from x1"))


@register("fitted_vs_actual", _TR_PANEL + _cte(*_LINE_CTES) + f"""
    select air_store_id, visit_date, visitors,
           round(exp(line.b + line.a * visitors_lag1), {R}) as predicted_visitors
    from panel, line where subset = 'train' and visitors_lag1 is not null
      and log_visitors is not null""")
def q_fitted_vs_actual(spark, sf_dir):
    """M14 with a one-feature line."""
    rows = _x1_rows(spark, sf_dir)
    model = mdl.regression_pipeline(mdl.linear_regression(True), ["visitors_lag1"]).fit(rows)
    return scoring.fitted_vs_actual(model, rows).select(
        "air_store_id", "visit_date", "visitors", rnd("predicted_visitors").alias(
            "predicted_visitors"))


@register("model_round_trip", _TR_PANEL + _cte(*_LINE_CTES) + f"""
    select id, round(line.b + line.a * visitors_lag1, {R}) as prediction
    from panel, line where subset = 'test' and visitors_lag1 is not null""")
def q_model_round_trip(spark, sf_dir):
    """A model is saved, loaded and applied to the test rows."""
    import uuid
    _, _, te = _train_test_rows(spark, sf_dir)
    rows = _x1_rows(spark, sf_dir)
    model = mdl.regression_pipeline(mdl.linear_regression(True), ["visitors_lag1"]).fit(rows)
    ensure_checkpoint_dir(spark)
    root = spark.sparkContext.getCheckpointDir().rstrip("/")
    again = search.load_model(search.save_model(model, f"{root}/models/{uuid.uuid4().hex}"))
    return again.transform(te.where(F.col("visitors_lag1").isNotNull())).select(
        "id", rnd("prediction").alias("prediction"))


@register("csv_round_trip", standin.oracle_with() + f"""
    select s.id, v.air_store_id, v.visit_date, v.visitors
    from (select concat(air_store_id, '_', cast(visit_date as varchar)) as key, * from visits) v
    left join submission s on s.id = v.key""")
def q_csv_round_trip(spark, sf_dir):
    """Visits and ids are written as CSV, read by their schemas, kept as a snapshot."""
    import uuid
    from footfall.functions import text
    from footfall.sources import schemas
    from footfall.sources import tables as tab
    t = standin.load(spark, sf_dir)
    ensure_checkpoint_dir(spark)
    root = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/csv/{uuid.uuid4().hex}"
    names = {attr: (name, schema) for name, (attr, schema) in schemas.CSV_FILES.items()}
    name, schema = names["visits"]
    tab.write_csv(t.visits.select(*schema.fieldNames()), f"{root}/{name}")
    tab.write_csv(t.submission.select(*schemas.SUBMISSION.fieldNames()), f"{root}/ids")
    visits = tab.write_snapshot(tab.read_csv(spark, f"{root}/{name}", schema), f"{root}/snapshot")
    ids = tab.read_submission_ids(spark, f"{root}/ids")
    return visits.join(ids, text.make_id("air_store_id", "visit_date") == F.col("id"),
                       "left").select("id", "air_store_id",
                                      F.to_date("visit_date").alias("visit_date"), "visitors")


# Lines that don't fit the schema: a word for a number, a field too many, a broken date.
_PLANTED = """case when visitors % 7 = 0 then concat(air_store_id, ',', {d}, ',many')
                   when visitors % 7 = 1 then concat(air_store_id, ',', {d}, ',', {v}, ',more')
                   when visitors % 7 = 2 then concat(air_store_id, ',2017-13-45,', {v})
                   else concat(air_store_id, ',', {d}, ',', {v}) end"""


@register("csv_bad_rows", standin.oracle_with() + f"""
    , l as (select *, {_PLANTED.format(d="cast(visit_date as varchar)",
                                       v="cast(visitors as varchar)")} as line from visits)
    select 'good' as outcome, air_store_id || ' ' || visit_date || ' ' || visitors as content
    from l where visitors % 7 > 2
    union all select 'rejected', line from l where visitors % 7 <= 2""")
def q_csv_bad_rows(spark, sf_dir):
    """S1 with bad rows: what fits is read, the rest is written as it stands."""
    import uuid
    from footfall.sources import schemas
    from footfall.sources import tables as tab
    t = standin.load(spark, sf_dir)
    ensure_checkpoint_dir(spark)
    root = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/csv/{uuid.uuid4().hex}"
    planted = _PLANTED.format(d="cast(visit_date as string)", v="cast(visitors as string)")
    schema = next(sch for attr, sch in schemas.CSV_FILES.values() if attr == "visits")
    lines = t.visits.select("air_store_id", "visit_date", "visitors").selectExpr(
        f"{planted} as value")
    lines.write.text(f"{root}/lines")
    good, bad = tab.read_csv_checked(spark, f"{root}/lines", schema, f"{root}/rejected",
                                     header=False)
    return good.select(F.lit("good").alias("outcome"), F.concat_ws(
        " ", "air_store_id", F.to_date("visit_date").cast("string"),
        F.col("visitors").cast("long").cast("string")).alias("content")).union(
        bad.select(F.lit("rejected"), "line"))


# Fixed-point forecast with a difference among the features: intercept, lag 1, diff 1.
FIXED_POINT_WEIGHTS = (0.4, 0.6, 0.25)
FIXED_POINT_PASSES = 11     # distinct test days of the stand-in, at every scale


def _fixed_point_sql() -> str:
    c, w, d = FIXED_POINT_WEIGHTS
    passes = [("q0", """select id, air_store_id, visit_date, log_visitors as v, subset = 'test' as t
                        from panel""")]
    for i in range(1, FIXED_POINT_PASSES + 1):
        passes.append((f"q{i}", f"""
            select id, air_store_id, visit_date, t,
                   case when t then case when {c} + {w} * l + {d} * (v - l) < 0 then 0.0
                                         else {c} + {w} * l + {d} * (v - l) end else v end as v
            from (select *, lag(v) over (partition by air_store_id order by visit_date) as l
                  from q{i - 1})"""))
    return _TR_PANEL + _cte(*passes) + f"""
        select id, round(v, {R}) as log_visitors, round(exp(v), {R}) as visitors
        from q{FIXED_POINT_PASSES} where t"""


@register("fixed_point_ar", _fixed_point_sql())
def q_fixed_point_ar(spark, sf_dir):
    """M13 and P10 with a difference feature: every pass derives the lags anew (trap T1)."""
    c, w, d = FIXED_POINT_WEIGHTS
    _, tr, te = _train_test_rows(spark, sf_dir)
    model = SQLTransformer(statement=f"SELECT *, {c} + {w} * visitors_lag1 + {d} * visitors_diff1 "
                                     "AS prediction FROM __THIS__")
    out = forecast.recursive_forecast(te, model, n_lags=7, clip=True, fill_value=None,
                                      mode="fixed_point", train_rows=tr)
    return out.select("id", rnd("log_visitors").alias("log_visitors"),
                      rnd("visitors").alias("visitors"))


# The slowest model jobs run last, after every cheap and oracle-checked query.
for _slow in ("model_leaderboard", "forest_cv", "gbt_cv"):
    QUERIES[_slow] = QUERIES.pop(_slow)
