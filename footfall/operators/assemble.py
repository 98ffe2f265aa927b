"""Wide train/test assembly.

Join plan: the panel is the fact side; the calendar (one row per day, bounded
by the calendar — size-checked) is broadcast; the store dimension and the two
reservation tables are keyed by store and joined by AQE's choice (broadcast
when small at runtime, sort-merge otherwise).  All joins are left joins, so
no row is lost or duplicated (every right side is unique on its key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import calendar as cal
from footfall.functions import numeric as num
from footfall.functions import text
from footfall.operators.encode import fit_label_codes
from footfall.operators.joins import bounded_broadcast, semi_join_null_safe
from footfall.session import materialize

STORE = "air_store_id"
DAY = "visit_date"
RES_COLS = ["rs1", "rv1", "rs2", "rv2"]
# Calendar table bound: one row per day for ~270 years.
CALENDAR_MAX_ROWS = 100_000


def holiday_table(date_info: DataFrame) -> DataFrame:
    """Calendar keyed by ``visit_date``, day name encoded."""
    hol = date_info.select(cal.to_day("calendar_date").alias(DAY), "day_of_week",
                           F.col("holiday_flg").cast("int").alias("holiday_flg"))
    return fit_label_codes(hol, ["day_of_week"]).apply(hol)


def _suffixed(res: DataFrame, suffix: str) -> DataFrame:
    return res.select(STORE, DAY, *[F.col(c).alias(c + suffix) for c in RES_COLS])


def attach(rows: DataFrame, hol: DataFrame, stores: DataFrame, ar: DataFrame,
           hr: DataFrame) -> DataFrame:
    """Calendar, store x dow, air (_x) and hpg (_y) reservations."""
    hol_side, _ = bounded_broadcast(hol, CALENDAR_MAX_ROWS)
    return (rows.join(hol_side, DAY, "left")
                .join(stores, [STORE, "dow"], "left")
                .join(_suffixed(ar, "_x"), [STORE, DAY], "left")
                .join(_suffixed(hr, "_y"), [STORE, DAY], "left"))


def frame_maxima(stores: DataFrame, rows: DataFrame):
    """J11 helper: (max latitude, max longitude) over the rows of a frame.

    Coordinates reach a row only through the (store, dow) join, so the maxima
    over the frame equal the maxima over the store rows matched by the frame's
    distinct (store, dow) keys — a small semi join instead of re-running the
    whole wide join pipeline.  Both maxima come from one scalar subquery.
    """
    keys = rows.select(STORE, "dow").distinct()
    m = (stores.join(keys, [STORE, "dow"], "left_semi")
               .agg(F.struct(F.max("latitude").alias("lat"),
                             F.max("longitude").alias("lon")).alias("m")))
    return m.scalar()


def derive(df: DataFrame, make_id: bool, maxima=None) -> DataFrame:
    """F3 (train only), totals (F16, T15), F13, J11, lon + lat."""
    if make_id:
        df = df.withColumn("id", text.make_id(STORE, DAY))
    # Column max minus column, per frame — an uncorrelated scalar subquery.
    if maxima is None:
        maxima = df.select(F.struct(F.max("latitude").alias("lat"),
                                    F.max("longitude").alias("lon"))).scalar()
    max_lat, max_lon = maxima.getField("lat"), maxima.getField("lon")
    return df.withColumns({
        "total_reserv_sum": F.col("rv1_x") + F.col("rv1_y"),
        "total_reserv_mean": (F.col("rv2_x") + F.col("rv2_y")) / 2,
        "total_reserv_dt_diff_mean": (F.col("rs2_x") + F.col("rs2_y")) / 2,
        "date_int": cal.date_int(DAY),
        "var_max_lat": max_lat - F.col("latitude"),
        "var_max_long": max_lon - F.col("longitude"),
        "lon_plus_lat": F.col("longitude") + F.col("latitude"),
    })


CLEAN_VARS = ["air_genre_name", "air_area_name", "air_store_id2", "cluster"]


def train_clean(train: DataFrame, test: DataFrame, variables=None,
                last_only: bool = False) -> DataFrame:
    """Drop train rows whose categories never occur in test.

    Default is the documented intent (all variables, conjunction); the
    original loop only kept the last variable's filter (``last_only``, T2).
    A variable absent from the frame is an error.
    """
    variables = list(variables or CLEAN_VARS)
    if last_only:
        variables = variables[-1:]
    for v in variables:
        train = semi_join_null_safe(train, test, v)
    return train


def create_train_test(train_rows: DataFrame, test_rows: DataFrame, stores: DataFrame,
                      hol: DataFrame, ar: DataFrame, hr: DataFrame, clean: bool = False,
                      clean_last_only: bool = False, fill: bool = True
                      ) -> tuple[DataFrame, DataFrame]:
    """C2 without the large-party model (see ``plans.features``)."""
    train = derive(attach(train_rows, hol, stores, ar, hr), make_id=True,
                   maxima=frame_maxima(stores, train_rows))
    test = derive(attach(test_rows, hol, stores, ar, hr), make_id=False,
                  maxima=frame_maxima(stores, test_rows))
    # fitted on the panel rows: the same distinct stores as the wide frame
    # (left joins keep rows), without re-running its joins
    codes = fit_label_codes(train_rows.select(STORE), [STORE])
    train = codes.apply(train, {STORE: "air_store_id2"})
    test = codes.apply(test, {STORE: "air_store_id2"}, handle_invalid="error")
    # The test frame is the forecast horizon only (stores x horizon rows); it is
    # read by the output and by every clean semi join, so materialise it once.
    test = materialize(test, "test_rows")
    if clean:
        train = train_clean(train, test, last_only=clean_last_only)
    if fill:
        train, test = num.fill_missing(train), num.fill_missing(test)
    return train, test
