"""Fixed schemas for the eight CSV sources (no inference, S1).

Dates arrive as text in the original files; the reader parses them directly
into DATE / TIMESTAMP_NTZ so no per-row Python parsing is ever needed.
"""

from pyspark.sql import types as T

VISITS = T.StructType([
    T.StructField("air_store_id", T.StringType()),
    T.StructField("visit_date", T.DateType()),
    T.StructField("visitors", T.LongType()),
])

STORE_INFO = T.StructType([
    T.StructField("air_store_id", T.StringType()),
    T.StructField("air_genre_name", T.StringType()),
    T.StructField("air_area_name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

AIR_RESERVE = T.StructType([
    T.StructField("air_store_id", T.StringType()),
    T.StructField("visit_datetime", T.TimestampNTZType()),
    T.StructField("reserve_datetime", T.TimestampNTZType()),
    T.StructField("reserve_visitors", T.LongType()),
])

HPG_RESERVE = T.StructType([
    T.StructField("hpg_store_id", T.StringType()),
    T.StructField("visit_datetime", T.TimestampNTZType()),
    T.StructField("reserve_datetime", T.TimestampNTZType()),
    T.StructField("reserve_visitors", T.LongType()),
])

STORE_RELATION = T.StructType([
    T.StructField("air_store_id", T.StringType()),
    T.StructField("hpg_store_id", T.StringType()),
])

SUBMISSION = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("visitors", T.LongType()),
])

DATE_INFO = T.StructType([
    T.StructField("calendar_date", T.DateType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("holiday_flg", T.IntegerType()),
])

# file name -> (table attribute, schema).  hpg_store_info.csv is loaded by the
# original pipeline but never read afterwards, so it is not part of the bundle.
CSV_FILES = {
    "air_visit_data.csv": ("visits", VISITS),
    "air_store_info.csv": ("store_info", STORE_INFO),
    "air_reserve.csv": ("air_reserve", AIR_RESERVE),
    "hpg_reserve.csv": ("hpg_reserve", HPG_RESERVE),
    "store_id_relation.csv": ("store_relation", STORE_RELATION),
    "sample_submission.csv": ("submission", SUBMISSION),
    "date_info.csv": ("date_info", DATE_INFO),
}
