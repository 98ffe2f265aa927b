"""The dataset bundle, CSV readers (S1, S2) and sinks."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from footfall.sources import schemas


@dataclass(frozen=True)
class Tables:
    """The seven inputs of the pipeline, all lazy DataFrames."""

    visits: DataFrame          # air_store_id, visit_date, visitors
    store_info: DataFrame      # air_store_id, air_genre_name, air_area_name, latitude, longitude
    air_reserve: DataFrame     # air_store_id, visit_datetime, reserve_datetime, reserve_visitors
    hpg_reserve: DataFrame     # hpg_store_id, visit_datetime, reserve_datetime, reserve_visitors
    store_relation: DataFrame  # air_store_id, hpg_store_id
    submission: DataFrame      # id, visitors
    date_info: DataFrame       # calendar_date, day_of_week, holiday_flg


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Header CSV with a fixed schema (no inference pass over the data)."""
    return (spark.read.schema(schema).option("header", True)
            .option("mode", "FAILFAST").csv(path))


BAD_LINE = "_bad_line"


def read_csv_checked(spark: SparkSession, path: str, schema, rejected: str, header: bool = True
                     ) -> tuple[DataFrame, DataFrame]:
    """S1 for files with bad rows: (rows that fit the schema, rejected lines).

    A line with a value that its column's type can't take, or with too many or too few
    fields, is written to ``rejected`` as it is, one per row, and left out.
    """
    marked = (spark.read.schema(StructType([*schema.fields, StructField(BAD_LINE, StringType())]))
              .option("header", header).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", BAD_LINE).csv(path))
    # all columns are parsed: with fewer a bad value could go unseen
    kept = marked.cache()
    bad = write_snapshot(kept.where(F.col(BAD_LINE).isNotNull()).select(
        F.col(BAD_LINE).alias("line")), rejected)
    good = kept.where(F.col(BAD_LINE).isNull()).select(*schema.fieldNames())
    return good, bad


def read_csv_tables(spark: SparkSession, data_dir: str) -> Tables:
    """The original CSV layout, one file (or directory of parts) each."""
    frames = {attr: read_csv(spark, os.path.join(data_dir, name), schema)
              for name, (attr, schema) in schemas.CSV_FILES.items()}
    return Tables(**frames)


def read_submission_ids(spark: SparkSession, path: str) -> DataFrame:
    """Re-read of the submission template, keeping only ``id``."""
    return read_csv(spark, path, schemas.SUBMISSION).select("id")


def write_csv(df: DataFrame, path: str) -> None:
    """S3: header CSV, no index column; one directory of part files."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Parquet snapshot for inspection; returns the re-read table, which
    doubles as a lineage cut."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
