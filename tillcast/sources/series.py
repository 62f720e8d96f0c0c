"""Reading stored daily series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.constants import OVERALL

SERIES_SCHEMA = (
    "date date, revenue double, purchases bigint, unique_streams bigint, unique_customers bigint, total_views bigint"
)
COLUMNS = ("series", "date", "revenue", "purchases", "unique_streams", "unique_customers", "total_views")


def read_series_csv(spark: SparkSession, overall_path: str, countries_path: str) -> DataFrame:
    """The overall file and the per-country file as one long table keyed by ``series``."""
    overall = spark.read.csv(overall_path, schema=SERIES_SCHEMA, header=True, enforceSchema=False)
    countries = spark.read.csv(countries_path, schema=f"{SERIES_SCHEMA}, country string", header=True, enforceSchema=False)
    return overall.withColumn("series", F.lit(OVERALL)).select(*COLUMNS).union(
        countries.withColumnRenamed("country", "series").select(*COLUMNS)
    )


def read_series_table(spark: SparkSession, path: str) -> DataFrame:
    """A series table written by ``write_daily_series``; a filter on ``series`` prunes folders."""
    return spark.read.schema(f"{SERIES_SCHEMA}, series string").parquet(path).select(*COLUMNS)
