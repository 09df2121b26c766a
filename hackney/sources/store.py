"""Stored trips and results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_store(
    spark: SparkSession,
    path: str,
    first_day: str | dt.date | None = None,
    last_day: str | dt.date | None = None,
    day: str = "day",
) -> DataFrame:
    """Rows stored by day, of the given days only: the other days' folders are not opened."""
    stored = spark.read.parquet(path)
    if first_day is not None:
        stored = stored.filter(F.col(day) >= F.lit(first_day).cast("date"))
    if last_day is not None:
        stored = stored.filter(F.col(day) <= F.lit(last_day).cast("date"))
    return stored


def hadoop_files(spark: SparkSession, path: str):
    """The file system of a path, and what makes its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make
