"""Trip files, and the folders tenants put them in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.schemas import TRIP_FILE_COLUMNS

RAW_TRIP = T.StructType([T.StructField(name, T.StringType()) for name in TRIP_FILE_COLUMNS])


def tenant_of(path: str) -> Column:
    """The folder above ``in`` in ``…/<tenant>/in/<file>``."""
    return F.split_part(F.col(path), F.lit("/"), F.lit(-3))


def read_trip_files(
    spark: SparkSession,
    path: str | list[str],
    stream: bool = False,
    files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """Cells of trip files as text. The header row is skipped, columns go by position.

    Quoted line breaks are off, so that Spark can split large files. A stream takes new files as
    they arrive, ``files_per_trigger`` of them at a time.
    """
    reader = spark.readStream if stream else spark.read
    if files_per_trigger:
        options["maxFilesPerTrigger"] = files_per_trigger
    return reader.schema(RAW_TRIP).options(header=True, enforceSchema=True, escape='"', **options).csv(path)


def read_landing(spark: SparkSession, root: str, stream: bool = False, **options) -> DataFrame:
    """Trip files below ``root/<tenant>/in`` with the ``tenant_id`` they belong to."""
    raw = read_trip_files(spark, f"{root}/*/in", stream=stream, **options)
    return raw.withColumn("tenant_id", tenant_of("_metadata.file_path"))


def list_landing(spark: SparkSession, root: str, tenant: str = "*") -> DataFrame:
    """Files of one tenant or of all of them; their content is not read."""
    found = spark.read.format("binaryFile").load(f"{root}/{tenant}/in")
    return found.select(
        tenant_of("path").alias("tenant_id"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )
