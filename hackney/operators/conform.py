"""Rows in the shape of a declared table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.schemas import Table


def _as_declared(df: DataFrame, name: str, kind: T.DataType) -> Column:
    if name not in df.columns:
        return F.lit(None).cast(kind).alias(name)
    have = df.schema[name].dataType
    if isinstance(kind, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(name).alias(name)
    return F.col(name).try_cast(kind).alias(name)


def conform(df: DataFrame, table: Table) -> DataFrame:
    """The declared columns in their order and type; what is missing or does not fit is NULL."""
    return df.select(*[_as_declared(df, field.name, field.dataType) for field in table.schema])


def create_table(spark: SparkSession, table: Table, location: str, database: str | None = None) -> str:
    """Create the declared table over ``location`` unless it exists; the key goes into its properties."""
    name = f"{database}.{table.name}" if database else table.name
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in table.schema)
    # ``table_sink`` puts every batch into a folder of its own.
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS (recursiveFileLookup 'true') "
        f"LOCATION '{location}' "
        f"TBLPROPERTIES ('key' = '{','.join(table.key)}')"
    )
    return name


def mapped(
    results: DataFrame,
    table: Table,
    mapping: Mapping[str, str] | None = None,
    identity: Column | None = None,
) -> DataFrame:
    """Result rows as rows of ``table``: ``mapping`` gives the result column of each table column.

    Every row gets an ``id`` of its own. By default it is random; pass ``identity`` for one that
    a repeated delivery gives again.
    """
    names = [field.name for field in table.schema if field.name != "id"]
    sources = {name: name for name in names} if mapping is None else mapping
    chosen = results.select(
        (F.uuid() if identity is None else identity).alias("id"),
        *[F.col(sources[name]).alias(name) for name in names if name in sources],
    )
    return conform(chosen, table)


def row_identity(*parts: str) -> Column:
    """A uuid-shaped text that depends on the given columns only."""
    digest = F.sha2(F.to_json(F.struct(*parts)), 256)
    pieces = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws("-", *pieces)


def ascending_identity(second: Column, batch: Column, *parts: Column) -> Column:
    """A uuid-shaped text: a time in seconds, the number of a batch, and 64 bits of the parts.

    Sorted as text, ids are in the order of times and batches, for four billion batches.
    """
    digits = [F.lpad(F.lower(F.hex(number)), 8, "0") for number in (second, batch)]
    text = F.concat(*digits, F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 16))
    pieces = [F.substring(text, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws("-", *pieces)
