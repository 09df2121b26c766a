"""JSON records: parsing, flattening and writing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.functions.clock import trip_time
from hackney.schemas import TRIP, narrow

CORRUPT = "_corrupt_record"


def wire_text(wire: DataFrame) -> DataFrame:
    """Key and value of a broker record as text, with the broker's time."""
    return wire.selectExpr("CAST(key AS STRING)", "CAST(value AS STRING)", "timestamp")


def parse(
    records: DataFrame,
    fields: Iterable[str] | T.StructType | None = None,
    value: str = "value",
    keep: Iterable[str] = ("timestamp",),
    lenient_ints: bool = False,
    trip_times: bool = False,
) -> DataFrame:
    """Read the JSON text in ``value`` into flat columns and carry the ``keep`` columns along.

    A field of the wrong type becomes NULL, a malformed record becomes a row of NULLs.
    ``fields`` (names or a schema) limits the parse to what the query needs.
    ``lenient_ints`` also accepts whole numbers written as 28.0 in integer fields.
    ``trip_times`` also accepts trip start and end in the format of the trip file.

    The parsed struct goes through ``inline``: filters on parsed fields then stay above the parse.
    With a plain projection the optimizer copies them below it and every copy parses again.
    """
    if isinstance(fields, T.StructType):
        schema = fields
    else:
        schema = TRIP if fields is None else narrow(fields)
    ints = [f.name for f in schema if lenient_ints and f.dataType == T.IntegerType()]
    times = [f.name for f in schema if trip_times and f.name in ("trip_start_timestamp", "trip_end_timestamp")]
    read_as = {**dict.fromkeys(ints, T.DoubleType()), **dict.fromkeys(times, T.StringType())}
    wire_schema = T.StructType([T.StructField(f.name, read_as.get(f.name, f.dataType)) for f in schema])

    flat = records.select(*keep, F.inline(F.array(F.from_json(F.col(value).cast("string"), wire_schema))))
    if read_as:
        whole = {name: F.when(F.col(name) == F.rint(name), F.col(name)).try_cast("int") for name in ints}
        flat = flat.withColumns({**whole, **{name: trip_time(name) for name in times}})
    return flat.select(*schema.names, *keep)


def serialise(df: DataFrame, *keep: str) -> DataFrame:
    """Every row as one JSON text ``value``; NULL fields are left out. ``keep`` stays beside it."""
    body = [F.col(name) for name in df.columns if name not in keep]
    return df.select(*keep, F.to_json(F.struct(*body)).alias("value"))
