"""From the rows of a trip file to records on the wire."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.functions.clock import EVENT_TIME, event_text, trip_time
from hackney.functions.records import serialise
from hackney.schemas import NULL_TOKENS, TRIP, TRIP_FILE_COLUMNS


def blank_to_null(raw: DataFrame, columns: Sequence[str] = TRIP_FILE_COLUMNS) -> DataFrame:
    """Blank cells and the usual texts for "no value" become NULL, for those who keep such rows."""
    tokens = ["", *NULL_TOKENS]
    return raw.withColumns({name: F.when(~F.col(name).isin(tokens), F.col(name)) for name in columns})


def clean(raw: DataFrame, columns: Sequence[str] = TRIP_FILE_COLUMNS) -> DataFrame:
    """Drop rows with any missing cell.

    It looks at the text of the file, so a cell that holds garbage is not missing: it stays and
    becomes a NULL field once it is read as a number.
    """
    tokens = ["", *NULL_TOKENS]
    return raw.filter(reduce(and_, [~F.col(name).isin(tokens) for name in columns]))


def _typed(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.TimestampType):
        return trip_time(field.name).alias(field.name)
    return F.col(field.name).try_cast(field.dataType).alias(field.name)


def typed_trips(raw: DataFrame) -> DataFrame:
    """Cells of a trip file as trip fields; other columns of ``raw`` stay as they are."""
    others = [name for name in raw.columns if name not in TRIP.names]
    return raw.select(*[_typed(TRIP[name]) for name in TRIP_FILE_COLUMNS], *others)


def stamp(df: DataFrame, at: Column | None = None, event_time: str = EVENT_TIME) -> DataFrame:
    """Add the ingest time: one instant for the whole batch or micro-batch."""
    return df.withColumn(event_time, F.current_timestamp() if at is None else at)


def to_wire(trips: DataFrame, key: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Trips as broker records (``key``, ``value``); times go out as local text without a zone.

    ``keep`` columns stay beside the record instead of going into it.
    """
    times = [f.name for f in trips.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    record_key = F.col(key).cast("string") if key else F.lit(None)
    sent = [name for name in trips.columns if name not in keep]
    body = [event_text(name).alias(name) if name in times else F.col(name) for name in sent]
    records = serialise(trips.select(record_key.cast("binary").alias("key"), *keep, *body), "key", *keep)
    return records.withColumn("value", F.col("value").cast("binary"))
