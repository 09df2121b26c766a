"""Event time, days and periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.schemas import EVENT_TIME_FORMAT, TRIP_TIME_FORMAT

EVENT_TIME = "event_timestamp"


def event_text(column: str | Column) -> Column:
    """A time as it goes on the wire: local to the session zone, no offset."""
    return F.date_format(column, EVENT_TIME_FORMAT)


def trip_time(column: str | Column) -> Column:
    """Time of a trip file or record; NULL where the text is neither form."""
    text = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.try_to_timestamp(text, F.lit(TRIP_TIME_FORMAT)), text.try_cast("timestamp"))


def day(as_of: str | dt.date | None = None) -> Column:
    """The given day, or the current one (which a stream renews with every micro-batch)."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def within_day(
    df: DataFrame,
    as_of: str | dt.date | None = None,
    event_time: str = EVENT_TIME,
    inclusive_start: bool = False,
) -> DataFrame:
    """Rows of one day. Midnight itself belongs to no day unless ``inclusive_start`` is set.

    The bounds take the type of the time column, so that a scan gets them as pushed filters.
    """
    kind = df.schema[event_time].dataType
    start, end = day(as_of).cast(kind), F.date_add(day(as_of), 1).cast(kind)
    time = F.col(event_time)
    lower = time >= start if inclusive_start else time > start
    return df.filter(lower & (time < end))


def watermarked(df: DataFrame, delay: str | None, event_time: str = EVENT_TIME) -> DataFrame:
    """A watermark bounds the state of a stream; a batch has no need of it."""
    return df.withWatermark(event_time, delay) if delay and df.isStreaming else df


def flat_window(df: DataFrame, window: str = "window") -> DataFrame:
    """``window`` as two zone-less columns in front, for tables and reports."""
    bounds = [
        F.col(f"{window}.{edge}").cast("timestamp_ntz").alias(f"{window}_{edge}")
        for edge in ("start", "end")
    ]
    return df.select(*bounds, *[name for name in df.columns if name != window])
