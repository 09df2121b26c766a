"""Totals of a day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.functions.amounts import cents, cents_sum, mean, rounded, total
from hackney.functions.clock import EVENT_TIME, within_day


#: What ``totals_by_day`` keeps of a day.
SUMS = ("trips", "fare_cents", "fare_count", "tips_cents", "tips_count", "trip_total_cents", "trip_total_count")


def trip_totals(trips: DataFrame, scale: int | None = 0, by: Sequence[str] = (), exact: bool = False) -> DataFrame:
    """Number of trips, sum of fares, mean tip and mean total; one row even without trips."""
    return trips.groupBy(*by).agg(
        F.count("*").alias("trips_total"),
        rounded(total("fare", exact), scale).alias("fare_total"),
        rounded(mean("tips", exact), scale).alias("tips_avg"),
        rounded(mean("trip_total", exact), scale).alias("trip_total_avg"),
    )


def day_totals(
    trips: DataFrame,
    as_of: str | dt.date | None = None,
    scale: int | None = 0,
    by: Sequence[str] = (),
    exact: bool = False,
    inclusive_start: bool = False,
    event_time: str = EVENT_TIME,
) -> DataFrame:
    """Totals of one day so far.

    As a stream in ``complete`` mode this has no group per day: a stream that runs past midnight
    keeps adding to the totals of the days before. ``totals_by_day`` starts each day afresh.
    """
    return trip_totals(within_day(trips, as_of, event_time, inclusive_start), scale, by, exact)


def totals_by_day(
    trips: DataFrame,
    by: Sequence[str] = (),
    event_time: str = EVENT_TIME,
) -> DataFrame:
    """Sums and counts per day, from which totals and means over any longer period follow.

    Sums are in cents, as BIGINT. A stream of it keeps one small row per day, so it needs no
    watermark and late trips still reach their day.
    """
    return (
        trips.filter(F.col(event_time).isNotNull())
        .groupBy(*by, F.to_date(event_time).alias("day"))
        .agg(
            F.count("*").alias("trips"),
            cents_sum("fare").alias("fare_cents"),
            F.count(cents("fare")).alias("fare_count"),
            cents_sum("tips").alias("tips_cents"),
            F.count(cents("tips")).alias("tips_count"),
            cents_sum("trip_total").alias("trip_total_cents"),
            F.count(cents("trip_total")).alias("trip_total_count"),
        )
    )


def day_report(daily: DataFrame, scale: int | None = 2) -> DataFrame:
    """``totals_by_day`` in the columns of ``day_totals``."""
    return daily.select(
        *[name for name in daily.columns if name not in SUMS],
        F.col("trips").alias("trips_total"),
        rounded(F.col("fare_cents") / F.lit(100.0), scale).alias("fare_total"),
        rounded(F.col("tips_cents") / F.lit(100.0) / F.col("tips_count"), scale).alias("tips_avg"),
        rounded(F.col("trip_total_cents") / F.lit(100.0) / F.col("trip_total_count"), scale).alias("trip_total_avg"),
    )
