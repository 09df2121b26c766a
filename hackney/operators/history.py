"""Longer periods and lasting hot spots, computed from stored day totals and window counts.

Day totals hold a row per day (and tenant), so everything here shuffles a few thousand rows
whatever the number of trips. Means are never averaged again: sums and counts are carried along.
Amounts are whole cents, see ``hackney.functions.amounts``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.operators.daily import SUMS
from hackney.operators.windows import LOCATION

GRAINS = ("month", "quarter", "year")


def _sums() -> list[Column]:
    return [F.try_sum(name).alias(name) for name in SUMS]


def _amount(name: str) -> Column:
    return F.col(name) / F.lit(100.0)


def trend(daily: DataFrame, grain: str = "month", by: Sequence[str] = ()) -> DataFrame:
    """Fare distribution over months, quarters or years: total, and means per day and per trip that has a fare."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    period = F.date_trunc(grain, "day").cast("timestamp_ntz").alias("period")
    return (
        daily.groupBy(*by, period)
        .agg(F.count("*").alias("days"), *_sums())
        .select(
            *by,
            "period",
            "days",
            "trips",
            _amount("fare_cents").alias("fare_total"),
            (_amount("fare_cents") / F.col("days")).alias("fare_per_day"),
            (_amount("fare_cents") / F.col("fare_count")).alias("fare_per_trip"),
        )
    )


def accumulated_revenue(daily: DataFrame, grain: str = "month", by: Sequence[str] = ()) -> DataFrame:
    """Trips, fares, tips and revenue summed per month, quarter or year."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    period = F.date_trunc(grain, "day").cast("timestamp_ntz").alias("period")
    return (
        daily.groupBy(*by, period)
        .agg(*_sums())
        .select(
            *by,
            "period",
            F.col("trips").alias("trips_total"),
            _amount("fare_cents").alias("fare_total"),
            _amount("tips_cents").alias("tips_total"),
            _amount("trip_total_cents").alias("revenue"),
            (_amount("tips_cents") / F.col("tips_count")).alias("tips_avg"),
            (_amount("trip_total_cents") / F.col("trip_total_count")).alias("trip_total_avg"),
        )
    )


def rollup_periods(daily: DataFrame) -> DataFrame:
    """Months, quarters, years and everything at once; NULL marks the levels summed over."""
    calendar = daily.select(
        F.year("day").alias("year"), F.quarter("day").alias("quarter"), F.month("day").alias("month"), "*"
    )
    return (
        calendar.rollup("year", "quarter", "month")
        .agg(*_sums())
        .select(
            "year",
            "quarter",
            "month",
            F.col("trips").alias("trips_total"),
            _amount("fare_cents").alias("fare_total"),
            _amount("trip_total_cents").alias("revenue"),
        )
    )


def persistent_hot_spots(spots: DataFrame, place: str, by: Sequence[str] = ()) -> DataFrame:
    """How often and how strongly a place shows up in stored hot-spot windows.

    Sliding windows overlap, so ``window_pickups`` counts a pick-up once per window it lies in.
    """
    return spots.groupBy(*by, place).agg(
        F.count("*").alias("windows"),
        F.sum("count").alias("window_pickups"),
        F.max("count").alias("peak"),
        (F.sum("count") / F.count("*")).alias("mean_per_window"),
    )


def location_frequency(trips: DataFrame, place: str = LOCATION, by: Sequence[str] = ()) -> DataFrame:
    """Pick-ups per place over the whole history."""
    return trips.groupBy(*by, place).agg(F.count("*").alias("pickups"))
