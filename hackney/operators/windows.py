"""Event-time windows: fare totals and pick-up hot spots.

All of them are sums and counts, which Spark combines before the shuffle: a window or a place that
holds a third of all trips arrives as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.functions.amounts import rounded, total
from hackney.functions.clock import EVENT_TIME, watermarked

DELAY = "10 seconds"
COMMUNITY = "pickup_community_area"
LOCATION = "pickup_centroid_location"


def fare_totals(
    trips: DataFrame,
    size: str = "5 seconds",
    scale: int | None = 0,
    by: Sequence[str] = (),
    exact: bool = False,
    delay: str | None = DELAY,
    event_time: str = EVENT_TIME,
) -> DataFrame:
    """Fares, tips and trip totals per tumbling window, and per ``by`` (a tenant, say)."""
    return (
        watermarked(trips, delay, event_time)
        .groupBy(*by, F.window(event_time, size))
        .agg(
            rounded(total("fare", exact), scale).alias("total_fare"),
            rounded(total("tips", exact), scale).alias("tips_fare"),
            rounded(total("trip_total", exact), scale).alias("total_trip_total"),
        )
    )


def hot_spots(
    trips: DataFrame,
    place: str,
    size: str = "1 minute",
    slide: str = "30 seconds",
    drop_null_place: bool = False,
    by: Sequence[str] = (),
    delay: str | None = DELAY,
    event_time: str = EVENT_TIME,
) -> DataFrame:
    """Pick-ups per sliding window and place."""
    if drop_null_place:
        trips = trips.filter(F.col(place).isNotNull())
    return watermarked(trips, delay, event_time).groupBy(*by, F.window(event_time, size, slide), place).count()


def community_hot_spots(trips: DataFrame, **options) -> DataFrame:
    """Pick-ups per community area; trips without an area do not count."""
    return hot_spots(trips, COMMUNITY, **{"drop_null_place": True, **options})


def location_hot_spots(trips: DataFrame, **options) -> DataFrame:
    """Pick-ups per location text; trips without a location form a group of their own."""
    return hot_spots(trips, LOCATION, **options)
