"""Window and day queries over a batch of trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.functions.clock import flat_window
from hackney.operators.daily import day_report, day_totals, totals_by_day
from hackney.operators.windows import community_hot_spots, fare_totals, location_hot_spots
from hackney.plans.fixtures import QUARTERS, TRIPS, batch_trips, in_quarters, sql_bucket, sql_sliding
from hackney.plans.registry import plan

DAY = "2024-01-15"


def sql_fares(size: str = "5 seconds", scale: int = 0, by: str = "", source: str = "trips") -> str:
    keys = f"{by}, " if by else ""
    return f"""
SELECT {keys}{sql_bucket(size)} AS window_start,
       {sql_bucket(size)} + INTERVAL '{size}' AS window_end,
       round(cast(sum(fare) AS double), {scale}) AS total_fare,
       round(cast(sum(tips) AS double), {scale}) AS tips_fare,
       round(cast(sum(trip_total) AS double), {scale}) AS total_trip_total
FROM {source}
GROUP BY ALL
"""


@plan(f"WITH trips AS ({TRIPS}) {sql_fares()}")
def fare_totals_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_window(fare_totals(batch_trips(spark, sf_dir), exact=True))


@plan(f"WITH trips AS ({TRIPS}) {sql_fares(scale=2)}")
def fare_totals_scale2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_window(fare_totals(batch_trips(spark, sf_dir), scale=2, exact=True))


@plan(f"WITH trips AS ({TRIPS}) {sql_fares('1 hour', 2, 'payment_type AS tenant_id')}")
def fare_totals_by_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = batch_trips(spark, sf_dir).withColumnRenamed("payment_type", "tenant_id")
    return flat_window(fare_totals(trips, size="1 hour", scale=2, by=["tenant_id"], exact=True))


@plan(
    f"""
WITH trips AS ({TRIPS})
SELECT count(*) AS trips_total,
       round(cast(sum(fare) AS double), 0) AS fare_total,
       round(cast(sum(tips) AS double) / count(tips), 0) AS tips_avg,
       round(cast(sum(trip_total) AS double) / count(trip_total), 0) AS trip_total_avg
FROM trips
WHERE event_timestamp > TIMESTAMP '{DAY} 00:00:00' AND event_timestamp < TIMESTAMP '{DAY} 00:00:00' + INTERVAL '1 day'
""",
    name="day_totals",
)
def day_totals_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_totals(batch_trips(spark, sf_dir), as_of=DAY, exact=True)


@plan(
    f"""
WITH trips AS ({TRIPS}), quarters AS ({QUARTERS}),
     last AS (SELECT date_trunc('day', max(event_timestamp)) AS day FROM trips)
SELECT count(*) AS trips_total, round(sum(fare), 0) AS fare_total, round(sum(tips) / count(tips), 0) AS tips_avg,
       round(sum(trip_total) / count(trip_total), 0) AS trip_total_avg
FROM quarters, last
WHERE event_timestamp > day AND event_timestamp < day + INTERVAL '1 day'
"""
)
def day_totals_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the present day, with plain sums and means, over trips moved so that their last day is today."""
    trips = in_quarters(batch_trips(spark, sf_dir))
    last = trips.agg(F.to_date(F.max("event_timestamp"))).first()[0]
    behind = F.date_diff(F.current_date(), F.lit(last))
    return day_totals(trips.withColumn("event_timestamp", F.col("event_timestamp") + F.make_dt_interval(behind)))


@plan(
    f"""
WITH trips AS ({TRIPS})
SELECT payment_type AS tenant_id,
       count(*) AS trips_total,
       cast(sum(fare) AS double) AS fare_total,
       cast(sum(tips) AS double) / count(tips) AS tips_avg,
       cast(sum(trip_total) AS double) / count(trip_total) AS trip_total_avg
FROM trips
WHERE event_timestamp >= TIMESTAMP '{DAY} 00:00:00' AND event_timestamp < TIMESTAMP '{DAY} 00:00:00' + INTERVAL '1 day'
GROUP BY ALL
"""
)
def day_totals_by_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = batch_trips(spark, sf_dir).withColumnRenamed("payment_type", "tenant_id")
    return day_totals(trips, as_of=DAY, scale=None, by=["tenant_id"], exact=True, inclusive_start=True)


SQL_BY_DAY = f"""
WITH trips AS ({TRIPS})
SELECT cast(event_timestamp AS date) AS day,
       count(*) AS trips_total,
       cast(sum(fare) AS double) AS fare_total,
       cast(sum(tips) AS double) / count(tips) AS tips_avg,
       cast(sum(trip_total) AS double) / count(trip_total) AS trip_total_avg
FROM trips
GROUP BY ALL
"""


@plan(SQL_BY_DAY, name="totals_by_day")
def totals_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_report(totals_by_day(batch_trips(spark, sf_dir)), scale=None)


@plan(f"WITH trips AS ({TRIPS}) {sql_sliding('pickup_community_area', 'pickup_community_area IS NOT NULL')}")
def hot_spots_community(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_window(community_hot_spots(batch_trips(spark, sf_dir)))


@plan(f"WITH trips AS ({TRIPS}) {sql_sliding('pickup_centroid_location')}")
def hot_spots_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_window(location_hot_spots(batch_trips(spark, sf_dir)))


@plan(
    f"""
WITH trips AS ({TRIPS}),
     spots AS ({sql_sliding('payment_type AS tenant_id, pickup_community_area', 'pickup_community_area IS NOT NULL')})
SELECT tenant_id, window_start, window_end, pickup_community_area, "count" FROM spots
"""
)
def hot_spots_by_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = batch_trips(spark, sf_dir).withColumnRenamed("payment_type", "tenant_id")
    return flat_window(community_hot_spots(trips, by=["tenant_id"]))
