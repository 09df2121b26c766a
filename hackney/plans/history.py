"""Batch analytics over a long history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.functions.clock import flat_window
from hackney.operators.alerts import Rule, alerts
from hackney.operators.daily import totals_by_day
from hackney.operators.history import (
    accumulated_revenue,
    location_frequency,
    persistent_hot_spots,
    rollup_periods,
    trend,
)
from hackney.operators.quality import preprocess
from hackney.operators.scoring import LinearModel, score, score_batches
from hackney.operators.windows import COMMUNITY, community_hot_spots, fare_totals
from hackney.plans.fixtures import (
    HISTORY,
    TRIPS,
    batch_trips,
    history_trips,
    order_trips,
    sql_sliding,
    table,
)
from hackney.plans.registry import plan
from hackney.plans.windows import sql_fares
from hackney.session import scratch
from hackney.sources.store import read_store
from hackney.streaming.sinks import write_store


def _sql_trend(grain: str) -> str:
    return f"""
WITH trips AS ({HISTORY})
SELECT cast(date_trunc('{grain}', event_timestamp) AS timestamp) AS period,
       count(DISTINCT cast(event_timestamp AS date)) AS days,
       count(*) AS trips,
       cast(sum(fare) AS double) AS fare_total,
       cast(sum(fare) AS double) / count(DISTINCT cast(event_timestamp AS date)) AS fare_per_day,
       cast(sum(fare) AS double) / count(fare) AS fare_per_trip
FROM trips
GROUP BY 1
"""


@plan(_sql_trend("month"))
def trend_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend(totals_by_day(history_trips(spark, sf_dir)), "month")


@plan(_sql_trend("quarter"))
def trend_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend(totals_by_day(history_trips(spark, sf_dir)), "quarter")


@plan(_sql_trend("year"))
def trend_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend(totals_by_day(history_trips(spark, sf_dir)), "year")


def _sql_revenue(grain: str) -> str:
    return f"""
WITH trips AS ({HISTORY})
SELECT cast(date_trunc('{grain}', event_timestamp) AS timestamp) AS period,
       count(*) AS trips_total,
       cast(sum(fare) AS double) AS fare_total,
       cast(sum(tips) AS double) AS tips_total,
       cast(sum(trip_total) AS double) AS revenue,
       cast(sum(tips) AS double) / count(tips) AS tips_avg,
       cast(sum(trip_total) AS double) / count(trip_total) AS trip_total_avg
FROM trips
GROUP BY 1
"""


@plan(_sql_revenue("month"), name="accumulated_revenue")
def accumulated_revenue_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accumulated_revenue(totals_by_day(history_trips(spark, sf_dir)), "month")


@plan(_sql_revenue("year"))
def accumulated_revenue_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accumulated_revenue(totals_by_day(history_trips(spark, sf_dir)), "year")


@plan(
    """
WITH trips AS (SELECT o_orderdate AS day, cast(o_totalprice AS decimal(18,2)) AS fare FROM orders)
SELECT coalesce(cast(year(day) AS varchar), 'all') AS "year",
       coalesce(cast(quarter(day) AS varchar), 'all') AS "quarter",
       coalesce(cast(month(day) AS varchar), 'all') AS "month",
       count(*) AS trips_total,
       cast(sum(fare) AS double) AS fare_total,
       cast(sum(fare) AS double) AS revenue
FROM trips
GROUP BY ROLLUP (year(day), quarter(day), month(day))
""",
    name="rollup_periods",
)
def rollup_of_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = rollup_periods(totals_by_day(order_trips(table(spark, sf_dir, "orders"))))
    names = ("year", "quarter", "month")
    return levels.withColumns({name: F.coalesce(F.col(name).cast("string"), F.lit("all")) for name in names})


@plan(
    f"""
WITH trips AS ({TRIPS}),
     spots AS ({sql_sliding('pickup_community_area', 'pickup_community_area IS NOT NULL')})
SELECT pickup_community_area,
       count(*) AS windows,
       cast(sum("count") AS bigint) AS window_pickups,
       max("count") AS peak,
       cast(sum("count") AS double) / count(*) AS mean_per_window
FROM spots
GROUP BY pickup_community_area
""",
    name="persistent_hot_spots",
)
def persistent_community_hot_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return persistent_hot_spots(community_hot_spots(batch_trips(spark, sf_dir)), COMMUNITY)


@plan(
    f"""
WITH trips AS ({TRIPS})
SELECT pickup_centroid_location, count(*) AS pickups FROM trips GROUP BY pickup_centroid_location
""",
    name="location_frequency",
)
def pickup_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return location_frequency(batch_trips(spark, sf_dir))


@plan(
    f"""
WITH trips AS ({HISTORY})
SELECT cast(event_timestamp AS date) AS day, pickup_centroid_location, cast(fare AS double) AS fare
FROM trips
WHERE event_timestamp >= TIMESTAMP '1997-01-01 00:00:00' AND event_timestamp < TIMESTAMP '1998-01-01 00:00:00'
"""
)
def store_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "store")
    month = F.date_trunc("month", "event_timestamp").cast("date")
    trips = history_trips(spark, sf_dir).select(
        "pickup_centroid_location", "fare", F.to_date("event_timestamp").alias("day"), month.alias("month")
    )
    write_store(trips, path, partition_by=("month",))
    stored = read_store(spark, path, "1997-01-01", "1997-12-01", day="month")
    return stored.select("day", "pickup_centroid_location", "fare")


SQL_REVENUE_MONTH = _sql_revenue("month")


@plan(SQL_REVENUE_MONTH)
def batch_workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean the trips, store day totals by year, read them back, analyse, store, read the result."""
    daily, report = scratch(spark, "daily"), scratch(spark, "report")
    trips = preprocess(history_trips(spark, sf_dir), required=("event_timestamp",), fill={"tips": 0.0})
    write_store(totals_by_day(trips).withColumn("year", F.year("day")), daily, partition_by=("year",))
    revenue = accumulated_revenue(read_store(spark, daily).drop("year"), "month")
    write_store(revenue, report, partition_by=())
    return read_store(spark, report)


RULES = (
    Rule("fares high", "total_fare", 500.0),
    Rule("fares low", "total_fare", 50.0, below=True),
    Rule("tips high", "tips_fare", 40.0),
)


def _sql_rule(rule: Rule) -> str:
    sign = "<" if rule.below else ">="
    return f"""
SELECT window_start, window_end, '{rule.name}' AS rule, {rule.metric} AS value,
       cast({rule.threshold} AS double) AS threshold
FROM totals WHERE {rule.metric} {sign} {rule.threshold}
"""


SQL_ALERTS = " UNION ALL ".join(_sql_rule(rule) for rule in RULES)


@plan(f"WITH trips AS ({TRIPS}), totals AS ({sql_fares('1 hour', 2)}) {SQL_ALERTS}", name="alerts")
def critical_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = flat_window(fare_totals(batch_trips(spark, sf_dir), size="1 hour", scale=2, exact=True))
    return alerts(totals, RULES, keep=("window_start", "window_end"))


MODEL = LinearModel(intercept=0.5, weights={"fare": 0.25, "tips": 1.5, "trip_total": -0.125})
SQL_SCORED = f"""
WITH trips AS ({TRIPS})
SELECT trip_id,
       ((cast(0.5 AS double) + cast(fare AS double) * cast(0.25 AS double))
         + cast(tips AS double) * cast(1.5 AS double))
         + cast(trip_total AS double) * cast(-0.125 AS double) AS score
FROM trips
"""


@plan(SQL_SCORED)
def score_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_batches(batch_trips(spark, sf_dir), MODEL.predictor(), tuple(MODEL.weights))
    return scored.select("trip_id", "score")


@plan(SQL_SCORED)
def score_trips_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(batch_trips(spark, sf_dir), MODEL).select("trip_id", "score")
