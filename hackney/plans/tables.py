"""Result tables: declared columns, mapping, versions."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.functions.records import parse, serialise
from hackney.operators.conform import conform, create_table, mapped
from hackney.operators.daily import day_totals
from hackney.operators.windows import community_hot_spots, fare_totals, location_hot_spots
from hackney.plans.fixtures import (
    TRIPS,
    batch_trips,
    event_trips,
    finish,
    sql_sliding,
    stream_trips,
    table,
    with_time_zone,
)
from hackney.plans.registry import plan
from hackney.plans.windows import DAY, sql_fares
from hackney.schemas import (
    ANALYTICS,
    DOUBLE,
    HOTSPOT_COMMUNITY_WINDOW,
    HOTSPOT_WINDOW,
    RESULT_TOPICS,
    SUM_FARE_TOPIC,
    SUM_FARE_WINDOW,
    TRIPS_TOTAL,
    schema_of,
)
from hackney.session import scratch
from hackney.streaming.sinks import emission, read_table, table_sink


@plan(
    f"""
WITH trips AS ({TRIPS})
SELECT trip_id, taxi_id,
       strftime(event_timestamp, '%Y-%m-%d') AS trip_start_timestamp,
       cast(pickup_community_area AS varchar) AS pickup_community_area,
       cast(trunc(fare) AS int) AS fare,
       cast(tips AS float) AS tips,
       cast(trip_total AS float) AS trip_total,
       payment_type, pickup_centroid_location,
       cast(NULL AS varchar) AS company
FROM trips
"""
)
def conform_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = event_trips(with_time_zone(table(spark, sf_dir, "events")))
    rows = conform(trips.withColumn("trip_start_timestamp", F.to_date("event_timestamp")), ANALYTICS)
    return rows.select(
        "trip_id",
        "taxi_id",
        "trip_start_timestamp",
        F.col("pickup_community_area").cast("string"),
        "fare",
        "tips",
        "trip_total",
        "payment_type",
        "pickup_centroid_location",
        "company",
    )


def _sql_window_text(source: str) -> str:
    form = "'%Y-%m-%dT%H:%M:%S.000Z'"
    return (
        f"""'{{"start":"' || strftime(window_start, {form}) || '","end":"' || strftime(window_end, {form}) || '"}}'"""
        f" AS \"window\"{source}"
    )


@plan(
    f"""
WITH trips AS ({TRIPS}), totals AS ({sql_fares('1 hour', 2)})
SELECT {_sql_window_text('')}, cast(total_fare AS float) AS total_fare, cast(tips_fare AS float) AS tips_fare,
       cast(total_trip_total AS float) AS total_trip_total
FROM totals
"""
)
def result_table_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "sumfarewindow")
    totals = fare_totals(stream_trips(spark, sf_dir), size="1 hour", scale=2, exact=True)
    finish(
        totals,
        name="sum_fare_table",
        mode="update",
        sink=table_sink(path, SUM_FARE_WINDOW),
    )
    return read_table(spark, path, SUM_FARE_WINDOW).drop("id")


@plan(
    f"""
WITH trips AS ({TRIPS}),
     spots AS ({sql_sliding('pickup_community_area', 'pickup_community_area IS NOT NULL')})
SELECT {_sql_window_text('')}, cast(pickup_community_area AS varchar) AS pickup_community_area,
       cast("count" AS int) AS "count"
FROM spots
"""
)
def hot_spot_community_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    spots = community_hot_spots(event_trips(with_time_zone(table(spark, sf_dir, "events"))))
    return mapped(spots, HOTSPOT_COMMUNITY_WINDOW).drop("id")


@plan(
    f"""
WITH trips AS ({TRIPS}), spots AS ({sql_sliding('pickup_centroid_location')})
SELECT {_sql_window_text('')}, pickup_centroid_location, cast("count" AS int) AS "count"
FROM spots
"""
)
def hot_spot_location_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    spots = location_hot_spots(event_trips(with_time_zone(table(spark, sf_dir, "events"))))
    return mapped(spots, HOTSPOT_WINDOW).drop("id")


@plan(
    f"""
WITH trips AS ({TRIPS})
SELECT cast(count(*) AS int) AS trips_total,
       cast(round(cast(sum(fare) AS double), 0) AS float) AS fare_total,
       cast(round(cast(sum(tips) AS double) / count(tips), 0) AS float) AS tips_avg,
       cast(round(cast(sum(trip_total) AS double) / count(trip_total), 0) AS float) AS trip_total_avg
FROM trips
WHERE event_timestamp > TIMESTAMP '{DAY} 00:00:00' AND event_timestamp < TIMESTAMP '{DAY} 00:00:00' + INTERVAL '1 day'
"""
)
def trips_total_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result records of a topic, read back and mapped into their table."""
    records = serialise(day_totals(batch_trips(spark, sf_dir), as_of=DAY, exact=True))
    fields = schema_of(trips_total=T.LongType(), fare_total=DOUBLE, tips_avg=DOUBLE, trip_total_avg=DOUBLE)
    return mapped(parse(records, fields, keep=()), TRIPS_TOTAL).drop("id")


@plan(
    f"""
WITH trips AS ({TRIPS}), totals AS ({sql_fares('1 hour', 2)})
SELECT {_sql_window_text('')}, cast(total_fare AS float) AS total_fare, cast(tips_fare AS float) AS tips_fare,
       cast(total_trip_total AS float) AS total_trip_total, cast(3 AS bigint) AS run, cast(7 AS bigint) AS batch_id
FROM totals
"""
)
def declared_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream fills the folder of a table that is declared before; what it holds is asked of the table."""
    path = scratch(spark, "declared")
    table_ = RESULT_TOPICS[SUM_FARE_TOPIC]
    name = create_table(spark, replace(table_, name=f"{table_.name}_{path[-32:]}"), path)
    totals = fare_totals(stream_trips(spark, sf_dir), size="1 hour", scale=2, exact=True)
    finish(emission(totals, 3, 7), name="declared", mode="update", sink=table_sink(path, table_))
    spark.sql(f"REFRESH TABLE {name}")
    return spark.table(name).drop("id")
