"""The given tables seen as trips, trip files and broker records; in Spark and in SQL.

``events`` are trips of a stream: one event is one trip, its value the fare and a tenth of it the
tip. Trips of type ``error`` have no pick-up area and no location. ``lineitem`` and ``orders`` are
trips of a long history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hackney.operators.ingest import to_wire
from hackney.schemas import TRIP_FILE_COLUMNS, TRIP_TIME_FORMAT
from hackney.session import scratch
from hackney.streaming.run import run_to_end
from hackney.streaming.sinks import Sink, write_records


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream; the pattern matches a single file and a folder of files."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def with_time_zone(df: DataFrame, column: str = "ts") -> DataFrame:
    """Streams need TIMESTAMP for their watermark; the tables hold times without a zone."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def _area() -> Column:
    area = F.get_json_object("props", "$.k").cast("int")
    return F.when(F.col("event_type") != "error", area)


def _location() -> Column:
    point = F.concat(F.lit("POINT (-87."), F.col("user_id").cast("string"), F.lit(" 41.9)"))
    return F.when(F.col("event_type") != "error", point)


def _share(amount: Column, percent: Column) -> tuple[Column, Column]:
    """Share of an amount and their sum; the share is rounded half up to cents."""
    in_cents = F.rint(amount * 100)
    share = F.floor((in_cents * F.rint(percent) + 50) / 100)
    return share / F.lit(100.0), (in_cents + share) / F.lit(100.0)


def event_trips(events: DataFrame) -> DataFrame:
    tips, total = _share(F.col("value"), F.lit(10))
    return events.select(
        F.col("event_id").cast("string").alias("trip_id"),
        F.col("user_id").cast("string").alias("taxi_id"),
        _area().alias("pickup_community_area"),
        F.col("value").alias("fare"),
        tips.alias("tips"),
        total.alias("trip_total"),
        F.col("event_type").alias("payment_type"),
        _location().alias("pickup_centroid_location"),
        F.col("ts").alias("event_timestamp"),
    )


TRIPS = """
SELECT cast(event_id AS varchar) AS trip_id,
       cast(user_id AS varchar) AS taxi_id,
       CASE WHEN event_type <> 'error' THEN cast(json_extract(props, '$.k') AS int) END AS pickup_community_area,
       cast(value AS decimal(18,2)) AS fare,
       round(cast(value AS decimal(18,2)) * cast(0.10 AS decimal(3,2)), 2) AS tips,
       cast(value AS decimal(18,2)) + round(cast(value AS decimal(18,2)) * cast(0.10 AS decimal(3,2)), 2) AS trip_total,
       event_type AS payment_type,
       CASE WHEN event_type <> 'error' THEN 'POINT (-87.' || cast(user_id AS varchar) || ' 41.9)' END
         AS pickup_centroid_location,
       ts AS event_timestamp
FROM events
"""


def batch_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_trips(table(spark, sf_dir, "events"))


def stream_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_trips(with_time_zone(table_stream(spark, sf_dir, "events")))


def lineitem_trips(lineitem: DataFrame) -> DataFrame:
    tips, total = _share(F.col("l_extendedprice"), F.col("l_discount") * 100)
    return lineitem.select(
        F.col("l_extendedprice").alias("fare"),
        tips.alias("tips"),
        total.alias("trip_total"),
        F.col("l_suppkey").cast("int").alias("pickup_community_area"),
        F.concat("l_returnflag", "l_linestatus").alias("pickup_centroid_location"),
        F.col("l_shipdate").alias("event_timestamp"),
    )


HISTORY = """
SELECT cast(l_extendedprice AS decimal(18,2)) AS fare,
       round(cast(l_extendedprice AS decimal(18,2)) * cast(l_discount AS decimal(4,2)), 2) AS tips,
       cast(l_extendedprice AS decimal(18,2))
         + round(cast(l_extendedprice AS decimal(18,2)) * cast(l_discount AS decimal(4,2)), 2) AS trip_total,
       cast(l_suppkey AS int) AS pickup_community_area,
       l_returnflag || l_linestatus AS pickup_centroid_location,
       l_shipdate AS event_timestamp
FROM lineitem
"""


def history_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_trips(table(spark, sf_dir, "lineitem"))


def order_trips(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_totalprice").alias("fare"),
        F.lit(0.0).alias("tips"),
        F.col("o_totalprice").alias("trip_total"),
        F.col("o_orderdate").alias("event_timestamp"),
    )


def in_quarters(trips: DataFrame) -> DataFrame:
    """Amounts in quarters, whose plain sums are exact in doubles, so they do not depend on the order."""
    return trips.withColumns({name: F.floor(F.col(name) * 4) / 4 for name in ("fare", "tips", "trip_total")})


QUARTERS = """
SELECT * REPLACE (floor(cast(fare AS double) * 4) / 4 AS fare, floor(cast(tips AS double) * 4) / 4 AS tips,
                  floor(cast(trip_total AS double) * 4) / 4 AS trip_total)
FROM trips
"""


def event_wire(events: DataFrame, change: Callable[[DataFrame], DataFrame] = lambda trips: trips) -> DataFrame:
    """Good records: the trip as JSON, the event's id as key, its time as the broker's time."""
    timed = with_time_zone(events)
    trips = change(event_trips(timed)).withColumn("timestamp", F.col("event_timestamp"))
    return to_wire(trips, key="trip_id", keep=("timestamp",))


def faulty_wire(events: DataFrame) -> DataFrame:
    """Records as a careless producer sends them; the fault depends on the type of the event.

    click: none. purchase: no area. signup: area written as 7.0. view: other field names.
    error: text that ends in the middle of the record.
    """
    timed = with_time_zone(events)
    trips = event_trips(timed).select(
        "*",
        F.col("event_timestamp").alias("timestamp"),
        F.col("payment_type").alias("topic"),
    )
    kind = F.col("payment_type")
    without = trips.withColumn("pickup_community_area", F.when(kind != "purchase", F.col("pickup_community_area")))
    good = to_wire(without, key="trip_id", keep=("timestamp", "topic"))
    key, text, topic = F.col("key").cast("string"), F.col("value").cast("string"), F.col("topic")
    value = (
        F.when(topic == "signup", F.regexp_replace(text, r'("pickup_community_area":\d+)', "$1.0"))
        .when(topic == "view", F.concat(F.lit('{"x":"'), key, F.lit('"}')))
        .when(topic == "error", F.concat(F.lit('{"trip_id":"'), key, F.lit('", fare')))
        .otherwise(text)
    )
    return good.select(key.alias("key"), value.alias("value"), "timestamp", "topic")


def file_topic(spark: SparkSession, sf_dir: str, path: str) -> str:
    """All events as wire records in files."""
    write_records(event_wire(table(spark, sf_dir, "events")), path)
    return path


def cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def finish(df: DataFrame, name: str, mode: str, sink: Sink, checkpoints: str | None = None) -> StreamingQuery:
    """Run a stream over all there is, with a state partition per core of the cluster."""
    spark = df.sparkSession
    return run_to_end(
        df,
        name=name,
        mode=mode,
        sink=sink,
        checkpoints=checkpoints or scratch(spark, "checkpoints"),
        state_partitions=cores(spark),
    )


def in_thirds(events: DataFrame) -> list[DataFrame]:
    """The events of the first, second and last third of the time they cover."""
    bounds = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    step = (bounds["last"] - bounds["first"]) / 3
    first, second = (F.lit(bounds["first"] + step * n).cast("timestamp_ntz") for n in (1, 2))
    time = F.col("ts")
    spans = (time < first, (time >= first) & (time < second), time >= second)
    return [events.filter(span) for span in spans]


def trip_file_rows(events: DataFrame, *more: Column) -> DataFrame:
    """Events as the 23 text columns of a trip file, and ``more``; the company is blank or N/A for two event types."""
    kind = F.col("event_type")
    value, user = F.col("value"), F.col("user_id")
    start = F.date_format("ts", TRIP_TIME_FORMAT)
    cells = {
        "trip_id": F.col("event_id"),
        "taxi_id": user,
        "trip_start_timestamp": start,
        "trip_end_timestamp": start,
        "trip_seconds": F.get_json_object("props", "$.k"),
        "trip_miles": value,
        "pickup_census_tract": F.lit(17031081500),
        "dropoff_census_tract": F.lit(17031081500),
        "pickup_community_area": F.get_json_object("props", "$.k"),
        "dropoff_community_area": F.get_json_object("props", "$.k"),
        "fare": value,
        "tips": F.lit("0.00"),
        "tolls": F.lit("0.00"),
        "extras": F.lit("0.00"),
        "trip_total": value,
        "payment_type": kind,
        "company": F.when(kind == "error", "").when(kind == "signup", "N/A").otherwise("Cabs, Ltd"),
        "pickup_centroid_latitude": F.lit("41.9"),
        "pickup_centroid_longitude": F.concat(F.lit("-87."), user.cast("string")),
        "pickup_centroid_location": F.concat(F.lit("POINT (-87."), user.cast("string"), F.lit(" 41.9)")),
        "dropoff_centroid_latitude": F.lit("41.9"),
        "dropoff_centroid_longitude": F.lit("-87.6"),
        "dropoff_centroid_location": F.lit("POINT (-87.6 41.9)"),
    }
    return events.select(*[cells[name].cast("string").alias(name) for name in TRIP_FILE_COLUMNS], *more)


# What is left of the trip file after cleaning.
TRIP_FILE = """
SELECT cast(event_id AS varchar) AS trip_id,
       cast(user_id AS varchar) AS taxi_id,
       date_trunc('second', ts) AS trip_start_timestamp,
       cast(json_extract(props, '$.k') AS int) AS trip_seconds,
       cast(json_extract(props, '$.k') AS int) AS pickup_community_area,
       value AS fare,
       event_type AS payment_type,
       'Cabs, Ltd' AS company,
       'POINT (-87.' || cast(user_id AS varchar) || ' 41.9)' AS pickup_centroid_location
FROM events
WHERE event_type NOT IN ('error', 'signup')
"""


def sql_bucket(size: str, column: str = "event_timestamp") -> str:
    return f"time_bucket(INTERVAL '{size}', {column})"


def sql_sliding(place: str, condition: str = "TRUE", source: str = "trips") -> str:
    """Counts per minute-long window every 30 seconds and place, in DuckDB."""
    return f"""
SELECT {sql_bucket('30 seconds')} - step * INTERVAL '30 seconds' AS window_start,
       {sql_bucket('30 seconds')} - step * INTERVAL '30 seconds' + INTERVAL '1 minute' AS window_end,
       {place},
       count(*) AS "count"
FROM {source}, range(2) steps(step)
WHERE {condition}
GROUP BY ALL
"""
