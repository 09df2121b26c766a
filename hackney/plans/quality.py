"""Checks, duplicates, throughput and health over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.functions.clock import flat_window
from hackney.operators.compat import compatibility, field_types, merge_types, merged_class
from hackney.operators.metrics import error_rate, input_health, throughput
from hackney.operators.quality import dedupe, drift_report, drop_outliers, preprocess, quarantined, valid, validate
from hackney.operators.windows import COMMUNITY
from hackney.plans.fixtures import TRIPS, batch_trips, faulty_wire, finish, stream_trips, table, table_stream
from hackney.plans.registry import plan
from hackney.schemas import DOUBLE, TEXT, TIME, narrow, schema_of
from hackney.session import scratch
from hackney.streaming.sinks import file_sink

FIELDS = narrow(["trip_id", "fare", "pickup_community_area", "event_timestamp"])


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return faulty_wire(table(spark, sf_dir, "events"))


@plan(
    """
SELECT cast(event_id AS varchar) AS "key",
       CASE event_type WHEN 'signup' THEN 'wrong type:pickup_community_area' ELSE 'unreadable' END AS reasons,
       CASE event_type WHEN 'view' THEN '{"x":"' || cast(event_id AS varchar) || '"}'
                       WHEN 'error' THEN '{"trip_id":"' || cast(event_id AS varchar) || '", fare' END AS value
FROM events
WHERE event_type IN ('signup', 'view', 'error')
""",
    name="validate_quarantine",
)
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = quarantined(validate(_records(spark, sf_dir), FIELDS, keep=("key", "topic")), "key", "topic")
    # The text of a signup holds a number written by Spark; it is left out of the comparison.
    text = F.when(F.col("topic") != "signup", F.col("value"))
    return bad.select("key", F.array_join("reasons", ",").alias("reasons"), text.alias("value"))


@plan(
    """
SELECT cast(event_id AS varchar) AS trip_id, value AS fare, ts AS event_timestamp,
       CASE WHEN event_type = 'click' THEN cast(json_extract(props, '$.k') AS varchar) END AS pickup_community_area
FROM events
WHERE event_type IN ('click', 'purchase')
"""
)
def valid_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = valid(validate(_records(spark, sf_dir), FIELDS, keep=()))
    return good.select(
        "trip_id",
        "fare",
        F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
        F.col("pickup_community_area").cast("string").alias("pickup_community_area"),
    )


@plan(
    """
WITH sound AS (SELECT * FROM events WHERE event_type IN ('click', 'purchase', 'signup'))
SELECT field, count(*) AS present, 0 AS unusable, field IN ('trip_id', 'fare', 'event_timestamp') AS declared
FROM sound, (VALUES ('trip_id'), ('fare'), ('event_timestamp'), ('taxi_id'), ('tips'), ('trip_total'),
                    ('payment_type'), ('pickup_centroid_location')) names(field)
GROUP BY field
UNION ALL
SELECT 'pickup_community_area', count(*) FILTER (event_type <> 'purchase'),
       count(*) FILTER (event_type = 'signup'), TRUE
FROM sound
UNION ALL
SELECT 'x', count(*), 0, FALSE FROM events WHERE event_type = 'view'
"""
)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift_report(_records(spark, sf_dir), FIELDS)


def _redelivered(trips: DataFrame) -> DataFrame:
    """Every trip arrives once; purchases arrive three times."""
    again = trips.filter(F.col("payment_type") == "purchase")
    return trips.unionByName(again).unionByName(again)


SQL_TRIPS = f"""
WITH trips AS ({TRIPS})
SELECT trip_id, taxi_id, cast(fare AS double) AS fare, payment_type, pickup_centroid_location, event_timestamp
FROM trips
"""
UNIQUE = ["trip_id", "taxi_id", "fare", "payment_type", "pickup_centroid_location", "event_timestamp"]


@plan(SQL_TRIPS)
def dedupe_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(_redelivered(batch_trips(spark, sf_dir))).select(*UNIQUE)


@plan(
    """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_shipdate
FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey
  ORDER BY l_shipdate, l_linenumber, l_suppkey, l_partkey) = 1
"""
)
def dedupe_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies that differ: the earliest one stays."""
    columns = ["l_orderkey", "l_shipdate", "l_linenumber", "l_suppkey", "l_partkey"]
    items = table(spark, sf_dir, "lineitem").select(*columns)
    return dedupe(items, key=["l_orderkey"], event_time="l_shipdate")


@plan(SQL_TRIPS)
def stream_dedupe_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "unique")
    finish(
        dedupe(_redelivered(stream_trips(spark, sf_dir))),
        name="dedupe",
        mode="append",
        sink=file_sink(path),
    )
    unique = spark.read.parquet(path).select(*UNIQUE)
    return unique.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def _noisy(trips: DataFrame) -> DataFrame:
    """Errors have negative fares, signups no tips, views NaN for tips, and purchases no time."""
    kind = F.col("payment_type")
    return trips.withColumns(
        {
            "fare": F.when(kind == "error", -F.col("fare")).otherwise(F.col("fare")),
            "tips": F.when(kind == "view", float("nan")).when(kind != "signup", F.col("tips")),
            "event_timestamp": F.when(kind != "purchase", F.col("event_timestamp")),
        }
    )


@plan(
    f"""
WITH trips AS ({TRIPS})
SELECT trip_id, cast(fare AS double) AS fare,
       CASE WHEN payment_type IN ('signup', 'view') THEN 0 ELSE cast(tips AS double) END AS tips,
       event_timestamp
FROM trips
WHERE payment_type <> 'purchase' AND (payment_type <> 'error' OR fare <= 0)
""",
    name="preprocess",
)
def preprocess_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = preprocess(_noisy(batch_trips(spark, sf_dir)), fill={"tips": 0.0})
    return ready.select("trip_id", "fare", "tips", "event_timestamp")


#: Every so many trips have amounts a thousand times too high.
ODD = 50


def sql_levels(source: str) -> str:
    """Numbers ``v`` of ``source`` cut to eight binary digits, as ``low``."""
    return f"SELECT * EXCLUDE (cut), (v >> cut) << cut AS low FROM (SELECT *, greatest(length(bin(v)) - 8, 0) AS cut FROM {source})"


@plan(
    f"""
WITH trips AS ({TRIPS}),
     noisy AS (SELECT *, CASE WHEN cast(trip_id AS bigint) % {ODD} = 0 THEN 1000 ELSE 1 END AS times FROM trips),
     amounts AS (SELECT trip_id, payment_type, pickup_community_area AS area, cast(fare * 100 AS bigint) * times AS fare,
                        cast(trip_total * 100 AS bigint) * times AS trip_total FROM noisy),
     each AS (SELECT area, 'fare' AS m, fare AS v FROM amounts UNION ALL SELECT area, 'trip_total', trip_total FROM amounts),
     counted AS (SELECT area, m, low, count(*) AS n FROM ({sql_levels('each')}) GROUP BY ALL),
     running AS (SELECT *, sum(n) OVER (PARTITION BY area, m ORDER BY low) AS up_to, sum(n) OVER (PARTITION BY area, m) AS every
                 FROM counted),
     quarters AS (SELECT area, m, min(low) FILTER (up_to >= ceil(every * 0.25)) AS q1,
                         min(low) FILTER (up_to >= ceil(every * 0.75)) AS q3 FROM running GROUP BY ALL),
     fences AS (SELECT area, m, q1 - 3 * greatest(q3 - q1, 100, (q3 >> 7) + 1) AS lo,
                      q3 + 3 * greatest(q3 - q1, 100, (q3 >> 7) + 1) AS hi FROM quarters)
SELECT trip_id, payment_type FROM amounts a
WHERE NOT EXISTS (
  SELECT 1 FROM fences f WHERE f.area IS NOT DISTINCT FROM a.area
  AND CASE m WHEN 'fare' THEN fare ELSE trip_total END NOT BETWEEN lo AND hi)
"""
)
def outliers_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips within the fences of their area; areas' fences come from their own trips."""
    times = F.when(F.col("trip_id").cast("bigint") % ODD == 0, 1000).otherwise(1)
    trips = batch_trips(spark, sf_dir)
    noisy = trips.withColumns({name: F.col(name) * times for name in ("fare", "trip_total")})
    return drop_outliers(noisy, [COMMUNITY]).select("trip_id", "payment_type")


SQL_FOUND = """
found AS (
  SELECT field, count(*) AS present, 'text' AS found
  FROM events, (VALUES ('trip_id'), ('taxi_id'), ('payment_type'), ('pickup_centroid_location')) names(field)
  WHERE event_type IN ('click', 'purchase', 'signup') GROUP BY field
  UNION ALL
  SELECT field, count(*), 'number' FROM events, (VALUES ('fare'), ('tips'), ('trip_total')) names(field)
  WHERE event_type IN ('click', 'purchase', 'signup') GROUP BY field
  UNION ALL
  SELECT 'event_timestamp', count(*), 'time' FROM events WHERE event_type IN ('click', 'purchase', 'signup') HAVING count(*) > 0
  UNION ALL
  SELECT 'pickup_community_area', count(*), CASE WHEN count(*) FILTER (event_type = 'signup') > 0 THEN 'number' ELSE 'small whole' END
  FROM events WHERE event_type IN ('click', 'signup') HAVING count(*) > 0
  UNION ALL
  SELECT 'x', count(*), 'text' FROM events WHERE event_type = 'view' HAVING count(*) > 0
)
"""


@plan(f"WITH {SQL_FOUND} SELECT * FROM found")
def record_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the fields of all records hold, from the reports of two halves."""
    records = _records(spark, sf_dir)
    halves = [field_types(records.filter(F.pmod(F.xxhash64("key"), F.lit(2)) == n)) for n in (0, 1)]
    types = merge_types(halves[0].unionByName(halves[1]))
    return types.select("field", "present", merged_class(F.col("mask")).alias("found"))


#: Two versions of the schema: what the second adds, and what it takes for more or less than the first.
VERSIONS = {
    "1": schema_of(trip_id=TEXT, fare=DOUBLE, pickup_community_area=T.IntegerType(), event_timestamp=TIME, company=TEXT),
    "2": schema_of(trip_id=T.LongType(), fare=TEXT, tips=DOUBLE, pickup_community_area=DOUBLE, event_timestamp=TEXT),
}


@plan(
    f"""
WITH {SQL_FOUND},
     declared(version, field, declared) AS (VALUES
       ('1', 'trip_id', 'text'), ('1', 'fare', 'number'), ('1', 'pickup_community_area', 'small whole'),
       ('1', 'event_timestamp', 'time'), ('1', 'company', 'text'),
       ('2', 'trip_id', 'whole'), ('2', 'fare', 'text'), ('2', 'tips', 'number'), ('2', 'pickup_community_area', 'number'),
       ('2', 'event_timestamp', 'text')),
     able(held, holder) AS (VALUES
       ('text', 'text'), ('number', 'number'), ('number', 'text'), ('small whole', 'small whole'), ('small whole', 'whole'),
       ('small whole', 'number'), ('small whole', 'text'), ('whole', 'whole'), ('whole', 'number'), ('whole', 'text'),
       ('time', 'time'), ('time', 'text')),
     wanted AS (SELECT version, field, found FROM found, (VALUES ('1'), ('2')) versions(version)),
     paired AS (SELECT coalesce(w.version, d.version) AS version, coalesce(w.field, d.field) AS field, declared, found
              FROM wanted w FULL JOIN declared d ON w.version = d.version AND w.field = d.field),
     checked AS (SELECT *, EXISTS (SELECT 1 FROM able WHERE held = found AND holder = declared) AS down,
                        EXISTS (SELECT 1 FROM able WHERE held = declared AND holder = found) AS up FROM paired)
SELECT version, field, declared, found,
       CASE WHEN declared IS NULL THEN 'added' WHEN found IS NULL THEN 'lost' WHEN declared = found THEN 'same'
            WHEN down THEN 'narrowed' ELSE 'widened' END AS status,
       declared IS NULL OR found IS NULL OR down AS old_reads_new, declared IS NULL OR (found IS NOT NULL AND up) AS new_reads_old
FROM checked
"""
)
def record_compatibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records against two declared versions, in both directions."""
    return compatibility(field_types(_records(spark, sf_dir)), VERSIONS)


SQL_HOUR = "time_bucket(INTERVAL '1 hour', ts)"


@plan(
    f"""
SELECT {SQL_HOUR} AS window_start, {SQL_HOUR} + INTERVAL '1 hour' AS window_end, event_type AS topic,
       count(*) AS messages, cast(sum(strlen(props)) AS bigint) AS bytes
FROM events
GROUP BY ALL
""",
    name="throughput",
)
def topic_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    records = events.select(
        F.col("event_type").alias("topic"), F.col("props").cast("binary").alias("value"), F.col("ts").alias("timestamp")
    )
    return flat_window(throughput(records))


@plan(
    f"""
SELECT {SQL_HOUR} AS window_start, {SQL_HOUR} + INTERVAL '1 hour' AS window_end,
       count(*) AS records, count(*) FILTER (event_type IN ('view', 'error')) AS malformed,
       cast(count(*) FILTER (event_type IN ('view', 'error')) AS double) / count(*) AS error_rate
FROM events
GROUP BY ALL
""",
    name="error_rate",
)
def record_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_window(error_rate(_records(spark, sf_dir)))


@plan(
    """
SELECT event_type AS topic, count(*) AS records,
       count(*) FILTER (event_type NOT IN ('view', 'error')) AS valid,
       count(*) FILTER (event_type IN ('view', 'error')) AS unusable,
       event_type IN ('view', 'error') AS silent
FROM events
GROUP BY event_type
""",
    name="input_health",
)
def health_of_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return input_health(_records(spark, sf_dir), by=["topic"])


@plan(
    """
SELECT event_type AS topic, count(*) AS records,
       count(*) FILTER (event_type NOT IN ('view', 'error')) AS valid
FROM events
GROUP BY event_type
"""
)
def stream_valid_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream writes every checked record, split by whether it is valid; counted from the store."""
    path = scratch(spark, "checked")
    records = faulty_wire(table_stream(spark, sf_dir, "events"))
    checked = validate(records, FIELDS, keep=("topic",)).withColumn("is_valid", F.size("reasons") == 0)
    finish(
        checked.withColumn("usable", F.col("event_timestamp").isNotNull()),
        name="valid_split",
        mode="append",
        sink=file_sink(path, partition_by=["is_valid"]),
    )
    stored = spark.read.parquet(path)
    return stored.groupBy("topic").agg(F.count("*").alias("records"), F.count_if("usable").alias("valid"))
