"""The standing queries run as streams to the end of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hackney.app import analyse, results_of, store
from hackney.functions.clock import flat_window
from hackney.functions.records import parse
from hackney.operators.alerts import alerts
from hackney.operators.daily import day_report, day_totals, totals_by_day
from hackney.operators.history import persistent_hot_spots
from hackney.operators.metrics import batch_health, error_rate, observed, progress_rows
from hackney.operators.quality import dedupe
from hackney.operators.windows import COMMUNITY, LOCATION, community_hot_spots, fare_totals, location_hot_spots
from hackney.plans.fixtures import (
    QUARTERS,
    TRIPS,
    batch_trips,
    cores,
    event_wire,
    faulty_wire,
    finish,
    in_quarters,
    in_thirds,
    lineitem_trips,
    sql_sliding,
    stream_trips,
    table,
    table_stream,
)
from hackney.plans.registry import plan
from hackney.plans.history import RULES, SQL_ALERTS
from hackney.plans.windows import DAY, SQL_BY_DAY, sql_fares
from hackney.schemas import (
    HOTSPOT_COMMUNITY_TOPIC,
    HOTSPOT_TOPIC,
    INGEST_TOPIC,
    RESULT_KEYS,
    RESULT_TOPICS,
    SUM_FARE_TOPIC,
    TRIPS_TOTAL_TOPIC,
    topic_name,
)
from hackney.session import scratch
from hackney.sources.store import read_store
from hackney.sources.wire import read_wire
from hackney.streaming.progress import ProgressLog
from hackney.streaming.run import ALL_AVAILABLE, MONEY, STANDING, await_all, start_tenant
from hackney.streaming.sinks import (
    BATCH,
    RUN,
    Sink,
    file_sink,
    fold_versions,
    latest,
    read_latest,
    read_table,
    versioned_sink,
    write_records,
    write_store,
)
from hackney.streaming.topics import Folders


def _deliver(
    spark: SparkSession,
    parts: list[DataFrame],
    query: Callable[[DataFrame], DataFrame],
    name: str,
    mode: str,
    path: str | None = None,
) -> DataFrame:
    """Put the parts into a topic one after the other and let the query catch up after each.

    The query ends and starts again from its checkpoint every time. Returns all it has emitted.
    """
    topic, checkpoints = scratch(spark, "topic"), scratch(spark, "checkpoints")
    path = path or scratch(spark, name)
    for part in parts:
        write_records(event_wire(part), topic)
        trips = parse(read_wire(spark, "parquet", path=topic), MONEY, keep=())
        finish(query(trips), name=name, mode=mode, sink=versioned_sink(path), checkpoints=checkpoints)
    return spark.read.parquet(path)


def _hourly(trips: DataFrame) -> DataFrame:
    return fare_totals(trips, size="1 hour", scale=2, exact=True)


@plan(f"WITH trips AS ({TRIPS}) {sql_fares('1 hour', 2)}")
def stream_fare_totals_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third of the time arrives on its own; windows across a border are emitted twice."""
    parts = in_thirds(table(spark, sf_dir, "events"))
    return flat_window(latest(_deliver(spark, parts, _hourly, "fare_totals", "update"), ["window"]))


@plan(
    f"""
WITH trips AS ({TRIPS})
SELECT count(*) AS trips_total,
       round(cast(sum(fare) AS double), 0) AS fare_total,
       round(cast(sum(tips) AS double) / count(tips), 0) AS tips_avg,
       round(cast(sum(trip_total) AS double) / count(trip_total), 0) AS trip_total_avg
FROM trips
WHERE event_timestamp > TIMESTAMP '{DAY} 00:00:00' AND event_timestamp < TIMESTAMP '{DAY} 00:00:00' + INTERVAL '1 day'
"""
)
def stream_day_totals_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each micro-batch writes the whole result again; the last one counts."""

    def totals(trips: DataFrame) -> DataFrame:
        return day_totals(trips, as_of=DAY, exact=True)

    parts = in_thirds(table(spark, sf_dir, "events"))
    return latest(_deliver(spark, parts, totals, "day_totals", "complete"), [])


@plan(SQL_BY_DAY)
def result_table_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of events arrive one after the other, so every day changes each time.

    The table keeps all versions; its reader takes the last one of each day.
    """
    events = table(spark, sf_dir, "events")
    parts = [events.filter("event_type < 'purchase'"), events.filter("event_type >= 'purchase'")]
    return day_report(latest(_deliver(spark, parts, totals_by_day, "days", "update"), ["day"]), scale=None)


@plan(SQL_BY_DAY)
def result_table_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table after its first versions have been folded into one."""
    events = table(spark, sf_dir, "events")
    path, folded = scratch(spark, "days"), scratch(spark, "folded")
    versions = _deliver(spark, in_thirds(events), totals_by_day, "days", "update", path)
    first, second = versions.select(RUN, BATCH).distinct().orderBy(RUN, BATCH).limit(2).collect()
    for last in (first, second):  # the second fold goes on from the first
        fold_versions(spark, path, folded, ["day"], last=tuple(last))
    return day_report(read_latest(spark, path, ["day"], folded), scale=None)


# The watermark is 10 seconds behind the last trip, in whole milliseconds. Trips without an area are
# filtered out below the watermark (the optimizer moves the filter there if it is written above), so
# they do not move it.
PASSED = "date_trunc('milliseconds', max(event_timestamp)) - INTERVAL '10 seconds'"
HAS_AREA = "pickup_community_area IS NOT NULL"


def _sql_closed(place: str, condition: str = "TRUE") -> str:
    """Windows that the watermark has passed."""
    return f"""
WITH trips AS ({TRIPS}), spots AS ({sql_sliding(place, condition)})
SELECT * FROM spots
WHERE window_end <= (SELECT {PASSED} FROM trips WHERE {condition})
"""


def _emitted(spark: SparkSession, spots: DataFrame, name: str) -> DataFrame:
    path = scratch(spark, name)
    finish(spots, name=name, mode="append", sink=file_sink(path))
    return flat_window(spark.read.parquet(path))


@plan(_sql_closed("pickup_community_area", HAS_AREA))
def stream_hot_spots_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _emitted(spark, community_hot_spots(stream_trips(spark, sf_dir)), "hot_spots_community")


@plan(_sql_closed("pickup_centroid_location"))
def stream_hot_spots_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _emitted(spark, location_hot_spots(stream_trips(spark, sf_dir)), "hot_spots_location")


@plan(
    f"""
WITH trips AS ({TRIPS}),
     mark AS (
       SELECT {PASSED} AS passed FROM trips WHERE payment_type <> 'error'),
     counted AS (
       SELECT trips.* FROM trips, mark
       WHERE payment_type <> 'error' OR time_bucket(INTERVAL '1 hour', event_timestamp) + INTERVAL '1 hour' > passed)
{sql_fares('1 hour', 2, source='counted')}
"""
)
def stream_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of type error arrive after all others: only those of windows still open count."""
    events = table(spark, sf_dir, "events")
    parts = [events.filter("event_type <> 'error'"), events.filter("event_type = 'error'")]
    return flat_window(latest(_deliver(spark, parts, _hourly, "late", "update"), ["window"]))


@plan(f"WITH trips AS ({TRIPS}) {sql_fares('1 hour', 2, 'payment_type AS tenant_id')}")
def stream_tenants_in_one_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenants (here: types of event) share one query; the tenant leads the key of its state."""
    trips = stream_trips(spark, sf_dir).withColumnRenamed("payment_type", "tenant_id")
    path = scratch(spark, "fares")
    finish(
        fare_totals(trips, size="1 hour", scale=2, by=["tenant_id"], exact=True),
        name="all_tenants",
        mode="update",
        sink=versioned_sink(path),
    )
    return flat_window(latest(spark.read.parquet(path), ["tenant_id", "window"]))


@plan(
    f"""
WITH trips AS ({TRIPS}), totals AS ({sql_fares('1 hour', 2)}), alerts AS ({SQL_ALERTS})
SELECT * FROM alerts WHERE window_end <= (SELECT {PASSED} FROM trips)
"""
)
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of closed windows, each raised once."""
    path = scratch(spark, "alerts")
    finish(
        alerts(_hourly(stream_trips(spark, sf_dir)), RULES, keep=["window"]),
        name="alerts",
        mode="append",
        sink=file_sink(path),
    )
    return flat_window(spark.read.parquet(path))


@plan(
    f"""
WITH trips AS ({TRIPS}), spots AS ({sql_sliding('pickup_community_area', HAS_AREA)}),
     closed AS (SELECT * FROM spots WHERE window_end <= (SELECT {PASSED} FROM trips WHERE {HAS_AREA}))
SELECT pickup_community_area, count(*) AS windows, cast(sum("count") AS bigint) AS window_pickups,
       max("count") AS peak, cast(sum("count") AS double) / count(*) AS mean_per_window
FROM closed
GROUP BY pickup_community_area
"""
)
def persistent_hot_spots_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot-spot windows that a stream has stored by day, analysed as a batch."""
    path = scratch(spark, "spots")
    spots = community_hot_spots(stream_trips(spark, sf_dir)).withColumn("day", F.to_date("window.start"))
    finish(
        spots,
        name="stored_spots",
        mode="append",
        sink=file_sink(path, partition_by=["day"]),
    )
    return persistent_hot_spots(read_store(spark, path), COMMUNITY)


@plan(f"WITH trips AS (SELECT * FROM ({TRIPS}) WHERE payment_type <> 'error') {sql_fares('1 hour', 2)}")
def stream_null_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of type error have no event time and are in no window."""
    time = F.when(F.col("payment_type") != "error", F.col("event_timestamp"))
    trips = stream_trips(spark, sf_dir).withColumn("event_timestamp", time)
    path = scratch(spark, "fares")
    finish(
        _hourly(trips),
        name="null_time",
        mode="update",
        sink=versioned_sink(path),
    )
    return flat_window(spark.read.parquet(path).drop(RUN, BATCH))


SQL_DAYS = """
SELECT strftime(event_timestamp, '%Y-%m-%d') AS day, count(*) AS trips_total, round(sum(fare), 0) AS fare_total,
       round(sum(tips) / count(tips), 0) AS tips_avg, round(sum(trip_total) / count(trip_total), 0) AS trip_total_avg
FROM quarters
GROUP BY 1
"""


def sql_standing() -> str:
    """All results of the four standing queries over amounts in quarters."""
    areas, places = sql_sliding("pickup_community_area", HAS_AREA), sql_sliding("pickup_centroid_location")
    return f"""
WITH trips AS ({TRIPS}), quarters AS ({QUARTERS}),
     fares AS (SELECT time_bucket(INTERVAL '5 seconds', event_timestamp) AS w, round(sum(fare), 0) AS a,
                      round(sum(tips), 0) AS b, round(sum(trip_total), 0) AS c FROM quarters GROUP BY 1),
     days AS ({SQL_DAYS}), community AS ({areas}), places AS ({places})
SELECT '{SUM_FARE_TOPIC}' AS query, strftime(w, '%Y-%m-%d %H:%M:%S') AS at, cast(NULL AS varchar) AS place,
       cast(NULL AS bigint) AS n, a, b, c FROM fares
UNION ALL SELECT '{TRIPS_TOTAL_TOPIC}', day, NULL, trips_total, fare_total, tips_avg, trip_total_avg FROM days
UNION ALL SELECT '{HOTSPOT_COMMUNITY_TOPIC}', strftime(window_start, '%Y-%m-%d %H:%M:%S'),
       cast(pickup_community_area AS varchar), "count", NULL, NULL, NULL FROM community
  WHERE window_end <= (SELECT {PASSED} FROM trips WHERE {HAS_AREA})
UNION ALL SELECT '{HOTSPOT_TOPIC}', strftime(window_start, '%Y-%m-%d %H:%M:%S'), pickup_centroid_location, "count",
       NULL, NULL, NULL FROM places WHERE window_end <= (SELECT {PASSED} FROM trips)
"""


def standing(topic: str, results: DataFrame, at: Column) -> DataFrame:
    """Results of a standing query in the columns of ``sql_standing``."""
    names = {
        SUM_FARE_TOPIC: (None, None, "total_fare", "tips_fare", "total_trip_total"),
        TRIPS_TOTAL_TOPIC: (None, "trips_total", "fare_total", "tips_avg", "trip_total_avg"),
        HOTSPOT_COMMUNITY_TOPIC: (COMMUNITY, "count", None, None, None),
        HOTSPOT_TOPIC: (LOCATION, "count", None, None, None),
    }[topic]
    kinds = ("string", "bigint", "double", "double", "double")
    values = [F.lit(None) if name is None else F.col(name) for name in names]
    columns = [v.cast(kind).alias(as_) for v, kind, as_ in zip(values, kinds, ("place", "n", "a", "b", "c"))]
    return results.select(F.lit(topic).alias("query"), at.alias("at"), *columns)


@plan(sql_standing())
def stream_tenant_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standing queries of a tenant at once, with plain sums, and all results each has written."""
    root, trips = scratch(spark, "results"), in_quarters(stream_trips(spark, sf_dir))

    def sink(topic: str) -> Sink:
        return versioned_sink(f"{root}/{topic}")

    options = {"trigger": ALL_AVAILABLE, "state_partitions": cores(spark)}
    await_all(start_tenant(lambda fields: trips, "acme", sink, scratch(spark, "checkpoints"), **options))

    def results(topic: str) -> DataFrame:
        rows = read_latest(spark, f"{root}/{topic_name('acme', topic)}", RESULT_KEYS[topic])
        start = F.date_format("window.start", "yyyy-MM-dd HH:mm:ss")
        return standing(topic, rows, F.col("day").cast("string") if "day" in rows.columns else start)

    return reduce(DataFrame.unionByName, [results(topic) for topic in STANDING])


@plan(
    """
SELECT 'complete' AS mode, count(*) AS emitted, cast(sum(n) AS bigint) AS trips, cast(NULL AS double) AS fare_total
FROM (SELECT 0 AS n FROM (SELECT count(*) AS c FROM events WHERE event_type IN ('view', 'error')) WHERE c > 0)
UNION ALL SELECT 'update', 0, NULL, NULL FROM (SELECT count(*) FROM events)
"""
)
def stream_bad_records_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a stream without a usable record the day total is one row of nothing, and there is no window."""
    wire = faulty_wire(table_stream(spark, sf_dir, "events")).filter(F.col("topic").isin("view", "error"))
    trips = parse(wire, MONEY, keep=())
    kinds = {"complete": day_totals(trips, as_of=DAY), "update": fare_totals(trips)}
    parts = []
    for mode, results in kinds.items():
        path = scratch(spark, mode)
        finish(results, name=f"bad_{mode}", mode=mode, sink=versioned_sink(path))
        rows = spark.read.schema(results.schema).option("recursiveFileLookup", True).parquet(path)
        trips_total = F.sum("trips_total") if mode == "complete" else F.lit(None)
        fares = F.sum("fare_total" if mode == "complete" else "total_fare")
        parts.append(
            rows.agg(
                F.lit(mode).alias("mode"), F.count("*").alias("emitted"),
                trips_total.cast("bigint").alias("trips"), fares.cast("double").alias("fare_total"),
            )
        )
    return parts[0].unionByName(parts[1])


# Files of a topic, each a micro-batch: more than the last hundred that Spark remembers the progress of.
MANY = 104


def many_batches(spark: SparkSession, records: DataFrame) -> DataFrame:
    topic = scratch(spark, "topic")
    records.repartitionByRange(MANY, "timestamp").write.parquet(topic)
    reader = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(topic)


def _logged(spark: SparkSession, run: Callable[[], list[StreamingQuery]]) -> DataFrame:
    """The complete progress of the queries that ``run`` runs to their end."""
    log = ProgressLog(spark, scratch(spark, "progress"))
    spark.streams.addListener(log)
    try:
        queries = run()
        log.wait(queries)
    finally:
        spark.streams.removeListener(log)
    names = [query.name for query in queries]
    return progress_rows(log.progress()).filter(F.col("query_name").isin(names))


def _one_file(df: DataFrame, name: str) -> StreamingQuery:
    """Small micro-batches, of whose results nothing is kept but a file each."""
    return finish(df, name=name, mode="update", sink=versioned_sink(scratch(df.sparkSession, name), files=1))


@plan(
    f"""
SELECT 'progress_fares' AS query_name, count(*) AS input_rows, cast(0 AS bigint) AS late_rows,
       cast({MANY} AS bigint) AS filled_batches, count(DISTINCT date_trunc('hour', ts)) AS state_rows
FROM events
""",
    name="query_progress",
)
def query_progress_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a stream over more micro-batches than Spark remembers."""
    records = many_batches(spark, event_wire(table(spark, sf_dir, "events")))
    totals = fare_totals(parse(records, MONEY, keep=()), size="1 hour", delay="1000 days", exact=True)
    rows = _logged(spark, lambda: [_one_file(totals, "progress_fares")])
    return rows.groupBy("query_name").agg(
        F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows").alias("late_rows"),
        F.count_if(F.col("input_rows") > 0).alias("filled_batches"),
        F.max("state_rows").alias("state_rows"),
    )


@plan(
    f"""
SELECT 'all_records' AS query_name, count(*) AS records,
       count(*) FILTER (event_type NOT IN ('view', 'error')) AS valid, cast({MANY} AS bigint) AS batches,
       cast(0 AS bigint) AS late_rows, cast(0 AS bigint) AS silent_batches
FROM events
UNION ALL
SELECT 'bad_records', count(*), 0, {MANY}, 0, {MANY} FROM events WHERE event_type IN ('view', 'error')
"""
)
def stream_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query over records of which none is usable ends well, and only its health shows it."""
    records = faulty_wire(table(spark, sf_dir, "events"))
    inputs = {"all_records": records, "bad_records": records.filter(F.col("topic").isin("view", "error"))}

    def run() -> list[StreamingQuery]:
        queries = []
        for name, wire in inputs.items():
            trips = observed(parse(many_batches(spark, wire), MONEY, keep=()))
            queries.append(_one_file(fare_totals(trips, delay="1000 days"), name))
        return queries

    health = batch_health(_logged(spark, run))
    return health.groupBy("query_name").agg(
        F.sum("records").alias("records"),
        F.sum("valid").alias("valid"),
        F.count("*").alias("batches"),
        F.sum("late_rows").alias("late_rows"),
        F.count_if("silent").alias("silent_batches"),
    )


@plan(
    """
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
       count(*) AS records, count(*) FILTER (event_type IN ('view', 'error')) AS malformed,
       cast(count(*) FILTER (event_type IN ('view', 'error')) AS double) / count(*) AS error_rate
FROM events
GROUP BY ALL
"""
)
def stream_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "errors")
    records = faulty_wire(table_stream(spark, sf_dir, "events"))
    finish(error_rate(records), name="errors", mode="update", sink=versioned_sink(path))
    return flat_window(latest(spark.read.parquet(path), ["window"]))


@plan(f"SELECT *, TRUE AS own_ids FROM ({sql_standing()})")
def results_in_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the records of a topic over the four standing queries and their topics to the result tables.

    The records come in thirds, so windows across a border and all days are emitted more than once, and the
    tables get all emissions in one batch. What counts is the last one of each result; and every row of a
    table has an id of its own.
    """
    root, tables = scratch(spark, "topics"), scratch(spark, "tables")
    topics, trigger = Folders(root), ALL_AVAILABLE
    settings = {"checkpoints": scratch(spark, "checkpoints"), "trigger": trigger, "state_partitions": cores(spark)}
    for part in in_thirds(table(spark, sf_dir, "events")):
        topics.send(event_wire(part, in_quarters), topic_name("acme", INGEST_TOPIC))
        await_all(analyse(spark, topics, "acme", **settings), poll_seconds=0.1)
    await_all(store(spark, topics, "acme", tables, settings["checkpoints"], trigger), poll_seconds=0.1)

    def results(topic: str) -> DataFrame:
        kind = RESULT_TOPICS[topic]
        start = F.date_format(F.get_json_object("window", "$.start").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
        rows = standing(topic, results_of(spark, tables, "acme", topic), F.col("day") if topic == TRIPS_TOTAL_TOPIC else start)
        ids = read_table(spark, f"{tables}/acme/{kind.name}", kind).agg((F.count_distinct("id") == F.count("*")).alias("own_ids"))
        return rows.withColumn("own_ids", F.lit(ids.first()["own_ids"]))

    return reduce(DataFrame.unionByName, [results(topic) for topic in STANDING])


@plan(
    """
SELECT l_shipdate::date AS day, count(*) AS trips, cast(round(sum(cast(l_extendedprice AS decimal(18,2))) * 100) AS bigint) AS fare_cents
FROM lineitem GROUP BY 1
"""
)
def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day totals stored in two loads, the second one twice: no day is lost, and none is doubled."""
    path = scratch(spark, "store")
    trips = lineitem_trips(table(spark, sf_dir, "lineitem"))
    early = trips.filter("year(event_timestamp) < 1995")
    late = trips.filter("year(event_timestamp) >= 1995")
    for load in (early, late, late):
        write_store(totals_by_day(load).withColumn("month", F.date_format("day", "yyyy-MM")), path, ["month"])
    return read_store(spark, path).select("day", "trips", "fare_cents")


def _copies(trips: DataFrame) -> DataFrame:
    """Views have no id, purchases arrive three times, and all errors have the same id."""
    kind = F.col("payment_type")
    again = trips.filter(kind == "purchase")
    number = F.when(kind == "error", F.lit("same")).when(kind != "view", F.col("trip_id"))
    return trips.unionByName(again).unionByName(again).withColumn("trip_id", number)


SQL_COPIES = f"""
WITH trips AS ({TRIPS})
SELECT payment_type, cast(CASE WHEN payment_type = 'error' THEN 1 ELSE count(*) END AS bigint) AS trips
FROM trips GROUP BY payment_type
"""


@plan(SQL_COPIES)
def dedupe_without_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips without an id are no copies of each other; an id with a fifth of all trips leaves one."""
    unique = dedupe(_copies(batch_trips(spark, sf_dir)))
    return unique.groupBy("payment_type").agg(F.count("*").alias("trips"))


@plan(SQL_COPIES)
def stream_dedupe_without_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "unique")
    unique = dedupe(_copies(stream_trips(spark, sf_dir)), delay="1000 days")
    finish(unique, name="dedupe_ids", mode="append", sink=file_sink(path))
    return spark.read.parquet(path).groupBy("payment_type").agg(F.count("*").alias("trips"))
