"""Starting, watching and stopping streams."""

from __future__ import annotations

import signal
import time
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hackney.functions.clock import EVENT_TIME
from hackney.functions.records import parse
from hackney.operators.daily import day_report, day_totals, totals_by_day
from hackney.operators.windows import COMMUNITY, LOCATION, community_hot_spots, fare_totals, location_hot_spots
from hackney.schemas import HOTSPOT_COMMUNITY_TOPIC, HOTSPOT_TOPIC, SUM_FARE_TOPIC, TRIPS_TOTAL_TOPIC, narrow, topic_name
from hackney.session import DEFAULTS
from hackney.sources.store import hadoop_files
from hackney.streaming.sinks import Sink, file_sink, run_number

ALL_AVAILABLE = {"availableNow": True}
PARTITIONS = "spark.sql.shuffle.partitions"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = DEFAULTS[STATE_STORE]
POOL = "spark.scheduler.pool"


def start(
    df: DataFrame,
    *,
    name: str,
    mode: str,
    sink: Sink,
    checkpoints: str,
    trigger: dict | None = None,
    pool: str | None = None,
    state_partitions: int | None = None,
    state_store: str | None = None,
) -> StreamingQuery:
    """Start a named query with a checkpoint folder of its own.

    Without ``trigger`` a micro-batch starts as soon as the last one is done. Queries of one
    ``pool`` get an equal share of the cores with those of any other. ``state_partitions`` and ``state_store`` are for
    the very first start; the checkpoint keeps them. They default to the session's.
    """
    spark = df.sparkSession
    checkpoint = f"{checkpoints}/{name}"
    run = run_number(spark, checkpoint)
    writer = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    writer = sink(writer, run)
    # A query takes its own copy of pool and settings when it starts; the caller keeps theirs.
    context = spark.sparkContext
    wanted = {name: value for name, value in ((PARTITIONS, state_partitions), (STATE_STORE, state_store)) if value is not None}
    usual, usual_pool = {name: spark.conf.get(name) for name in wanted}, context.getLocalProperty(POOL)
    context.setLocalProperty(POOL, pool)
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        return writer.start()
    finally:
        context.setLocalProperty(POOL, usual_pool)
        for name, value in usual.items():
            spark.conf.set(name, value)


def run_to_end(df: DataFrame, **options) -> StreamingQuery:
    """Process what is there and return the finished query; raises what the query raised."""
    query = start(df, trigger=ALL_AVAILABLE, **options)
    query.awaitTermination()
    return query


def days_so_far(trips: DataFrame) -> DataFrame:
    """The totals of every day there are trips of; a day starts afresh at midnight."""
    return day_report(totals_by_day(trips), scale=0)


# The standing queries: result topic, query, output mode and the trip fields it reads.
MONEY = (EVENT_TIME, "fare", "tips", "trip_total")
STANDING = {
    SUM_FARE_TOPIC: (fare_totals, "update", MONEY),
    TRIPS_TOTAL_TOPIC: (days_so_far, "update", MONEY),
    HOTSPOT_COMMUNITY_TOPIC: (community_hot_spots, "append", (EVENT_TIME, COMMUNITY)),
    HOTSPOT_TOPIC: (location_hot_spots, "append", (EVENT_TIME, LOCATION)),
}
# The day total with one state that never starts anew: of the day of its start, and all that follow.
ENDLESS_DAY = {TRIPS_TOTAL_TOPIC: (day_totals, "complete", MONEY)}


def start_tenant(
    trips: Callable[[Sequence[str]], DataFrame],
    tenant: str,
    sink: Callable[[str], Sink],
    checkpoints: str,
    standing: Mapping[str, tuple] = STANDING,
    **options,
) -> list[StreamingQuery]:
    """Start the standing queries of a tenant; names, checkpoints, sinks and pool are its own.

    ``trips`` gives the stream of trips with the fields a query asks for, ``sink`` the sink of a
    result topic.
    """
    return [
        start(
            query(trips(fields)),
            name=topic_name(tenant, topic),
            mode=mode,
            sink=sink(topic_name(tenant, topic)),
            checkpoints=checkpoints,
            pool=tenant,
            **options,
        )
        for topic, (query, mode, fields) in standing.items()
    ]


def fields_of(standing: Mapping[str, tuple] = STANDING) -> list[str]:
    """All trip fields that the queries read."""
    return list(dict.fromkeys(name for _, _, fields in standing.values() for name in fields))


def decode(records: DataFrame, path: str, *, name: str, fields: Sequence[str] | None = None, **options) -> StreamingQuery:
    """Parse the records once, into columns of a folder that any number of queries then read.

    Spark's own log of the folder says which of its files count, so that each record is there once.
    """
    trips = parse(records, fields or fields_of(), keep=())
    return start(trips, name=name, mode="append", sink=file_sink(path), **options)


def decoded(spark: SparkSession, path: str, fields: Sequence[str] | None = None) -> Callable[[Sequence[str]], DataFrame]:
    """The trips that ``decode`` writes to the folder, as ``start_tenant`` asks for them: only the columns it names."""
    files, make = hadoop_files(spark, path)
    files.mkdirs(make(path))
    trips = spark.readStream.schema(narrow(fields or fields_of())).parquet(path)
    return lambda wanted: trips.select(*wanted)


def await_all(
    queries: Iterable[StreamingQuery], poll_seconds: float = 1.0, stop: Callable[[], bool] = lambda: False
) -> None:
    """Wait until all have ended. The first failure stops the others and is raised.

    When ``stop`` says so, all are stopped; what they have not finished they repeat at their next start.
    """
    queries = list(queries)
    while any(query.isActive for query in queries):
        if any(query.exception() for query in queries):
            break
        if stop():
            stop_all(queries)
            break
        time.sleep(poll_seconds)
    failed = [query for query in queries if query.exception()]
    if failed:
        stop_all(queries)
        raise failed[0].exception()


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def stop_on_signals(numbers: Iterable[int] = (signal.SIGTERM, signal.SIGINT)) -> Callable[[], bool]:
    """Take note of signals instead of dying of them; gives the ``stop`` of ``await_all``. For the main thread."""
    came: list[int] = []
    for number in numbers:
        signal.signal(number, lambda got, frame: came.append(got))
    return lambda: bool(came)


def stop_session_queries(spark: SparkSession) -> None:
    """Stop every query of the session; state and offsets stay in the checkpoints."""
    stop_all(spark.streams.active)
