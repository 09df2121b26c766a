"""Trip files and broker records, in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.functions.clock import flat_window
from hackney.functions.records import parse, serialise
from hackney.operators.ingest import clean, stamp, to_wire, typed_trips
from hackney.operators.windows import fare_totals
from hackney.plans.fixtures import (
    TRIP_FILE,
    TRIPS,
    batch_trips,
    faulty_wire,
    file_topic,
    finish,
    stream_trips,
    table,
    trip_file_rows,
)
from hackney.plans.registry import plan
from hackney.plans.windows import sql_fares
from hackney.schemas import DOUBLE, TIME, TRIP, schema_of
from hackney.session import scratch
from hackney.sources.files import list_landing, read_landing, read_trip_files
from hackney.sources.store import hadoop_files
from hackney.sources.wire import read_wire
from hackney.streaming.sinks import file_sink, write_records

STAMP = "2024-02-01 12:00:00.123456"
INGESTED = [
    "trip_id",
    "taxi_id",
    "trip_start_timestamp",
    "trip_seconds",
    "pickup_community_area",
    "fare",
    "payment_type",
    "company",
    "pickup_centroid_location",
]


def _zone_less(df: DataFrame) -> DataFrame:
    times = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


SQL_PARSED = f"""
WITH trips AS ({TRIPS})
SELECT trip_id, taxi_id, cast(pickup_community_area AS varchar) AS pickup_community_area,
       cast(fare AS double) AS fare, cast(tips AS double) AS tips, cast(trip_total AS double) AS trip_total,
       payment_type, pickup_centroid_location, event_timestamp
FROM trips
"""


def _parsed_columns(parsed: DataFrame) -> DataFrame:
    chosen = parsed.select(
        "trip_id",
        "taxi_id",
        F.col("pickup_community_area").cast("string"),
        "fare",
        "tips",
        "trip_total",
        "payment_type",
        "pickup_centroid_location",
        "event_timestamp",
    )
    return _zone_less(chosen)


@plan(SQL_PARSED)
def wire_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = file_topic(spark, sf_dir, scratch(spark, "topic"))
    return _parsed_columns(parse(read_wire(spark, "parquet", stream=False, path=topic)))


@plan(SQL_PARSED)
def wire_parse_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "lines")
    write_records(to_wire(batch_trips(spark, sf_dir)), path, format="text")
    return _parsed_columns(parse(read_wire(spark, "text", stream=False, path=path)))


def _faults(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


def _sql_faulty(area_types: str) -> str:
    sound = "event_type NOT IN ('view', 'error')"
    return f"""
SELECT cast(event_id AS varchar) AS "key",
       {_faults(sound, 'cast(event_id AS varchar)')} AS trip_id,
       {_faults(sound, 'value')} AS fare,
       {_faults(f"event_type IN ({area_types})", "cast(json_extract(props, '$.k') AS varchar)")}
         AS pickup_community_area,
       {_faults(sound, 'ts')} AS event_timestamp
FROM events
"""


def _faulty_parsed(spark: SparkSession, sf_dir: str, lenient_ints: bool) -> DataFrame:
    fields = ["trip_id", "fare", "pickup_community_area", "event_timestamp"]
    records = faulty_wire(table(spark, sf_dir, "events"))
    parsed = parse(records, fields, keep=("key",), lenient_ints=lenient_ints)
    return _zone_less(parsed.withColumn("pickup_community_area", F.col("pickup_community_area").cast("string")))


@plan(_sql_faulty("'click'"))
def wire_parse_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _faulty_parsed(spark, sf_dir, lenient_ints=False)


@plan(_sql_faulty("'click', 'signup'"))
def wire_parse_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _faulty_parsed(spark, sf_dir, lenient_ints=True)


@plan(f"WITH trips AS ({TRIPS}) {sql_fares(scale=2)}")
def wire_roundtrip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = fare_totals(batch_trips(spark, sf_dir), scale=2, exact=True)
    window = F.struct(*[F.col(f"window.{edge}").cast("timestamp").alias(edge) for edge in ("start", "end")])
    records = serialise(totals.withColumn("window", window))
    bounds = schema_of(start=TIME, end=TIME)
    schema = schema_of(window=bounds, total_fare=DOUBLE, tips_fare=DOUBLE, total_trip_total=DOUBLE)
    return flat_window(parse(records, schema, keep=()))


def _trip_files(spark: SparkSession, sf_dir: str, path: str) -> str:
    rows = trip_file_rows(table(spark, sf_dir, "events"))
    rows.write.options(header=True, escape='"', emptyValue="").csv(path)
    return path


@plan(TRIP_FILE)
def ingest_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trip_file_rows(table(spark, sf_dir, "events"))
    return _zone_less(typed_trips(clean(rows)).select(*INGESTED))


SQL_INGESTED = f"SELECT *, TIMESTAMP '{STAMP}' AS event_timestamp FROM ({TRIP_FILE})"


def _ingested(raw: DataFrame) -> DataFrame:
    trips = stamp(typed_trips(clean(raw)), F.lit(STAMP).cast("timestamp"))
    return to_wire(trips, key="trip_id")


@plan(SQL_INGESTED)
def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_trip_files(spark, _trip_files(spark, sf_dir, scratch(spark, "trip-files")))
    parsed = parse(_ingested(raw), TRIP, keep=())
    return _zone_less(parsed.select(*INGESTED, "event_timestamp"))


@plan(SQL_INGESTED)
def stream_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _trip_files(spark, sf_dir, scratch(spark, "trip-files"))
    topic = scratch(spark, "topic")
    raw = read_trip_files(spark, files, stream=True)
    finish(
        _ingested(raw),
        name="csv_ingest",
        mode="append",
        sink=file_sink(topic),
    )
    parsed = parse(spark.read.parquet(topic), TRIP, keep=())
    return _zone_less(parsed.select(*INGESTED, "event_timestamp"))


@plan(
    f"""
WITH trips AS ({TRIPS})
SELECT trip_id, cast(fare AS double) AS fare, event_timestamp FROM trips
"""
)
def stream_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = scratch(spark, "topic")
    finish(
        to_wire(stream_trips(spark, sf_dir), key="trip_id"),
        name="to_topic",
        mode="append",
        sink=file_sink(topic),
    )
    return _zone_less(parse(spark.read.parquet(topic), ["trip_id", "fare", "event_timestamp"], keep=()))


def _land(spark: SparkSession, sf_dir: str) -> str:
    """Every tenant (here: type of event) has its trip file in its own folder."""
    root, aside = scratch(spark, "landing"), scratch(spark, "aside")
    events = table(spark, sf_dir, "events")
    rows = trip_file_rows(events, F.col("event_type").alias("tenant"))
    rows.write.partitionBy("tenant").options(header=True, escape='"', emptyValue="").csv(aside)
    # Folders as they are found in a landing zone: <tenant>/in/<files>.
    files, path = hadoop_files(spark, aside)
    for status in files.listStatus(path(aside)):
        if status.isDirectory():
            tenant = status.getPath().getName().partition("=")[2]
            files.mkdirs(path(f"{root}/{tenant}"))
            files.rename(status.getPath(), path(f"{root}/{tenant}/in"))
    return root


@plan(
    """
SELECT event_type AS tenant_id, count(*) AS trips, cast(sum(cast(value AS decimal(18,2))) AS double) AS fare_total
FROM events
GROUP BY event_type
"""
)
def landing_by_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_landing(spark, _land(spark, sf_dir))
    money = F.sum(F.col("fare").cast("decimal(18,2)")).cast("double")
    return raw.groupBy("tenant_id").agg(F.count("*").alias("trips"), money.alias("fare_total"))


@plan("SELECT event_type AS tenant_id, count(*) AS trips FROM events GROUP BY event_type")
def landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips in the files that the list names, where name and size agree with what was read."""
    root = _land(spark, sf_dir)
    listed = list_landing(spark, root).select("tenant_id", "file_name", "bytes")
    read = read_landing(spark, root).select(
        "tenant_id", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("bytes")
    )
    per_file = read.groupBy("tenant_id", "file_name", "bytes").agg(F.count("*").alias("trips"))
    return per_file.join(listed, per_file.columns[:3]).groupBy("tenant_id").agg(F.sum("trips").alias("trips"))
