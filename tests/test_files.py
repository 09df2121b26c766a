"""Trip files, landing folders, topics and sessions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hackney.functions.records import parse
from hackney.operators.ingest import blank_to_null, clean, stamp, to_wire, typed_trips
from hackney.schemas import NULL_TOKENS, TRIP, TRIP_FILE_COLUMNS, topic_name
from hackney.session import build_session, scratch
from hackney.sources.files import list_landing, read_landing, read_trip_files
from hackney.sources.store import read_store
from hackney.sources.wire import broker_options, read_wire, sasl
from hackney.streaming.run import run_to_end
from hackney.streaming.sinks import broker_sink, file_sink, write_records, write_store

HEADER = ",".join(f"Some Name {n}" for n in range(23))
FULL = (
    'trip-0001,cab-17,03/05/2024 01:30:00 PM,03/05/2024 01:45:05 PM,905,6.5,4711,4712,3,9,18.50,'
    '2.25,0.50,0.75,22.00,Voucher,"Cabs, Ltd",47.5,8.25,'
    "POINT (8.25 47.5),47.75,8.5,POINT (8.5 47.75)"
)


def with_cell(name, text):
    """The full row with one cell replaced."""
    cells = FULL.replace('"Cabs, Ltd"', "Cabs").split(",")
    cells[TRIP_FILE_COLUMNS.index(name)] = text
    return ",".join(cells)


def write(path, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join((HEADER, *rows)) + "\n")
    return str(path)


def test_names_go_by_position_and_the_header_is_skipped(spark, folder):
    raw = read_trip_files(spark, write(folder / "t.csv", FULL))
    assert raw.columns == TRIP_FILE_COLUMNS and len(raw.columns) == 23
    row = typed_trips(raw).first()
    assert row["company"] == "Cabs, Ltd"
    assert row["trip_start_timestamp"] == dt.datetime(2024, 3, 5, 13, 30)
    assert (row["trip_seconds"], row["fare"], row["pickup_community_area"]) == (905, 18.5, 3)
    assert row["pickup_census_tract"] == 4711.0


def test_rows_with_a_missing_cell_are_dropped(spark, folder):
    rows = [with_cell("company", text) for text in ["", *NULL_TOKENS]]
    raw = read_trip_files(spark, write(folder / "t.csv", FULL, *rows, with_cell("fare", ""), with_cell("tips", "0")))
    assert clean(raw).count() == 2
    assert blank_to_null(raw).filter("company IS NULL").count() == len(rows)


def test_a_cell_of_garbage_is_not_missing(spark, folder):
    raw = read_trip_files(spark, write(folder / "t.csv", with_cell("fare", "free"), with_cell("trip_start_timestamp", "soon")))
    rows = typed_trips(clean(raw)).collect()
    assert [r["fare"] for r in rows] == [None, 18.5]
    assert [r["trip_start_timestamp"] is None for r in rows] == [False, True]


def test_a_short_row_has_missing_cells(spark, folder):
    raw = read_trip_files(spark, write(folder / "t.csv", "only,two", FULL))
    assert raw.count() == 2 and clean(raw).count() == 1


def test_one_ingest_time_per_batch(spark, folder):
    raw = read_trip_files(spark, write(folder / "t.csv", FULL, FULL, FULL))
    stamped = stamp(typed_trips(clean(raw)))
    assert stamped.select("event_timestamp").distinct().count() == 1
    assert stamped.columns == TRIP.names


def test_files_arrive_one_after_the_other(spark, folder):
    for n in range(3):
        write(folder / "in" / f"{n}.csv", FULL)
    raw = read_trip_files(spark, str(folder / "in"), stream=True, files_per_trigger=1)
    query = run_to_end(
        to_wire(stamp(typed_trips(clean(raw))), key="trip_id"),
        name="ingest",
        mode="append",
        sink=file_sink(str(folder / "topic")),
        checkpoints=str(folder / "c"),
    )
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1]
    trips = parse(read_wire(spark, "parquet", stream=False, path=str(folder / "topic")))
    assert trips.select("event_timestamp").distinct().count() == 3


def test_landing_folders(spark, folder):
    write(folder / "one" / "in" / "a.csv", FULL, FULL)
    write(folder / "two" / "in" / "b.csv", FULL)
    write(folder / "two" / "out" / "c.csv", FULL)
    counts = {r["tenant_id"]: r["count"] for r in read_landing(spark, str(folder)).groupBy("tenant_id").count().collect()}
    assert counts == {"one": 2, "two": 1}
    files = list_landing(spark, str(folder)).collect()
    assert {(r["tenant_id"], r["file_name"]) for r in files} == {("one", "a.csv"), ("two", "b.csv")}
    assert [r["file_name"] for r in list_landing(spark, str(folder), "two").collect()] == ["b.csv"]
    assert all(r["bytes"] == (folder / r["tenant_id"] / "in" / r["file_name"]).stat().st_size for r in files)


def test_landing_folders_as_a_stream(spark, folder):
    write(folder / "landing" / "one" / "in" / "a.csv", FULL, FULL)
    raw = read_landing(spark, str(folder / "landing"), stream=True)
    run_to_end(
        raw.select("tenant_id", "trip_id"),
        name="landing",
        mode="append",
        sink=file_sink(str(folder / "out"), partition_by=["tenant_id"]),
        checkpoints=str(folder / "c"),
    )
    assert [tuple(r) for r in spark.read.parquet(str(folder / "out")).collect()] == [("trip-0001", "one")] * 2


def test_text_topic(spark, folder):
    rows = spark.createDataFrame([("a", 1.5)], "trip_id STRING, fare DOUBLE")
    write_records(to_wire(rows), str(folder / "lines"), format="text")
    row = parse(read_wire(spark, "text", stream=False, path=str(folder / "lines")), ["trip_id", "fare"]).first()
    assert (row["trip_id"], row["fare"]) == ("a", 1.5) and row["timestamp"] is not None


def test_store_opens_only_the_days_asked_for(spark, folder):
    rows = spark.range(100).select("id", F.expr("date_add(DATE'2024-01-01', CAST(id % 10 AS INT))").alias("day"))
    write_store(rows, str(folder / "store"))
    some = read_store(spark, str(folder / "store"), "2024-01-03", "2024-01-04")
    assert some.count() == 20
    assert len(some.inputFiles()) == 10  # what the plan may list; pruning shows below
    plan = some._jdf.queryExecution().executedPlan().toString()
    partitions = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "2024-01-03" in partitions and "2024-01-04" in partitions


def test_storing_some_days_leaves_the_others(spark, folder):
    path = str(folder / "store")

    def days(*rows):
        return spark.createDataFrame(rows, "day STRING, n INT")

    write_store(days(("2024-01-01", 1), ("2024-01-02", 2)), path)
    for _ in range(2):
        write_store(days(("2024-01-02", 3), ("2024-01-03", 4)), path)
    rows = {(str(r["day"]), r["n"]) for r in spark.read.parquet(path).collect()}
    assert rows == {("2024-01-01", 1), ("2024-01-02", 3), ("2024-01-03", 4)}


def test_broker_settings():
    login = sasl("user", "secret")
    options = broker_options("host:9092", topic_name("acme", "ingestData"), login)
    assert options["subscribe"] == "acme_ingestData"
    assert (options["startingOffsets"], options["failOnDataLoss"]) == ("latest", "false")
    assert broker_options("h:1", "t", None, "earliest")["startingOffsets"] == "earliest"
    assert options["kafka.security.protocol"] == "SASL_PLAINTEXT"
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="user" password="secret"' in options["kafka.sasl.jaas.config"]

    class Writer(dict):
        def format(self, name):
            self["format"] = name
            return self

        def options(self, **options):
            self.update(options)
            return self

    writer = broker_sink("host:9092", "t", login)(Writer(), 1)
    assert writer["format"] == "kafka" and writer["topic"] == "t" and writer["kafka.sasl.mechanism"] == "PLAIN"


def test_a_day_with_most_of_the_rows_is_written_by_many_tasks(spark, folder):
    rows = spark.range(0, 400_000, 1, 8).select(
        F.expr("date_add(DATE'2024-01-01', IF(id % 10 = 0, CAST(id / 10 % 30 AS INT), 3))").alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        write_store(rows, str(folder / "store"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert read_store(spark, str(folder / "store")).count() == 400_000
    files = {day.name: len(list(day.glob("*.parquet"))) for day in (folder / "store").glob("day=*")}
    # Days that share a hash with the large one are split with it; most have a single file.
    assert files["day=2024-01-04"] > 4 and len(files) == 30
    assert sorted(files.values())[15] == 1


class Settings:
    """Stands in for a session; only its settings are read."""

    def __init__(self, **settings):
        self.conf = {name.replace("_", "."): value for name, value in settings.items()}


def test_scratch_is_new_each_time_and_in_the_named_folder():
    cluster = Settings(spark_checkpoint_dir="hdfs://shared/", spark_master="yarn")
    one, two = scratch(cluster, "x"), scratch(cluster, "x")
    assert one != two and one.startswith("hdfs://shared/x-")


def test_scratch_on_a_cluster_is_never_a_local_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch(Settings(spark_master="yarn"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch(Settings(), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch(Settings(spark_master="local-cluster[2,1,1024]"), "x")
    assert scratch(Settings(spark_master="local[2]"), "x") and scratch(Settings(spark_master="local"), "x")


def test_session_settings(spark):
    assert build_session("again") is not None
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")


def test_broker_connector_is_named_when_it_is_missing(spark):
    with pytest.raises(Exception, match="kafka"):
        read_wire(spark, **broker_options("localhost:1", "t"))


@pytest.mark.parametrize("tenant", ["a", "tenant-b"])
def test_topics_carry_the_tenant(tenant):
    assert topic_name(tenant, "sumFareWindowStream") == f"{tenant}_sumFareWindowStream"
