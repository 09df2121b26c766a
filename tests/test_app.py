"""The three jobs of a tenant, one after the other, over folders as topics."""

from __future__ import annotations

import glob
import json
import os
import signal
import subprocess
import sys
import time

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from hackney import app
from hackney.functions.records import parse
from hackney.operators.ingest import to_wire
from hackney.operators.metrics import progress_rows
from hackney.schemas import RESULT_TOPICS, TRIP
from hackney.sources.wire import sasl
from hackney.streaming.progress import progress_log
from hackney.streaming.run import ALL_AVAILABLE, await_all
from hackney.streaming.sinks import BATCH, RUN, read_table
from hackney.streaming.topics import Broker, Folders
from tests.test_files import FULL, with_cell, write
from tests.test_records import trips


def test_ingest_analyse_store(spark, folder):
    topics, checkpoints, tables = str(folder / "topics"), str(folder / "c"), str(folder / "tables")
    common = ["--tenant", "acme", "--topics", topics, "--checkpoints", checkpoints, "--once"]
    Folders(topics).send(to_wire(trips(spark)), "acme_ingestData")
    app.main(["analyse", *common], spark)
    app.main(["store", *common, "--tables", tables], spark)

    def table(name):
        return next(read_table(spark, f"{tables}/acme/{name}", t) for t in RESULT_TOPICS.values() if t.name == name)

    fares = table("sumfarewindow")
    assert fares.columns == ["id", "window", "total_fare", "tips_fare", "total_trip_total", RUN, BATCH]
    row = fares.first()
    assert (row["total_fare"], row["tips_fare"], row["total_trip_total"]) == (88.0, 13.0, 102.0)
    assert json.loads(row["window"])["start"].startswith("2024-05-02T09:15:20.000")
    total = table("tripstotal").first()
    assert (total["day"], total["trips_total"], total["fare_total"]) == ("2024-05-02", 2, 88.0)
    # The job has declared the tables, over what it stores.
    assert spark.table("acme.sumfarewindow").collect() == fares.collect()

    # The windows of the hot spots close when a later trip comes in.
    later = trips(spark).selectExpr("event_timestamp + INTERVAL 5 MINUTES AS event_timestamp", "* EXCEPT (event_timestamp)")
    Folders(topics).send(to_wire(later), "acme_ingestData")
    app.main(["analyse", *common], spark)
    app.main(["store", *common, "--tables", tables], spark)
    areas = table("hotspotcommunitywindow").collect()
    assert [(r["pickup_community_area"], r["count"]) for r in areas] == [("7", 1)] * 2
    places = table("hotspotwindow").collect()
    assert sorted(str(r["pickup_centroid_location"]) for r in places) == ["None"] * 2 + ["POINT (10.5 50.25)"] * 2
    assert table("sumfarewindow").count() == 2


def test_several_emissions_in_one_batch_of_the_store(spark, folder):
    """A window is emitted three times before the store starts; its last emission counts."""
    topics, tables = Folders(str(folder / "topics")), str(folder / "tables")
    once = {"checkpoints": str(folder / "c"), "trigger": ALL_AVAILABLE}
    for fare in (1.0, 4.0, 8.0):
        row = trips(spark).limit(1).withColumn("fare", F.lit(fare))
        topics.send(to_wire(row), "acme_ingestData")
        await_all(app.analyse(spark, topics, "acme", **once), poll_seconds=0.1)
    await_all(app.store(spark, topics, "acme", tables, **once), poll_seconds=0.1)
    last = app.results_of(spark, tables, "acme", "sumFareWindowStream").collect()
    assert [r["total_fare"] for r in last] == [13.0]
    days = app.results_of(spark, tables, "acme", "tripsTotalStream").collect()
    assert [(r["trips_total"], r["fare_total"]) for r in days] == [(3, 13.0)]
    rows = read_table(spark, f"{tables}/acme/sumfarewindow", RESULT_TOPICS["sumFareWindowStream"])
    assert [r["total_fare"] for r in rows.orderBy("id").collect()] == [1.0, 5.0, 13.0]

    # An analysis that starts anew, with a checkpoint of its own, comes after all that was.
    anew = {"checkpoints": str(folder / "c2"), "trigger": ALL_AVAILABLE}
    topics.send(to_wire(trips(spark).limit(1).withColumn("fare", F.lit(16.0))), "acme_ingestData")
    await_all(app.analyse(spark, topics, "acme", **anew), poll_seconds=0.1)
    await_all(app.store(spark, topics, "acme", tables, **once), poll_seconds=0.1)
    last = app.results_of(spark, tables, "acme", "sumFareWindowStream").collect()
    assert [r["total_fare"] for r in last] == [29.0]
    rows = read_table(spark, f"{tables}/acme/sumfarewindow", RESULT_TOPICS["sumFareWindowStream"])
    assert rows.count() == 4
    assert rows.select("id").distinct().count() == 4


def test_a_large_batch_of_the_store_is_written_by_many_tasks(spark, folder):
    """Files grow in number with the batch, and none has most of its rows; a small batch is one file."""
    topics, tables, topic = Folders(str(folder / "topics")), str(folder / "tables"), "sumFareWindowStream"
    table = RESULT_TOPICS[topic]
    once = {"checkpoints": str(folder / "c"), "trigger": ALL_AVAILABLE}
    for name in RESULT_TOPICS:
        os.makedirs(topics.path(f"acme_{name}"))

    def batch(number, rows):
        """How many rows the files of the table's batch have."""
        text = "named_struct('window', '{\"start\":\"' || id || '\"}', 'total_fare', id, 'run', 1, 'batch_id', 2)"
        topics.send(spark.range(rows).selectExpr(f"encode(to_json({text}), 'utf-8') AS value"), f"acme_{topic}")
        await_all(app.store(spark, topics, "acme", tables, **once), poll_seconds=0.1)
        return [pq.read_metadata(f).num_rows for f in glob.glob(f"{tables}/acme/{table.name}/*-batch-{number:012d}/*.parquet")]

    size = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    usual = spark.conf.get(size)
    try:
        assert batch(0, 20) == [20]
        spark.conf.set(size, "16KB")
        large = batch(1, 20_000)
    finally:
        spark.conf.set(size, usual)
    assert sum(large) == 20_000 and max(large) < 10_000
    assert read_table(spark, f"{tables}/acme/{table.name}", table).select("id").distinct().count() == 20_020


def test_quarantine_alerts_and_progress(spark, folder):
    topics, bad, log = str(folder / "topics"), str(folder / "bad"), str(folder / "log")
    wire = to_wire(trips(spark).withColumn("trip_id", F.lit("a"))).unionByName(
        spark.createDataFrame([("oops",)], "value STRING").select(F.lit(None).cast("binary").alias("key"), F.encode("value", "utf-8").alias("value")),
        allowMissingColumns=True,
    )
    Folders(topics).send(wire, "acme_ingestData")
    later = trips(spark).selectExpr("event_timestamp + INTERVAL 5 MINUTES AS event_timestamp", "* EXCEPT (event_timestamp)")
    common = ["analyse", "--tenant", "acme", "--topics", topics, "--checkpoints", str(folder / "c"), "--once"]
    arguments = [*common, "--quarantine", bad, "--alert", "rich", "total_fare", "80", "--progress", log]
    app.main(arguments, spark)
    Folders(topics).send(to_wire(later.withColumn("trip_id", F.lit("b"))), "acme_ingestData")
    app.main(arguments, spark)
    assert [r["reasons"] for r in spark.read.parquet(f"{bad}/acme").collect()] == [["unreadable"]]
    raised = Folders(topics).read(spark, "acme_alertStream", stream=False).collect()
    assert [json.loads(r["value"])["rule"] for r in raised] == ["rich"]
    rows = progress_rows(progress_log(spark, log)).groupBy("query_name").agg(F.sum("input_rows").alias("n")).collect()
    assert {r["query_name"]: r["n"] for r in rows if r["n"]} == dict.fromkeys(
        ["acme_quarantine", "acme_alertStream", *(f"acme_{topic}" for topic in RESULT_TOPICS)], 5
    )


def test_corrected_totals_and_unique_trips(spark, folder):
    topics, fixed, unique = str(folder / "topics"), str(folder / "fixed"), str(folder / "unique")
    arguments = ["analyse", "--tenant", "acme", "--topics", topics, "--checkpoints", str(folder / "c"), "--once"]
    first = trips(spark).withColumn("trip_id", F.concat(F.lit("a"), F.monotonically_increasing_id()))
    later = first.selectExpr("event_timestamp + INTERVAL 5 MINUTES AS event_timestamp", "* EXCEPT (event_timestamp)").withColumn("trip_id", F.lit("b"))
    late = first.limit(1).withColumn("trip_id", F.lit("c"))
    for rows in (first, later.limit(1), late.unionByName(first)):
        Folders(topics).send(to_wire(rows), "acme_ingestData")
        app.main([*arguments, "--corrected", fixed, "--unique", unique], spark)
    made = app.CorrectedTotals(spark, f"{fixed}/acme")
    got = sorted((r["trips"], r["late_trips"], r["total_fare"], r["closed"]) for r in made.totals().collect())
    # The late trip and both copies are late; copies are another matter, which the unique trips settle.
    assert got == [(1, 0, 87.0, False), (5, 3, 263.0, True)]
    assert made.late().count() == 3
    kept = app.UniqueTrips(spark, f"{unique}/acme").read()
    assert sorted(r["trip_id"] for r in kept.collect()) == sorted([*(r["trip_id"] for r in first.collect()), "b", "c"])
    assert kept.columns == TRIP.names


def test_monitor(spark, folder):
    topics, tables = str(folder / "topics"), str(folder / "tables")
    good = to_wire(trips(spark).withColumn("trip_id", F.lit("a")).withColumn("timestamp", F.col("event_timestamp")), keep=["timestamp"])
    day = F.lit("2024-05-02 20:00:00").cast("timestamp")
    bad = good.limit(1).withColumns({"value": F.encode(F.lit("oops"), "utf-8"), "timestamp": day})
    arguments = ["monitor", "--tenant", "acme", "--topics", topics, "--checkpoints", str(folder / "c"), "--tables", tables, "--interval", "1 hour", "--once"]
    for wire in (good, bad):
        Folders(topics).send(wire, "acme_ingestData")
        app.main(arguments, spark)
    rows = {str(r["window_start"]): r for r in app.monitored(spark, tables, "acme").collect()}
    assert rows["2024-05-02 20:00:00"]["silent"] and rows["2024-05-02 20:00:00"]["bytes"] == 4
    others = [r for start, r in rows.items() if start != "2024-05-02 20:00:00"]
    known = good.filter("timestamp IS NOT NULL").count()
    assert sum(r["messages"] for r in others) == sum(r["records"] for r in others) == known
    assert not any(r["silent"] or r["malformed"] for r in others)


JOB = """
import sys
from hackney import app
app.main(sys.argv[1:])
"""


def test_a_signal_stops_a_job_that_later_goes_on(spark, folder):
    topics, checkpoints = Folders(str(folder / "topics")), str(folder / "c")
    topics.send(to_wire(trips(spark)), "acme_ingestData")
    arguments = ["analyse", "--tenant", "acme", "--topics", topics.root, "--checkpoints", checkpoints]
    env = os.environ | {"PYTHONPATH": os.getcwd(), "SPARK_LOCAL_IP": "127.0.0.1"}
    command = [sys.executable, "-c", JOB, *arguments]
    job = subprocess.Popen(command, env=env, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)

    def emitted():
        try:
            rows = topics.read(spark, "acme_sumFareWindowStream", stream=False).collect()
        except AnalysisException:
            return []
        return sorted(json.loads(r["value"])["total_fare"] for r in rows)

    try:
        for _ in range(600):
            if emitted():
                break
            time.sleep(0.2)
        job.send_signal(signal.SIGTERM)
        assert job.wait(60) == 0
    finally:
        job.kill()
    assert emitted() == [88.0]
    topics.send(to_wire(trips(spark)), "acme_ingestData")
    app.main([*arguments, "--once"], spark)
    assert emitted() == [88.0, 176.0]


def test_ingest_sends_complete_rows(spark, folder):
    write(folder / "in" / "a.csv", FULL, with_cell("company", ""))
    arguments = ["ingest", "--tenant", "acme", "--topics", str(folder / "topics"), "--files", str(folder / "in")]
    topics = Folders(str(folder / "topics"))

    def sent():
        return parse(topics.read(spark, "acme_ingestData", stream=False), keep=())

    app.main(arguments, spark)
    assert sent().columns == TRIP.names
    row = sent().first()
    assert row["trip_id"] == "trip-0001" and row["event_timestamp"] is not None

    watching = [*arguments, "--checkpoints", str(folder / "c"), "--once", "--files-per-trigger", "1"]
    for _ in range(2):  # a file is taken once, however often the job starts
        app.main(watching, spark)
    assert sent().count() == 2
    write(folder / "in" / "b.csv", FULL, FULL)
    app.main(watching, spark)
    assert sent().count() == 4


def test_arguments():
    broker = app._topics(app._arguments(["ingest", "--tenant", "a", "--servers", "h:1", "--files", "f"]))
    assert broker == Broker("h:1")
    login = ["--sasl-username", "u", "--sasl-password", "p"]
    broker = app._topics(app._arguments(["ingest", "--tenant", "a", "--servers", "h:1", "--files", "f", *login]))
    assert broker == Broker("h:1", sasl("u", "p"))
    for wrong in (["analyse", "--tenant", "a", "--topics", "t"], ["ingest", "--tenant", "a", "--files", "f"]):
        with pytest.raises(SystemExit):
            app._arguments(wrong)
