"""Sequences of micro-batches: output modes, late trips, restarts, tenants, failures."""

from __future__ import annotations

import json

import pytest

from hackney.functions.records import parse
from hackney.operators.daily import day_totals, totals_by_day
from hackney.operators.metrics import batch_health, observed, operation_times, progress_rows, query_progress
from hackney.operators.quality import dedupe
from hackney.operators.windows import community_hot_spots, fare_totals
from hackney.schemas import RESULT_TOPICS, SUM_FARE_WINDOW
from hackney.streaming.progress import ProgressLog, progress_log, progress_table
from hackney.streaming.run import STANDING, await_all, run_to_end, start, start_tenant, stop_session_queries
from hackney.streaming.sinks import (
    BATCH,
    RUN,
    file_sink,
    fold_versions,
    latest,
    read_latest,
    read_table,
    table_sink,
    versioned_sink,
    versions_between,
)


def at(time, fare=1.0, **more):
    return {"event_timestamp": f"2024-04-13 {time}", "fare": fare, **more}


def emitted(spark, path):
    """Rows per batch, as (batch, fare total)."""
    rows = spark.read.parquet(str(path)).collect()
    return sorted((r[BATCH], r["total_fare"]) for r in rows)


def run(spark, df, folder, mode="update", name="q", out="out"):
    return run_to_end(
        df, name=name, mode=mode, sink=versioned_sink(str(folder / out)), checkpoints=str(folder / "checkpoints")
    )


LATE = (at("10:00:00", 1), at("10:10:00", 1), at("10:00:01", 7), at("10:00:02", 9))


@pytest.mark.parametrize(
    "several, expected, dropped",
    [("true", [(0, 1.0), (1, 1.0), (2, 8.0)], [0, 0, 0, 1]), ("false", [(0, 1.0), (1, 1.0)], [0, 0, 1, 1])],
)
def test_late_trips(spark, batches, folder, several, expected, dropped):
    """The drop is one batch behind the watermark unless a query may hold one stateful operator only."""
    setting = "spark.sql.streaming.statefulOperator.allowMultiple"
    for record in LATE:
        batches.add(record)
    spark.conf.set(setting, several)
    try:
        query = run(spark, fare_totals(parse(batches.stream(spark))), folder)
    finally:
        spark.conf.unset(setting)
    assert emitted(spark, folder / "out") == expected
    with_input = [p for p in query.recentProgress if p["numInputRows"]]
    assert [p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in with_input] == dropped


def test_update_emits_changed_windows_only(spark, batches, folder):
    batches.add(at("10:00:01"), at("10:00:06"))
    batches.add(at("10:00:07"))
    run(spark, fare_totals(parse(batches.stream(spark))), folder)
    assert emitted(spark, folder / "out") == [(0, 1.0), (0, 1.0), (1, 2.0)]
    last = latest(spark.read.parquet(str(folder / "out")), ["window"])
    assert sorted(r["total_fare"] for r in last.collect()) == [1.0, 2.0]


def test_append_emits_closed_windows_once(spark, batches, folder):
    batches.add(at("10:00:10", pickup_community_area=8), at("10:00:20", pickup_community_area=8))
    batches.add(at("10:02:00", pickup_community_area=8))
    spots = community_hot_spots(parse(batches.stream(spark)))
    path = str(folder / "out")
    run_to_end(spots, name="q", mode="append", sink=file_sink(path), checkpoints=str(folder / "c"))
    rows = spark.read.parquet(path).collect()
    assert sorted((r["window"]["start"].strftime("%H:%M:%S"), r["count"]) for r in rows) == [
        ("09:59:30", 2),
        ("10:00:00", 2),
    ]


def test_no_state_for_trips_without_area(spark, batches, folder):
    batches.add(at("10:00:10", pickup_community_area=8), at("10:00:10"), at("10:00:10", pickup_community_area=8.0))
    query = run(spark, community_hot_spots(parse(batches.stream(spark))), folder)
    assert query.recentProgress[0]["stateOperators"][0]["numRowsTotal"] == 2


def on(day, fare):
    return {"event_timestamp": f"{day} 12:00:00", "fare": fare}


def test_running_totals_go_on_over_midnight_and_totals_by_day_do_not(spark, batches, folder):
    batches.add(on("2024-04-13", 10))
    run(spark, day_totals(parse(batches.stream(spark)), as_of="2024-04-13"), folder, mode="complete")
    run(spark, totals_by_day(parse(batches.stream(spark))), folder, name="days", out="days")
    batches.add(on("2024-04-14", 5))
    run(spark, day_totals(parse(batches.stream(spark)), as_of="2024-04-14"), folder, mode="complete")
    run(spark, totals_by_day(parse(batches.stream(spark))), folder, name="days", out="days")

    totals = latest(spark.read.parquet(str(folder / "out")), []).first()
    assert (totals["trips_total"], totals["fare_total"]) == (2, 15.0)
    days = latest(spark.read.parquet(str(folder / "days")), ["day"]).orderBy("day").collect()
    assert [(r["trips"], r["fare_cents"]) for r in days] == [(1, 1000), (1, 500)]


def test_bad_records_give_a_zero_row_in_complete_mode_and_nothing_in_update_mode(spark, batches, folder):
    batches.add('{"x": 1}', "bad")
    trips = parse(batches.stream(spark))
    run(spark, day_totals(trips, as_of="2024-04-13"), folder, mode="complete", out="totals")
    row = spark.read.parquet(str(folder / "totals")).first()
    assert (row["trips_total"], row["fare_total"]) == (0, None)
    query = run(spark, fare_totals(observed(trips)), folder, name="fares", out="fares")
    assert spark.read.parquet(str(folder / "fares")).count() == 0

    health = batch_health(progress_rows(progress_table(spark, [query]))).collect()
    assert [(r["records"], r["valid"], r["silent"]) for r in health] == [(2, 0, True)]


def test_standing_day_totals_start_afresh(spark, batches, folder):
    query, mode, fields = STANDING["tripsTotalStream"]
    for day, fare in (("2024-04-13", 10), ("2024-04-14", 5), ("2024-04-14", 1)):
        batches.add(on(day, fare))
        run(spark, query(parse(batches.stream(spark), fields)), folder, mode=mode)
    days = latest(spark.read.parquet(str(folder / "out")), ["day"]).orderBy("day").collect()
    assert [(r["trips_total"], r["fare_total"]) for r in days] == [(1, 10.0), (2, 6.0)]


@pytest.mark.parametrize("hot_keys", [True, False])
def test_trips_without_an_id_are_not_copies(spark, batches, folder, hot_keys):
    batches.add(at("10:00:00"), at("10:00:00"), at("10:00:01", trip_id="a"), "bad")
    batches.add(at("10:00:00"), at("10:00:01", trip_id="a"))
    unique = dedupe(parse(batches.stream(spark)), hot_keys=hot_keys)
    path = str(folder / "out")
    run_to_end(unique, name="q", mode="append", sink=file_sink(path), checkpoints=str(folder / "c"))
    rows = spark.read.parquet(path)
    assert rows.columns == unique.columns and "__sole" not in rows.columns
    assert rows.filter("trip_id = 'a'").count() == 1
    assert rows.filter("trip_id IS NULL AND event_timestamp IS NOT NULL").count() == 3


@pytest.mark.parametrize("hot_keys", [True, False])
def test_dedupe_within_watermark(spark, batches, folder, hot_keys):
    first, second = at("10:00:00", trip_id="a"), at("10:00:01", trip_id="b")
    batches.add(first, first)
    batches.add(first, second)
    unique = dedupe(parse(batches.stream(spark)), hot_keys=hot_keys)
    path = str(folder / "out")
    run_to_end(unique, name="q", mode="append", sink=file_sink(path), checkpoints=str(folder / "c"))
    assert sorted(r["trip_id"] for r in spark.read.parquet(path).collect()) == ["a", "b"]


def test_restart_goes_on_from_the_checkpoint(spark, batches, folder):
    batches.add(at("10:00:01"))
    run(spark, fare_totals(parse(batches.stream(spark))), folder)
    batches.add(at("10:00:02"))
    query = run(spark, fare_totals(parse(batches.stream(spark))), folder)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    assert emitted(spark, folder / "out")[-1][1] == 2.0


def test_a_repeated_batch_does_not_count_twice(spark, folder):
    path = str(folder / "out")
    writers = []

    class Writer:
        def foreachBatch(self, write):
            writers.append(write)
            return self

    versioned_sink(path, files=1)(Writer(), 5)
    rows = spark.createDataFrame([("w", 1)], "window STRING, total BIGINT")
    writers[0](rows, 3)
    # Who reads the folder as a stream has taken the batch before it is repeated.
    onward = spark.readStream.schema("window STRING, total BIGINT").option("recursiveFileLookup", True).parquet(path)
    sink, checkpoints = file_sink(str(folder / "onward")), str(folder / "c")
    run_to_end(onward, name="onward", mode="append", sink=sink, checkpoints=checkpoints)
    writers[0](rows, 3)
    run_to_end(onward, name="onward", mode="append", sink=sink, checkpoints=checkpoints)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("w", 1, 5, 3)]
    assert spark.read.parquet(str(folder / "onward")).count() == 1


def test_a_new_checkpoint_leaves_what_is_there(spark, batches, folder):
    batches.add(at("10:00:01"))
    for checkpoints in ("one", "two"):
        totals = fare_totals(parse(batches.stream(spark)))
        sink = versioned_sink(str(folder / "out"))
        run_to_end(totals, name="q", mode="update", sink=sink, checkpoints=str(folder / checkpoints))
        batches.add(at("10:00:02"))
    versions = spark.read.parquet(str(folder / "out"))
    assert versions.select(RUN).distinct().count() == 2
    assert latest(versions, ["window"]).first()["total_fare"] == 2.0


def test_equal_rows_of_a_table_have_ids_of_their_own(spark, folder):
    path, writers = str(folder / "t"), []

    class Writer:
        def foreachBatch(self, write):
            writers.append(write)

    rows = spark.createDataFrame([("w", 1.0)] * 3 + [("v", 2.0)], "window STRING, total_fare DOUBLE")
    table_sink(path, SUM_FARE_WINDOW)(Writer(), 7 << 40)
    for batch in (0, 1, 1):
        writers[0](rows, batch)
    found = [r["id"] for r in read_table(spark, path, SUM_FARE_WINDOW).collect()]
    assert len(found) == 8 == len(set(found))
    table_sink(str(folder / "again"), SUM_FARE_WINDOW)(Writer(), 7 << 40)
    for batch in (0, 1):
        writers[1](rows.orderBy("window"), batch)
    assert sorted(found) == sorted(r["id"] for r in read_table(spark, str(folder / "again"), SUM_FARE_WINDOW).collect())


def test_a_crash_after_the_write_neither_loses_nor_doubles(spark, batches, folder):
    """The sink has written when the query dies; the restart repeats the batch over what it wrote."""
    batches.add(at("10:00:01"), at("10:00:01"))
    path, crashes = str(folder / "out"), [True]

    def sink(writer, run):
        writes = []

        class Grab:
            def foreachBatch(self, write):
                writes.append(write)
                return self

        versioned_sink(path)(Grab(), run)

        def write_then_crash(rows, batch):
            writes[0](rows, batch)
            if crashes.pop() if crashes else False:
                raise RuntimeError("executor and driver are gone")

        return writer.foreachBatch(write_then_crash)

    def attempt():
        totals = fare_totals(parse(batches.stream(spark)))
        return run_to_end(totals, name="q", mode="update", sink=sink, checkpoints=str(folder / "c"))

    with pytest.raises(Exception, match="are gone"):
        attempt()
    attempt()
    assert emitted(spark, path) == [(0, 2.0)]
    batches.add(at("10:00:02"))
    attempt()
    assert [total for _, total in emitted(spark, path)] == [2.0, 3.0]


def test_result_table_has_a_row_and_an_id_per_emission(spark, batches, folder):
    batches.add(at("10:00:01", tips=1, trip_total=2))
    batches.add(at("10:00:02", tips=1, trip_total=2))
    path = str(folder / "table")
    totals = fare_totals(parse(batches.stream(spark)))
    run_to_end(
        totals, name="q", mode="update", sink=table_sink(path, SUM_FARE_WINDOW), checkpoints=str(folder / "c")
    )
    table = read_table(spark, path, SUM_FARE_WINDOW)
    assert table.columns == SUM_FARE_WINDOW.schema.names
    rows = table.orderBy("id").collect()  # ids ascend with the batches
    assert [r["total_fare"] for r in rows] == [1.0, 2.0]
    assert len({r["id"] for r in rows}) == 2 and all(len(r["id"]) == 36 for r in rows)
    window = json.loads(rows[0]["window"])
    assert window["start"].startswith("2024-04-13T10:00:00.000")


def test_folded_versions(spark, folder):
    path, target = str(folder / "v"), str(folder / "folded")
    for batch, total in enumerate((1, 2, 3)):
        rows = spark.createDataFrame([("w", total), (f"only{batch}", 0)], "window STRING, total BIGINT")
        rows.write.parquet(f"{path}/{RUN}=1/{BATCH}={batch}")
    fold_versions(spark, path, target, ["window"], last=(1, 1))
    folded = spark.read.parquet(target)
    assert {(r["window"], r["total"], r[BATCH]) for r in folded.collect()} == {("w", 2, 1), ("only0", 0, 1), ("only1", 0, 1)}
    now = {("w", 3), ("only0", 0), ("only1", 0), ("only2", 0)}
    for folds in (target, None):
        assert {(r["window"], r["total"]) for r in read_latest(spark, path, ["window"], folds).collect()} == now
    recent = read_latest(spark, path, ["window"], target).inputFiles()
    assert recent and all("batch_id=0" not in f for f in recent)
    fold_versions(spark, path, target, ["window"])
    assert {(r["window"], r["total"]) for r in read_latest(spark, path, ["window"], target).collect()} == now
    assert [v for v, _ in versions_between(spark, target)] == [(1, 1), (1, 2)]
    fold_versions(spark, path, target, ["window"])  # nothing new
    assert len(versions_between(spark, target)) == 2


def test_two_tenants_do_not_double_results(spark, batches, folder):
    batches.add(at("10:00:01", pickup_community_area=1))
    queries = []
    for tenant in ("one", "two"):
        queries += start_tenant(
            lambda fields: parse(batches.stream(spark), fields),
            tenant,
            lambda topic: versioned_sink(str(folder / topic)),
            str(folder / "checkpoints"),
            trigger={"availableNow": True},
        )
    assert len({query.name for query in queries}) == 8
    await_all(queries, poll_seconds=0.1)
    for tenant in ("one", "two"):
        assert emitted(spark, folder / f"{tenant}_sumFareWindowStream") == [(0, 1.0)]
    assert set(RESULT_TOPICS) == set(STANDING) and len(STANDING) == 4


def test_a_failed_query_is_seen_at_once_and_stops_the_others(spark, batches, folder):
    batches.add(at("10:00:01"))

    def fail(rows, batch):
        raise RuntimeError("sink is gone")

    trips = parse(batches.stream(spark))
    healthy = start(
        fare_totals(trips), name="healthy", mode="update", sink=versioned_sink(str(folder / "a")), checkpoints=str(folder / "c")
    )
    broken = start(
        fare_totals(trips), name="broken", mode="update", sink=lambda w, run: w.foreachBatch(fail), checkpoints=str(folder / "c")
    )
    with pytest.raises(Exception, match="sink is gone"):
        await_all([healthy, broken], poll_seconds=0.1)
    assert not healthy.isActive


def test_stop_keeps_the_checkpoint(spark, batches, folder):
    batches.add(at("10:00:01"))
    query = start(
        fare_totals(parse(batches.stream(spark))),
        name="standing",
        mode="update",
        sink=versioned_sink(str(folder / "out")),
        checkpoints=str(folder / "c"),
        trigger={"processingTime": "1 second"},
    )
    query.processAllAvailable()
    stop_session_queries(spark)
    assert not spark.streams.active
    assert (folder / "c" / "standing" / "offsets").exists()


def test_progress_log_and_reports(spark, batches, folder):
    batches.add(at("10:00:01"))
    log = ProgressLog(spark, str(folder / "log"))
    spark.streams.addListener(log)
    try:
        log.wait([run(spark, fare_totals(parse(batches.stream(spark))), folder, name="logged")])
    finally:
        spark.streams.removeListener(log)
    rows = progress_rows(progress_log(spark, str(folder / "log")))
    report = query_progress(rows).filter("query_name = 'logged'").first()
    assert report["input_rows"] == 1 and report["batches"] >= 1 and report["state_rows"] == 1
    assert "addBatch" in {r["operation"] for r in operation_times(rows).collect()}
    assert log.ended().first()["failure"] is None
