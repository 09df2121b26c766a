"""Late trips, late copies, landing folders, merged progress, outliers and the types of records."""

from __future__ import annotations

import datetime as dt
import json
import shutil

import pytest
from pyspark.sql import functions as F

from hackney import app
from hackney.functions.records import parse
from hackney.operators.compat import compatibility, field_types, merge_types, merged_class
from hackney.operators.quality import amount_fences, amount_sketch, drop_outliers
from hackney.operators.sketch import level, quantiles, sketch
from hackney.schemas import DOUBLE, TEXT, TIME, schema_of
from hackney.streaming.commits import Commits
from hackney.streaming.landing import Landing
from hackney.streaming.late import CorrectedTotals
from hackney.streaming.progress import merge_progress, progress_log
from hackney.streaming.topics import Folders
from hackney.streaming.unique import UniqueTrips
from tests.test_files import FULL, with_cell, write

SCHEMA = "trip_id STRING, event_timestamp TIMESTAMP, fare DOUBLE, tips DOUBLE, trip_total DOUBLE, tenant_id STRING"


def trips(spark, *rows):
    """(id, minute, fare, tenant)."""
    cells = [(i, None if m is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), f, 0.0, f, t) for i, m, f, t in rows]
    return spark.createDataFrame(cells, SCHEMA)


class Crash(Exception):
    pass


def totals_of(made):
    return {
        (r["window_start"].minute, r["tenant_id"]): (r["total_fare"], r["trips"], r["late_trips"], r["closed"])
        for r in made.totals(scale=2).collect()
    }


def test_late_trips_are_listed_and_added(spark, folder):
    made = CorrectedTotals(spark, str(folder / "t"), "5 minutes", "10 minutes", ["tenant_id"], buckets=4)
    made.add(trips(spark, ("a", 1, 1.0, "x"), ("b", 2, 2.0, None), ("c", None, 9.0, "x")), 1, 0)
    assert totals_of(made) == {(0, "x"): (1.0, 1, 0, False), (0, None): (2.0, 1, 0, False)}
    made.add(trips(spark, ("d", 21, 4.0, "x")), 1, 1)
    # The watermark is at minute 11 now; what came with it was judged by the one before.
    made.add(trips(spark, ("e", 3, 8.0, "x"), ("f", 12, 16.0, "x"), ("g", 4, 32.0, None)), 1, 2)
    want = {
        (0, "x"): (9.0, 2, 1, True), (0, None): (34.0, 2, 1, True), (20, "x"): (4.0, 1, 0, False), (10, "x"): (16.0, 1, 0, False),
    }
    assert totals_of(made) == want
    assert sorted(r["trip_id"] for r in made.late().collect()) == ["e", "g"]
    made.add(trips(spark, ("e", 3, 8.0, "x")), 1, 2)  # the same batch again
    made.fold()
    assert totals_of(made) == want and made.late().count() == 2


def test_a_crash_between_totals_and_manifest(spark, folder, monkeypatch):
    made = CorrectedTotals(spark, str(folder / "t"), "5 minutes", "10 minutes", ["tenant_id"], buckets=2)
    made.add(trips(spark, ("a", 30, 1.0, "x")), 1, 0)
    inner = Commits.commit

    def commit(self, name, body):
        if self.root.endswith("late"):
            raise Crash
        return inner(self, name, body)

    with monkeypatch.context() as patch:
        patch.setattr(Commits, "commit", commit)
        with pytest.raises(Crash):
            made.add(trips(spark, ("b", 1, 2.0, "x")), 1, 1)
    made.add(trips(spark, ("b", 1, 2.0, "x")), 1, 1)
    assert totals_of(made) == {(30, "x"): (1.0, 1, 0, False), (0, "x"): (2.0, 1, 1, True)}
    assert made.late().count() == 1


def test_copies_that_come_days_later(spark, folder):
    store = UniqueTrips(spark, str(folder / "u"))
    day = 24 * 60
    store.add(trips(spark, ("a", 1, 1.0, "x"), ("b", 2, 2.0, "x"), ("a", 1, 1.0, "x"), (None, 3, 3.0, "x"), (None, 3, 3.0, "x")), 1, 0)
    store.add(trips(spark, ("c", day, 1.0, "x"), ("d", None, 1.0, "x")), 1, 1)
    assert store.opened == []
    store.relist()
    store.add(trips(spark, ("a", 1, 1.0, "x"), ("e", 9 * day, 1.0, "x"), ("f", 5, 1.0, "x"), ("d", None, 1.0, "x"), (None, 3, 3.0, "x")), 2, 0)
    # Only days on which a copy may be have been opened.
    assert store.opened == ["2024-01-01", "none"]
    assert not store.add(trips(spark, ("g", 1, 1.0, "x")), 2, 0)
    ids = sorted(r["trip_id"] or "" for r in store.read().collect())
    assert ids == ["", "", "", "a", "b", "c", "d", "e", "f"]
    assert {r["trip_id"] for r in store.read(["2024-01-10"]).collect()} == {"e"}


def test_a_crowded_sketch_drops_copies_only(spark, folder):
    store = UniqueTrips(spark, str(folder / "u"), bits=32_768)
    first = spark.range(30_000).selectExpr("concat('t', id) AS trip_id", "TIMESTAMP '2024-01-01 00:00:00' AS event_timestamp")
    second = spark.range(20_000, 60_000).selectExpr("concat('t', id) AS trip_id", "TIMESTAMP '2024-01-01 00:00:00' AS event_timestamp")
    for n, part in enumerate((first, second)):
        store.add(part, 1, n)
    assert store.read().count() == store.read().distinct().count() == 60_000
    with pytest.raises(ValueError, match="32768 bits"):
        UniqueTrips(spark, str(folder / "u")).read()


def landing(spark, folder, share):
    def make(raw):
        return raw.select("tenant_id", "trip_id")

    return Landing(spark, str(folder / "landing"), str(folder / "landed"), make, share)


def test_two_tenants_progress_together(spark, folder):
    for n in range(5):
        write(folder / "landing" / "big" / "in" / f"{n}.csv", with_cell("trip_id", f"big{n}"))
    write(folder / "landing" / "small" / "in" / "0.csv", FULL)
    made = landing(spark, folder, share=2)
    assert made.waiting().count() == 6
    assert made.take().files == {"big": 2, "small": 1}
    write(folder / "landing" / "small" / "in" / "1.csv", with_cell("trip_id", "later"))
    assert made.take().files == {"big": 2, "small": 1}
    assert made.take().files == {"big": 1} and made.take() is None
    got = sorted((r["tenant_id"], r["trip_id"]) for r in made.records().collect())
    assert got == [*(("big", f"big{n}") for n in range(5)), ("small", "later"), ("small", "trip-0001")]


def test_a_file_delivered_twice_counts_once(spark, folder, monkeypatch):
    home = folder / "landing" / "a" / "in"
    write(home / "0.csv", FULL)
    shutil.copy(home / "0.csv", home / "copy.csv")
    write(folder / "landing" / "b" / "in" / "0.csv", FULL)  # another tenant's own
    made = landing(spark, folder, share=10)

    def die(*_):
        raise Crash

    with monkeypatch.context() as patch:
        patch.setattr(Commits, "commit", die)
        with pytest.raises(Crash):
            made.take()
    assert made.take().files == {"a": 2, "b": 1}
    shutil.copy(home / "0.csv", home / "third.csv")
    (home / "0.csv").touch()  # delivered again under its own name
    assert made.take().files == {"a": 2}
    assert sorted(r["tenant_id"] for r in made.records().collect()) == ["a", "b"]
    assert made.ledger().filter("counts").count() == 2 and made.waiting().count() == 0


def test_landing_job(spark, folder, capsys):
    for n in range(3):
        write(folder / "landing" / "a" / "in" / f"{n}.csv", with_cell("trip_id", f"a{n}"), with_cell("company", ""))
    write(folder / "landing" / "b" / "in" / "0.csv", FULL)
    topics = str(folder / "topics")
    arguments = ["land", "--topics", topics, "--landing", str(folder / "landing"), "--tables", str(folder / "t"), "--share", "2"]
    app.main(arguments, spark)
    app.main(arguments, spark)
    assert capsys.readouterr().out.split("\n")[:2] == ["batch 1: 2 of a, 1 of b", "batch 2: 1 of a"]

    def sent(tenant):
        rows = parse(Folders(topics).read(spark, f"{tenant}_ingestData", stream=False), keep=())
        return sorted(r["trip_id"] for r in rows.collect())

    assert sent("a") == ["a0", "a1", "a2"] and sent("b") == ["trip-0001"]


def records(folder, numbers):
    (folder / "progress").mkdir(parents=True, exist_ok=True)
    for n in numbers:
        (folder / "progress" / f"run-{n:012d}").write_text(json.dumps({"name": "q", "batchId": n, "numInputRows": n}) + "\n")


def total(spark, folder):
    rows = [json.loads(r["progress"])["numInputRows"] for r in progress_log(spark, str(folder)).collect()]
    return len(rows), sum(rows)


def test_progress_of_a_thousand_batches_in_few_files(spark, folder, monkeypatch):
    path = str(folder)
    for n in range(10):
        records(folder, range(100 * n, 100 * (n + 1)))
        if n == 4:  # a crash between merge and manifest
            def die(*_):
                raise Crash

            with monkeypatch.context() as patch:
                patch.setattr(Commits, "commit", die)
                with pytest.raises(Crash):
                    merge_progress(spark, path)
            assert total(spark, folder) == (500, sum(range(500)))
        if n == 7:  # a crash between manifest and deletion
            before = sorted((folder / "progress").glob("run-*"))
            kept = {f.name: f.read_text() for f in before}
            assert merge_progress(spark, path) == 100
            for name, text in kept.items():
                (folder / "progress" / name).write_text(text)
            assert total(spark, folder) == (800, sum(range(800)))
            continue
        assert merge_progress(spark, path) == 100
    assert total(spark, folder) == (1000, sum(range(1000)))
    assert merge_progress(spark, path) == 0
    # Small files are gone, and one merged file counts.
    assert not list((folder / "progress").glob("run-*"))
    assert len(Commits(spark, f"{path}/merged").last()[1]["files"]) == 1
    records(folder, [1000])
    assert merge_progress(spark, path) == 0 and total(spark, folder) == (1001, sum(range(1001)))
    assert merge_progress(spark, path, at_least=1, most=10) == 1
    assert total(spark, folder) == (1001, sum(range(1001)))


def test_levels_and_quantiles(spark):
    numbers = [0, 1, 255, 256, 257, 511, 512, 1023, 10**15 + 7, -257, -3]
    rows = spark.createDataFrame([(n,) for n in numbers] + [(None,)], "v BIGINT")
    got = {r["v"]: r["l"] for r in rows.select("v", level(F.col("v")).alias("l")).collect()}
    for n in numbers:
        cut = max(0, abs(n).bit_length() - 8)
        assert got[n] == (abs(n) >> cut << cut) * (-1 if n < 0 else 1)
    assert got[None] is None
    many = spark.range(1, 1001).selectExpr("id AS v", "id % 2 AS g")
    parts = [sketch(many.filter(f"v % 3 = {k}"), {"v": F.col("v")}, ["g"]) for k in range(3)]
    found = quantiles(parts[0].unionByName(parts[1]).unionByName(parts[2]), {"q": 0.5, "all": 1.0}, ["g"]).collect()
    for r in found:
        assert r["many"] == 500 and 0.992 * 499 <= r["q"] <= 501 and 0.992 * 999 <= r["all"] <= 1000


def test_outliers_go_and_two_runs_are_equal(spark):
    rows = [(f"t{n}", g, 10.0 + n % 7, 12.0) for g in ("a", None) for n in range(200)]
    rows += [("odd", "a", 500.0, 12.0), ("odd", None, -80.0, 12.0), ("odd", "a", 12.0, 9000.0), ("none", "a", None, None), ("nan", "a", float("nan"), 12.0)]
    rows += [("alone", "b", 10**6 * 1.0, 12.0)]
    df = spark.createDataFrame(rows, "trip_id STRING, area STRING, fare DOUBLE, trip_total DOUBLE")
    found = [sorted(r["trip_id"] for r in drop_outliers(x, ["area"]).collect()) for x in (df, df.repartition(7, "fare"))]
    assert found[0] == found[1] == sorted([*(r[0] for r in rows if r[0] not in ("odd",))])
    # Fences of earlier trips hold for later ones; a group without fences keeps all.
    fences = amount_fences(amount_sketch(df, ["area"]), ["area"])
    later = spark.createDataFrame([("x", "a", 499.0, 12.0), ("y", "a", 11.0, 12.0), ("z", "new", 499.0, 12.0)], df.schema)
    assert sorted(r["trip_id"] for r in drop_outliers(later, ["area"], fences=fences).collect()) == ["y", "z"]
    assert drop_outliers(df.limit(0), ["area"]).count() == 0


def test_types_of_records(spark):
    texts = [
        '{"a": 1, "b": 1.5, "c": "x", "t": "2024-01-01 10:00:00", "o": {"k": 1}, "l": [1], "n": null, "u": true}',
        '{"a": 3000000000, "b": 2, "c": "2024-01-01", "t": "2024-02-01", "y": "2024"}',
        "broken", "[1]", None, "{}", '{"m": 1}', '{"m": "1"}',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    report = merge_types(field_types(df.limit(4)).unionByName(field_types(df.subtract(df.limit(4)))))
    types = {r["field"]: (r["present"], r["nulls"], r["found"]) for r in report.withColumn("found", merged_class(F.col("mask"))).collect()}
    assert types == {
        "a": (2, 0, "whole"), "b": (2, 0, "number"), "c": (2, 0, "text"), "t": (2, 0, "time"), "o": (1, 0, "object"),
        "l": (1, 0, "list"), "n": (1, 1, "nothing"), "u": (1, 0, "boolean"), "y": (1, 0, "text"), "m": (2, 0, "text"),
    }
    from pyspark.sql import types as T

    old = schema_of(a=T.IntegerType(), b=DOUBLE, c=TEXT, t=TEXT, n=DOUBLE, u=TIME, z=TEXT)
    rows = compatibility(field_types(df), {"old": old}).collect()
    got = {r["field"]: (r["status"], r["old_reads_new"], r["new_reads_old"]) for r in rows}
    assert got == {
        "a": ("widened", False, True), "b": ("same", True, True), "c": ("same", True, True), "t": ("narrowed", True, False),
        "u": ("widened", False, False), "n": ("lost", True, False), "z": ("lost", True, False), "o": ("added", True, True),
        "l": ("added", True, True), "y": ("added", True, True), "m": ("added", True, True),
    }
    assert field_types(df.limit(0)).count() == 0
