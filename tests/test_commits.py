"""Batches that count by manifests, keyed tables, and the workflow over several loads."""

from __future__ import annotations

import datetime as dt
import os
import time
from pathlib import Path

import pytest
from hackney.operators.daily import totals_by_day
from hackney.operators.history import accumulated_revenue
from hackney.plans.stored import loaded
from hackney.streaming.commits import Commits, batch_name, committed_sink, files_of, read_committed
from hackney.streaming.keyed import KeyedTable
from hackney.streaming.sinks import RUN
from hackney.workflow import Workflow, from_trip_files
from tests.conftest import SF_DIR
from tests.test_files import FULL, with_cell, write


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k STRING, v BIGINT")


def values(df):
    return sorted((r["k"], r["v"]) for r in df.collect())


class Crash(Exception):
    pass


def test_a_crash_after_half_the_files_and_a_repeat(spark, folder, monkeypatch):
    path = str(folder / "table")
    commits, batch = Commits(spark, path), rows(spark, ("a", 1), ("b", 2), ("c", 3), ("d", 4)).repartition(4)
    commits.put(batch_name(1, 0), rows(spark, ("z", 9)))

    def die(*_):
        raise Crash

    with monkeypatch.context() as patch:
        patch.setattr(Commits, "commit", die)
        with pytest.raises(Crash):
            commits.put(batch_name(1, 1), batch)
    # Half of the files are gone too; nothing of the batch counts.
    [counted] = {f.path.split("/")[1] for f in files_of(commits.load(batch_name(1, 0)))}
    left = [f for f in sorted((folder / "table" / "files").glob("*/part-*.parquet")) if f.parent.name != counted]
    assert len(left) == 4
    for file in left[::2]:
        file.unlink()
    assert values(read_committed(spark, path)) == [("z", 9)]
    assert commits.put(batch_name(1, 1), batch)
    assert not commits.put(batch_name(1, 1), batch)
    assert values(read_committed(spark, path)) == [("a", 1), ("b", 2), ("c", 3), ("d", 4), ("z", 9)]
    # Of two attempts at once the first to commit counts.
    late = commits.write(batch)
    assert not commits.commit(batch_name(1, 1), {"files": [[f.path, f.part] for f in late], "schema": batch.schema.jsonValue()})
    assert len(read_committed(spark, path).collect()) == 5


def test_a_manifest_that_broke_off_is_none(spark, folder):
    path = str(folder / "table")
    commits = Commits(spark, path)
    commits.put(batch_name(1, 0), rows(spark, ("a", 1)))
    broken = Path(path) / "_commits" / f"{batch_name(1, 1)}.json"
    broken.write_text('{"files": [["files/x')
    (broken.parent / f".{broken.name}.crc").unlink(missing_ok=True)
    assert commits.load(batch_name(1, 1)) is None and commits.load(batch_name(1, 2)) is None
    assert values(read_committed(spark, path)) == [("a", 1)]
    assert commits.put(batch_name(1, 1), rows(spark, ("b", 2)))
    assert values(read_committed(spark, path)) == [("a", 1), ("b", 2)]


def test_vacuum_leaves_what_counts(spark, folder):
    path = str(folder / "table")
    commits = Commits(spark, path)
    commits.put(batch_name(1, 0), rows(spark, ("a", 1)))
    commits.write(rows(spark, ("leftover", 1)))
    kept = [f for n in commits.names() for f in files_of(commits.load(n))]
    assert commits.vacuum(kept, 0) == 0
    assert commits.vacuum(kept, int(time.time() * 1000) + 60_000) == 1
    assert values(read_committed(spark, path)) == [("a", 1)]


def test_nothing_committed(spark, folder):
    with pytest.raises(ValueError, match="nothing is committed"):
        read_committed(spark, str(folder / "none"))
    Commits(spark, str(folder / "t")).put(batch_name(1, 0), rows(spark))
    assert read_committed(spark, str(folder / "t")).count() == 0


def test_stream_into_committed_batches(spark, batches, folder):
    path = str(folder / "out")
    for start in (1, 2):
        batches.add({"k": start}, {"k": start * 10})
        query = committed_sink(path, files=1)(batches.stream(spark).select("value").writeStream.option("checkpointLocation", str(folder / "c")), 7)
        query.trigger(availableNow=True).start().awaitTermination()
    assert Commits(spark, path).names() == [batch_name(7, 0), batch_name(7, 1)]
    assert read_committed(spark, path).count() == 4


def test_a_fold_rewrites_the_touched_buckets_only(spark, folder):
    table = KeyedTable(spark, str(folder / "t"), ("k",), buckets=16)
    many = [(f"k{n}", n) for n in range(500)]
    table.put(rows(spark, *many), 1, 0)
    assert len(table.fold()) == 16 and table.fold() == []
    before = {f.part: f.path for f in table.state().base}
    assert len(before) == 16
    table.put(rows(spark, ("k3", -3), ("k4", -4)), 1, 1)
    table.put(rows(spark, ("k3", -33)), 2, 0)
    want = sorted((dict(many) | {"k3": -33, "k4": -4}).items())
    assert values(table.read()) == want
    touched = table.state().touched
    assert 1 <= len(touched) <= 2
    assert sorted(map(str, table.fold())) == sorted(touched)
    after = {f.part: f.path for f in table.state().base}
    assert {b for b in before if before[b] != after[b]} == touched
    assert values(table.read()) == want and not table.state().deltas
    assert {r[RUN] for r in table.read().filter("k = 'k3'").collect()} == {2}


def test_batches_after_and_during_a_fold(spark, folder, monkeypatch):
    table = KeyedTable(spark, str(folder / "t"), ("k",), buckets=2)
    table.put(rows(spark, ("a", 1), ("b", 1)), 1, 0)
    table.put(rows(spark, ("a", 2)), 1, 1)
    # While batch 0 is folded, batch 2 comes.
    inner = Commits.write

    def write(self, *args):
        out = inner(self, *args)
        monkeypatch.setattr(Commits, "write", inner)
        table.put(rows(spark, ("b", 3)), 1, 2)
        return out

    monkeypatch.setattr(Commits, "write", write)
    table.fold(last=(1, 0))
    assert values(table.read()) == [("a", 2), ("b", 3)]
    assert len(table.state().deltas) == 2
    assert not table.put(rows(spark, ("a", 99)), 1, 1)
    table.fold()
    assert values(table.read()) == [("a", 2), ("b", 3)]
    assert table.vacuum(int(time.time() * 1000) + 60_000) >= 2
    assert values(table.read()) == [("a", 2), ("b", 3)]


def test_a_table_keeps_its_key_and_buckets(spark, folder):
    KeyedTable(spark, str(folder / "t"), ("k",), buckets=2).put(rows(spark, ("a", 1)), 1, 0)
    with pytest.raises(ValueError, match="2 buckets"):
        KeyedTable(spark, str(folder / "t"), ("k",), buckets=4).read()
    with pytest.raises(ValueError, match="nothing is committed"):
        KeyedTable(spark, str(folder / "u"), ("k",)).read()


def trips(spark, *days):
    cells = [(dt.datetime.fromisoformat(f"{d}T10:00:00"), f, 1.0, f + 1) for d, f in days]
    return spark.createDataFrame(cells, "event_timestamp TIMESTAMP_NTZ, fare DOUBLE, tips DOUBLE, trip_total DOUBLE")


def test_a_run_reads_new_files_and_writes_touched_months(spark, folder):
    source, read = str(folder / "in"), []

    def extract(session, paths):
        read.append(sorted(paths))
        return session.read.parquet(*paths)

    workflow = Workflow(spark, source, str(folder / "out"), extract)
    loads = [
        trips(spark, ("2024-01-05", 1.0), ("2024-02-10", 2.0), ("2024-03-01", 4.0)),
        trips(spark, ("2024-03-02", 8.0), ("2024-04-01", 16.0)),
        trips(spark, ("2024-01-05", 32.0), ("2024-01-06", 64.0)),
    ]
    done, every = [], None
    for n, load in enumerate(loads):
        load.coalesce(1).write.parquet(f"{source}/{n}")
        done.append(workflow.run())
        every = load if every is None else every.unionByName(load)
    assert [len(r) for r in read] == [1, 1, 1] and len({p for r in read for p in r}) == 3
    assert [d.months for d in done] == [["2024-01", "2024-02", "2024-03"], ["2024-03", "2024-04"], ["2024-01"]]
    full = accumulated_revenue(totals_by_day(every), "month")
    assert sorted(workflow.report().collect()) == sorted(full.collect())
    assert sorted(workflow.totals().collect()) == sorted(totals_by_day(every).collect())
    bounds = {r["month"]: (str(r["first_day"]), str(r["last_day"]), r["days"], r["trips"]) for r in workflow.bounds().collect()}
    assert bounds["2024-01"] == ("2024-01-05", "2024-01-06", 2, 3) and bounds["2024-03"] == ("2024-03-01", "2024-03-02", 2, 2)
    # Nothing new: nothing read, nothing written.
    again = workflow.run()
    assert (again.number, again.taken, again.months) == (3, [], []) and len(read) == 3
    assert workflow.waiting().count() == 0
    assert sorted(r["run"] for r in workflow.inputs().collect()) == [1, 2, 3]


def test_months_that_are_not_touched_keep_their_files(spark, folder):
    workflow, runs = loaded(spark, SF_DIR)
    commits = Commits(spark, workflow.root)
    first, second, third = (commits.load(f"{n:012d}") for n in (1, 2, 3))

    def by_month(body):
        return {f.part: f.path for f in files_of(body, "totals")}

    assert {m for m, p in by_month(second).items() if by_month(first).get(m) != p} == set(runs[1].months)
    assert set(runs[0].months) & set(runs[1].months) == {"1997-06"}
    assert by_month(third).keys() == {m for r in runs for m in r.months}


def test_a_run_that_crashes_has_not_taken_its_files(spark, folder, monkeypatch):
    source = str(folder / "in")
    workflow = Workflow(spark, source, str(folder / "out"))
    trips(spark, ("2024-01-05", 1.0)).write.parquet(f"{source}/0")
    workflow.run()
    trips(spark, ("2024-01-06", 2.0)).write.parquet(f"{source}/1")

    def die(*_):
        raise Crash

    with monkeypatch.context() as patch:
        patch.setattr(Commits, "commit", die)
        with pytest.raises(Crash):
            workflow.run()
    assert [r["trips_total"] for r in workflow.report().collect()] == [1]
    assert workflow.run().number == 2
    assert [(r["trips_total"], r["fare_total"]) for r in workflow.report().collect()] == [(2, 3.0)]
    # Of two runs at once one is refused.
    trips(spark, ("2024-01-07", 4.0)).write.parquet(f"{source}/2")
    inner = Commits.commit

    def commit(self, name, body):
        monkeypatch.setattr(Commits, "commit", inner)
        workflow.run()
        return inner(self, name, body)

    monkeypatch.setattr(Commits, "commit", commit)
    with pytest.raises(RuntimeError, match="another run"):
        workflow.run()
    assert [(r["trips_total"], r["fare_total"]) for r in workflow.report().collect()] == [(3, 7.0)]


def test_an_input_that_changes_is_refused(spark, folder):
    source = folder / "in"
    workflow = Workflow(spark, str(source), str(folder / "out"))
    trips(spark, ("2024-01-05", 1.0)).coalesce(1).write.parquet(f"{source}/0")
    workflow.run()
    [file] = source.glob("0/part-*.parquet")
    os.utime(file, (1, 1))
    with pytest.raises(Exception, match="input has changed"):
        workflow.run()


def test_trip_files_as_input(spark, folder):
    write(folder / "in" / "a.csv", FULL, with_cell("fare", "-5"))
    workflow = Workflow(spark, str(folder / "in"), str(folder / "out"), from_trip_files)
    assert len(workflow.run().taken) == 1
    [month] = workflow.report().collect()
    assert month["trips_total"] == 1


def test_no_trips_in_new_files(spark, folder):
    workflow = Workflow(spark, str(folder / "in"), str(folder / "out"))
    trips(spark).write.parquet(str(folder / "in" / "0"))
    done = workflow.run()
    assert done.months == [] and workflow.report().count() == 0
    assert workflow.totals().count() == 0
