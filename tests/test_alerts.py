"""Alerts that remember, micro-batch by micro-batch; one decode for all queries; the jobs around them."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from hackney import app
from hackney.operators.alerts import Rule, conditions, episodes
from hackney.operators.ingest import to_wire
from hackney.schemas import RESULT_TOPICS
from hackney.streaming.progress import progress_log
from hackney.streaming.run import ROCKSDB, run_to_end
from hackney.streaming.sinks import file_sink
from hackney.streaming.topics import Folders
from hackney.workflow import Workflow, from_trip_files
from tests.test_files import FULL, with_cell, write
from tests.test_records import trips

RULES = (Rule("hot", "v", 10.0), Rule("cold", "v", 0.0, below=True))


class Watch:
    """Results of an hour each, by their hour; what has been told so far, in order."""

    def __init__(self, spark, folder, batches, delay="0 seconds"):
        self.spark, self.folder, self.batches, self.delay = spark, folder, batches, delay

    def tell(self, *rows):
        """(hour, value) or (hour, value, place)."""
        self.batches.add(*[{"t": str(dt.datetime(2024, 1, 1) + dt.timedelta(hours=r[0])), "v": r[1], "place": r[2] if len(r) > 2 else None} for r in rows])
        lines = self.batches.stream(self.spark)
        parsed = lines.select(F.from_json("value", "t TIMESTAMP, v DOUBLE, place STRING").alias("r")).select("r.*")
        broken = conditions(parsed, RULES, F.col("t"), F.expr("t + INTERVAL 1 HOUR"), F.col("place"), self.delay)
        run_to_end(
            episodes(broken, dt.timedelta(minutes=90)), name="w", mode="append", sink=file_sink(str(self.folder / "out")),
            checkpoints=str(self.folder / "c"), state_partitions=2, state_store=ROCKSDB,
        )
        told = self.spark.read.parquet(str(self.folder / "out")).collect()
        hour = lambda t: (t - dt.datetime(2024, 1, 1)).total_seconds() / 3600
        return sorted((r.rule, r.subject, hour(r["at"]), r.event, hour(r["first"]), hour(r["last"]), r.value) for r in told)


def test_raise_stay_clear_and_raise_again(spark, folder, batches):
    watch = Watch(spark, folder, batches)
    raised = ("hot", "", 1.0, "raised", 0.0, 1.0, 20.0)
    assert watch.tell((0, 20.0)) == [raised]
    assert watch.tell((1, 30.0), (2, 1.0)) == [raised]
    # One sound hour within the gap is no end; the query has started anew in between.
    assert watch.tell((3, 15.0)) == [raised]
    cleared = ("hot", "", 5.5, "cleared", 0.0, 4.0, 30.0)
    assert watch.tell((4, 2.0), (6, 3.0)) == [raised, cleared]
    again = ("hot", "", 8.0, "raised", 7.0, 8.0, 11.0)
    assert watch.tell((7, 11.0)) == [raised, cleared, again]


def test_several_episodes_in_one_batch_and_subjects(spark, folder, batches):
    watch = Watch(spark, folder, batches)
    told = watch.tell((0, 10.0, "a"), (0, -1.0, "b"), (5, 12.0, "a"), (6, 13.0, "a"), (6, -3.0, "b"))
    assert told == [
        ("cold", "b", 1.0, "raised", 0.0, 1.0, -1.0), ("cold", "b", 2.5, "cleared", 0.0, 1.0, -1.0),
        ("cold", "b", 7.0, "raised", 6.0, 7.0, -3.0), ("hot", "a", 1.0, "raised", 0.0, 1.0, 10.0),
        ("hot", "a", 2.5, "cleared", 0.0, 1.0, 10.0), ("hot", "a", 6.0, "raised", 5.0, 6.0, 12.0),
    ]


def test_a_late_result_joins_two_episodes(spark, folder, batches):
    watch = Watch(spark, folder, batches, delay="1 day")
    watch.tell((0, 10.0))
    two = watch.tell((3, 10.0))
    assert [r[3] for r in two] == ["raised", "raised"]
    assert watch.tell((1.4, 50.0)) == two
    # Emitted again with another value: the worst counts.
    assert watch.tell((1.4, 60.0)) == two
    told = watch.tell((40, 0.0))
    assert [r for r in told if r[3] == "cleared"] == [("hot", "", 5.5, "cleared", 0.0, 4.0, 60.0)]


def alerts_in(spark, topics):
    rows = Folders(topics).read(spark, "acme_alertStream", stream=False).collect()
    return sorted((a["rule"], a["subject"], a["event"]) for a in (json.loads(r["value"]) for r in rows))


def test_the_jobs_from_records_to_alerts(spark, folder):
    topics, log = str(folder / "topics"), str(folder / "log")
    common = ["--tenant", "acme", "--topics", topics, "--checkpoints", str(folder / "c"), "--once"]
    days = "tripsTotalStream"
    rules = ["--rule", "rich", "sumFareWindowStream", "total_fare", "80", "--rule", "any", "hotspotCommunityPickupWindowStream", "count", "1"]
    rules += ["--rule", "day", days, "trips_total", "2", "--gap", "60"]
    for minutes in (0, 5, 10):
        later = trips(spark).selectExpr(f"event_timestamp + INTERVAL {minutes} MINUTES AS event_timestamp", "* EXCEPT (event_timestamp)")
        Folders(topics).send(to_wire(later), "acme_ingestData")
        app.main(["analyse", *common, "--decoded", str(folder / "decoded"), "--progress", log], spark)
        app.main(["watch", *common, *rules], spark)
    told = alerts_in(spark, topics)
    assert [t for t in told if t[0] == "rich"] == [("rich", "", "cleared")] * 2 + [("rich", "", "raised")] * 3
    # The day is raised once, however often its total is emitted.
    assert [t for t in told if t[0] == "day"] == [("day", "", "raised")]
    assert {t[1] for t in told if t[0] == "any"} == {"7"}
    # The records are read once, by the query that decodes them; the four others read its columns.
    read = {}
    for r in progress_log(spark, log).collect():
        p = json.loads(r["progress"])
        for source in p["sources"]:
            place = "records" if "acme_ingestData" in source["description"] else "columns" if "decoded" in source["description"] else "other"
            read.setdefault((p["name"], place), 0)
            read[p["name"], place] += source["numInputRows"]
    n = 3 * trips(spark).count()
    columns = {name: rows for (name, place), rows in read.items() if place == "columns"}
    assert {key: rows for key, rows in read.items() if key[1] != "columns"} == {("acme_decoded", "records"): n}
    # Trips without an area are left out of the scan.
    assert columns == {f"acme_{topic}": n // 2 if "Community" in topic else n for topic in RESULT_TOPICS}


def test_history_job(spark, folder, capsys):
    write(folder / "in" / "a.csv", FULL)
    arguments = ["history", "--tenant", "acme", "--files", str(folder / "in"), "--tables", str(folder / "tables")]
    app.main(arguments, spark)
    write(folder / "in" / "b.csv", with_cell("trip_id", "other"), with_cell("trip_start_timestamp", "04/01/2024 01:30:00 PM"))
    app.main(arguments, spark)
    app.main(arguments, spark)
    said = capsys.readouterr().out.split("\n")
    assert said[:3] == ["run 1: 1 files, months 2024-03", "run 2: 1 files, months 2024-03, 2024-04", "run 2: 0 files, months none"]
    report = Workflow(spark, str(folder / "in"), str(folder / "tables/acme/history"), from_trip_files).report()
    assert {str(r["period"])[:7]: r["trips_total"] for r in report.collect()} == {"2024-03": 2, "2024-04": 1}
