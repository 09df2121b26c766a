"""Tables that count by manifests: repeated batches, keyed rows, the workflow in several loads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.functions.records import parse
from hackney.operators.daily import day_report, totals_by_day
from hackney.plans.fixtures import HISTORY, event_wire, finish, history_trips, in_thirds, table
from hackney.plans.history import SQL_REVENUE_MONTH
from hackney.plans.registry import plan
from hackney.plans.windows import SQL_BY_DAY
from hackney.session import scratch
from hackney.sources.store import hadoop_files
from hackney.sources.wire import read_wire
from hackney.streaming.commits import Commits, batch_name, committed_sink, read_committed
from hackney.streaming.keyed import KeyedTable
from hackney.streaming.run import MONEY
from hackney.streaming.sinks import BATCH, RUN, Sink, emission, latest, write_records
from hackney.workflow import Workflow


def _days_in_thirds(spark: SparkSession, sf_dir: str, sink: Sink, after: Callable[[int], None]) -> None:
    """The totals of days as a stream that gets the events in thirds; ``after`` is called when it has one."""
    topic, checkpoints = scratch(spark, "topic"), scratch(spark, "checkpoints")
    for n, part in enumerate(in_thirds(table(spark, sf_dir, "events"))):
        write_records(event_wire(part), topic)
        trips = parse(read_wire(spark, "parquet", path=topic), MONEY, keep=())
        finish(totals_by_day(trips), name="days", mode="update", sink=sink, checkpoints=checkpoints)
        after(n)


@plan(SQL_BY_DAY)
def result_table_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Between the batches lie the leftovers of others that crashed: files without a manifest, and half a manifest."""
    path = scratch(spark, "days")
    commits = Commits(spark, path)

    def crash(n: int) -> None:
        rows = read_committed(spark, path).withColumn("trips", F.col("trips") * 1000)
        commits.write(rows)
        run, batch = rows.agg(F.max(F.struct(RUN, BATCH))).first()[0]
        # What the next batch will be called: it finds the beginning of its own manifest.
        files, make = hadoop_files(spark, path)
        out = files.create(make(f"{path}/_commits/{batch_name(run, batch + 1)}.json"), True)
        out.write(bytearray(b'{"files": [["files/'))
        out.close()

    _days_in_thirds(spark, sf_dir, committed_sink(path, emission), crash)
    return day_report(latest(read_committed(spark, path), ["day"]), scale=None)


@plan(SQL_BY_DAY)
def result_table_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days in buckets, folded after the first and after the second third; the last one is merged on read."""
    days = KeyedTable(spark, scratch(spark, "days"), ("day",), buckets=8)
    _days_in_thirds(spark, sf_dir, days.sink(), lambda n: days.fold() if n < 2 else None)
    return day_report(days.read().drop(RUN, BATCH), scale=None)


def _loads(trips: DataFrame) -> list[DataFrame]:
    """The first two meet in the middle of a month; the third are trips of both that come late."""
    time = F.col("event_timestamp")
    late = F.pmod(F.xxhash64("fare", "event_timestamp", "pickup_community_area"), F.lit(10)) == 0
    middle = F.lit("1997-06-15").cast("timestamp_ntz")
    return [trips.filter(~late & (time < middle)), trips.filter(~late & (time >= middle)), trips.filter(late)]


def loaded(spark: SparkSession, sf_dir: str) -> tuple[Workflow, list]:
    """The workflow over three loads, and what each run did."""
    source = scratch(spark, "trips")
    workflow, runs = Workflow(spark, source, scratch(spark, "workflow")), []
    for n, load in enumerate(_loads(history_trips(spark, sf_dir))):
        load.write.parquet(f"{source}/{n}")
        runs.append(workflow.run())
    return workflow, runs


@plan(SQL_REVENUE_MONTH)
def workflow_in_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads, each by a run of its own, give what one run over everything gives."""
    return loaded(spark, sf_dir)[0].report()


@plan(
    f"""
WITH trips AS ({HISTORY})
SELECT strftime(event_timestamp, '%Y-%m') AS "month", min(cast(event_timestamp AS date)) AS first_day,
       max(cast(event_timestamp AS date)) AS last_day, count(DISTINCT cast(event_timestamp AS date)) AS days,
       count(*) AS trips
FROM trips GROUP BY 1
"""
)
def workflow_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the record says of every month after three loads."""
    return loaded(spark, sf_dir)[0].bounds()

