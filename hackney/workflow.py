"""The batch workflow: extract, prepare, aggregate, store. Every run takes what has come since the last one.

A run lists the input, leaves out the files that earlier runs have taken, and reads the others only. What it adds up
per day is merged into the months that it touches; other months keep their files. What came in, the bounds of
every month, day totals and monthly reports count together, by one manifest: a run that crashes has not taken its
files, and the next one does. Rows that come late are new rows of an old month.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.functions.clock import EVENT_TIME
from hackney.operators.daily import SUMS, totals_by_day
from hackney.operators.history import accumulated_revenue
from hackney.operators.ingest import clean, typed_trips
from hackney.operators.quality import preprocess
from hackney.sources.files import read_trip_files
from hackney.streaming.commits import Commits, File, files_of, listed

#: Makes trips of some input files.
Extract = Callable[[SparkSession, list[str]], DataFrame]
Prepare = Callable[[DataFrame], DataFrame]
INPUTS = "path string, bytes bigint, modified timestamp, run bigint"
BOUNDS = "month string, first_day date, last_day date, days bigint, trips bigint"


def from_trip_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Complete rows of trip files, by the start of the trip."""
    trips = typed_trips(clean(read_trip_files(spark, paths)))
    return trips.withColumn(EVENT_TIME, F.col("trip_start_timestamp"))


def from_parquet(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Trips as they are stored."""
    return spark.read.parquet(*paths)


def sound(trips: DataFrame) -> DataFrame:
    """Trips with a time and without impossible amounts; a missing tip is none."""
    return preprocess(trips, required=(EVENT_TIME,), fill={"tips": 0.0})


@dataclass(frozen=True)
class Run:
    """What a run has done."""

    number: int
    taken: list[str] = field(default_factory=list)
    """Input files, which it alone has read."""
    months: list[str] = field(default_factory=list)
    """Months whose totals and reports it has written."""


@dataclass(frozen=True)
class Workflow:
    """The workflow of the trips in a folder, with its results below ``root``. One run at a time."""

    spark: SparkSession
    source: str
    root: str
    extract: Extract = from_parquet
    prepare: Prepare = sound

    @property
    def _commits(self) -> Commits:
        return Commits(self.spark, self.root)

    def _last(self) -> tuple[int, dict]:
        name, body = self._commits.last() or ("0", {"inputs": [], "totals": [], "report": [], "bounds": {}})
        return int(name), body

    def waiting(self) -> DataFrame:
        """Input files that no run has taken. Their content is not read."""
        return self._waiting(self._last()[1])

    def _waiting(self, body: dict) -> DataFrame:
        listing = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.source)
        there = listing.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
        taken = self._rows(body, "inputs", INPUTS).select("path", F.struct("bytes", "modified").alias("__taken"))
        joined = there.join(taken, "path", "left")
        # What has been added up cannot be taken off again, so a file must stay as it was.
        same = F.col("__taken") == F.struct("bytes", "modified")
        problem = F.raise_error(F.concat(F.lit("input has changed since it was taken: "), F.col("path")))
        state = F.when(F.col("__taken").isNull(), F.lit(True)).when(same, F.lit(False)).otherwise(problem.cast("boolean"))
        return joined.withColumn("__new", state).filter("__new").drop("__taken", "__new")

    def _rows(self, body: dict, dataset: str, schema: str | T.StructType) -> DataFrame:
        kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        return self._commits.read(files_of(body, dataset), kind)

    def run(self) -> Run:
        """Take the new input files. Without any, or if another run has been faster with them, nothing changes."""
        number, body = self._last()
        commits, number = self._commits, number + 1
        new = self._waiting(body).withColumn("run", F.lit(number).cast("bigint"))
        inputs = commits.write(new)
        paths = [r["path"] for r in self._commits.read(inputs, T._parse_datatype_string(INPUTS)).select("path").collect()] if inputs else []
        if not paths:
            return Run(number - 1)
        month = F.date_format("day", "yyyy-MM")
        fresh = totals_by_day(self.prepare(self.extract(self.spark, paths))).withColumn("month", month)
        # A row per day; written, so that the input is read once.
        added = commits.write(fresh)
        months = sorted(r["month"] for r in commits.read(added, fresh.schema).select("month").distinct().collect())
        totals = commits.write(self._merged(body, added, fresh.schema, months), "month")
        merged = commits.read(totals, fresh.schema)
        report = commits.write(accumulated_revenue(merged.drop("month"), "month").withColumn("month", F.date_format("period", "yyyy-MM")), "month")
        bounds = merged.groupBy("month").agg(
            F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("days"), F.sum("trips").alias("trips")
        )
        parts = {"totals": totals, "report": report}
        others = {name: [f for f in files_of(body, name) if f.part not in months] for name in parts}
        snapshot = {name: listed([*others[name], *files]) for name, files in parts.items()}
        # A row per touched month.
        touched = {r["month"]: [str(r["first_day"]), str(r["last_day"]), r["days"], r["trips"]] for r in bounds.collect()}
        snapshot["bounds"] = body["bounds"] | touched
        snapshot["inputs"] = listed([*files_of(body, "inputs"), *inputs])
        snapshot["schemas"] = {"totals": fresh.schema.jsonValue(), "report": commits.read(report, self._schema(report)).schema.jsonValue()}
        if not commits.commit(f"{number:012d}", snapshot):
            raise RuntimeError(f"another run has been number {number}; start again")
        return Run(number, paths, months)

    def _schema(self, files: list[File]) -> T.StructType:
        return self.spark.read.parquet(f"{self.root}/{files[0].path}").schema if files else T.StructType()

    def _merged(self, body: dict, added: list[File], schema: T.StructType, months: list[str]) -> DataFrame:
        """Day totals of the touched months, with what is new; sums and counts simply add up."""
        before = [f for f in files_of(body, "totals") if f.part in months]
        every = self._commits.read([*before, *added], schema)
        return every.groupBy("month", "day").agg(*[F.try_sum(name).alias(name) for name in SUMS]).select(*schema.names)

    def _dataset(self, name: str) -> DataFrame:
        _, body = self._last()
        if "schemas" not in body:
            raise ValueError(f"no run has stored anything in {self.root}")
        return self._rows(body, name, T.StructType.fromJson(body["schemas"][name]))

    def totals(self) -> DataFrame:
        """The totals of every day, for analyses of any period."""
        return self._dataset("totals").drop("month")

    def report(self) -> DataFrame:
        """Accumulated revenue by month."""
        return self._dataset("report").drop("month")

    def bounds(self) -> DataFrame:
        """Per month its first and last day, and how many days and trips it has."""
        kept = self._last()[1]["bounds"]
        rows = [(month, dt.date.fromisoformat(first), dt.date.fromisoformat(last), *more) for month, (first, last, *more) in kept.items()]
        return self.spark.createDataFrame(rows, BOUNDS)

    def inputs(self) -> DataFrame:
        """The input files that have been taken, and by which run."""
        return self._rows(self._last()[1], "inputs", INPUTS)
