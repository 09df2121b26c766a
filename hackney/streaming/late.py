"""Late trips: listed, and added to the windows they belong to, closed ones too.

Every micro-batch adds its sums per window to those stored, so a total is right whenever a trip comes. What comes
behind the watermark is also listed, and its window counts how many such trips it has: a reader of closed windows
sees which of them have been corrected since. The watermark is that of the batches before, and travels in their manifests.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from hackney.functions.amounts import cents, cents_sum, rounded
from hackney.functions.clock import EVENT_TIME
from hackney.streaming.commits import Commits, batch_name, files_of
from hackney.streaming.keyed import KeyedTable
from hackney.streaming.sinks import Sink

AMOUNTS = ("fare", "tips", "trip_total")
COUNTS = ("trips", "late_trips")
START, END = "window_start", "window_end"


@dataclass(frozen=True)
class CorrectedTotals:
    """Fares per window in a folder, and the late trips beside them. ``size`` and ``delay`` are Spark intervals."""

    spark: SparkSession
    path: str
    size: str = "5 seconds"
    delay: str = "10 seconds"
    by: Sequence[str] = ()
    buckets: int = 64

    @property
    def _table(self) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.path}/windows", (START, END, *self.by), self.buckets)

    @property
    def _late(self) -> Commits:
        return Commits(self.spark, f"{self.path}/late")

    def passed(self, before: str | None = None) -> int | None:
        """The watermark after the batches so far (or before the one of that name), in milliseconds."""
        names = [n for n in self._late.names() if before is None or n < before]
        for name in reversed(names):
            if (body := self._late.load(name)) is not None:
                return body["passed"]
        return None

    def sink(self) -> Sink:
        """For a stream of trips, without a watermark of its own."""

        def complete(writer: DataStreamWriter, run: int) -> DataStreamWriter:
            return writer.foreachBatch(lambda trips, batch_id: self.add(trips, run, batch_id))

        return complete

    def add(self, trips: DataFrame, run: int, batch_id: int) -> None:
        """Take a batch of trips. A repeated one changes nothing. Trips without a time are in no window."""
        name = batch_name(run, batch_id)
        mark = self.passed(name)
        timed = trips.filter(F.col(EVENT_TIME).isNotNull()).withColumn("__window", F.window(F.col(EVENT_TIME).cast("timestamp"), self.size))
        late = F.lit(False) if mark is None else F.unix_millis("__window.end") <= F.lit(mark)
        # Read twice: for what is late, and for the sums.
        timed = timed.withColumn("__late", late).persist()
        listed = self._late.write(timed.filter("__late").drop("__late", "__window"))
        sums = self._sums(timed).persist()
        try:
            newest = sums.agg(F.max("__newest").alias("at"), F.expr(f"INTERVAL {self.delay}").alias("delay")).select(
                F.unix_millis(F.col("at") - F.col("delay")).alias("mark")
            )
            reached = newest.first()["mark"]
            self._table.add(sums.drop("__newest"), run, batch_id, [*COUNTS, *(f"{a}_{p}" for a in AMOUNTS for p in ("cents", "count"))])
        finally:
            sums.unpersist()
            timed.unpersist()
        marks = [m for m in (mark, reached) if m is not None]
        schema = trips.schema.jsonValue()
        self._late.commit(name, {"files": [[f.path, f.part] for f in listed], "schema": schema, "passed": max(marks, default=None)})

    def _sums(self, timed: DataFrame) -> DataFrame:
        amounts = [c for a in AMOUNTS for c in (cents_sum(a).alias(f"{a}_cents"), F.count(cents(a)).alias(f"{a}_count"))]
        return (
            timed.groupBy(F.col("__window.start").alias(START), F.col("__window.end").alias(END), *self.by)
            .agg(
                F.count("*").alias("trips"), F.count_if("__late").alias("late_trips"), *amounts,
                F.max(F.col(EVENT_TIME).cast("timestamp")).alias("__newest"),
            )
        )

    def totals(self, scale: int | None = 0) -> DataFrame:
        """All windows: their fares, whether the watermark has passed them, and how many of their trips came after it had."""
        mark = self.passed()
        closed: Column = F.lit(False) if mark is None else F.unix_millis(END) <= F.lit(mark)
        names = {"fare": "total_fare", "tips": "tips_fare", "trip_total": "total_trip_total"}
        amounts = [rounded(F.when(F.col(f"{a}_count") > 0, F.col(f"{a}_cents") / F.lit(100.0)), scale).alias(n) for a, n in names.items()]
        return self._table.read().select(START, END, *self.by, *amounts, *COUNTS, closed.alias("closed"))

    def late(self) -> DataFrame:
        """The trips that came behind the watermark."""
        files, schema = [], None
        for name in self._late.names():
            if (body := self._late.load(name)) is not None:
                files += files_of(body)
                schema = T.StructType.fromJson(body["schema"])
        if schema is None:
            raise ValueError(f"no batch has been taken in {self.path}")
        return self._late.read(files, schema)

    def fold(self) -> list[int]:
        """Bring the window's deltas into their buckets; see ``KeyedTable.fold``."""
        return self._table.fold()

