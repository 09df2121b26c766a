"""Trips stored once, however late a copy comes.

Trips are stored by day. Beside each day's trips lies a sketch of their keys, a bitmap by a hash of the key; bitmaps
of several batches are one by an OR. Of a batch, only keys whose bit is set can be copies: for those, and only on
the days they are of, stored keys are opened and the copies dropped. A batch of fresh trips opens none.

A copy is a trip with the same key and the same day, as a repeated record has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from hackney.functions.clock import EVENT_TIME
from hackney.streaming.commits import Commits, File, batch_name, files_of, listed
from hackney.streaming.sinks import Sink

DAY, NO_DAY = "__day", "none"
#: Bits of a bitmap, as Spark's own functions have them.
PAGE = 32_768
SKETCH = f"{DAY} string, page bigint, bitmap binary"
_LISTING = "~list"


@dataclass(frozen=True)
class UniqueTrips:
    """``bits`` of a day's sketch, some ten per trip of a day, in whole pages; fixed by the first batch.

    Rows without a key (or part of it) are no copies of each other and all stay.
    """

    spark: SparkSession
    path: str
    key: Sequence[str] = ("trip_id",)
    event_time: str = EVENT_TIME
    bits: int = 64 * PAGE
    opened: list[str] = field(default_factory=list)
    """Days whose stored keys batches have opened; for those who watch."""

    @property
    def _commits(self) -> Commits:
        return Commits(self.spark, self.path)

    def sink(self) -> Sink:
        """For a stream of trips."""

        def complete(writer: DataStreamWriter, run: int) -> DataStreamWriter:
            return writer.foreachBatch(lambda trips, batch_id: self.add(trips, run, batch_id))

        return complete

    def _state(self) -> dict:
        """What the last listing names and the batches after it."""
        commits = self._commits
        names, state, at = commits.names(), {"files": [], "sketch": [], "schema": None}, ""
        for name in reversed(names):
            if name.endswith(_LISTING) and (body := commits.load(name)) is not None:
                state, at = dict(body), name
                break
        for name in names:
            if name > at and not name.endswith(_LISTING) and (body := commits.load(name)) is not None:
                state = {"files": state["files"] + body["files"], "sketch": state["sketch"] + body["sketch"], "schema": body["schema"], "bits": body["bits"]}
                state["last"] = name
        if state.get("bits", self.bits) != self.bits:
            raise ValueError(f"{self.path} has sketches of {state['bits']} bits")
        return state

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.bits))

    def add(self, trips: DataFrame, run: int, batch_id: int) -> bool:
        """Store the trips of a batch that are not copies, of each other or of any before. A repeated batch changes nothing."""
        commits, name = self._commits, batch_name(run, batch_id)
        if commits.load(name) is not None:
            return False
        schema = trips.schema
        day = F.coalesce(F.date_format(self.event_time, "yyyy-MM-dd"), F.lit(NO_DAY))
        # Looked at for its days, for copies, and to be written.
        dated = trips.withColumn(DAY, day).persist()
        try:
            written, made = self._write(dated)
        finally:
            dated.unpersist()
        return commits.commit(name, {"files": listed(written), "sketch": listed(made), "schema": schema.jsonValue(), "bits": self.bits})

    def _write(self, dated: DataFrame) -> tuple[list[File], list[File]]:
        """Files of the trips that are no copies, and of the sketch of their keys."""
        commits, schema = self._commits, dated.schema
        whole = reduce(and_, (F.col(n).isNotNull() for n in self.key))
        # Of copies within the batch one stays; they are combined before the shuffle.
        single = dated.filter(whole).dropDuplicates([DAY, *self.key])
        state = self._state()
        days = {r[DAY] for r in dated.select(DAY).distinct().collect()}
        known = [f for f in files_of(state, "sketch") if f.part in days]
        if known:
            single = self._fresh(single, state, known)
        written = commits.write(single.unionByName(dated.filter(~whole)), DAY)
        if not written:
            return [], []
        slots = commits.read(written, schema).filter(whole).withColumn("__slot", self._slot())
        page = F.floor(F.col("__slot") / PAGE).cast("bigint").alias("page")
        bitmap = F.bitmap_construct_agg(F.col("__slot") % PAGE).alias("bitmap")
        return written, commits.write(slots.groupBy(DAY, page).agg(bitmap), DAY)

    def _fresh(self, single: DataFrame, state: dict, known: list[File]) -> DataFrame:
        """Trips of which no copy is stored."""
        commits = self._commits
        pages = commits.read(known, T._parse_datatype_string(SKETCH)).groupBy(DAY, "page").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        slots = single.withColumn("__slot", self._slot())
        joined = slots.withColumn("page", F.floor(F.col("__slot") / PAGE).cast("bigint")).join(pages, [DAY, "page"], "left")
        place = (F.col("__slot") % PAGE).cast("int")
        byte = F.conv(F.hex(F.substr("bitmap", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.call_function("shiftright", byte, place % 8).bitwiseAND(F.lit(1)) == 1
        marked = joined.withColumn("__maybe", F.coalesce(is_set, F.lit(False))).drop("page", "bitmap", "__slot")
        # Days on which a copy may be.
        days = {r[DAY] for r in marked.filter("__maybe").select(DAY).distinct().collect()}
        self.opened.extend(sorted(days))
        fresh = marked.filter("NOT __maybe").drop("__maybe")
        if not days:
            return fresh
        files = [f for f in files_of(state) if f.part in days]
        kinds = T.StructType([*(f for f in single.schema if f.name in self.key), T.StructField(DAY, T.StringType())])
        keys = commits.read(files, kinds)
        return fresh.unionByName(marked.filter("__maybe").drop("__maybe").join(keys, [DAY, *self.key], "left_anti").select(*fresh.columns))

    def relist(self) -> None:
        """Name all files in one manifest, so that the next start opens that and the batches after it."""
        state = self._state()
        if "last" in state:
            body = {k: state[k] for k in ("files", "sketch", "schema", "bits")}
            self._commits.commit(f"{state['last']}{_LISTING}", body)

    def read(self, days: Sequence[str] | None = None) -> DataFrame:
        """The stored trips, of some days or of all."""
        state = self._state()
        if state["schema"] is None:
            raise ValueError(f"nothing is stored in {self.path}")
        return self._commits.read([f for f in files_of(state) if days is None or f.part in days], T.StructType.fromJson(state["schema"]))
