"""A table of the last row per key that batches change: buckets of a base, and deltas that are merged on read.

Keys are dealt over buckets by a hash. A batch is a delta: its rows, in a file per bucket. A fold rewrites the
buckets that deltas have touched and no others, and names the base's files of all buckets, so that a reader opens one
fold and the deltas after it. All of it counts by manifests, see ``commits``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from hackney.streaming.commits import Commits, File, batch_name, files_of, listed
from hackney.streaming.sinks import BATCH, RUN, Prepare, Sink, emission

BUCKET = "bucket"
#: Sorts a fold behind the last batch that it holds.
_FOLD = "~fold"


@dataclass(frozen=True)
class State:
    """What a reader opens: the base's files, and the deltas after it."""

    base: list[File]
    deltas: list[File]
    last: str
    """The last batch or fold."""
    schema: T.StructType | None

    @property
    def touched(self) -> set[str]:
        return {f.part for f in self.deltas}


@dataclass(frozen=True)
class KeyedTable:
    """``buckets`` is fixed by the first batch; a bucket should be some hundred megabytes in the end."""

    spark: SparkSession
    path: str
    key: Sequence[str]
    buckets: int = 64

    @property
    def _commits(self) -> Commits:
        return Commits(self.spark, self.path)

    def state(self, last: str | None = None) -> State:
        """As of the batch ``last``, or now. Opens the last fold's manifest and those of the batches after it."""
        commits = self._commits
        names = [n for n in commits.names() if last is None or n.removesuffix(_FOLD) <= last]
        base, deltas, schema, at = [], [], None, ""
        for name in reversed(names):
            if name.endswith(_FOLD) and (body := commits.load(name)) is not None:
                base, at, schema = files_of(body), name, T.StructType.fromJson(body["schema"])
                self._check(body)
                break
        newest = at
        # A fold that came while later batches were written holds fewer of them than its place says.
        for name in names:
            if name > at and not name.endswith(_FOLD) and (body := commits.load(name)) is not None:
                self._check(body)
                deltas += files_of(body)
                newest, schema = name, T.StructType.fromJson(body["schema"])
        return State(base, deltas, newest, schema)

    def _check(self, body: dict) -> None:
        if body["buckets"] != self.buckets or body["key"] != list(self.key):
            raise ValueError(f"{self.path} has {body['buckets']} buckets of {body['key']}")

    def put(self, rows: DataFrame, run: int, batch_id: int) -> bool:
        """Let ``rows`` replace those of the same keys. A repeated batch changes nothing.

        Of rows with the same key in a batch none is preferred: combine them before.
        """
        dealt = emission(rows, run, batch_id).withColumn(BUCKET, F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))
        # A bucket's rows come together, so that a batch leaves a file per bucket.
        dealt = dealt.repartition(BUCKET)
        more = {"buckets": self.buckets, "key": list(self.key)}
        return self._commits.put(batch_name(run, batch_id), dealt, BUCKET, **more)

    def add(self, rows: DataFrame, run: int, batch_id: int, sums: Sequence[str]) -> bool:
        """Let ``rows`` be added to those of the same keys: the columns ``sums`` add up. A repeated batch changes nothing.

        Only the buckets of the rows' keys are read, as they were before the batch.
        """
        name = batch_name(run, batch_id)
        if self._commits.load(name) is not None:
            return False
        mine = rows.select(F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("string").alias(BUCKET)).distinct()
        buckets = {r[BUCKET] for r in mine.collect()}  # as many as there are buckets at most
        state = self.state()
        every = rows.select(*self.key, *sums)
        if state.schema is not None and buckets:
            files = [f for f in [*state.base, *state.deltas] if f.part in buckets]
            old, wanted = self._last(files, state.schema), rows.select(*[F.col(name).alias(f"__{name}") for name in self.key])
            same = reduce(and_, (old[name].eqNullSafe(wanted[f"__{name}"]) for name in self.key))
            every = every.unionByName(old.join(wanted, same, "left_semi").select(*every.columns))
        added = every.groupBy(*self.key).agg(*[F.sum(c).alias(c) for c in sums])
        return self.put(added, run, batch_id)

    def sink(self, prepare: Prepare | None = None, fold_every: int | None = None) -> Sink:
        """For ``update`` and ``complete`` mode. Folds after every so many batches, so that readers merge few deltas."""

        def complete(writer: DataStreamWriter, run: int) -> DataStreamWriter:
            def write(emitted: DataFrame, batch_id: int) -> None:
                self.put(prepare(emitted, run, batch_id) if prepare else emitted, run, batch_id)
                if fold_every and batch_id % fold_every == fold_every - 1:
                    self.fold()

            return writer.foreachBatch(write)

        return complete

    def read(self) -> DataFrame:
        """The last row of each key, with the run and batch that wrote it. Only touched buckets are merged."""
        state = self.state()
        if state.schema is None:
            raise ValueError(f"nothing is committed in {self.path}")
        return self._merged(state, set()).drop(BUCKET)

    def _merged(self, state: State, only: set[str]) -> DataFrame:
        """Rows of the state, or of the buckets ``only``."""
        touched = state.touched
        quiet = [f for f in state.base if f.part not in touched and not only]
        busy = [f for f in [*state.base, *state.deltas] if f.part in touched]
        merged = self._last(busy, state.schema)
        return self._commits.read(quiet, state.schema).unionByName(merged) if quiet else merged

    def _last(self, files: list[File], schema: T.StructType) -> DataFrame:
        """The last row of each key in some files."""
        rest = F.struct(*[n for n in schema.names if n not in self.key])
        last = F.max_by(rest, F.struct(RUN, BATCH)).alias("__last")
        return self._commits.read(files, schema).groupBy(*self.key).agg(last).select(*self.key, "__last.*").select(*schema.names)

    def fold(self, last: tuple[int, int] | None = None) -> list[int]:
        """Bring the deltas up to the batch ``last`` (default: all there are) into the base; the buckets rewritten.

        Later batches may come meanwhile. A fold that crashes leaves files that do not count.
        """
        state = self.state(batch_name(*last) if last else None)
        touched = state.touched
        if not touched:
            return []
        rows = self._merged(state, touched).repartition(BUCKET)
        written = self._commits.write(rows, BUCKET)
        kept = [f for f in state.base if f.part not in touched]
        body = {"files": listed([*kept, *written]), "schema": state.schema.jsonValue(), "buckets": self.buckets, "key": list(self.key)}
        self._commits.commit(f"{state.last}{_FOLD}", body)
        return sorted(map(int, touched))

    def vacuum(self, older_than_ms: int) -> int:
        """Delete what no reader opens any more and is older than the time."""
        state = self.state()
        return self._commits.vacuum([*state.base, *state.deltas], older_than_ms)

