"""Progress records of streaming queries as a table."""

from __future__ import annotations

import json
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from hackney.sources.store import hadoop_files
from hackney.streaming.commits import Commits, files_of, listed

SCHEMA = "progress STRING"


def _as_json(progress) -> str:
    return progress if isinstance(progress, str) else progress.json


def progress_table(spark: SparkSession, queries: Iterable[StreamingQuery]) -> DataFrame:
    """The last progress of the given queries: one JSON text per micro-batch.

    Spark keeps the last 100 per query (``spark.sql.streaming.numRecentProgressUpdates``); totals
    need a ``ProgressLog``.
    """
    return spark.createDataFrame([(_as_json(p),) for query in queries for p in query.recentProgress], SCHEMA)


class ProgressLog(StreamingQueryListener):
    """Keeps every progress record, and how queries ended, in two folders.

    Each record is a small file that is there before the next one comes, written without a Spark job.
    ``merge_progress`` brings them together from time to time.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path
        self._ended: set[str] = set()

    def _put(self, name: str, text: str) -> None:
        files, make = hadoop_files(self._spark, self._path)
        out = files.create(make(f"{self._path}/{name}"), True)
        try:
            out.write(bytearray((text + "\n").encode()))
        finally:
            out.close()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        # Batches without input report under the number of the next one.
        self._put(f"progress/{progress.runId}-{progress.batchId:012d}-{progress.timestamp.replace(':', '')}", progress.json)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        ended = {"id": str(event.id), "run_id": str(event.runId), "failure": event.exception}
        self._put(f"ended/{event.runId}", json.dumps(ended))
        self._ended.add(str(event.runId))

    def wait(self, queries: Iterable[StreamingQuery], seconds: float = 60) -> None:
        """Until all that the ended queries have reported is kept."""
        runs, until = {str(query.runId) for query in queries}, time.monotonic() + seconds
        while not runs <= self._ended:
            if time.monotonic() > until:
                raise TimeoutError(f"no end reported of {sorted(runs - self._ended)}")
            time.sleep(0.05)

    def progress(self) -> DataFrame:
        """All progress records: one JSON text per micro-batch."""
        return progress_log(self._spark, self._path)

    def ended(self) -> DataFrame:
        return self._spark.read.schema("id STRING, run_id STRING, failure STRING").json(f"{self._path}/ended")


def progress_log(spark: SparkSession, path: str) -> DataFrame:
    """The progress records that a ``ProgressLog`` has kept in a folder: those merged, and the small files since."""
    names = _small(spark, path)
    body = (Commits(spark, f"{path}/merged").last() or ("", {"files": [], "gone": []}))[1]
    merged = Commits(spark, f"{path}/merged").read(files_of(body), T.StructType().add("progress", "string"))
    # Files that the last merge holds and that are still there, after a crash, do not count again.
    gone = set(body["gone"])
    left = [f"{path}/progress/{name}" for name in names if name not in gone]
    return merged.unionByName(spark.read.text(left).select(F.col("value").alias("progress"))) if left else merged


def _small(spark: SparkSession, path: str) -> list[str]:
    files, make = hadoop_files(spark, path)
    folder = make(f"{path}/progress")
    found = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    return sorted(name for name in found if not name.startswith((".", "_")))


def merge_progress(spark: SparkSession, path: str, at_least: int = 100, most: int = 10_000) -> int:
    """Bring the small files into the merged ones if there are ``at_least`` so many; how many were.

    The merge counts by its manifest, which names what it has taken: until then readers see the small files, and
    from then on the merged ones, whatever a crash has left. A manifest holds the merged files of all merges: a few,
    as each of them takes up the last one while that is smaller than ``most`` records. One merge at a time; queries may run.
    """
    commits, (files, make) = Commits(spark, f"{path}/merged"), hadoop_files(spark, path)
    number, body = commits.last() or ("0", {"files": [], "gone": [], "records": []})
    names = _small(spark, path)
    # What a crash has kept the last merge from deleting.
    gone = set(body["gone"])
    for name in gone & set(names):
        files.delete(make(f"{path}/progress/{name}"), False)
    names = [name for name in names if name not in gone]
    if len(names) < at_least:
        return 0
    schema = T.StructType().add("progress", "string")
    rows = spark.read.text([f"{path}/progress/{name}" for name in names]).select(F.col("value").alias("progress"))
    held, records = files_of(body), body["records"]
    while records and records[-1] < most:
        rows = rows.unionByName(commits.read([held.pop()], schema))
        records = records[:-1]
    written = commits.write(rows.coalesce(1))
    many = commits.read(written, schema).count()
    snapshot = {"files": listed([*held, *written]), "records": [*records, many], "gone": names}
    if not commits.commit(f"{int(number) + 1:012d}", snapshot):
        raise RuntimeError(f"another merge has been number {int(number) + 1}")
    for name in names:
        files.delete(make(f"{path}/progress/{name}"), False)
    return len(names)
