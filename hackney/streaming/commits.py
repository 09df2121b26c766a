"""Batches that count as soon as a manifest names their files, and not before.

Files are written where no reader looks for them by listing: each attempt into a folder of its own. What makes
them count is one small manifest, created after them, that lists them. Readers open what manifests list and
nothing else, so the leftovers of a crash are never seen, and nothing is ever moved: it holds where a move is a
copy, as in object stores. A manifest that breaks off in the middle is none.

Names of batches sort in the order in which they count. There is one writer of a name at a time; of two that
race, the first manifest stays.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from hackney.sources.store import hadoop_files
from hackney.streaming.sinks import Prepare, Sink

#: Folders of manifests and of files below the root.
MANIFESTS, FILES = "_commits", "files"
_PART = "__part"


@dataclass(frozen=True)
class File:
    """A file of a batch: its path below the root, and the part of the table that it belongs to."""

    path: str
    part: str = ""


@dataclass(frozen=True)
class Commits:
    """The manifests of a folder."""

    spark: SparkSession
    root: str

    def names(self, after: str = "") -> list[str]:
        """Names that have a manifest, in order; it may have broken off, see ``load``."""
        files, path = hadoop_files(self.spark, self.root)
        folder = path(f"{self.root}/{MANIFESTS}")
        found = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        return sorted(n for n in (f.removesuffix(".json") for f in found if f.endswith(".json")) if n > after)

    def load(self, name: str) -> dict | None:
        """The manifest of that name; None if there is none or it broke off."""
        files, path = hadoop_files(self.spark, self.root)
        place = path(f"{self.root}/{MANIFESTS}/{name}.json")
        if not files.exists(place):
            return None
        stream = files.open(place)
        try:
            text = bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()
        # The line's end is the last to be written.
        return json.loads(text) if text.endswith("}\n") else None

    def last(self) -> tuple[str, dict] | None:
        """The last whole manifest."""
        for name in reversed(self.names()):
            if (body := self.load(name)) is not None:
                return name, body
        return None

    def write(self, rows: DataFrame, part: str | None = None) -> list[File]:
        """Write the rows to a new folder and return its files, which do not count yet.

        With ``part``, a column, each of its values has files of its own; the column is stored too.
        """
        folder = f"{FILES}/{uuid.uuid4().hex}"
        if part is None:
            rows.write.parquet(f"{self.root}/{folder}")
        else:
            rows.withColumn(_PART, F.col(part)).write.partitionBy(_PART).parquet(f"{self.root}/{folder}")
        return self._files(folder)

    def _files(self, folder: str) -> list[File]:
        files, path = hadoop_files(self.spark, self.root)
        listed, out = files.listFiles(path(f"{self.root}/{folder}"), True), []
        while listed.hasNext():
            place = str(listed.next().getPath())
            below = place[place.rindex(folder) :]
            *_, above, name = below.split("/")
            if not name.startswith(("_", ".")):
                out.append(File(below, above.partition("=")[2] if above.startswith(_PART) else ""))
        return sorted(out, key=lambda f: f.path)

    def commit(self, name: str, body: dict) -> bool:
        """Let the batch count. False if another attempt has come first; then that one counts."""
        files, path = hadoop_files(self.spark, self.root)
        place = path(f"{self.root}/{MANIFESTS}/{name}.json")
        broken = files.exists(place)
        if broken and self.load(name) is not None:
            return False
        try:
            out = files.create(place, broken)
        except Exception as failed:
            if "FileAlreadyExists" in str(failed):
                return False
            raise
        try:
            out.write(bytearray((json.dumps(body, sort_keys=True) + "\n").encode()))
        finally:
            out.close()
        return True

    def put(self, name: str, rows: DataFrame, part: str | None = None, **more) -> bool:
        """Write and commit a batch once. One that counts is not written again."""
        if self.load(name) is not None:
            # A stream's state must come to the end of the batch all the same.
            rows.write.format("noop").mode("overwrite").save()
            return False
        written = self.write(rows, part)
        return self.commit(name, {"files": listed(written), "schema": rows.schema.jsonValue(), **more})

    def read(self, files: Iterable[File], schema: T.StructType) -> DataFrame:
        """The rows of those files."""
        paths = [f"{self.root}/{f.path}" for f in files]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def vacuum(self, keep: Iterable[File], older_than_ms: int) -> int:
        """Delete folders of files of which ``keep`` names none and that are older than the time; how many.

        Leftovers of a running attempt are younger than any crash that counts: give it hours.
        """
        files, path = hadoop_files(self.spark, self.root)
        folder = path(f"{self.root}/{FILES}")
        kept, gone = {f.path.split("/")[1] for f in keep}, 0
        for status in files.listStatus(folder) if files.exists(folder) else []:
            if status.getPath().getName() not in kept and status.getModificationTime() < older_than_ms:
                files.delete(status.getPath(), True)
                gone += 1
        return gone


def listed(files: Iterable[File]) -> list[list[str]]:
    """Files as a manifest holds them."""
    return [[f.path, f.part] for f in files]


def files_of(body: dict, key: str = "files") -> list[File]:
    return [File(*f) for f in body[key]]


def batch_name(run: int, batch_id: int) -> str:
    """Sorts by run and then by batch."""
    return f"{run:020d}-{batch_id:012d}"


def committed_sink(path: str, prepare: Prepare | None = None, files: int | None = None) -> Sink:
    """Keep what each micro-batch emits, once, by manifests; for every output mode and any file system."""

    def complete(writer: DataStreamWriter, run: int) -> DataStreamWriter:
        def write(emitted: DataFrame, batch_id: int) -> None:
            rows = prepare(emitted, run, batch_id) if prepare else emitted
            rows = rows.repartition(files) if files else rows
            Commits(emitted.sparkSession, path).put(batch_name(run, batch_id), rows)

        return writer.foreachBatch(write)

    return complete


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the batches that count."""
    commits, files, schema = Commits(spark, path), [], None
    for name in commits.names():
        if (body := commits.load(name)) is not None:
            files += files_of(body)
            schema = T.StructType.fromJson(body["schema"])
    if schema is None:
        raise ValueError(f"nothing is committed in {path}")
    return commits.read(files, schema)

