"""Landing folders of many tenants: each file once, and a share of each batch for every tenant.

A ledger says which files have been taken, by tenant and content. A batch takes the oldest waiting files of every tenant
up to its share, so that a tenant with a backlog does not hold up the others. Files are read where they are; nothing is
moved or deleted. Records and ledger entries of a batch count together, by one manifest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.sources.files import list_landing, read_trip_files, tenant_of
from hackney.streaming.commits import Commits, files_of, listed

TAKEN = "tenant_id string, file_name string, bytes bigint, modified timestamp, digest string, batch bigint, counts boolean"


@dataclass(frozen=True)
class Taken:
    """A batch: its number and how many files of each tenant it has."""

    batch: int
    files: dict[str, int]


@dataclass(frozen=True)
class Landing:
    """The folders ``root/<tenant>/in``, and what has been taken from them below ``path``.

    ``make`` turns raw cells, with ``tenant_id``, into what is stored. One batch at a time.
    """

    spark: SparkSession
    root: str
    path: str
    make: Callable[[DataFrame], DataFrame]
    share: int = 100

    @property
    def _commits(self) -> Commits:
        return Commits(self.spark, self.path)

    def _last(self) -> tuple[int, dict]:
        name, body = self._commits.last() or ("0", {"records": [], "ledger": [], "schema": None})
        return int(name), body

    def ledger(self) -> DataFrame:
        """All files that have been taken; ``counts`` is false for those whose content had come before."""
        return self._ledger(self._last()[1])

    def _ledger(self, body: dict) -> DataFrame:
        return self._commits.read(files_of(body, "ledger"), T._parse_datatype_string(TAKEN))

    def waiting(self) -> DataFrame:
        """Files that no batch has taken; their content is not read."""
        return self._waiting(self._last()[1])

    def _waiting(self, body: dict) -> DataFrame:
        there = list_landing(self.spark, self.root)
        known = self._ledger(body).select("tenant_id", "file_name", "bytes", "modified")
        return there.join(known, ["tenant_id", "file_name", "bytes", "modified"], "left_anti")

    def take(self) -> Taken | None:
        """The next batch; None if nothing waits."""
        number, body = self._last()
        commits, number = self._commits, number + 1
        oldest = Window.partitionBy("tenant_id").orderBy("modified", "file_name")
        chosen = self._waiting(body).withColumn("__nth", F.row_number().over(oldest)).filter(F.col("__nth") <= self.share)
        rows = chosen.select("tenant_id", "file_name").collect()  # a share per tenant
        if not rows:
            return None
        paths = {f"{self.root}/{r['tenant_id']}/in/{r['file_name']}" for r in rows}
        entries = commits.write(self._entries(sorted(paths), body, number))
        kept = commits.read(entries, T._parse_datatype_string(TAKEN))
        counted = kept.filter("counts").select("tenant_id", "file_name").collect()
        files = [f"{self.root}/{r['tenant_id']}/in/{r['file_name']}" for r in counted]
        written, schema = [], body["schema"]
        if files:
            raw = read_trip_files(self.spark, files).withColumn("tenant_id", tenant_of("_metadata.file_path"))
            records = self.make(raw)
            written, schema = commits.write(records), records.schema.jsonValue()
        snapshot = {
            "new": listed(written),
            "records": listed([*files_of(body, "records"), *written]),
            "ledger": listed([*files_of(body, "ledger"), *entries]),
            "schema": schema,
        }
        if not commits.commit(f"{number:012d}", snapshot):
            raise RuntimeError(f"another batch has been number {number}; start again")
        found = kept.groupBy("tenant_id").count().collect()
        return Taken(number, {r["tenant_id"]: r["count"] for r in found})

    def _entries(self, paths: list[str], body: dict, number: int) -> DataFrame:
        """Ledger rows of the batch's files. Of equal content of a tenant the first one counts."""
        read = self.spark.read.format("binaryFile").load(paths)
        hashed = read.select(
            tenant_of("path").alias("tenant_id"),
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("modified"),
            F.sha2("content", 256).alias("digest"),
        )
        before = self._ledger(body).filter("counts").select("tenant_id", "digest").withColumn("__before", F.lit(True))
        first = F.row_number().over(Window.partitionBy("tenant_id", "digest").orderBy("modified", "file_name")) == 1
        marked = hashed.join(before, ["tenant_id", "digest"], "left").withColumn("counts", F.col("__before").isNull() & first)
        return marked.withColumn("batch", F.lit(number).cast("bigint")).select(*[f.split()[0] for f in TAKEN.split(", ")])

    def records(self) -> DataFrame:
        """What all batches have made."""
        _, body = self._last()
        if body["schema"] is None:
            raise ValueError(f"no file has been taken from {self.root}")
        return self._commits.read(files_of(body, "records"), T.StructType.fromJson(body["schema"]))

    def batches(self, after: int = 0) -> Iterator[tuple[int, DataFrame]]:
        """The records of the batches after the one of that number, batch by batch."""
        for name in self._commits.names(f"{after:012d}"):
            if (body := self._commits.load(name)) is not None and body["new"]:
                yield int(name), self._commits.read(files_of(body, "new"), T.StructType.fromJson(body["schema"]))
