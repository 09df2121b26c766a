"""Where results go: topics, append-only files, versioned tables and stores.

A sink is a function that completes a stream writer.
"""

from __future__ import annotations

import secrets
import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from hackney.operators.conform import ascending_identity, mapped
from hackney.schemas import Table
from hackney.sources.store import hadoop_files
from hackney.sources.wire import client_options

#: Completes a writer for the run with the given number; see ``run_number``.
Sink = Callable[[DataStreamWriter, int], DataStreamWriter]
#: Makes what a micro-batch writes of what it has emitted, the run and the batch.
Prepare = Callable[[DataFrame, int, int], DataFrame]
RUN, BATCH = "run", "batch_id"


def run_number(spark: SparkSession, checkpoint: str) -> int:
    """The number of all starts from a checkpoint. Later checkpoints have larger ones."""
    kept = f"{checkpoint}.run"
    try:
        # Without a row the first start ended while it wrote its number, so before the stream began.
        if (row := spark.read.text(kept).first()) is not None:
            return int(row[0])
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    number = (time.time_ns() // 1_000_000 << 20) + secrets.randbits(20)
    spark.createDataFrame([(str(number),)], "value STRING").coalesce(1).write.mode("overwrite").text(kept)
    return number


def put_once(rows: DataFrame, root: str, name: str) -> None:
    """Write ``rows`` to the folder ``name`` below ``root``, unless it is there: then it is complete.

    Rows are written aside and moved when all of them are. Who reads the root, even as a stream,
    sees every folder once and whole, however often a batch is repeated.
    """
    files, path = hadoop_files(rows.sparkSession, root)
    final = path(f"{root}/{name}")
    if files.exists(final):
        # A stream's state must come to the end of the batch all the same.
        rows.write.format("noop").mode("overwrite").save()
        return
    aside = f"{root}/_staging/{name.replace('=', '-').replace('/', '-')}"
    rows.write.mode("overwrite").parquet(aside)
    files.mkdirs(final.getParent())
    if not files.rename(path(aside), final):
        raise OSError(f"could not move {aside} to {name}")


def broker_sink(
    servers: str, topic: str, security: dict[str, str] | None = None, prepare: Prepare | None = None
) -> Sink:
    """Write the ``value`` column to a topic; with ``prepare`` batch by batch what that makes."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, **client_options(security)}

    def complete(writer: DataStreamWriter, run: int) -> DataStreamWriter:
        if prepare is None:
            return writer.format("kafka").options(**options)

        def write(emitted: DataFrame, batch_id: int) -> None:
            prepare(emitted, run, batch_id).write.format("kafka").options(**options).save()

        return writer.foreachBatch(write)

    return complete


def file_sink(path: str, format: str = "parquet", partition_by: Sequence[str] = ()) -> Sink:
    """Append files to a folder, each row exactly once; for ``append`` mode."""

    def complete(writer: DataStreamWriter, run: int) -> DataStreamWriter:
        chosen = writer.format(format).option("path", path)
        return chosen.partitionBy(*partition_by) if partition_by else chosen

    return complete


def versioned_sink(path: str, prepare: Prepare | None = None, files: int | None = None) -> Sink:
    """Keep what each micro-batch emits in a folder of its own, by run and batch; for every output mode.

    A batch that is repeated after a failure finds its folder and leaves it, so nothing counts twice, and
    a query with a new checkpoint writes beside what earlier ones have left. Every state partition writes
    a file of its own unless ``files`` sets how many there are.
    """

    def complete(writer: DataStreamWriter, run: int) -> DataStreamWriter:
        def write(emitted: DataFrame, batch_id: int) -> None:
            rows = prepare(emitted, run, batch_id) if prepare else emitted
            rows = rows.repartition(files) if files else rows
            put_once(rows, path, f"{RUN}={run}/{BATCH}={batch_id}")

        return writer.foreachBatch(write)

    return complete


def emission(results: DataFrame, run: int, batch_id: int) -> DataFrame:
    """Results with the run and batch that emitted them, which order all emissions of a window."""
    return results.withColumns({RUN: F.lit(run).cast("bigint"), BATCH: F.lit(batch_id).cast("bigint")})


def table_sink(path: str, table: Table, files: int | None = None) -> Sink:
    """Append result rows to a declared table, of which ``read_table`` gives all.

    Every row has an ``id`` of its own, equal rows too, and a repeated delivery gives the same ones: it
    is made of the run, the batch, the row, and its number among equal ones. Ids ascend in the order in
    which results were emitted, or delivered if that is not known.
    """
    names = [name for name in table.schema.names if name != "id"]

    def complete(writer: DataStreamWriter, run: int) -> DataStreamWriter:
        def write(emitted: DataFrame, batch_id: int) -> None:
            known = {name: name for name in names if name in emitted.columns}
            same = F.sha2(F.to_json(F.struct(*known)), 256)
            nth = F.row_number().over(Window.partitionBy(same).orderBy(F.lit(0))).cast("string")
            delivered = {RUN: F.lit(run), BATCH: F.lit(batch_id)}
            first, second = (F.coalesce(*([n] if n in known else []), d).cast("bigint") for n, d in delivered.items())
            seconds = F.floor(F.shiftright(first, 20) / 1000).cast("bigint")
            identity = ascending_identity(seconds, second, F.lit(f"{run}:{batch_id}"), same, nth)
            rows = mapped(emitted, table, known, identity)
            rows = rows.repartition(files) if files else rows
            put_once(rows, path, f"run-{run}-batch-{batch_id:012d}")

        return writer.foreachBatch(write)

    return complete


def read_table(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """All rows of a table that ``table_sink`` has filled."""
    return spark.read.schema(table.schema).option("recursiveFileLookup", True).parquet(path)


def latest(versions: DataFrame, key: Sequence[str], order: Sequence[str] = (RUN, BATCH)) -> DataFrame:
    """The last emission per key of a versioned table, by ``order``.

    Of a declared table take ``(RUN, BATCH, "id")``: rows of one batch then have an order too.
    """
    values = [name for name in versions.columns if name not in (*key, *order)]
    last = F.struct(*order)
    return versions.groupBy(*key).agg(*[F.max_by(name, last).alias(name) for name in values])


def versions_between(
    spark: SparkSession, path: str, after: tuple[int, int] | None = None, last: tuple[int, int] | None = None
) -> list[tuple[tuple[int, int], str]]:
    """(run, batch) and folder of the versions after ``after`` up to ``last``, in their order."""
    files, make = hadoop_files(spark, path)

    def numbered(folder: str, name: str) -> list[tuple[int, str]]:
        found = [str(s.getPath()) for s in files.listStatus(make(folder))] if files.exists(make(folder)) else []
        return [(int(f.rpartition("=")[2]), f) for f in found if f.rpartition("/")[2].startswith(f"{name}=")]

    found = [((run, batch), f) for run, folder in numbered(path, RUN) for batch, f in numbered(folder, BATCH)]
    return sorted((v, f) for v, f in found if (after is None or v > after) and (last is None or v <= last))


def read_latest(spark: SparkSession, path: str, key: Sequence[str], folded: str | None = None) -> DataFrame:
    """The last emission per key of a versioned table; with ``folded``, of its last fold and what came after.

    Only the folders that count are opened.
    """
    folds = versions_between(spark, folded) if folded else []
    recent = versions_between(spark, path, after=folds[-1][0] if folds else None)
    parts = [spark.read.option("basePath", folded).parquet(folds[-1][1])] if folds else []
    if recent or not parts:
        parts.append(spark.read.option("basePath", path).parquet(*(f for _, f in recent)))
    return latest(reduce(DataFrame.unionByName, parts), key)


def fold_versions(
    spark: SparkSession, path: str, folded: str, key: Sequence[str], last: tuple[int, int] | None = None
) -> None:
    """Store the last emissions up to the version ``last`` (default: all there are) as one in ``folded``.

    Goes on from the last fold. Readers then open that and the versions after it instead of all folders.
    """
    folds = versions_between(spark, folded, last=last)
    recent = versions_between(spark, path, after=folds[-1][0] if folds else None, last=last)
    if not recent:
        return
    parts = [spark.read.option("basePath", path).parquet(*(f for _, f in recent))]
    if folds:
        parts.append(spark.read.option("basePath", folded).parquet(folds[-1][1]))
    run, batch = recent[-1][0]
    put_once(latest(reduce(DataFrame.unionByName, parts), key), folded, f"{RUN}={run}/{BATCH}={batch}")


def write_store(df: DataFrame, path: str, partition_by: Sequence[str] = ("day",), mode: str = "overwrite") -> None:
    """Store rows by day (or other columns). The days that ``df`` has are replaced, all others stay.

    The rebalance hint brings rows of a day together, so that a small day does not leave a file
    per task, and lets AQE split a day with a third of all rows over many tasks.
    """
    spread = df.hint("rebalance", *[F.col(name) for name in partition_by]) if partition_by else df
    writer = spread.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_records(records: DataFrame, path: str, format: str = "parquet") -> None:
    """Store wire records as a topic in files (``parquet``), or one JSON text per line (``text``)."""
    if format == "text":
        records.select(F.col("value").cast("string")).write.mode("append").text(path)
    else:
        records.write.mode("append").format(format).save(path)


def send_records(records: DataFrame, servers: str, topic: str, security: dict[str, str] | None = None) -> None:
    """Write wire records to a topic as a batch."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, **client_options(security)}
    records.write.format("kafka").options(**options).save()

