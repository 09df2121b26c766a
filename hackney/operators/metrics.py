"""Throughput, error rate and health of a stream, and the progress of its queries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.functions.clock import EVENT_TIME, flat_window, watermarked
from hackney.functions.records import parse
from hackney.operators.windows import DELAY
from hackney.schemas import DOUBLE, TEXT, TIME, schema_of


def throughput(
    records: DataFrame, interval: str = "1 hour", topic: str = "topic", delay: str | None = DELAY
) -> DataFrame:
    """Messages and bytes per topic and interval of the broker's time."""
    timed = watermarked(records, delay, "timestamp")
    return timed.groupBy(F.window("timestamp", interval), topic).agg(
        F.count("*").alias("messages"), F.sum(F.octet_length("value")).alias("bytes")
    )


def error_rate(
    records: DataFrame,
    interval: str = "1 hour",
    fields: Sequence[str] = ("trip_id", EVENT_TIME),
    delay: str | None = DELAY,
) -> DataFrame:
    """Share of records, per interval of the broker's time, that lack one of ``fields``."""
    parsed = parse(records, fields, keep=("timestamp",))
    bad = reduce(or_, [F.col(name).isNull() for name in fields])
    return (
        watermarked(parsed, delay, "timestamp")
        .groupBy(F.window("timestamp", interval))
        .agg(F.count("*").alias("records"), F.count_if(bad).alias("malformed"))
        .withColumn("error_rate", F.col("malformed") / F.col("records"))
    )


def _silent() -> Column:
    return (F.col("records") > 0) & (F.col("valid") == 0)


def input_health(records: DataFrame, by: Sequence[str], event_time: str = EVENT_TIME) -> DataFrame:
    """Records read, usable and unusable per group; ``silent`` marks input that yields nothing.

    A query over such input ends as a success and writes no result.
    """
    parsed = parse(records, (event_time,), keep=by)
    return (
        parsed.groupBy(*by)
        .agg(F.count("*").alias("records"), F.count(event_time).alias("valid"))
        .withColumn("unusable", F.col("records") - F.col("valid"))
        .withColumn("silent", _silent())
    )


LONG = T.LongType()
# Name of the counts that ``observed`` adds.
INPUT = "input"

# The parts of a progress record that the reports use.
PROGRESS = schema_of(
    id=TEXT,
    runId=TEXT,
    name=TEXT,
    timestamp=TIME,
    batchId=LONG,
    numInputRows=LONG,
    inputRowsPerSecond=DOUBLE,
    processedRowsPerSecond=DOUBLE,
    durationMs=T.MapType(TEXT, LONG),
    observedMetrics=T.MapType(TEXT, schema_of(records=LONG, valid=LONG)),
    sink=schema_of(numOutputRows=LONG),
    stateOperators=T.ArrayType(
        schema_of(numRowsTotal=LONG, memoryUsedBytes=LONG, numRowsDroppedByWatermark=LONG)
    ),
)


def observed(trips: DataFrame, event_time: str = EVENT_TIME) -> DataFrame:
    """Let the progress of a stream tell how many records came in and how many were usable."""
    counts = (F.count(F.lit(1)).alias("records"), F.count(event_time).alias("valid"))
    return trips.observe(INPUT, *counts)


def progress_rows(progress: DataFrame) -> DataFrame:
    """Progress records (JSON text ``progress``) as columns, one row per batch and query."""
    flat = parse(progress, PROGRESS, value="progress", keep=())

    def over_operators(name: str) -> Column:
        start = F.lit(0).cast("bigint")
        return F.aggregate(F.col(f"stateOperators.{name}"), start, lambda acc, value: acc + F.coalesce(value, start))

    return flat.select(
        F.col("name").alias("query_name"),
        F.col("runId").alias("run_id"),
        "timestamp",
        F.col("batchId").alias("batch_id"),
        F.col("numInputRows").alias("input_rows"),
        F.col("inputRowsPerSecond").alias("input_rate"),
        F.col("processedRowsPerSecond").alias("process_rate"),
        F.col("durationMs.triggerExecution").alias("batch_ms"),
        F.col("durationMs").alias("operation_ms"),
        F.col("observedMetrics")[INPUT]["records"].alias("records"),
        F.col("observedMetrics")[INPUT]["valid"].alias("valid"),
        F.nullif(F.col("sink.numOutputRows"), F.lit(-1)).alias("output_rows"),
        F.coalesce(over_operators("numRowsTotal"), F.lit(0)).alias("state_rows"),
        F.coalesce(over_operators("memoryUsedBytes"), F.lit(0)).alias("state_bytes"),
        F.coalesce(over_operators("numRowsDroppedByWatermark"), F.lit(0)).alias("late_rows"),
    )


def query_progress(rows: DataFrame, interval: str = "1 hour") -> DataFrame:
    """Progress per query and interval."""
    summary = rows.groupBy("query_name", F.window("timestamp", interval)).agg(
        F.count("*").alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.avg("input_rate").alias("input_rate"),
        F.avg("process_rate").alias("process_rate"),
        F.avg("batch_ms").alias("batch_ms"),
        F.max("state_rows").alias("state_rows"),
        F.max("state_bytes").alias("state_bytes"),
        F.sum("late_rows").alias("late_rows"),
    )
    return flat_window(summary)


def batch_health(rows: DataFrame) -> DataFrame:
    """Micro-batches of ``observed`` streams: records in, usable, late, out; ``silent`` if none was usable."""
    batches = rows.filter(F.col("records") > 0)
    return batches.select(
        "query_name", "batch_id", "records", "valid", "late_rows", "output_rows", _silent().alias("silent")
    )


def operation_times(rows: DataFrame) -> DataFrame:
    """Time per query and kind of operation."""
    operations = rows.select("query_name", F.explode("operation_ms").alias("operation", "ms"))
    return operations.groupBy("query_name", "operation").agg(
        F.count("*").alias("batches"), F.sum("ms").alias("total_ms"), F.max("ms").alias("longest_ms")
    )
