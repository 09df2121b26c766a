"""Broker records, from the broker or from files in the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.functions.records import wire_text
from hackney.schemas import WIRE


def broker_options(
    servers: str, topic: str, security: dict[str, str] | None = None, starting_offsets: str = "latest"
) -> dict[str, str]:
    """Options of a topic scan: start with new records, go on when old ones are gone.

    ``security`` takes client settings such as ``security.protocol`` or ``sasl.mechanism``;
    ``starting_offsets`` may be ``earliest``, for all that the topic still holds.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
        **client_options(security),
    }


def client_options(security: dict[str, str] | None) -> dict[str, str]:
    return {f"kafka.{name}": value for name, value in (security or {}).items()}


def sasl(
    username: str, password: str, protocol: str = "SASL_PLAINTEXT", mechanism: str = "PLAIN"
) -> dict[str, str]:
    """Client settings for a log-in with name and password."""
    module = "org.apache.kafka.common.security.plain.PlainLoginModule"
    return {
        "security.protocol": protocol,
        "sasl.mechanism": mechanism,
        "sasl.jaas.config": f'{module} required username="{username}" password="{password}";',
    }


def read_wire(
    spark: SparkSession,
    format: str = "kafka",
    stream: bool = True,
    path: str | None = None,
    **options,
) -> DataFrame:
    """Key and value as text, and the time of the record.

    ``kafka`` needs the connector on the class path and ``broker_options``. ``parquet`` reads
    records stored by ``file_topic``; ``text`` reads one JSON record per line, timed by its file.
    """
    reader = (spark.readStream if stream else spark.read).format(format).options(**options)
    if format == "kafka":
        return wire_text(reader.load())
    if format == "text":
        lines = reader.load(path)
        return lines.select(
            F.lit(None).cast("string").alias("key"),
            "value",
            F.col("_metadata.file_modification_time").alias("timestamp"),
        )
    return wire_text(reader.schema(WIRE).load(path))
