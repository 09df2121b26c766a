"""Topics of a broker, or folders that stand in for them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from hackney.sources.wire import broker_options, read_wire
from hackney.streaming.sinks import Prepare, Sink, broker_sink, send_records, versioned_sink, write_records


@dataclass(frozen=True)
class Broker:
    """Topics of a broker; ``security`` takes client settings as ``sources.wire.sasl`` gives them."""

    servers: str
    security: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession, topic: str, starting_offsets: str = "latest") -> DataFrame:
        return read_wire(spark, **broker_options(self.servers, topic, dict(self.security), starting_offsets))

    def sink(self, topic: str, prepare: Prepare | None = None) -> Sink:
        return broker_sink(self.servers, topic, dict(self.security), prepare)

    def send(self, records: DataFrame, topic: str) -> None:
        send_records(records, self.servers, topic, dict(self.security))


@dataclass(frozen=True)
class Folders:
    """A folder of files per topic, below a root that all executors share.

    Batches put files into the folder itself, streams into one below it per micro-batch, which appears when it
    is complete and never again; readers take both. Folders are always read from their beginning.
    """

    root: str
    #: Files that a stream writes per micro-batch.
    files: int = 4

    def path(self, topic: str) -> str:
        return f"{self.root}/{topic}"

    def read(
        self, spark: SparkSession, topic: str, starting_offsets: str = "earliest", stream: bool = True
    ) -> DataFrame:
        return read_wire(spark, "parquet", stream=stream, path=self.path(topic), recursiveFileLookup=True)

    def sink(self, topic: str, prepare: Prepare | None = None) -> Sink:
        return versioned_sink(self.path(topic), prepare, self.files)

    def send(self, records: DataFrame, topic: str) -> None:
        write_records(records, self.path(topic))


Topics = Broker | Folders
