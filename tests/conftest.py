from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

from hackney.session import build_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = build_session(
        "hackney-tests",
        master="local[8]",
        shuffle_partitions=4,
        **{
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "1000",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder() -> Path:
    """A new folder; nothing deletes it."""
    return Path(tempfile.mkdtemp(prefix="run-"))


class Batches:
    """Files of JSON lines that a stream reads one per micro-batch, in the order they were added."""

    def __init__(self, path: Path) -> None:
        self.path, self._count = path, 0
        path.mkdir(parents=True, exist_ok=True)

    def add(self, *records: dict | str) -> None:
        self._count += 1
        hidden = self.path.parent / f"{self._count}.tmp"
        hidden.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))
        os.utime(hidden, (1_700_000_000 + self._count,) * 2)
        hidden.rename(self.path / f"{self._count:04d}.json")

    def stream(self, spark: SparkSession):
        from hackney.sources.wire import read_wire

        return read_wire(spark, "text", path=str(self.path), maxFilesPerTrigger=1)


@pytest.fixture
def batches(folder: Path) -> Batches:
    return Batches(folder / "in")
