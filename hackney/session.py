"""Session set-up and the shared scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Window state of a long stream outgrows the heap; RocksDB keeps it on disk.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A commit then uploads what has changed instead of the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Queries of several tenants share the cores instead of queueing one behind the other.
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "hackney",
    master: str | None = None,
    packages: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """Start a session. ``packages`` names connectors, ``settings`` are further Spark settings.

    A stream fixes its number of state partitions at its first checkpoint, so size
    ``shuffle_partitions`` for the cluster before the first start.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if packages:
        builder = builder.config("spark.jars.packages", packages)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.catalog.clearCache()
    return spark


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="hackney-")


# The folders that ``scratch`` has named in this process, by application.
_named: dict[str, list[str]] = {}


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared folder that ``spark.checkpoint.dir`` names; see ``discard_scratch``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root()
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _named.setdefault(spark.conf.get("spark.app.id", ""), []).append(path)
    return path


def discard_scratch(spark: SparkSession) -> int:
    """Delete what this run has written on the way; how many folders it was.

    For when results are stored: a result that is not yet written reads some of those folders.
    """
    gone = 0
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in _named.pop(spark.conf.get("spark.app.id", ""), []):
        place = make(path)
        gone += bool(place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True))
    return gone
