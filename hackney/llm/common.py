"""What the operators share: tables on the way, and texts in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from hackney.session import scratch

#: Bytes that separate words: space, and tab to carriage return.
SPACES = b" \t\n\x0b\x0c\r"
#: Stands for a null ``doc_id`` where ids are compared; smaller than all others.
NO_ID = -(2**63)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: work done once, which outlives executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The texts of a batch in UTF-8; null is empty."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())
    for value in column:
        yield value.as_py() or b""


def small(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, so that what is made from the texts stays small."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
