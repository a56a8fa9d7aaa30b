"""Bounds on what a Python worker holds at once, however many rows its task has."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

ROWS, BYTES = 1000, 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``ROWS`` rows and about ``BYTES`` from here on, in place of 10,000 rows of any size."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES))


def bounded_slices(lists: pa.Array, limit: int) -> Iterator[pa.Array]:
    """The rows of a list column in slices of about ``limit`` items; one longer row is a slice of its own."""
    ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(lists):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield lists.slice(first, last - first)
        first = last
