"""What the operators share: packed rows, bounded Arrow batches, scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscope.staging import shared_folder


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 1000 rows and 16 MB, so that long texts cannot fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def packed(df: DataFrame, **named: Column) -> DataFrame:
    """The whole row as one struct column ``row``, and the ``named`` columns beside it.

    Only these names exist then, so no column of ``df`` can clash with an operator's own.
    """
    bounded_batches(df.sparkSession)
    return df.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in named.items()])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def grouped_batches(batches: Iterable[pa.RecordBatch], limit: int, column: str) -> Iterator[pa.RecordBatch]:
    """Join or cut batches to about ``limit`` bytes of ``column``; one longer row is a batch of its own."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max(limit - size, 1), "right")))
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1] - before)
            start = stop
            if size >= limit or start < batch.num_rows:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)
    pa.default_memory_pool().release_unused()  # the worker goes on to other tasks


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(held) == 1:
        return held[0]
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class Scratch:
    """Parquet tables of one run in the shared folder, dropped one by one when they are used up."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write ``df`` and read it back: later steps start from the files, whatever executor is lost."""
        path = f"{self.path}/{name}"
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Delete one table, or all of them."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def read_file(spark: SparkSession, path: str) -> bytes:
    """Content of a small file (a vocabulary): on the driver's disk, or anywhere Spark reads."""
    if "://" not in path:
        with open(path, "rb") as file:
            return file.read()
    return bytes(spark.read.format("binaryFile").load(path).first().content)
