"""Where a job cuts its plan: small measured tables and staged parquet tables.

Both are remembered by session, so that a job can give back what it made once its results are stored:

    with staged_work(spark):
        ...
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_kept: list[DataFrame] = []
_paths: list[str] = []
_own_root: str | None = None


def measured(df: DataFrame) -> DataFrame:
    """Compute a per-label (or smaller) table once and keep it; runs a job.

    Once computed, Spark knows the table's real size, so a later join broadcasts it
    only if it is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
    A lost executor only means the lost blocks are computed again.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    _kept.append(kept)
    return kept


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors must share.

    Where it is unset, a session inside one process gets a folder that goes with the process; any other raises.
    """
    global _own_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share.")
    if _own_root is None:
        _own_root = tempfile.mkdtemp(prefix="corpuscope-")
        atexit.register(shutil.rmtree, _own_root, ignore_errors=True)
    return _own_root


def stage(df: DataFrame, name: str, partition_by: str | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back; runs a job.

    For tables that several later passes read: each pass then scans only its own
    columns, and nothing upstream is computed twice or lost with an executor. Passes that
    select values of ``partition_by`` read those folders only. ``compression`` is that of the session unless given.
    """
    return df.sparkSession.read.schema(df.schema).parquet(staged_path(df, name, partition_by, compression))


def staged_path(df: DataFrame, name: str, partition_by: str | None = None, compression: str | None = None) -> str:
    """Write ``df`` as :func:`stage` does; where it is."""
    path = f"{shared_folder(df.sparkSession)}/corpuscope/{name}-{uuid.uuid4().hex}"
    _paths.append(path)
    df.write.partitionBy(*[partition_by] if partition_by else []).parquet(path, compression=compression)
    return path


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and ``path`` as it wants it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def release(spark: SparkSession, since: tuple[int, int] = (0, 0)) -> None:
    """Unpersist measured tables and delete staged ones made after the mark ``since``.

    Frames that still depend on them can then no longer be computed.
    """
    frames, paths = since
    for kept in _kept[frames:]:
        kept.unpersist()
    for path in _paths[paths:]:
        files, hadoop = filesystem(spark, path)
        files.delete(hadoop, True)
    del _kept[frames:], _paths[paths:]


@contextmanager
def staged_work(spark: SparkSession) -> Iterator[None]:
    """Give back, at the end, all that is measured or staged inside."""
    mark = len(_kept), len(_paths)
    try:
        yield
    finally:
        release(spark, mark)
