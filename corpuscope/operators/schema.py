"""Column names and required columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalise_columns(df: DataFrame) -> DataFrame:
    """Strip and lower-case the column names and replace their spaces with ``_``."""
    names = [name.strip().lower().replace(" ", "_") for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"Column names collide after normalising: {clashes}")
    return df.toDF(*names)


def require_columns(df: DataFrame, required: Iterable[str], what: str = "Dataset") -> DataFrame:
    """Raise ``ValueError`` with the sorted missing names; reads the schema only."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} missing required columns: {missing}")
    return df


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raise ``ValueError`` when the frame has no row."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def require_unique_key(df: DataFrame, key: str) -> DataFrame:
    """Raise ``ValueError`` when a key is missing or repeats; runs a job on the key column."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(key).isNull())
    found = repeated.first()
    if found is not None:
        raise ValueError(f"key {key} must be unique and present: {found[key]!r} occurs {found.n} times")
    return df
