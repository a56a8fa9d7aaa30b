"""Read and write note tables: CSV, parquet and JSON."""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from corpuscope.sources.records import cells, records
from corpuscope.staging import filesystem

# Cell texts that stand for a missing value in a CSV file.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The first, unnamed column of the file is the row number.
RAW_SCHEMA = S.StructType(
    [S.StructField("Unnamed: 0", S.LongType())]
    + [
        S.StructField(name, S.StringType())
        for name in ("description", "transcription", "sample_name", "keywords", "medical_specialty")
    ]
)


DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_notes_csv(spark: SparkSession, path: str, schema: S.StructType = RAW_SCHEMA) -> DataFrame:
    """Read notes with quoted line breaks and doubled quotes; missing-value texts become NULL.

    Columns are found by the names in the header, whatever their order; an unnamed first column is
    the row number. Columns that ``schema`` does not name follow as strings. A missing column raises
    ValueError, and a record with too few or too many cells fails when it is read.

    Files are read in parallel by byte ranges (:mod:`corpuscope.sources.records`): two passes and a stored copy of the records, so
    store the result once with :func:`ensure_table` and work from there. Runs these jobs when called. Lines
    must end in ``\\n`` or ``\\r\\n``.
    """
    header = spark.read.csv(path, header=True, multiLine=True, **DIALECT).columns
    found = ["Unnamed: 0" if k == 0 and name == "_c0" else name for k, name in enumerate(header)]
    missing = sorted({f.name for f in schema.fields} - set(found))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    stored = records(spark, path)
    names = [f"_{k}" for k in range(len(header))]
    first = stored.where("first").select("text").distinct()
    for row in first.toLocalIterator():  # one row for each way to write the header
        if [name or f"_c{k}" for k, name in enumerate(next(csv.reader(io.StringIO(row.text, newline=""))))] != header:
            raise ValueError(f"the header {row.text!r} differs from the columns {header}")
    parsed = stored.where("not first").select(cells(F.col("text"), names, **DIALECT).alias("cells"))
    raw = parsed.select(*[F.col(f"cells.{name}") for name in names]).toDF(*found)
    extra = [name for name in found if name not in schema.names]
    present = {name: F.when(~F.col(f"`{name}`").isin(*NULL_TOKENS), F.col(f"`{name}`")) for name in found}
    return raw.select(
        *[present[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields],
        *[present[name].alias(name) for name in extra],
    )


def keyed_by_row_number(notes: DataFrame, key: str = "doc_id") -> DataFrame:
    """Notes with the file's row number as their key, the column that cleaning takes for the row order."""
    return notes.withColumnRenamed("Unnamed: 0", key)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _aside(path: str, what: str) -> str:
    """A hidden folder beside ``path``: on the same file system, and never read as a table."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}-{what}-{uuid.uuid4().hex}"


def _moved(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder unless the target exists."""
    files, to = filesystem(spark, target)
    if files.exists(to) or not files.rename(filesystem(spark, source)[1], to):
        return False
    # Where the target came into being meanwhile, the folder was moved into it.
    _, inside = filesystem(spark, f"{target.rstrip('/')}/{source.rpartition('/')[2]}")
    return not (files.exists(inside) and files.delete(inside, True))


def _delete(spark: SparkSession, path: str) -> None:
    files, folder = filesystem(spark, path)
    files.delete(folder, True)


def _finished(spark: SparkSession, path: str) -> bool:
    files, mark = filesystem(spark, f"{path.rstrip('/')}/_SUCCESS")
    return files.exists(mark)


def write_aside(spark: SparkSession, path: str, write: Callable[[str], None], replace: bool = True) -> None:
    """Let ``write`` store a table in a hidden folder, then put it at ``path`` by a rename.

    ``path`` never shows part of a table or files of two: a job that fails leaves it as it was, and of two writers one
    puts its whole table there. Unless ``replace``, a finished table that is there by then stays. Between taking
    the old table away and renaming the new one there is a moment without any.
    """
    new, old = _aside(path, "new"), _aside(path, "old")
    try:
        write(new)
        if not replace and _finished(spark, path):
            return
        files, target = filesystem(spark, path)
        while not _moved(spark, new, path):
            if not replace and _finished(spark, path):
                return
            if files.exists(target):
                files.rename(target, filesystem(spark, old)[1])
                _delete(spark, old)
    finally:
        _delete(spark, new)


def ensure_table(df: DataFrame, path: str, force: bool = False) -> DataFrame:
    """Store ``df`` at ``path`` unless a finished table is there already (or ``force``); return the table.

    Only a folder with a success mark is a table. It appears at once and whole (:func:`write_aside`).
    """
    spark = df.sparkSession
    if force or not _finished(spark, path):
        write_aside(spark, path, lambda at: df.write.parquet(at), replace=force)
    return spark.read.parquet(path)


def _in_files(df: DataFrame, *order: Column, key: str) -> DataFrame:
    """``df`` in one order over all its files, by their names.

    The key ends the order, so a label of any size is cut into ranges like the rest; adaptive execution joins small ranges.
    """
    keys = [*order, F.asc(key)] if key in df.columns else list(order)
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_clean(df: DataFrame, path: str, label: str = "medical_specialty", key: str = "doc_id") -> None:
    """Parquet, sorted by label and falling length over all files."""
    ordered = _in_files(df, F.asc(label), F.desc("word_count"), key=key)
    write_aside(df.sparkSession, path, lambda at: ordered.write.parquet(at))


def write_train_ready(df: DataFrame, path: str, key: str = "doc_id") -> None:
    """Parquet in one folder per split, each sorted by label and length over all its files."""
    ordered = _in_files(df, F.asc("split"), F.asc("label"), F.asc("word_count"), key=key)
    write_aside(df.sparkSession, path, lambda at: ordered.write.partitionBy("split").parquet(at))


def write_split_csv(df: DataFrame, path: str) -> dict[str, str]:
    """CSV with header in one folder per split; returns the folder of each split that has rows."""
    rows = df.write.partitionBy("split").option("quote", '"').option("escape", '"')
    write_aside(df.sparkSession, path, lambda at: rows.csv(at, header=True))
    files, _ = filesystem(df.sparkSession, path)
    folders = {name: f"{path}/split={name}" for name in ("train", "val", "test")}
    return {name: at for name, at in folders.items() if files.exists(filesystem(df.sparkSession, at)[1])}


def write_metrics(df: DataFrame, path: str) -> None:
    """One-row metrics record as JSON."""
    write_aside(df.sparkSession, path, lambda at: df.coalesce(1).write.json(at))
