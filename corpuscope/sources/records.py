"""Records of CSV files whose quoted cells hold line breaks, read in parallel.

A file is scanned as lines, which Spark splits among tasks by byte ranges. Whether a line begins a record depends on
quotes that may be open since an earlier range, so each range is first scanned under both assumptions: it
begins outside or inside quotes. That gives what the range makes of either state, three small values. A
prefix pass over the ranges of a file, in order, then tells the state in which each really begins. Now the ranges are cut
into records, again in parallel. Records that lie inside a range are whole; of others each range
gives a fragment, at most two, and only fragments move to be joined. A task takes many ranges where they are small: the ranges
stay as they were cut, but neither tasks nor stored files are as many.

A quote opens a cell only as its first character, and is doubled inside it. Whatever follows a closing quote runs
to the next comma or the line's end. Lines end in ``\\n`` or ``\\r\\n``; a record that ends in the latter has its own line breaks
of that form read as ``\\n``. Empty lines are no records.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscope.staging import stage

TASK_BYTES = 32 << 20  # of the small ranges that one task takes, once there are tasks for every core
TASKS_A_CORE = 4
SCANNED_ROWS = 1000  # ranges to a batch
SCANNED = "file long, start long, outside boolean, inside boolean, closes boolean"
CUT = "file long, start long, place int, text string, owner long, whole boolean"


def ends_inside(line: str, inside: bool, delimiter: str = ",") -> bool:
    """Whether quotes are open after the line, given whether they are before it."""
    if '"' not in line:
        return inside
    at = 0
    if not inside and line[0] == '"':
        inside, at = True, 1
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
                continue
            inside = False
        at = line.find(delimiter, at)
        if at < 0:
            return False
        at += 1
        if line.startswith('"', at):
            inside, at = True, at + 1


def _ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], Iterator[str]]]:
    """(file, start) and the lines of each byte range of a task."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "value"))))
    for key, own in groupby(rows, key=lambda row: row[:2]):
        yield key, (row[2] for row in own)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in the order of the file, with the byte range that each begins in; no range is read by two tasks."""
    source = spark.read.text(path, lineSep="\n")
    return source.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def gathered(ranged: DataFrame) -> DataFrame:
    """The same ranges, several small ones to a task. A task begins a process and a file, which cost more than a small range."""
    spark = ranged.sparkSession
    ranges = ranged.rdd.getNumPartitions()
    each = max(1, TASK_BYTES // spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    tasks = max(-(-ranges // each), min(ranges, TASKS_A_CORE * spark.sparkContext.defaultParallelism))
    return ranged.coalesce(tasks) if tasks < ranges else ranged


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["file", "start", "outside", "inside", "closes"]
    rows: list[tuple] = []
    for (file, start), own in _ranges(batches):
        outside, inside, closes = False, True, False
        for line in own:
            same = outside == inside
            outside = ends_inside(line, outside)
            inside = outside if same else ends_inside(line, inside)
            closes = closes or not inside
        rows.append((file, start, outside, inside, closes))
        if len(rows) == SCANNED_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*rows)], names=names)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*rows)], names=names)


def prefix_states(scanned: Iterable[tuple[int, int, bool, bool, bool]]) -> dict[tuple[int, int], tuple[bool, int, bool]]:
    """For each (file, start): whether it begins inside quotes, the range where the open record began, and whether it is the file's first."""
    found = {}
    for file, own in groupby(sorted(scanned), key=lambda row: row[0]):
        state, owner, first = False, 0, True
        for _, start, outside, inside, closes in own:
            found[file, start] = (state, owner, first)
            if not state or closes:
                owner = start  # a record that is open at the end began in this range
            state, first = inside if state else outside, False
    return found


def records(spark: SparkSession, path: str) -> DataFrame:
    """``(text, first)``: every record without its line end, and whether it is its file's first; stores them (jobs).

    The driver learns three truth values of each range, and nothing of the text.
    """
    ranged = gathered(lines(spark, path))
    scanned = ranged.mapInArrow(_scan, SCANNED).collect()
    states = spark.sparkContext.broadcast(prefix_states(map(tuple, scanned)))

    def cut(batches):
        held: list[tuple] = []
        size = 0
        for (file, start), own in _ranges(batches):
            if (file, start) not in states.value:
                raise RuntimeError("The files were split differently in the second pass: read them again.")
            state, owner, first = states.value[file, start]
            parts: list[str] = []
            place, whole = 0 if first else 1, not state  # the file's first record has place 0
            for line in own:
                if not parts and whole and line in ("", "\r"):
                    continue
                parts.append(line)
                state = ends_inside(line, state)
                size += len(line)
                if not state:
                    held.append((file, start, place, "\n".join(parts), owner, whole))
                    parts, place, whole, owner = [], 1, True, start
                if size > 1 << 22:
                    yield _cut_batch(held)
                    held, size = [], 0
            if parts:
                held.append((file, start, place, "\n".join(parts), owner if not whole else start, False))
        if held:
            yield _cut_batch(held)

    found = stage(ranged.mapInArrow(cut, CUT), "records", partition_by="whole")
    inside, others = gathered(found.where("whole")), gathered(found.where(~F.col("whole")))
    # A fragment is named by the range where its record began; pieces of a record are put together in order.
    piece = F.struct("start", "place", "text")
    pieces = others.groupBy("file", "owner").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    joined = pieces.select(F.array_join("pieces.text", "\n").alias("text"), (F.col("pieces")[0]["place"] == 0).alias("first"))
    whole = inside.select("text", (F.col("place") == 0).alias("first"))
    text = F.when(F.col("text").endswith("\r"), F.regexp_replace(F.regexp_replace("text", "\r$", ""), "\r\n", "\n")).otherwise(F.col("text"))
    return whole.unionByName(joined).select(text.alias("text"), "first")


def _cut_batch(held: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.bool_()]
    names = ["file", "start", "place", "text", "owner", "whole"]
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*held), kinds)], names=names)


def cells(text: Column, names: list[str], **dialect) -> Column:
    """A record's cells as a struct of strings, by Spark's own parser; a wrong number of cells fails."""
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    return F.from_csv(text, schema, {**{k: str(v) for k, v in dialect.items()}, "mode": "FAILFAST", "multiLine": "true"})
