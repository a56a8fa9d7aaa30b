"""Candidates for the most frequent terms, from a bounded summary of each task.

A vocabulary of n-grams keeps the most frequent terms of a long tail, and counting the tail exactly is what moves. So
each task first counts its terms in a summary of at most ``capacity`` counters: where it overflows, the
count that the first one left out has reached is taken off all (Misra and Gries; Space-Saving is the same with another way to
write it). A summary's count is then at most the true one and falls short by no more than what was taken off, in
total ``missed`` over all tasks. The ``top``-th largest of the added counts is a count that ``top`` terms surely reach, so a
term that cannot reach it even with ``missed`` is no candidate. Only candidates are counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.operators.batches import bounded_batches, bounded_slices
from corpuscope.operators.counting import grams
from corpuscope.staging import measured, stage

ROOM = 4  # counters of a summary for each wanted term
WORDS = 1 << 18  # words whose n-grams are made at once


@dataclass(frozen=True)
class Candidates:
    """``terms`` holds every term that occurs more than ``limit`` times."""

    terms: DataFrame
    limit: int


def _cut(counts: pa.Table, capacity: int) -> tuple[pa.Table, int]:
    """The largest counters, lowered by the largest count left out, which is returned too."""
    summed = counts.group_by("term").aggregate([("n", "sum")]).rename_columns(["term", "n"])
    if summed.num_rows <= capacity:
        return summed, 0
    largest = summed.take(pc.select_k_unstable(summed, capacity + 1, sort_keys=[("n", "descending")]))
    off = pc.min(largest.column("n")).as_py()
    lowered = largest.set_column(1, "n", pc.subtract(largest.column("n"), off))
    return lowered.filter(pc.greater(lowered.column("n"), 0)), off


def _grams(tokens: pa.Array, low: int, high: int) -> Iterator[pa.DictionaryArray]:
    """All n-grams of the rows of a list column, joined with a space; equal ones are stored once."""
    for _, numbers, names in grams(tokens, low, high):
        yield pa.DictionaryArray.from_arrays(pa.array(numbers), names)


def summaries(tokens: DataFrame, ngram_range: tuple[int, int], capacity: int, words: int = WORDS) -> DataFrame:
    """``(term, n)`` of each task's summary, and a row with a NULL term for what was taken off, from the array column ``terms``.

    A task makes the n-grams of about ``words`` words at once, so what it holds does not grow with its rows. ``terms`` may also
    hold n-grams that are numbers, in the range ``(1, 1)``.
    """
    bounded_batches(tokens.sparkSession)
    kind = tokens.schema["terms"].dataType.elementType.simpleString()
    stored = pa.string() if kind == "string" else pa.int64()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, missed = [], 0, 0
        for tokens in (part for batch in batches for part in bounded_slices(batch.column("terms"), words)):
            for met in _grams(tokens, *ngram_range):
                names, numbers = met.dictionary.cast(stored), met.indices.to_numpy()
                held.append(pa.table({"term": names, "n": np.bincount(numbers, minlength=len(names))}))
                rows += len(names)
            if rows > 4 * capacity:
                table, off = _cut(pa.concat_tables(held), capacity)
                held, rows, missed = [table], table.num_rows, missed + off
                pa.default_memory_pool().release_unused()
        if held:
            table, off = _cut(pa.concat_tables(held), capacity)
            table = pa.concat_tables([table, pa.table({"term": pa.array([None], stored), "n": pa.array([missed + off], pa.int64())})])
            yield from table.to_batches(max_chunksize=100_000)

    return tokens.select("terms").mapInArrow(run, f"term {kind}, n long")


def candidates(tokens: DataFrame, ngram_range: tuple[int, int], top: int, capacity: int | None = None) -> Candidates | None:
    """Candidates for the ``top`` most frequent n-grams of the tokens, or nothing if the summaries are too small to tell; runs jobs."""
    added = measured(summaries(tokens, ngram_range, capacity or ROOM * top).groupBy("term").agg(F.sum("n").alias("n")))
    missed = added.where("term is null").agg(F.sum("n")).first()[0] or 0
    known = added.where("term is not null")
    reached = known.orderBy(F.desc("n")).limit(top).agg(F.count("n").alias("terms"), F.min("n").alias("least")).first()
    if reached.terms < top:
        return None if missed else Candidates(stage(known.select("term"), "candidates"), 0)
    if reached.least <= missed:
        return None
    # Whatever is left out has a true count below the least that is surely reached.
    kept = known.where(F.col("n") + missed >= reached.least)
    return Candidates(stage(kept.select("term"), "candidates"), max(reached.least - 1, missed))
