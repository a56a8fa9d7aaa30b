"""Terms of a row and how often it holds each, counted in Arrow batches.

A task numbers the tokens of about ``WORDS`` words at once; an n-gram is the pair of the number of its beginning and that of its last
word, so strings are joined only for n-grams that differ. Nothing is shuffled, and what a task holds does not grow with its rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from corpuscope.operators.batches import bounded_batches, bounded_slices

WORDS = 1 << 17  # words counted at once


def _numbered(tokens: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = tokens.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def grams(tokens: pa.Array, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """For each n in ``low..high`` the n-grams of a list column, joined with a space: the row and the number of each, and what the numbers stand for."""
    words, row = tokens.flatten(), pc.list_parent_indices(tokens).to_numpy().astype(np.int64)
    if words.null_count:
        present = words.is_valid()
        words, row = words.filter(present), row[present.to_numpy(zero_copy_only=False)]
    word, known = _numbered(words)
    if low == 1:
        yield row, word, known
    begun = word
    for n in range(2, high + 1):
        # What begins where an n-gram of n - 1 words does, and the word that follows it; those that run into the next row are left out.
        inside = row[n - 1:] == row[:max(len(row) - n + 1, 0)]
        begun, different = _numbered(pa.array(begun[:len(inside)] * max(len(known), 1) + word[n - 1:]))
        if n < low:
            continue
        kept, place = np.flatnonzero(inside), np.full(len(different), -1, dtype=np.int64)
        place[begun[kept]] = kept
        used = np.flatnonzero(place >= 0)
        number = np.full(len(different), -1, dtype=np.int64)
        number[used] = np.arange(len(used))
        parts = [words.take(pa.array(place[used] + shift)) for shift in range(n)]
        yield row[kept], number[begun[kept]], pc.binary_join_element_wise(*parts, " ")


def row_codes(tokens: pa.Array, low: int, high: int, extra: Sequence[str] = ()) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Of a list column, row by row, the different terms of each row: the row, the term's number, what the numbers stand for, and the count.

    Terms are the n-grams for n in ``low..high``, and once in each row that is not NULL the ``extra`` ones.
    """
    found = list(grams(tokens, low, high))
    valid = np.flatnonzero(tokens.is_valid().to_numpy(zero_copy_only=False))
    found += [(valid, np.zeros(len(valid), dtype=np.int64), pa.array([term], pa.string())) for term in extra]
    before = np.cumsum([0, *[len(names) for _, _, names in found]])
    size = max(int(before[-1]), 1)
    every = np.concatenate([rows * size + codes + first for (rows, codes, _), first in zip(found, before)])
    pairs, counts = np.unique(every, return_counts=True)
    row, code = np.divmod(pairs, size)
    return row, code, pa.concat_arrays([names.cast(found[0][2].type) for _, _, names in found]), counts.astype(np.int64)


def row_counts(tokens: pa.Array, low: int, high: int, extra: Sequence[str] = ()) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Of a list column the number of different terms of each row, then, row by row, these terms and their counts, as :func:`row_codes` has them."""
    row, code, names, counts = row_codes(tokens, low, high, extra)
    return np.bincount(row, minlength=len(tokens)), names.take(pa.array(code)), counts


def counted(found: DataFrame, keep: Sequence[str], ngram_range: tuple[int, int], extra: Sequence[str] = ()) -> DataFrame:
    """``(keep..., term, tf)`` from the array column ``terms``, whose items are words, or in the range ``(1, 1)`` also numbers."""
    bounded_batches(found.sparkSession)
    kind = found.schema["terms"].dataType.elementType
    cell = StructType().add("term", kind).add("tf", LongType())
    stored = pa.int64() if isinstance(kind, LongType) else pa.string()
    row = F.struct(*keep) if keep else F.struct(F.lit(True).alias("_row"))
    source = found.select(row.alias("row"), "terms")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for part in bounded_slices(batch.column("terms"), WORDS):
                sizes, terms, counts = row_counts(part, *ngram_range, extra)
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                cells = pa.StructArray.from_arrays([terms.cast(stored), pa.array(counts)], names=["term", "tf"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(first, len(part)), pa.ListArray.from_arrays(ends, cells)], names=["row", "cells"]
                )
                first += len(part)

    schema = StructType().add("row", source.schema["row"].dataType).add("cells", ArrayType(cell))
    cells = source.mapInArrow(run, schema).select("row", F.explode("cells").alias("cell"))
    return cells.select(*[F.col("row")[name].alias(name) for name in keep], "cell.term", "cell.tf")
