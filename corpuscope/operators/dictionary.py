"""A dictionary of the corpus's words, and token tables that hold ids in place of words.

Ids are places in the order of words, from 1. A table is read in blocks: a task numbers the words of a block as it
meets them and writes the rows with these small codes, so that each word leaves it once for each block. Words are ordered
by ranges and numbered by offsets; each block then gets the list of its ids, and its codes are looked up there. After
that no word moves: an n-gram is one number, its ids side by side with as many bits as the dictionary needs, or a
list of ids where these do not fit. Either sorts as the words would, since a space comes before any character of a word.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from corpuscope.functions.stopwords import CLOUD_EXTRA, ENGLISH
from corpuscope.operators.batches import bounded_batches, bounded_slices
from corpuscope.operators.ordering import in_order, numbered
from corpuscope.staging import stage

BLOCK_WORDS, BLOCK_TOKENS = 1 << 17, 1 << 20  # a block ends with the slice of a batch in which it reaches either
SLICE_TOKENS = 1 << 17  # tokens of a batch coded at once
_TASK_BITS = 31
BITS, STOPS = "id_bits", "stop_ids"  # metadata of a column of ids


@dataclass(frozen=True)
class Encoded:
    """``rows`` with ids for tokens, and ``terms``, the dictionary ``(term, id)``."""

    rows: DataFrame
    terms: DataFrame
    bits: int


def encode(
    df: DataFrame, column: str = "tokens", looked_up: Sequence[str] = (*ENGLISH, *CLOUD_EXTRA),
    block_words: int = BLOCK_WORDS, block_tokens: int = BLOCK_TOKENS,
) -> Encoded:
    """``df`` with ids in the array column ``column``; runs jobs and stages the dictionary and the rows.

    The ids of the words ``looked_up`` go with the column, so that these can be stop words later on. A row without a
    list stays so; NULL in a list is left out. Rows come in any order.
    """
    rest = [c for c in df.columns if c != column]
    row = F.struct(*rest) if rest else F.struct(F.lit(True).alias("_row"))
    source = df.select(row.alias("row"), F.filter(column, lambda t: t.isNotNull()).alias("tokens"))
    kind = source.schema["row"].dataType.simpleString()

    bounded_batches(df.sparkSession)

    def sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for part in bounded_slices(batch.column("tokens"), min(SLICE_TOKENS, block_tokens)):
                yield batch.slice(first, len(part))
                first += len(part)

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, words, held = TaskContext.get().partitionId() << _TASK_BITS, {}, 0
        row_type = None

        def closing() -> pa.RecordBatch:
            found = pa.array([list(words)], pa.list_(pa.string()))
            columns = [pa.array([block], pa.int64()), pa.nulls(1, row_type), pa.nulls(1, pa.list_(pa.int32())), found]
            return pa.RecordBatch.from_arrays(columns, names=["block", "row", "codes", "words"])

        for batch in sliced(batches):
            tokens, row_type = batch.column("tokens"), batch.column("row").type
            met = tokens.flatten().dictionary_encode()
            own = [words.setdefault(w, len(words)) for w in met.dictionary.to_pylist()]
            codes = np.array(own, dtype=np.int32)[met.indices.to_numpy(zero_copy_only=False)] if own else np.zeros(0, np.int32)
            lengths = np.array(tokens.value_lengths().fill_null(0), dtype=np.int32)
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(codes), mask=tokens.is_null())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block)), batch.column("row"), lists, pa.nulls(n, pa.list_(pa.string()))],
                names=["block", "row", "codes", "words"],
            )
            held += len(codes)
            if len(words) >= block_words or held >= block_tokens:
                yield closing()
                block, words, held = block + 1, {}, 0
                pa.default_memory_pool().release_unused()
        if words:
            yield closing()

    coded = stage(source.mapInArrow(code, f"block long, row {kind}, codes array<int>, words array<string>"), "coded", compression="zstd")
    words = coded.where("words is not null").select("block", F.posexplode("words").alias("place", "term"))
    terms = numbered(in_order(words.select("term").distinct(), "term"), "id").select("term", F.col("id").cast("long"))
    terms = stage(terms, "dictionary")
    size = terms.count()
    bits = max(size.bit_length(), 1)
    stops = dict.fromkeys(looked_up, 0)
    stops.update(terms.where(F.col("term").isin(list(looked_up))).select("term", "id").collect())
    ids = words.join(terms, "term").groupBy(F.col("block").alias("of_block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "id"))).alias("placed")
    ).select("of_block", F.col("placed.id").alias("ids"))
    schema = StructType().add("row", coded.schema["row"].dataType).add("ids", ArrayType(LongType()))

    def look_up(rows: pa.Table, found: pa.Table) -> pa.Table:
        codes = rows.column("codes").combine_chunks()
        table = np.asarray(found.column("ids").combine_chunks().flatten(), dtype=np.int64) if found.num_rows else np.zeros(0, np.int64)
        at = np.asarray(codes.flatten(), dtype=np.int32)
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.array(codes.value_lengths().fill_null(0)))]), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(table[at], pa.int64()), mask=codes.is_null())
        return pa.table({"row": rows.column("row"), "ids": lists})

    # A block is bounded by its words and tokens, so no group is large.
    rows = coded.where("words is null").select("block", "row", "codes").groupBy("block").cogroup(
        ids.groupBy("of_block")
    ).applyInArrow(look_up, schema)
    of_rows = [F.col(f"row.{c}").alias(c) for c in rest]
    by_name = {c: F.col(c) for c in rest} | {column: F.col(column).alias(column, metadata={BITS: bits, STOPS: json.dumps(stops)})}
    staged = stage(rows.select(*of_rows, F.col("ids").alias(column)), "encoded", compression="zstd")
    return Encoded(staged.select(*[by_name[c] for c in df.columns]), terms, bits)


def holds_ids(df: DataFrame, column: str) -> bool:
    return BITS in df.schema[column].metadata


def without(df: DataFrame, column: str, stop_words: Sequence[str]) -> Column:
    """The ids of a column but for the stop words, which must be among those that were looked up."""
    stops = json.loads(df.schema[column].metadata[STOPS])
    unknown = sorted(set(stop_words) - set(stops))
    if unknown:
        raise ValueError(f"Stop words that were not looked up when the tokens were encoded: {unknown[:5]}")
    held = sorted(stops[w] for w in set(stop_words) if stops[w])
    return F.filter(F.col(column), lambda x: ~x.isin(held)) if held else F.col(column)


def packs(bits: int, n: int) -> bool:
    """Whether an n-gram is one number."""
    return bits * n <= 63


def grams(ids: Column, bits: int, low: int, high: int) -> Column:
    """All n-grams for n in ``low..high`` of a plain column of ids, with room for ``high`` words each."""
    if not 1 <= low <= high:
        raise ValueError("n-gram range must satisfy 1 <= low <= high.")
    parts = [_grams_of(ids, n, bits, high) for n in range(low, high + 1)]
    return F.coalesce(parts[0] if len(parts) == 1 else F.concat(*parts), F.array())


def _grams_of(ids: Column, n: int, bits: int, high: int) -> Column:
    starts = F.greatest(F.size(ids) - (n - 1), F.lit(0))
    first = F.slice(ids, F.lit(1), starts)
    if not packs(bits, high):
        return F.transform(first, lambda _, i: F.slice(ids, i + 1, n))
    found = F.transform(first, lambda x: F.shiftleft(x, bits * (high - 1)))
    for shift in range(1, n):
        place = bits * (high - 1 - shift)
        following = F.slice(ids, F.lit(1 + shift), starts)
        found = F.zip_with(found, following, lambda gram, x: gram.bitwiseOR(F.shiftleft(x, place)))  # noqa: B023
    return found


def named(df: DataFrame, encoded: Encoded, n: int = 1, column: str = "term") -> DataFrame:
    """``df`` with words in place of ids in ``column``, which holds n-grams of up to ``n`` words; for results, as it joins
    the dictionary once for each of the n words."""
    names = encoded.terms
    for k in range(n):
        at = F.get(column, F.lit(k)) if isinstance(df.schema[column].dataType, ArrayType) else (
            F.shiftright(F.col(column), encoded.bits * (n - 1 - k)).bitwiseAND((1 << encoded.bits) - 1)
        )
        word = names.select(F.col("term").alias(f"_word{k}"), F.col("id").alias(f"_id{k}"))
        df = df.withColumn(f"_at{k}", at).join(word, F.col(f"_at{k}") == F.col(f"_id{k}"), "left")
    words = F.concat_ws(" ", *[F.col(f"_word{k}") for k in range(n)])
    return df.withColumn(column, words).drop(*[f"_{part}{k}" for part in ("at", "id", "word") for k in range(n)])
