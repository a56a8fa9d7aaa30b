"""Periodic run detection by an online sparse diagonal DP.

A run is a maximal stretch of words with smallest period q (words q apart are equal) and a length of at least
max(6, 4q). In terms of the matrix of word matches it is a diagonal of lag q with at least max(6 - q, 3q) matches in a row, so
at least ``CONTEXT`` = 5. The words pass by once; each looks up its earlier occurrence, and that match adds one to the length
of the active diagonal of its lag. A diagonal that does not go on has ended: if it is long enough, its run is emitted there.

A word is looked up together with the words before it, which keeps the diagonals sparse and loses none. Pass k looks
up L = 5 * 2^k words at once and is in charge of the lags from L/2 (excluded) to L; pass 0 of all up to 5. A run of such a lag q has
3q >= L matches, and its L words contain a whole period. A smallest period is a word that is no power, and such a word occurs
in its own repetition only at multiples of its length. So inside the run the *nearest* earlier occurrence of the L words is
exactly q back, and no other needs to be followed: one step a word and pass, however often a word occurs. The other way
round, a diagonal of nearest occurrences with enough matches has no smaller period, which by Fine and Wilf would divide q
and lead to a nearer occurrence. So runs come out exact, maximal and once, in n log n steps.

The L words carry a number; that of 2L words is the pair of two such numbers, so words are compared once. A pass in which nothing
occurs again is the last: no longer context can.

Words are split at space and \\x09-\\x0D. Defined cases: a NULL or empty text has no words and no runs, and collapses to the
empty text. Rows are judged each on its own, so repeated rows and NULL keys need no rule. A text is held by one task, with some
hundred bytes a word.
"""

from __future__ import annotations

from collections.abc import Hashable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import as_bytes, packed

LEAST, TIMES = 6, 4  # a run has at least 6 words and 4 periods
CONTEXT = LEAST - 1
RUN_TYPE = "array<struct<start: long, length: long, period: long>>"


def diagonals(names: Sequence[Hashable], context: int, low: int) -> tuple[list[tuple[int, int, int]], bool]:
    """Runs (start, length, period) whose period is over ``low`` and at most ``context``; whether any name occurs again.

    ``names[i]`` stands for the ``context`` words from word i on.
    """
    found, again = [], False
    latest: dict[Hashable, int] = {}
    active = matches = 0  # the lag of the diagonal that the last word was on, and its matches so far
    for place, name in enumerate(names):
        before = latest.get(name)
        latest[name] = place
        lag = 0
        if before is not None:
            again = True
            if low < place - before <= context:
                lag = place - before
        if lag and lag == active:
            matches += 1
            continue
        if active and matches + active >= max(LEAST, TIMES * active):
            found.append((place + context - 1 - matches - active, matches + active, active))
        active, matches = lag, context
    if active and matches + active >= max(LEAST, TIMES * active):
        found.append((len(names) + context - 1 - matches - active, matches + active, active))
    return found, again


def runs(words: Sequence[bytes]) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of the words, by start and then period."""
    grams = list(zip(*[words[k:] for k in range(CONTEXT)]))
    if len(set(grams)) == len(grams):
        return []  # no word occurs again in its context: every diagonal is too short
    numbers: dict = {}
    names = [numbers.setdefault(gram, len(numbers)) for gram in grams]
    del grams
    found, low, context = [], 0, CONTEXT
    while True:
        more, again = diagonals(names, context, low)
        found += more
        # The next pass is in charge of lags over this context, four of which must fit.
        if not again or TIMES * (context + 1) > len(words):
            return sorted(found, key=lambda run: (run[0], run[2]))
        numbers, width = {}, len(names)
        names = [numbers.setdefault(a * width + b, len(numbers)) for a, b in zip(names, names[context:])]
        low, context = context, 2 * context


def collapsed(words: Sequence[bytes], found: Sequence[tuple[int, int, int]]) -> bytes:
    """The words joined by a space; of each run only the first period stays."""
    if not found:
        return b" ".join(words)
    parts, at = [], 0
    for begin, end in sorted((start + period, start + length) for start, length, period in found):
        if at < begin:
            parts += words[at:begin]
        at = max(at, end)
    return b" ".join(parts + list(words[at:]))


def find_runs(documents: DataFrame, text: Column) -> DataFrame:
    """``row`` (the whole row), ``n_words``, ``runs`` by start and period, and ``collapsed``, the text without repetitions."""

    def run(batches):
        for batch in batches:
            counts, found, kept = [], [], []
            for value in as_bytes(batch.column("text")):
                words = value.split() if value else []
                own = runs(words)
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                kept.append(collapsed(words, own))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), pa.array(counts, pa.int64()), pa.array(found, RUNS),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["row", "n_words", "runs", "collapsed"],
            )

    rows = packed(documents, text=text)
    row = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {row}, n_words long, runs {RUN_TYPE}, collapsed string")


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
