from __future__ import annotations

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuscope.operators import counting, terms


def texts():
    rng = random.Random(4)
    words = ["aa", "bb", "ccc", "é日", "dd", "ee"]
    return [[rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 9, 40]))] for _ in range(60)] + [[]]


def brute(words, low, high, extra=()):
    found = Counter(" ".join(words[i:i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1))
    return found + Counter(extra)


@pytest.mark.parametrize("low, high", [(1, 1), (1, 2), (2, 2), (3, 3), (1, 4)])
def test_counts_of_rows_and_of_a_slice(low, high):
    rows = texts()
    tokens = pa.array([["zz"], *rows, None]).slice(1)  # a part of a batch
    sizes, found, counts = counting.row_counts(tokens, low, high, ("",))
    pairs, at = list(zip(found.to_pylist(), counts.tolist())), 0
    for size, words in zip(sizes, [*rows, None]):
        assert Counter(dict(pairs[at:at + size])) == (brute(words, low, high, [""]) if words is not None else Counter())
        at += size
    assert at == len(pairs)
    whole = Counter()
    for _, numbers, names in counting.grams(tokens, low, high):
        whole.update(names[k].as_py() for k in numbers)
    assert whole == sum((brute(words, low, high) for words in rows), Counter())


def test_terms_of_rows_are_counted_without_sorting_their_strings(spark, monkeypatch):
    monkeypatch.setattr(counting, "WORDS", 50)
    rows = [(k, f"l{k % 3}", " ".join(words)) for k, words in enumerate(texts())] + [(1000, None, None), (1000, None, "aa aa")]
    df = spark.createDataFrame(rows, "doc_id long, label string, text string").repartition(3)
    counted = terms.counted_terms(df, "text", ["doc_id", "label"], (1, 2), (), ("",))
    assert "sort_array" not in counted._jdf.queryExecution().toString()
    got = sorted(((r.doc_id, r.label, r.term, r.tf) for r in counted.collect()), key=repr)
    token = lambda text: [w for w in (text or "").split() if len(w) > 1]
    want = [(k, label, term, n) for k, label, text in rows for term, n in brute(token(text), 1, 2, [""]).items()]
    assert got == sorted(want, key=repr)


def test_ids_are_counted_as_numbers(spark):
    df = spark.createDataFrame([(1, [5, 6, 5]), (2, []), (3, None)], "k long, terms array<long>")
    got = counting.counted(df, ["k"], (1, 1))
    assert got.schema["term"].dataType.simpleString() == "bigint"
    assert sorted(map(tuple, got.collect())) == [(1, 5, 2), (1, 6, 1)]
    assert counting.counted(df, [], (1, 1)).agg(F.sum("tf")).first()[0] == 3
