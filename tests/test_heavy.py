from __future__ import annotations

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuscope.operators import dictionary, heavy, terms


def made(spark, seed, rows=400):
    """Words by a heavy tail, over several tasks."""
    rng = random.Random(seed)
    texts = [(k, " ".join(f"w{min(int(rng.paretovariate(0.7)), 3000)}" for _ in range(rng.randint(0, 60)))) for k in range(rows)]
    return texts, spark.createDataFrame(texts, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("capacity", [30, 100, 10_000])
def test_no_frequent_term_is_left_out(spark, capacity):
    texts, df = made(spark, 1)
    counts = Counter(g for _, t in texts for w in [t.split()] for g in [*w, *map(" ".join, zip(w, w[1:]))])
    found = heavy.candidates(terms.with_terms(df, "text", [], (1, 1), ()), (1, 2), 10, capacity)
    kept = {r.term for r in found.terms.collect()}
    assert {g for g, n in counts.items() if n > found.limit} <= kept
    assert {g for g, _ in counts.most_common(10)} <= kept and len(kept) < len(counts) / 20


def test_grams_stay_inside_their_row():
    rows = [["a", "b", "c"], [], ["d"], ["e", "f"], ["g", "h", "i", "j"]]
    found = [g.to_pylist() for g in heavy._grams(pa.array(rows, pa.list_(pa.string())), 1, 3)]
    assert found == [[" ".join(r[k:k + n]) for r in rows for k in range(len(r) - n + 1)] for n in (1, 2, 3)]
    assert [g.to_pylist() for g in heavy._grams(pa.array([["x"]], pa.list_(pa.string())), 2, 3)] == [[], []]


def test_summaries_bound_every_count(spark):
    texts, df = made(spark, 2)
    counts = Counter(w for _, t in texts for w in t.split())
    rows = heavy.summaries(terms.with_terms(df, "text", [], (1, 1), ()), (1, 1), 25).collect()
    missed, lower = sum(r.n for r in rows if r.term is None), Counter()
    for r in rows:
        if r.term is not None:
            lower[r.term] += r.n
    assert missed > 0 and max(Counter(r.term for r in rows).values()) <= 5
    assert all(lower[w] <= n <= lower[w] + missed for w, n in counts.items())


def test_summaries_too_small_to_tell(spark):
    df = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(30))) for k in range(40)], "doc_id long, text string").repartition(4)
    assert heavy.candidates(terms.with_terms(df, "text", [], (1, 1), ()), (1, 1), 20, 30) is None
    assert heavy.candidates(terms.with_terms(df.where("false"), "text", [], (1, 1), ()), (1, 3), 20).terms.count() == 0


@pytest.mark.parametrize("options", [
    dict(max_features=50), dict(max_features=50, max_df=0.2), dict(max_features=50, min_df=3, max_df=30), dict(max_features=10**6), dict(max_features=2000),
])
def test_vocabularies_are_the_same(spark, monkeypatch, options):
    _, df = made(spark, 3)
    pruned = sorted(map(tuple, terms.vocabulary(df, "text", (1, 2), stop_words=(), **options).collect()))
    monkeypatch.setattr(heavy, "candidates", lambda *_: None)
    assert pruned == sorted(map(tuple, terms.vocabulary(df, "text", (1, 2), stop_words=(), **options).collect()))


@pytest.mark.parametrize("ids", [False, True])
def test_few_grams_are_shuffled_and_none_is_lost(spark, monkeypatch, ids):
    texts, df = made(spark, 3)
    counts, held = Counter(), Counter()
    for _, t in texts:
        w = t.split()
        grams = [*map(" ".join, zip(w, w[1:]))]
        counts.update(grams)
        held.update(set(grams))
    encoded = dictionary.encode(terms.token_table(df.withColumn("label", F.lit("x")), "text", "label", "doc_id", ()))
    kept, stats = [], terms.term_stats
    monkeypatch.setattr(terms, "term_stats", lambda *a: kept.append(a[5]) or stats(*a))
    monkeypatch.setattr(terms, "COUNTERS", 400)
    found = terms.top_ngrams(*((encoded.rows, 2, 5, "tokens") if ids else (df, 2, 5, "text")), stop_words=())
    found = dictionary.named(found, encoded, 2) if ids else found
    want = sorted(((-n, g) for g, n in counts.items() if 2 <= held[g] <= 0.9 * len(texts)))[:5]
    assert sorted((-r.total, r.term) for r in found.collect()) == want
    assert len(kept) == 1 and 5 <= kept[0].count() < len(counts) / 5
