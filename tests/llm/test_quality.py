from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from corpuscope.llm import quality as Q


def test_linear_time_equals_all_pairs():
    rng = np.random.default_rng(2)
    machine = Q.Machine(0.3, rng.normal(size=Q.SIZE), rng.normal(size=(Q.SIZE, Q.FACTORS)))
    index, value = rng.choice(Q.SIZE, 12, replace=False), rng.normal(size=12)
    want = 0.3 + machine.linear[index] @ value + sum(
        machine.factors[i] @ machine.factors[j] * x * y
        for a, (i, x) in enumerate(zip(index, value)) for j, y in list(zip(index, value))[a + 1:]
    )
    assert machine.score(index, value) == pytest.approx(1 / (1 + np.exp(-want)))


def labelled(spark, documents, n=500):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(150)]
    docs, labels = [], []
    for k in range(n):
        good = rng.random() < 0.7
        own = [rng.choice(words) for _ in range(rng.randint(10, 60))]
        if not good:
            own = own[:3] * 12 if k % 2 else [w.upper() + "!!" for w in own]
        docs.append((k, " ".join(own)))
        labels.append((k, int(good)))
    labels += [(10_000, 1), (0, None), (None, 1), (3, 7)]
    return documents(docs), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels[:n])


def test_held_out_rows_are_told_apart_and_never_learnt(spark, documents):
    docs, labels, truth = labelled(spark, documents)
    machine = Q.fit(docs, labels)
    got = {r.row.doc_id: r.score for r in Q.score(docs, machine).collect()}
    held = [k for k in truth if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([(got[k] >= Q.CUT) == (truth[k] == 1) for k in held]) > 0.97
    marked = {r[0]: r[1] for r in docs.select("doc_id", Q.held_out(docs.doc_id)).collect()}
    assert {k for k, v in marked.items() if v} == set(held)
    # Held-out labels can be turned round without any effect.
    turned = spark.createDataFrame([(k, 1 - y if k in held else y) for k, y in truth.items()], "doc_id long, quality int")
    other = Q.fit(docs, turned)
    assert np.array_equal(machine.factors, Q.fit(docs, spark.createDataFrame(list(truth.items()), "doc_id long, quality int")).factors)
    assert np.array_equal(machine.factors, other.factors)


def test_odd_and_empty_tables(spark, documents, odd, none):
    docs, labels, _ = labelled(spark, documents, 120)
    machine = Q.fit(docs, labels)
    scores = [(r.row.doc_id, r.score) for r in Q.score(odd, machine).collect()]
    assert len(scores) == 9 and all(0 <= s <= 1 for _, s in scores)
    assert len({s for k, s in scores if k == 5}) == 1 and len({s for k, s in scores if k in (1, 2)}) == 1
    assert Q.score(none, machine).count() == 0
    assert {round(r.score, 6) for r in Q.score(odd, Q.fit(none, labels)).collect()} == {0.5}


def test_a_key_that_repeats_does_not_grow_the_fit(spark, documents, monkeypatch):
    docs, labels, _ = labelled(spark, documents, 200)
    once, learnt = Q.fit(docs, labels), []
    same = docs
    for _ in range(3):
        same = same.unionByName(docs)
    assert np.array_equal(Q.fit(same, labels).factors, once.factors)
    train = Q.train
    monkeypatch.setattr(Q, "train", lambda rows: learnt.append(rows) or train(rows))
    key = next(k for k in range(200) if zlib.crc32(str(k).encode()) % 5)
    other = documents([(key, f"text {k} of a document that says something else every time") for k in range(100)])
    Q.fit(docs.unionByName(other), labels, max_rows=150)
    Q.fit(docs, labels, max_features=900)
    assert len(learnt[0]) <= 150 and sum(len(index) for index, _, _ in learnt[1]) <= 900 and learnt[1]
