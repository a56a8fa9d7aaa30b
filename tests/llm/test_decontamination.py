from __future__ import annotations

import re

import numpy as np
import pytest

from corpuscope.llm import decontamination as D

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    out = []
    for _, text in docs:
        w, hit, held = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(window, len(v))
            for p in range(len(v) - n + 1) if n else ():
                for q in range(len(w) - n + 1):
                    if w[q:q + n] == v[p:p + n]:
                        hit.update(range(q, q + n))
                        held.add(item_id)
        out.append((len(w), len(hit), sorted(held - {None})))
    return out


def cases(prose):
    texts = prose(3, 60, (0, 80), vocabulary=12)  # few words: many accidental matches
    items = [(k, t) for k, t in enumerate(prose(4, 12, (0, 30), vocabulary=12))]
    items += [(100, "alpha beta gamma"), (101, None), (102, ""), (None, "lost key words of an item that has no id at all here"),
              (103, " ".join(words(texts[5])[4:30])), (103, "alpha beta gamma")]
    docs = list(enumerate(texts)) + [(200, "so ALPHA, beta; gamma end"), (201, None), (202, "")]
    docs.append((203, "lost key words of an item that has no id at all here"))
    return docs, items


@pytest.mark.parametrize("block_words", [D.BLOCK_WORDS, 40])
def test_hits_are_those_of_every_pair(spark, documents, prose, block_words):
    docs, items = cases(prose)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.mark(documents(docs), bench, block_words=block_words).select("row.doc_id", "n_words", "n_hit", "items").collect()
    assert [(r.n_words, r.n_hit, r["items"]) for r in sorted(got, key=lambda r: r.doc_id)] == brute(docs, items)


def test_suffix_array_sorts_suffixes():
    rng = np.random.default_rng(1)
    for trial in range(60):
        codes = np.append(rng.integers(0, 4, rng.integers(0, 80)), 0).astype(np.int32)
        order = D.suffix_array(codes, 1000)
        def suffix(i):
            stop = i + np.flatnonzero(codes[i:] == 0)[0]
            return codes[i:stop].tolist()
        listed = [suffix(i) for i in order]
        assert listed == sorted(listed) and sorted(order) == np.flatnonzero(codes).tolist()


def test_longest_matches_are_the_longest(spark, documents, prose):
    docs, items = cases(prose)
    items = [(k, t) for k, t in items if k is not None and k < 103]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.item_id, r.item_word): r for r in D.longest_matches(documents(docs), bench).collect()}
    want = {}
    for item_id, item in items:
        v = words(item)
        for p in range(len(v)):
            best = 0
            for doc_id, text in docs:
                w = words(text)
                for q in range(len(w)):
                    n = 0
                    while q + n < len(w) and p + n < len(v) and w[q + n] == v[p + n]:
                        n += 1
                    best = max(best, n)
            if best >= min(10, len(v)):
                want[item_id, p] = best
    assert {k: r.words for k, r in got.items()} == want
    texts = dict(docs)
    for (item_id, p), r in got.items():
        assert words(texts[r.doc_id])[r.doc_word:r.doc_word + r.words] == words(dict(items)[item_id])[p:p + r.words]


def test_affected_documents_go_and_all_columns_stay(spark, documents):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    docs = documents([(1, "x ONE two three four five six seven eight nine ten y"), (2, "one two three"), (2, "one two three"), (3, None)])
    left = D.decontaminate(docs, bench)
    assert left.schema == docs.schema
    assert sorted(r.doc_id for r in left.collect()) == [2, 2, 3]


def test_odd_and_empty_tables(spark, odd, none):
    bench = spark.createDataFrame([(1, "ab " * 12), (2, None)], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit) for r in D.mark(odd, bench).select("row.doc_id", "n_words", "n_hit").collect()}
    assert got[1] == (0, 0) and got[2] == (0, 0) and got[3] == (0, 0) and got[4] == (60_000, 60_000) and got[6] == (1, 0)
    assert D.mark(none, bench).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert D.mark(odd, empty).filter("n_hit > 0").count() == 0
    assert D.longest_matches(odd, empty).count() == 0
