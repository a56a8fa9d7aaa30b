from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from corpuscope.llm import periodic as P
from corpuscope.llm.queries import QUERIES, with_repeated_tail


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[:len(words) - q])


def brute(words):
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            end = i
            while end < n and words[end] == words[end - q]:
                end += 1
            start, length = i - q, end - i + q
            if length >= max(6, 4 * q) and smallest_period(words[start:end]) == q:
                found.append((start, length, q))
            i = end
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def shapes():
    rng = random.Random(11)
    for size in (1, 2, 3, 6):
        for _ in range(150):
            yield [rng.choice("abcdef"[:size]) for _ in range(rng.randint(0, 70))]
    for _ in range(150):  # runs beside, in and across one another
        words = []
        for _ in range(rng.randint(1, 5)):
            unit = [rng.choice("abcd") for _ in range(rng.randint(1, 14))]
            if rng.random() < 0.4:
                unit *= rng.randint(1, 5)
            words += (unit * rng.randint(1, 7))[: rng.randint(1, 90)] + [rng.choice("abx") for _ in range(rng.randint(0, 3))]
        yield words


def test_runs_against_all_lags():
    for words in shapes():
        words = [w.encode() for w in words]
        found = P.runs(words)
        assert found == brute(words), words
        assert P.collapsed(words, found).split() == brute_collapsed(words, found)


def test_one_word_repeated_takes_no_square():
    assert P.runs([b"ab"] * 300_000) == [(0, 300_000, 1)]
    words = [b"ab", b"cd"] * 50_000 + [b"x"] + [b"ab", b"cd", b"ef"] * 50_000
    assert P.runs(words) == [(0, 100_000, 2), (100_001, 150_000, 3)]


def test_bounds_are_inclusive():
    assert P.runs([b"a"] * 5) == [] and P.runs([b"a"] * 6) == [(0, 6, 1)]
    assert P.runs(list(b"abababa")) == [] and P.runs(list(b"abababab")) == [(0, 8, 2)]
    assert P.runs(list(b"abc" * 3 + b"ab")) == [] and P.runs(list(b"abc" * 4)) == [(0, 12, 3)]


def repeated_tail(doc_id, text):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_the_query_against_brute_force(spark, documents, prose, tmp_path):
    texts = prose(3, 300, (0, 90))
    texts[7], texts[8], texts[9] = None, "", "so " * 40 + "on and on and on and on and on\nand on"
    documents(list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(rows) == 300
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    some = 0
    for doc_id, text in enumerate(texts):
        words = repeated_tail(doc_id, text)
        found = brute(words)
        some += bool(found)
        top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        milli = 1000 * top[1] // top[2] if found else None
        assert rows[doc_id] == (
            doc_id, len(found), *top, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            sha(" ".join(brute_collapsed(words, found))),
        ), doc_id
    assert some > 10


def test_columns_of_the_row_stay(documents):
    got = P.find_runs(documents([(1, "a b a b a b a b a c"), (1, "a b a b a b a b a c")]), F.col("text"))
    assert [r.row.text for r in got.collect()] == ["a b a b a b a b a c"] * 2
    assert [tuple(r.runs[0]) for r in got.collect()] == [(0, 9, 2)] * 2
    assert {r.collapsed for r in got.collect()} == {"a b c"}


def test_odd_and_empty_tables(odd, none):
    rows = P.find_runs(odd, F.col("text")).collect()
    assert len(rows) == 9 and all(r.collapsed is not None for r in rows)
    long = next(r for r in rows if r.row.doc_id == 4)
    assert [tuple(x) for x in long.runs] == [(0, 60_000, 1)] and long.collapsed == "ab"
    assert all(r.runs == [] for r in rows if r.row.doc_id != 4)
    assert P.find_runs(none, F.col("text")).count() == 0
    tails = odd.select(with_repeated_tail(F.col("doc_id"), F.col("text")).alias("t"), "text").collect()
    assert [r.t is None for r in tails] == [r.text is None for r in tails]


@pytest.mark.parametrize("doc_id", [-7, 0, 38, 10**15])
def test_tail_of_any_key(documents, doc_id):
    text = " ".join(f"w{k}" for k in range(57))
    got = documents([(doc_id, text)]).select(with_repeated_tail(F.col("doc_id"), F.col("text")).alias("t")).first().t
    assert got.split() == repeated_tail(doc_id, text)
