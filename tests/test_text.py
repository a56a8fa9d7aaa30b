"""Text measures against plain Python on hand-written and supplied texts."""

from __future__ import annotations

import re
import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from corpuscope.functions import stopwords
from corpuscope.functions import text as T
from corpuscope.functions.readability import SCORES, with_readability, with_text_stats

EDGE_TEXTS = [
    None, "", "   ", "\t  word  \x1c", "a b\x85c", "one. two! three?? . ", "...", "Éa déjà_vu 42 x y2",
    "a" + " " * 3000 + "b", "ünïcode wörds ARE fine", "no-stop. \x1d yes", "it's the end", "\x0bvt\x0c",
]


def one_column(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def python_stats(text):
    if text is None:
        return 0, 0, 0, 0.0
    words = text.split()
    sentences = [s for s in re.split(r"[.!?]+", text) if s.strip()]
    mean = sum(map(len, words)) / len(words) if words else 0.0
    return len(text), len(words), len(sentences), mean


def check_texts(spark, texts):
    rows = with_text_stats(one_column(spark, texts), "text").select(
        "*", T.strip(F.col("text")).alias("stripped"), T.tokens(F.col("text"), ()).alias("tokens"),
        *[T.at_least_words(F.col("text"), k).alias(f"least_{k}") for k in (1, 2, 3, 20)],
    ).orderBy("doc_id").collect()
    for text, row in zip(texts, rows):
        chars, words, sentences, mean = python_stats(text)
        assert (row.char_len, row.word_count, row.sentence_count) == (chars, words, sentences), repr(text)
        assert row.avg_word_len == pytest.approx(mean, abs=0.0051)
        if text is not None:
            assert row.stripped == text.strip()
            assert row.tokens == re.findall(r"\b\w\w+\b", text.lower()), repr(text)
            for k in (1, 2, 3, 20):
                assert row[f"least_{k}"] == (words >= k), (repr(text), k)


def test_measures_of_edge_texts(spark):
    check_texts(spark, EDGE_TEXTS)


ALPHABET = "ab É9_.!? \t\n\x1c\x1f\x85    　-'"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=30, max_size=60))
def test_measures_of_random_texts(spark, texts):
    check_texts(spark, texts)


def test_every_whitespace_code_point_is_known():
    spaces = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    assert sorted(T.WHITESPACE) == spaces


def test_default_stop_words_are_those_of_spark(spark):
    assert list(stopwords.ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")


def test_stop_words_go_before_ngrams(spark):
    df = one_column(spark, ["chest of pain and fever"]).select(T.tokens(F.col("text")).alias("t"))
    row = df.select(T.ngrams(F.col("t"), 2, 2).alias("two"), T.ngrams(F.col("t"), 1, 3).alias("all")).first()
    assert row.two == ["chest pain", "pain fever"]
    assert row.all == ["chest", "pain", "fever", "chest pain", "pain fever", "chest pain fever"]


def test_ngrams_of_short_texts_are_empty(spark):
    df = one_column(spark, ["", "alone"]).select(T.tokens(F.col("text")).alias("t"))
    assert [r.g for r in df.select(T.ngrams(F.col("t"), 2, 2).alias("g")).collect()] == [[], []]
    with pytest.raises(ValueError):
        T.ngrams(F.col("t"), 2, 1)


def test_token_options(spark):
    text = F.col("text")
    row = one_column(spark, ["The Pain is in the Chest"]).select(
        T.tokens(text, (), lowercase=False).alias("cased"), T.tokens(text, max_length=1).alias("cut")
    ).first()
    assert row.cased == ["The", "Pain", "is", "in", "the", "Chest"]
    assert row.cut == ["pain"]


def python_readability(text):
    words = text.lower().split()
    if len(words) < 10:
        return [None] * 4
    syllables = [max(1, len(re.findall("[aeiouy]+", w))) for w in words]
    w, y, c = len(words), sum(syllables), sum(s >= 3 for s in syllables)
    s = max(1, python_stats(text)[2])
    letters = sum(ch.isalpha() or ch.isdecimal() for ch in text)
    return [
        206.835 - 1.015 * w / s - 84.6 * y / w, 0.39 * w / s + 11.8 * y / w - 15.59,
        0.4 * (w / s + 100 * c / w), 0.0588 * 100 * letters / w - 0.296 * 100 * s / w - 15.8,
    ]


def test_readability_matches_a_word_loop(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in with_readability(docs, "text").collect():
        for name, expected in zip(SCORES, python_readability(texts[row.doc_id])):
            assert (row[name] is None) == (expected is None)
            if expected is not None:
                assert row[name] == pytest.approx(expected, abs=0.0051)


def test_readability_needs_ten_words(spark):
    rows = with_readability(one_column(spark, [None, "one two three", " ".join(["word"] * 10)]), "text")
    assert [r.gunning_fog is None for r in rows.orderBy("doc_id").collect()] == [True, True, False]
