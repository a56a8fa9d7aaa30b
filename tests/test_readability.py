from __future__ import annotations

import re

from pyspark.sql import functions as F

from corpuscope.functions import text as T
from corpuscope.functions.readability import SCORES, with_readability
from corpuscope.plans import profile

TEXTS = [
    (1, "The Patient was admitted. Nothing remarkable was reported by anyone, really! Hm."), (2, "one two three four five six seven eight nine"),
    (3, None), (4, " one two three four five six seven eight nine ten "), (5, ""), (6, "...... a b c d e f g h i j"),
]


def test_fewer_scores_are_the_same_and_count_less(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(2)
    every = {r.doc_id: r.asDict() for r in with_readability(docs, "text").collect()}
    few = with_readability(docs, "text", SCORES[:3])
    assert few.columns == ["doc_id", "text", *SCORES[:3]]
    assert {r.doc_id: r.asDict() for r in few.collect()} == {k: {c: v for c, v in r.items() if c != SCORES[3]} for k, r in every.items()}
    assert [k for k, r in sorted(every.items()) if r["gunning_fog"] is not None] == [1, 4, 6]
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "letters" not in plan and plan.count("lower(") == 1


ODD = [
    None, "", " ", "\n\t", ".", "...!?", " . ! ", "word", " word ", "One. Two! Three?", "..a..b", "a. .\x1c. b", " x\xa0y\x85z ",
    "no end", "\U0001F600 b\U0001F600 .", "rhythm sky aeiou", "Aé ÿ y", "x\ny.\r\nz", "bcd", "aaa", "aba", "b" * 40 + "a", "a" * 5000 + "." * 5000,
]


def test_counts_are_those_of_the_matches(spark):
    rows = spark.createDataFrame(list(enumerate(ODD)), "k int, t string").select(
        "k", T.word_count(F.col("t")).alias("words"), T.sentence_count(F.col("t")).alias("sentences"), T.vowel_groups(F.col("t")).alias("groups"),
    ).collect()
    space = re.escape(T.WHITESPACE)
    for row in rows:
        text = ODD[row.k] or ""
        assert row.words == len(re.findall(f"[^{space}]+", text))
        assert row.sentences == len(re.findall(f"[^{space}.!?][^.!?]*", text))
        assert row.groups == (None if ODD[row.k] is None else len(re.findall("[aeiouy]+", text)))


def test_profile_counts_words_and_sentences_of_a_row_once(spark):
    df = spark.createDataFrame([(1, "a", "One two. Three")], "doc_id long, label string, text string")
    facts = profile.document_facts(df, "text", "label", "doc_id")
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    # A pattern has its class of spaces as it stands: once the words, once the sentences, and no second time.
    assert plan.count(f", {T.WORD}") == 1 and plan.count(f", {T.SENTENCE}") == 1
