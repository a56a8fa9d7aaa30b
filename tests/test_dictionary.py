"""Term work on ids against the same on words."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpuscope.operators import dictionary, terms


def made(spark, rows=300, words=400):
    rng = random.Random(5)
    texts = [
        (k, rng.choice("AB"), " ".join(f"w{min(int(rng.paretovariate(0.7)), words)}" for _ in range(rng.randint(0, 40))))
        for k in range(rows)
    ]
    return spark.createDataFrame([*texts, (rows, "A", None), (rows + 1, None, "zz ähre w1"), (rows + 2, "B", "")], "doc_id long, lang string, text string").repartition(5)


def encoded(df, **blocks):
    return dictionary.encode(terms.token_table(df, "text", "lang", stop_words=()), **blocks)


@pytest.mark.parametrize("blocks", [{}, dict(block_words=20), dict(block_tokens=1)])
def test_ids_read_back_and_are_in_order_of_words(spark, blocks):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        df = made(spark)
        ids = encoded(df, **blocks)
        names = {r.id: r.term for r in ids.terms.collect()}
        assert sorted(names) == list(range(1, len(names) + 1))
        assert [names[k] for k in sorted(names)] == sorted(names.values(), key=lambda w: w.encode())
        assert 1 << ids.bits > len(names)
        want = {r.doc_id: r.tokens for r in terms.token_table(df, "text", "lang", stop_words=()).collect()}
        assert {r.doc_id: [names[k] for k in r.tokens] for r in ids.rows.collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_and_empty_tables(spark):
    kind = "doc_id long, tokens array<string>, row string, block long, ids int"
    odd = [(1, None, None, 1, 1), (1, [], "x", 2, 2), (1, ["b", None, "a", "b"], "y", None, None), (1, ["b", None, "a", "b"], "y", None, None)]
    ids = dictionary.encode(spark.createDataFrame(odd, kind))
    assert ids.rows.columns == ["doc_id", "tokens", "row", "block", "ids"]
    found = sorted(map(tuple, ids.rows.collect()), key=str)
    assert found == sorted([(1, None, None, 1, 1), (1, [], "x", 2, 2), *[(1, [2, 1, 2], "y", None, None)] * 2], key=str)
    for rows in ([], odd[:2]):
        none = dictionary.encode(spark.createDataFrame(rows, kind))
        assert none.terms.count() == 0 and none.rows.count() == len(rows)
        assert terms.vocabulary(none.rows, "tokens", (1, 2)).count() == 0
    fixed = dictionary.encode(spark.range(2).select("id", F.array(F.lit("a")).alias("tokens"), F.lit(1).alias("one")))
    assert sorted(map(tuple, fixed.rows.collect())) == [(0, [1], 1), (1, [1], 1)]  # columns that are never NULL
    alone = dictionary.encode(spark.createDataFrame([(["a"],)], "tokens array<string>"))
    assert [tuple(r) for r in alone.rows.collect()] == [([1],)]


@pytest.mark.parametrize("lists", [False, True])
@pytest.mark.parametrize("ngram_range", [(1, 1), (2, 2), (1, 3)])
def test_term_work_is_the_same(spark, monkeypatch, lists, ngram_range):
    """Also where n-grams do not fit a number and are lists."""
    df = made(spark)
    if lists:
        monkeypatch.setattr(dictionary, "packs", lambda *_: False)
    options = dict(ngram_range=ngram_range, stop_words=("w1",) if ngram_range == (1, 1) else ())
    ids = dictionary.encode(terms.token_table(df, "text", "lang", stop_words=()), looked_up=("w1", "nowhere"))
    vocab, vocab_ids = (terms.vocabulary(d, c, max_features=40, **options) for d, c in ((df, "text"), (ids.rows, "tokens")))
    named = dictionary.named(vocab_ids, ids, ngram_range[1])
    assert sorted(map(tuple, vocab.collect())) == sorted(map(tuple, named.select(vocab.columns).collect()))
    weights, by_id = (terms.weighted_terms(d, v, c, **options) for d, v, c in ((df, vocab, "text"), (ids.rows, vocab_ids, "tokens")))
    assert by_id.schema["term"].dataType.simpleString() in ("bigint", "array<bigint>")
    by_id = dictionary.named(by_id, ids, ngram_range[1]).select(weights.columns)
    rounded = lambda d: sorted(map(tuple, d.withColumn("weight", F.round("weight", 9)).collect()))
    assert rounded(weights) == rounded(by_id)


def test_no_word_moves_after_the_dictionary(spark):
    ids = encoded(made(spark))
    vocab = terms.vocabulary(ids.rows, "tokens", (1, 2), stop_words=(), max_features=40)
    for found in (vocab, terms.weighted_terms(ids.rows, vocab, "tokens", ngram_range=(1, 2), stop_words=()), terms.top_ngrams(ids.rows, 3, 5, "tokens", stop_words=())):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in plan and "dictionary-" not in plan and dict(found.dtypes)["term"] == "bigint"


def test_stop_words_must_have_been_looked_up(spark):
    ids = encoded(made(spark))
    with pytest.raises(ValueError, match="not looked up"):
        terms.vocabulary(ids.rows, "tokens", stop_words=("w2",))
    with pytest.raises(ValueError, match="words, not"):
        terms.cloud_weights(ids.rows, "tokens", "lang", plurals=True)
