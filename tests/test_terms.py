"""Term analytics against plain Python loops."""

from __future__ import annotations

import math
from collections import Counter

import pytest

from corpuscope.operators import terms

DOCS = [
    (1, "heart pain heart rhythm", "A"), (2, "heart valve pain", "A"), (3, "brain pain tremor", "B"),
    (4, "brain tremor brain gait", "B"), (5, "heart brain", None), (6, "the of and", "B"), (7, None, "A"),
]


def counts(text):
    return Counter(w for w in (text or "").split() if w not in {"the", "of", "and"})


def test_term_stats(spark, notes):
    got = {r.term: (r.df, r.total) for r in terms.term_stats(notes(DOCS)).collect()}
    words = {w for _, t, _ in DOCS for w in counts(t)}
    assert got == {w: (sum(w in counts(t) for _, t, _ in DOCS), sum(counts(t)[w] for _, t, _ in DOCS)) for w in words}


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]


def test_counting_terms_moves_no_text(notes):
    df = notes(DOCS)
    assert exchanges(terms.document_terms(df)) == []
    vocab = terms.vocabulary(df)
    for found in (terms.weighted_terms(df, vocab), terms.vocabulary_lookup(df, vocab)):
        moved = exchanges(found)
        assert moved and not any("transcription" in line for line in moved)


def test_a_vocabulary_counts_terms_once(notes):
    found = terms.vocabulary(notes(DOCS), max_features=2)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_document_terms_count_repeats(notes):
    got = {(r.doc_id, r.term): r.tf for r in terms.document_terms(notes(DOCS)).collect()}
    assert got == {(key, w): n for key, text, _ in DOCS for w, n in counts(text).items()}


def test_bounds_and_ties_of_the_vocabulary(notes):
    found = terms.vocabulary(notes(DOCS), min_df=2, max_df=3 / 7, max_features=2).collect()
    assert [r.term for r in found] == ["brain", "heart"]  # 4 uses in 3 of 7 texts each; ties by name
    assert found[1].idf == pytest.approx(math.log(8 / 4) + 1)


@pytest.mark.parametrize("sublinear", [False, True])
def test_weights(notes, sublinear):
    df = notes(DOCS)
    vocab = terms.vocabulary(df, min_df=2, max_df=1.0)
    idf = {r.term: r.idf for r in vocab.collect()}
    got = {(r.doc_id, r.term): r.weight for r in terms.weighted_terms(df, vocab, sublinear=sublinear).collect()}
    expected = {}
    for key, text, _ in DOCS:
        raw = {w: (1 + math.log(n) if sublinear else n) * idf[w] for w, n in counts(text).items() if w in idf}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        expected |= {(key, w): x / norm for w, x in raw.items()}
    assert got == pytest.approx(expected)


def test_mean_scores_count_documents_without_the_term(notes):
    df = notes(DOCS)
    vocab = terms.vocabulary(df, min_df=1, max_df=1.0)
    weights = {(r.doc_id, r.term): r.weight for r in terms.weighted_terms(df, vocab).collect()}
    got = {(r.medical_specialty, r.term): r for r in terms.top_tfidf_terms(df, min_df=1, max_df=1.0).collect()}
    a_docs = [k for k, _, lab in DOCS if lab == "A"]
    assert got["A", "heart"].tfidf_score == pytest.approx(
        sum(weights.get((k, "heart"), 0) for k in a_docs) / len(a_docs), abs=1e-4
    )
    assert got["A", "heart"].rank == 1 and {lab for lab, _ in got} == {"A", "B"}


def test_top_ngrams_by_label_use_bounds_inside_the_label(notes):
    rows = [(1, "chest pain", "A"), (2, "chest pain", "A"), (3, "chest pain now", "B"), (4, "left arm", "B"), (5, "left arm", "A")]
    got = [(r.medical_specialty, r.term, r.total) for r in terms.top_ngrams_by_label(notes(rows), max_df=1.0).collect()]
    assert got == [("A", "chest pain", 2)]
    assert [tuple(r) for r in terms.top_ngrams(notes(rows), max_df=0.5).collect()] == [("left arm", 2)]


def test_vocabulary_overlap(notes):
    rows = [(1, "xx yy zz", "A"), (2, "yy zz ww", "B"), (3, "qq qq", "C"), (4, "the", "D")]
    df = notes(rows)
    got = {(r.label_a, r.label_b): r.jaccard for r in terms.jaccard(df, min_docs=1).collect()}
    assert len(got) == 16
    assert got["A", "B"] == got["B", "A"] == 0.5
    assert got["A", "A"] == 1.0 and got["A", "C"] == 0.0 and got["D", "D"] == 0.0
    unique = {r.medical_specialty: (r.n_terms, r.n_unique, r.unique_pct, r.n_all) for r in terms.exclusive_terms(df, min_docs=1).collect()}
    assert unique == {"A": (3, 1, 33.3, 5), "B": (3, 1, 33.3, 5), "C": (1, 1, 100.0, 5), "D": (0, 0, 0.0, 5)}


def test_cloud_weights_leave_out_the_extra_words(notes):
    got = terms.cloud_weights(notes([(1, "patient pain pain using fever", "A")])).orderBy("rank").collect()
    assert [(r.term, r.total, r.weight) for r in got] == [("pain", 2, 1.0), ("fever", 1, 0.5)]


def test_heat_map_fills_zeros(notes):
    df = notes(DOCS)
    best = terms.top_tfidf_terms(df, min_df=1, max_df=1.0)
    grid = {r.term: r for r in terms.tfidf_heatmap(best, df).collect()}
    assert grid["gait"]["A"] == 0.0 and grid["gait"]["B"] > 0


@pytest.mark.parametrize("top", [1, 2, 3, 5, 6, 9])
def test_top_lists_of_any_length(notes, top):
    stats = terms.term_stats(notes(DOCS))
    every = sorted((tuple(r) for r in stats.collect()), key=lambda r: (-r[2], r[0]))
    assert [tuple(r) for r in terms.most_frequent(stats, top).collect()] == every[:top]


def test_top_lists_are_cut_before_the_shuffle(notes):
    plan = terms.top_tfidf_terms(notes(DOCS), min_df=1, max_df=1.0)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_clouds_fold_plurals_and_take_phrases_out(spark):
    texts = [("left knee and left knee", "x"), ("left knee of knees", "x"), ("glass glas tide", "x"), ("tide pool quay", "x"), *[(f"word{k} other{k}", "x") for k in range(40)], ("knees", "y")]
    df = spark.createDataFrame([(k, *t) for k, t in enumerate(texts)], "doc_id long, transcription string, medical_specialty string")
    options = dict(stop_words=("and", "of"), words=200)
    plain = {(r.medical_specialty, r.term): r.total for r in terms.cloud_weights(df, **options).collect()}
    assert plain["x", "knee"] == 3 and plain["x", "knees"] == 1
    folded = {(r.medical_specialty, r.term): r.total for r in terms.cloud_weights(df, plurals=True, **options).collect()}
    assert folded["x", "knee"] == 4 and ("x", "knees") not in folded  # one form where both occur
    assert folded["y", "knees"] == 1 and folded["x", "glass"] == 1 and folded["x", "glas"] == 1  # not across labels, not from ss
    both = {(r.medical_specialty, r.term): r.total for r in terms.cloud_weights(df, plurals=True, phrases=True, threshold=15.0, **options).collect()}
    assert both["x", "left knee"] == 3 and both["x", "knee"] == 1 and ("x", "left") not in both
    assert ("x", "knee left") not in both and ("x", "knee knee") not in both  # stop words stand between
    assert both["x", "tide"] == 2
