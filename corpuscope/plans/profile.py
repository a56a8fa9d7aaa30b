"""Exploratory profile of a labelled corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuscope.functions.numeric import round_even
from corpuscope.functions.readability import SCORES, with_readability, with_text_stats
from corpuscope.operators import cleaning, dictionary, distributions, labels, quality, terms
from corpuscope.staging import measured, stage

LENGTHS = ("char_len", "word_count", "sentence_count", "avg_word_len")


def document_facts(
    df: DataFrame, text: str = cleaning.TEXT, label: str = cleaning.LABEL, key: str = cleaning.KEY
) -> DataFrame:
    """Key, label, lengths and readability of each row with a text; no text column."""
    present = cleaning.drop_missing(df.select(key, label, text), text)
    return with_readability(with_text_stats(present, text), text, words="word_count", sentences="sentence_count").drop(text)


def corpus_summary(facts: DataFrame, label: str = cleaning.LABEL) -> DataFrame:
    """One row of headline numbers from :func:`document_facts`.

    Built on two small tables only: rows per label, and the frequencies of two measures.
    """
    per_label = facts.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(F.col(label).isNull()).orderBy(F.desc("n"), F.asc(label))
    labelled = F.sum("n").over(Window.partitionBy(F.col(label).isNull()))
    shares = per_label.select(
        F.when(F.col(label).isNotNull(), F.col("n")).alias("labelled"), "n",
        F.when(
            F.col(label).isNotNull() & (F.row_number().over(order) <= 5),
            round_even(F.col("n") / labelled * 100.0, 2),
        ).alias("top_pct"),
    )
    balance = shares.agg(
        F.sum("n").alias("n_rows"),
        F.count("labelled").alias("n_labels"),
        round_even(F.max("labelled").cast("double") / F.min("labelled"), 1).alias("imbalance_ratio"),
        F.count_if(F.col("labelled") < 50).alias("labels_below_50"),
        F.count_if(F.col("labelled") < 100).alias("labels_below_100"),
        round_even(F.sum("top_pct"), 1).alias("top5_pct"),
    )
    described = distributions.describe(facts, ["word_count", "flesch_kincaid_grade"], digits=4)
    words = F.col("metric") == "word_count"
    measures = described.agg(
        *[F.max(F.when(words, F.col(name))).alias(name) for name in ("q50", "mean", "std")],
        F.max(F.when(~words, F.col("q50"))).alias("grade"),
    )
    row = measures.select(F.struct("*").alias("row")).scalar()
    return balance.select(
        "*", row["q50"].alias("median_words"), row["mean"].alias("mean_words"),
        row["std"].alias("std_words"), row["grade"].alias("median_fk_grade"),
    )


def profile(
    df: DataFrame, text: str = cleaning.TEXT, label: str = cleaning.LABEL, key: str = cleaning.KEY
) -> dict[str, DataFrame]:
    """Every table of the exploratory profile, by name.

    Missing values and duplicates describe the raw rows, all else the rows with a text.
    The per-document measures and the tokens, as ids of a dictionary, are staged once, and what two tables share (best
    terms, label sets) is computed once; words come back into the results alone. Runs those jobs; :func:`corpuscope.staging.staged_work` around the use gives all back.
    """
    raw_text = text
    facts = stage(document_facts(df, text, label, key), "facts")
    encoded = dictionary.encode(terms.token_table(cleaning.drop_missing(df, text), text, label, key))
    present, text = encoded.rows, "tokens"
    best = measured(dictionary.named(terms.top_tfidf_terms(present, text, label, key), encoded))
    sets = measured(terms.label_sets(terms.label_vocabularies(present, text, label), label))
    return {
        "shape": quality.shape(df),
        "missing": quality.missing_profile(df),
        "duplicates": quality.duplicate_profile(df, raw_text),
        "label_frequency": labels.label_frequency(facts, label),
        "pareto": labels.pareto(facts, label),
        "imbalance": labels.imbalance(facts, label),
        "thin_labels": labels.thin_labels(facts, label),
        "lengths": distributions.describe(facts, LENGTHS),
        "length_histogram": distributions.histogram(facts, ["word_count", "char_len", "sentence_count"]),
        "length_boxes": distributions.box_summary(facts, "word_count", label),
        "outliers": distributions.outlier_summary(facts, "word_count"),
        "top_terms": best,
        "term_heatmap": terms.tfidf_heatmap(best, present, label),
        "bigrams": dictionary.named(terms.top_ngrams(present, 2, 20, text, summarised=False), encoded, 2).orderBy(F.desc("total"), "term"),
        "trigrams": dictionary.named(terms.top_ngrams(present, 3, 20, text, summarised=False), encoded, 3).orderBy(F.desc("total"), "term"),
        "bigrams_by_label": dictionary.named(terms.top_ngrams_by_label(present, 2, 5, 10, text, label), encoded, 2),
        "jaccard": terms.jaccard(present, text, label, sets=sets),
        "exclusive_terms": terms.exclusive_terms(present, text, label, sets=sets),
        "readability": distributions.describe(facts, SCORES, digits=2),
        "readability_by_label": distributions.medians(
            facts.where(F.col(label).isNotNull()), SCORES[:3], [label]
        ).orderBy("median_flesch_reading_ease"),
        "cloud_weights": dictionary.named(terms.cloud_weights(present, text, label), encoded),
        "summary": corpus_summary(facts, label),
    }
