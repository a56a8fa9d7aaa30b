"""One query per operator (or group of operators) over the supplied tables.

``documents`` stands for the notes, with ``lang`` (four labels, uneven) or ``source``
(twenty labels, even) as the label. ``untidy`` derives missing, blank and padded cells
from ``documents`` and ``labels``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscope.functions import text as T
from corpuscope.functions.numeric import round_even
from corpuscope.functions.readability import SCORES, with_readability, with_text_stats
from corpuscope.functions.stopwords import ENGLISH
from corpuscope.operators import (
    classifier, cleaning, dictionary, distributions, labels, metrics, quality, schema, splitting, terms,
)
from corpuscope.plans import prepare, profile, train
from corpuscope.sources import tables
from corpuscope.staging import shared_folder, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LANG = {"text": "text", "label": "lang"}
NOTES = {**LANG, "key": "doc_id"}
LENGTHS = ["word_count", "char_len", "sentence_count"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.read_table(spark, f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def untidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes with NULL, blank and padded texts and labels."""
    joined = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    text = (
        F.when(~good & ~toxic, None)
        .when(good & toxic, F.lit("\t\u00a0 "))
        .otherwise(F.concat(F.lit("\t\u00a0"), F.col("text"), F.lit("\u2003\x1c")))
    )
    label = (
        F.when(~good & toxic, None)
        .when(F.col("source") == "src3", F.lit("  "))
        .otherwise(F.concat(F.lit(" "), F.col("lang"), F.lit("\t")))
    )
    return joined.select("doc_id", text.alias("text"), label.alias("lang"))


def uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, source)`` with labels of very different size, made of the language and the root of the source's number."""
    number = F.floor(F.sqrt(F.substring("source", 4, 9).cast("int"))).cast("int")
    return documents(spark, sf_dir).select("doc_id", F.concat_ws("-", "lang", number.cast("string")).alias("source"))


def clean_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_distinct(documents(spark, sf_dir), **NOTES)


def measured_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, label and length columns of the notes."""
    return with_text_stats(documents(spark, sf_dir).select("doc_id", "lang", "text"), "text").drop("text")


def scored_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_readability(documents(spark, sf_dir).select("doc_id", "lang", "text"), "text").drop("text")


def few_scores(spark: SparkSession, sf_dir: str, scores: Sequence[str]) -> DataFrame:
    """As :func:`scored_notes`, with these scores alone, and nothing counted that they do not use."""
    return with_readability(documents(spark, sf_dir).select("doc_id", "lang", "text"), "text", scores).drop("text")


def train_ready_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.train_ready(stage(clean_notes(spark, sf_dir), "clean"), **NOTES)


def digest(items: Column) -> Column:
    """A token list as one comparable value."""
    return F.md5(F.concat_ws("|", items))


# --- reading, schema, projections ------------------------------------------------------


@query
def parquet_scan(spark, sf):
    return documents(spark, sf).select("doc_id", "text", "lang")


@query
def renamed_columns(spark, sf):
    shouted = documents(spark, sf).select(
        F.col("doc_id").alias(" Doc ID"), F.col("lang").alias("Medical Specialty "), F.col("n_chars").alias("N Chars")
    )
    named = schema.require_columns(schema.normalise_columns(shouted), {"doc_id", "medical_specialty"})
    return schema.rename(named, {"medical_specialty": "label"}).select(
        F.col("doc_id").cast("string").alias("doc_id"), "label", "n_chars"
    )


@query
def strip_text(spark, sf):
    return untidy(spark, sf).select("doc_id", T.strip(F.col("text")).alias("text"), T.strip(F.col("lang")).alias("lang"))


@query
def text_stats(spark, sf):
    return with_text_stats(untidy(spark, sf).select("doc_id", "text"), "text").drop("text")


@query
def fill_missing(spark, sf):
    return cleaning.fill_missing(untidy(spark, sf), "text").select(
        "doc_id", "text", T.char_len(F.col("text")).alias("char_len")
    )


@query
def tokens(spark, sf):
    found = documents(spark, sf).select("doc_id", T.tokens(F.col("text"), ()).alias("t"))
    return found.select("doc_id", F.size("t").cast("long").alias("n_tokens"), digest(F.col("t")).alias("tokens"))


@query
def stop_word_removal(spark, sf):
    found = documents(spark, sf).select("doc_id", T.tokens(F.col("text")).alias("t"))
    return found.select("doc_id", F.size("t").cast("long").alias("n_tokens"), digest(F.col("t")).alias("tokens"))


@query
def ngram_lists(spark, sf):
    kept = documents(spark, sf).select("doc_id", T.tokens(F.col("text")).alias("t"))
    ranges = {"unigrams": (1, 1), "bigrams": (2, 2), "trigrams": (3, 3), "uni_bigrams": (1, 2)}
    return kept.select("doc_id", *[digest(T.ngrams(F.col("t"), *r)).alias(name) for name, r in ranges.items()])


@query
def preprocessing_options(spark, sf):
    text = F.col("text")
    return documents(spark, sf).select(
        "doc_id",
        digest(T.tokens(text, (), lowercase=False)).alias("cased"),
        digest(T.tokens(text, (), lowercase=True)).alias("lowered"),
        digest(T.tokens(text, lowercase=True)).alias("without_stop_words"),
        F.size(T.tokens(text, max_length=512)).cast("long").alias("n_within_max_length"),
    )


# --- filters ---------------------------------------------------------------------------


@query
def drop_missing(spark, sf):
    return cleaning.drop_missing(untidy(spark, sf), "text", "lang").select("doc_id", "lang")


@query
def drop_empty(spark, sf):
    rows = untidy(spark, sf).select("doc_id", T.strip(F.col("text")).alias("text"), T.strip(F.col("lang")).alias("lang"))
    return cleaning.drop_empty(rows, "text", "lang").select("doc_id", "lang")


@query
def usable_rows(spark, sf):
    return cleaning.usable_rows(untidy(spark, sf), **NOTES)


@query
def min_words(spark, sf):
    return cleaning.min_words(documents(spark, sf), 20, "text").select("doc_id", "lang", "n_chars")


@query
def rare_label_filter(spark, sf):
    return labels.keep_frequent_labels(uneven(spark, sf), "source", 20)


@query
def top_label_rows(spark, sf):
    return labels.keep_top_labels(uneven(spark, sf), "source", 10)


@query
def outlier_rows(spark, sf):
    return distributions.outlier_rows(measured_notes(spark, sf), "word_count").select("doc_id", "lang", "word_count")


# --- cleaning --------------------------------------------------------------------------


@query
def exact_dedup(spark, sf):
    return cleaning.drop_duplicate_texts(documents(spark, sf).select("doc_id", "text", "lang"), "text")


@query
def clean_pair(spark, sf):
    return cleaning.clean_pair(untidy(spark, sf), **NOTES)


@query
def clean_pair_as_named(spark, sf):
    return cleaning.clean_pair_as_named(untidy(spark, sf), min_class_samples=80, min_doc_length=30, **NOTES)


@query
def clean_distinct(spark, sf):
    return clean_notes(spark, sf)


@query
def clean_distinct_untidy(spark, sf):
    return cleaning.clean_distinct(untidy(spark, sf), **NOTES)


@query
def clean_summary(spark, sf):
    return cleaning.clean_summary(clean_notes(spark, sf), "lang")


@query
def clean_preview(spark, sf):
    return clean_notes(spark, sf).orderBy(*cleaning.clean_order("lang")).limit(10)


# --- quality and labels ----------------------------------------------------------------


@query
def missing_profile(spark, sf):
    return quality.missing_profile(untidy(spark, sf))


@query
def duplicate_profile(spark, sf):
    return quality.duplicate_profile(untidy(spark, sf), "text")


@query
def table_shape(spark, sf):
    return quality.shape(documents(spark, sf))


@query
def label_frequency(spark, sf):
    return labels.label_frequency(untidy(spark, sf), "lang")


@query
def clean_label_frequency(spark, sf):
    return labels.label_frequency(clean_notes(spark, sf), "lang")


@query
def pareto(spark, sf):
    return labels.pareto(uneven(spark, sf), "source").withColumn("cumulative_pct", round_even(F.col("cumulative_pct"), 8))


@query
def imbalance(spark, sf):
    found = labels.imbalance(untidy(spark, sf), "lang")
    return found.withColumns({name: round_even(F.col(name), 8) for name in ("imbalance_ratio", "rows_per_class")})


@query
def thin_labels(spark, sf):
    return labels.thin_labels(uneven(spark, sf), "source", 50)


@query
def thin_label_totals(spark, sf):
    return labels.thin_label_totals(uneven(spark, sf), "source")


@query
def top_share(spark, sf):
    return labels.top_share(uneven(spark, sf), "source", 5)


@query
def top_labels(spark, sf):
    return labels.top_labels(uneven(spark, sf), "source", 6)


@query
def distinct_labels(spark, sf):
    return labels.distinct_labels(untidy(spark, sf), "lang")


# --- lengths and readability -----------------------------------------------------------


@query
def describe_lengths(spark, sf):
    return distributions.describe(measured_notes(spark, sf), [*LENGTHS, "avg_word_len"], digits=1)


@query
def median_words_by_label(spark, sf):
    return distributions.medians(measured_notes(spark, sf), ["word_count"], ["lang"])


@query
def iqr_bounds(spark, sf):
    return distributions.iqr_bounds(measured_notes(spark, sf), "word_count")


@query
def outlier_summary(spark, sf):
    return distributions.outlier_summary(measured_notes(spark, sf), "word_count")


@query
def length_histogram(spark, sf):
    found = distributions.histogram(measured_notes(spark, sf), LENGTHS)
    return found.withColumns({name: round_even(F.col(name), 6) for name in ("bin_low", "bin_high")})


@query
def box_summary(spark, sf):
    return distributions.box_summary(measured_notes(spark, sf), "word_count", "lang")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line prices: a metric of nearly as many values as rows."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_partkey", net.cast("double").alias("net"))


@query
def describe_prices(spark, sf):
    return distributions.describe(prices(spark, sf), ["net"], ["l_returnflag"], digits=3)


@query
def price_bounds(spark, sf):
    found = distributions.iqr_bounds(prices(spark, sf), "net", ["l_returnflag"])
    return found.select("l_returnflag", *[round_even(F.col(c), 6).alias(c) for c in ("q1", "q3", "lower_bound", "upper_bound")])


@query
def price_outliers(spark, sf):
    found = distributions.outlier_rows(prices(spark, sf).withColumn("net", F.col("net") * F.col("net")), "net")
    return found.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query
def part_frequency(spark, sf):
    """Labels by the thousand: no task sums over all of them."""
    return labels.label_frequency(prices(spark, sf), "l_partkey")


@query
def part_pareto(spark, sf):
    return labels.pareto(prices(spark, sf), "l_partkey").withColumn("cumulative_pct", round_even(F.col("cumulative_pct"), 8))


@query
def part_weights(spark, sf):
    found = labels.class_weights(prices(spark, sf), "l_partkey")
    return found.withColumn("weight", round_even(F.col("weight"), 8))


@query
def part_quotas(spark, sf):
    """Split sizes of thousands of labels, by largest remainders."""
    counts = labels.label_counts(prices(spark, sf), "l_partkey")
    return splitting.split_quotas(counts, "l_partkey", 0.15, 0.15)


@query
def readability(spark, sf):
    return scored_notes(spark, sf).drop("lang")


@query
def describe_readability(spark, sf):
    return distributions.describe(scored_notes(spark, sf), SCORES, digits=2)


@query
def readability_by_label(spark, sf):
    found = distributions.medians(few_scores(spark, sf, SCORES[:3]), SCORES[:3], ["lang"])
    return found.select("lang", *[round_even(F.col(f"median_{s}"), 6).alias(f"median_{s}") for s in SCORES[:3]])


@query
def corpus_summary(spark, sf):
    return profile.corpus_summary(profile.document_facts(untidy(spark, sf), **NOTES), "lang")


# --- terms -----------------------------------------------------------------------------


@query
def document_terms(spark, sf):
    return terms.document_terms(documents(spark, sf), "text")


@query
def vocabulary(spark, sf):
    found = terms.vocabulary(documents(spark, sf), "text", min_df=3, max_df=0.85)
    return found.withColumn("idf", round_even(F.col("idf"), 8))


@query
def tfidf_weights(spark, sf):
    docs = documents(spark, sf)
    vocab = terms.vocabulary(docs, "text", min_df=3, max_df=0.85)
    return terms.weighted_terms(docs, vocab, "text").withColumn("weight", round_even(F.col("weight"), 8))


@query
def tfidf_top_terms(spark, sf):
    return terms.top_tfidf_terms(documents(spark, sf), **NOTES)


@query
def tfidf_heatmap(spark, sf):
    docs = documents(spark, sf)
    best = terms.top_tfidf_terms(docs, **NOTES)
    return terms.tfidf_heatmap(best, docs, "lang")


@query
def sublinear_tfidf(spark, sf):
    """Fitted on the train rows; all rows are weighted."""
    ready = train_ready_notes(spark, sf)
    tokens = terms.with_terms(ready, "text", ["doc_id", "split"], (1, 1), ENGLISH).withColumnRenamed("terms", "tokens")
    tokens = stage(tokens, "tokens", compression="zstd")
    vocab = terms.vocabulary(splitting.select_split(tokens, "train"), "tokens", (1, 2), max_features=20_000, stop_words=())
    found = terms.weighted_terms(tokens, vocab, "tokens", ngram_range=(1, 2), stop_words=(), sublinear=True)
    return found.withColumn("weight", round_even(F.col("weight"), 8))


@query
def top_bigrams(spark, sf):
    return terms.top_ngrams(documents(spark, sf), 2, 20, "text")


@query
def top_trigrams(spark, sf):
    return terms.top_ngrams(documents(spark, sf), 3, 20, "text")


@query
def bigrams_by_label(spark, sf):
    return terms.top_ngrams_by_label(documents(spark, sf), 2, 5, 10, **LANG)


@query
def label_vocabularies(spark, sf):
    return terms.label_vocabularies(documents(spark, sf), **LANG)


@query
def vocabulary_union(spark, sf):
    return terms.label_vocabularies(documents(spark, sf), **LANG).select("term").distinct()


@query
def label_sets(spark, sf):
    sets = terms.label_sets(terms.label_vocabularies(documents(spark, sf), "text", "source"), "source")
    return sets.select(F.concat_ws(",", "labels").alias("labels"), "n")


@query
def jaccard(spark, sf):
    return terms.jaccard(documents(spark, sf), "text", "source")


@query
def exclusive_terms(spark, sf):
    return terms.exclusive_terms(documents(spark, sf), **LANG)


@query
def cloud_weights(spark, sf):
    return terms.cloud_weights(documents(spark, sf), **LANG).withColumn("weight", round_even(F.col("weight"), 8))


@query
def cloud_phrases(spark, sf):
    found = terms.cloud_weights(documents(spark, sf), **LANG, plurals=True, phrases=True)
    return found.withColumn("weight", round_even(F.col("weight"), 8))


@query
def cloud_plurals(spark, sf):
    found = terms.cloud_weights(documents(spark, sf), **LANG, plurals=True, words=2000)
    return found.withColumn("weight", round_even(F.col("weight"), 8))


@query
def vocabulary_lookup(spark, sf):
    docs = documents(spark, sf)
    return terms.vocabulary_lookup(docs, terms.vocabulary(docs, "text", min_df=3, max_df=0.85), "text")


# --- the same on ids of a dictionary ---------------------------------------------------


def encoded(docs, text="text"):
    return dictionary.encode(terms.token_table(docs, text, "lang"))


@query
def term_dictionary(spark, sf):
    return encoded(documents(spark, sf)).terms


@query
def encoded_top_terms(spark, sf):
    ids = encoded(documents(spark, sf))
    return dictionary.named(terms.top_tfidf_terms(ids.rows, "tokens", "lang"), ids)


@query
def encoded_trigrams(spark, sf):
    ids = encoded(documents(spark, sf))
    return dictionary.named(terms.top_ngrams(ids.rows, 3, 20, "tokens"), ids, 3)


@query
def encoded_bigrams_by_label(spark, sf):
    ids = encoded(documents(spark, sf))
    return dictionary.named(terms.top_ngrams_by_label(ids.rows, 2, 5, 10, "tokens", "lang"), ids, 2)


@query
def encoded_label_vocabularies(spark, sf):
    ids = encoded(documents(spark, sf))
    return dictionary.named(terms.label_vocabularies(ids.rows, "tokens", "lang"), ids)


@query
def encoded_cloud_weights(spark, sf):
    ids = encoded(documents(spark, sf))
    found = dictionary.named(terms.cloud_weights(ids.rows, "tokens", "lang"), ids)
    return found.withColumn("weight", round_even(F.col("weight"), 8))


@query
def encoded_sublinear_tfidf(spark, sf):
    """As ``sublinear_tfidf``; the dictionary is that of all rows, the vocabulary that of the train rows."""
    ready = train_ready_notes(spark, sf)
    tokens = terms.with_terms(ready, "text", ["doc_id", "split"], (1, 1), ENGLISH).withColumnRenamed("terms", "tokens")
    ids = dictionary.encode(tokens)
    vocab = terms.vocabulary(splitting.select_split(ids.rows, "train"), "tokens", (1, 2), max_features=20_000)
    found = terms.weighted_terms(ids.rows, vocab, "tokens", ngram_range=(1, 2), sublinear=True)
    return dictionary.named(found, ids, 2).withColumn("weight", round_even(F.col("weight"), 8))


# --- splitting -------------------------------------------------------------------------


@query
def split_quotas(spark, sf):
    return splitting.split_quotas(labels.label_counts(documents(spark, sf), "source"), "source", 0.15, 0.15)


@query
def split_assignment(spark, sf):
    docs = documents(spark, sf).select("doc_id", "lang")
    return splitting.add_splits(docs, label="lang")


@query
def split_without_validation(spark, sf):
    docs = documents(spark, sf).select("doc_id", "source")
    return splitting.add_splits(docs, test_size=0.2, val_size=0, seed=7, label="source")


@query
def train_ready(spark, sf):
    return train_ready_notes(spark, sf)


@query
def split_label_counts(spark, sf):
    found = splitting.split_label_counts(train_ready_notes(spark, sf))
    return found.orderBy(F.asc("split"), F.desc("n_rows"), F.asc("label")).limit(15)


@query
def split_summary(spark, sf):
    return splitting.split_summary(train_ready_notes(spark, sf))


@query
def split_rows(spark, sf):
    train, val, test = splitting.split_frames(documents(spark, sf).select("doc_id", "lang"), label="lang")
    parts = [part.withColumn("part", F.lit(name)) for name, part in (("train", train), ("val", val), ("test", test))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def train_ready_preview(spark, sf):
    return train_ready_notes(spark, sf).orderBy(*splitting.train_ready_order()).limit(10).drop("text")


# --- metrics and classifier ------------------------------------------------------------


def guessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes with a rule in place of a model: accents tell the language."""
    text = F.lower("text")
    rule = (
        F.when(F.length("text") < 300, "unknown")
        .when(text.rlike("[ñ¿]|ción"), "es")
        .when(text.rlike("[ßüöä]"), "de")
        .when(text.rlike("[èêç]"), "fr")
        .otherwise("en")
    )
    return documents(spark, sf_dir).select(F.col("lang").alias("label"), rule.alias("prediction"))


@query
def class_weights(spark, sf):
    return labels.class_weights(documents(spark, sf), "lang").withColumn("weight", round_even(F.col("weight"), 8))


@query
def confusion(spark, sf):
    return metrics.confusion(guessed(spark, sf))


@query
def classification_report(spark, sf):
    found = metrics.classification_report(metrics.confusion(guessed(spark, sf)))
    return found.select(
        "label", *[round_even(F.col(name), 8).alias(name) for name in ("precision", "recall", "f1")], "support"
    )


@query
def macro_f1(spark, sf):
    return metrics.macro_f1(metrics.confusion(guessed(spark, sf))).select(
        round_even(F.col("macro_f1"), 8).alias("macro_f1")
    )


@query
def metrics_record(spark, sf):
    found = metrics.metrics_record(guessed(spark, sf))
    return found.select(
        round_even(F.col("macro_f1"), 8).alias("macro_f1"), F.concat_ws(",", "labels").alias("labels"), "validation_rows"
    )


def _baseline(spark: SparkSession, sf_dir: str) -> tuple[classifier.BaselineModel, DataFrame]:
    ready = stage(train_ready_notes(spark, sf_dir), "train_ready")
    return classifier.fit_baseline(splitting.select_split(ready, "train")), ready


@query
def baseline_predictions(spark, sf):
    model, ready = _baseline(spark, sf)
    return model.predict(splitting.select_split(ready, "val"), ["label"])


@query
def baseline_report(spark, sf):
    """The training job from end to end."""
    root = f"{shared_folder(spark)}/corpuscope/baseline-{uuid.uuid4().hex}"
    return train.train_baseline(stage(train_ready_notes(spark, sf), "train_ready"), f"{root}/model", f"{root}/metrics").report


@query
def baseline_optimum(spark, sf):
    """The gradient of the objective at the fitted coefficients, summed by joins: zero for every label, so the fit is the optimum."""
    ready = stage(train_ready_notes(spark, sf), "train_ready")
    rows = splitting.select_split(ready, "train")
    model = classifier.fit_baseline(rows, tol=1e-8)
    weights = labels.class_weights(rows, "label")
    pulls = []
    for k, name in enumerate(model.labels):
        signed = F.when(F.col("label") == name, 1.0).otherwise(-1.0)
        pulls.append(F.when(F.col("label") == name, F.col("weight")).otherwise(1.0) * -signed / (1 + F.exp(signed * F.col("margins")[k])))
    pulled = model.margins(rows, ["label"]).join(weights, "label").select("doc_id", F.array(*pulls).alias("pull"))
    cells = model.features.transform(rows).select("doc_id", F.explode(F.arrays_zip("features.indices", "features.values")).alias("cell"))
    slopes = cells.join(pulled, "doc_id").groupBy(F.col("cell.indices").alias("index")).agg(
        *[F.sum(F.col("cell.values") * F.col("pull")[k]).alias(f"slope_{k}") for k in range(len(model.labels))]
    ).join(model.coefficients, "index")
    steepest = slopes.agg(*[F.max(F.abs(F.col("weights")[k] + F.col(f"slope_{k}"))).alias(name) for k, name in enumerate(model.labels)])
    steepest = steepest.unpivot([], model.labels, "label", "steepest")
    return weights.join(steepest, "label").select(
        "label", "n", round_even(F.col("weight"), 8).alias("weight"), round_even(F.col("steepest"), 4).alias("steepest")
    )


def marked_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train-ready notes with a word after each word that names the label, so that SQL knows every prediction."""
    ready = train_ready_notes(spark, sf_dir)
    marked = F.regexp_replace("text", F.lit("([\\p{L}]+)"), F.concat(F.lit("$1 mark"), F.col("label")))
    return stage(ready.withColumn("text", marked), "marked")


@query
def marked_predictions(spark, sf):
    ready = marked_notes(spark, sf)
    model = classifier.fit_baseline(splitting.select_split(ready, "train"))
    return model.predict(ready.where(F.col("split") != "train"), ["label", "split"])


@query
def marked_report(spark, sf):
    """The training job from end to end, on labels that can be told apart."""
    root = f"{shared_folder(spark)}/corpuscope/marked-{uuid.uuid4().hex}"
    return train.train_baseline(marked_notes(spark, sf), f"{root}/model", f"{root}/metrics").report


def refusal(case: str, call: Callable[[], object]) -> tuple[str, str]:
    try:
        call()
    except ValueError as error:
        return case, str(error)
    return case, ""


@query
def refused_inputs(spark, sf):
    """What the guards say of these tables; an empty message is an input that is taken."""
    docs = documents(spark, sf)
    ready = stage(train_ready_notes(spark, sf), "train_ready")
    by_key = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    jobs = {
        "columns": lambda: schema.require_columns(docs, {"doc_id", "label", "split"}),
        "columns present": lambda: schema.require_columns(docs, {"doc_id", "text"}),
        "no training rows": lambda: splitting.add_splits(docs, 0.5, 0.5, label="lang"),
        "no test rows": lambda: splitting.add_splits(docs, 0.0, 0.2, label="lang"),
        "sizes taken": lambda: splitting.add_splits(docs, 0.2, 0.0, label="lang"),
        "single rows": lambda: splitting.add_splits(by_key, 0.2, 0.2, label="doc_id", key="n_chars"),
        "empty side": lambda: train.train_baseline(ready.where("split <> 'val'"), "unused", "unused"),
        "one label": lambda: classifier.fit_baseline(ready.where(F.col("label") == "en")),
    }
    return spark.createDataFrame([refusal(case, call) for case, call in jobs.items()], "case string, message string")


@query
def linear_scores(spark, sf):
    """Scores of a stored model with made-up coefficients, so that SQL can give them: three labels, sub-linear terms."""
    ready = stage(train_ready_notes(spark, sf), "train_ready")
    features = classifier.TextFeatures.fit(splitting.select_split(ready, "train"), 5000, (1, 2))
    weights = F.array(*[((F.length("term") * (i + 2) % 7) - 3) * 0.1 for i in range(3)])
    model = classifier.BaselineModel(features, ["a", "b", "c"], features.terms.withColumn("weights", weights))
    path = f"{shared_folder(spark)}/corpuscope/model-{uuid.uuid4().hex}"
    model.save(path)
    found = classifier.load_model(spark, path).margins(ready, ["label"])
    return found.select("doc_id", "label", *[round_even(F.col("margins")[i], 7).alias(f"margin_{i}") for i in range(3)])


# --- whole jobs and what they store -----------------------------------------------------


@query
def stored_clean(spark, sf):
    path = f"{shared_folder(spark)}/corpuscope/clean-{uuid.uuid4().hex}"
    tables.write_clean(clean_notes(spark, sf), path, "lang")
    return tables.read_table(spark, path)


@query
def stored_train_ready(spark, sf):
    root = f"{shared_folder(spark)}/corpuscope/ready-{uuid.uuid4().hex}"
    return prepare.prepare_train_ready(documents(spark, sf), f"{root}/clean", f"{root}/ready", **NOTES)


@query
def stored_metrics(spark, sf):
    path = f"{shared_folder(spark)}/corpuscope/metrics-{uuid.uuid4().hex}"
    tables.write_metrics(metrics.metrics_record(guessed(spark, sf)), path)
    found = spark.read.schema("macro_f1 double, labels array<string>, validation_rows long").json(path)
    return found.select(round_even(F.col("macro_f1"), 8).alias("macro_f1"), F.concat_ws(",", "labels").alias("labels"), "validation_rows")


CSV_FILE_BYTES = 256 << 20  # text of one CSV file: the most that one task writes


def few_files(df: DataFrame, column: str, limit: int) -> DataFrame:
    """``df`` in few parts that hold about ``limit`` bytes of ``column`` each: one part where that is all. Rows move only where
    there are fewer parts to begin with."""
    held = df.agg(F.sum(F.octet_length(column))).first()[0] or 0
    files = 1 + held // limit
    if files == 1:
        return df.coalesce(1)
    parts = df.rdd.getNumPartitions()
    return df.coalesce(-(-parts // (parts // files))) if parts >= files else df.repartition(files)


@query
def one_csv_file(spark, sf):
    """The documents in a single CSV file (or, as one task writes a file, in one for each ``CSV_FILE_BYTES`` of text), cut at
    64 KB so that several tasks read it, wherever a quoted line break falls."""
    root = f"{shared_folder(spark)}/corpuscope/one-csv-{uuid.uuid4().hex}"
    raw = documents(spark, sf).select(
        F.col("doc_id").alias("Unnamed: 0"), F.col("source").alias("description"), F.col("text").alias("transcription"),
        F.lit("NA").alias("sample_name"), F.concat(F.lit('6" of "'), F.col("lang")).alias("keywords"), F.col("lang").alias("medical_specialty"),
    )
    few_files(raw, "transcription", CSV_FILE_BYTES).write.csv(root, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    cut = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(cut)
    spark.conf.set(cut, "64k")
    try:
        notes = tables.read_notes_csv(spark, root)
    finally:
        spark.conf.set(cut, before)
    return notes.select(
        F.col("Unnamed: 0").alias("doc_id"), "description", F.md5("transcription").alias("text_md5"), "sample_name", "keywords", "medical_specialty"
    )


@query
def splits_from_csv(spark, sf):
    """The documents as a raw CSV file, prepared from there."""
    root = f"{shared_folder(spark)}/corpuscope/csv-{uuid.uuid4().hex}"
    filler = [F.lit("d").alias(name) for name in ("description", "sample_name", "keywords")]
    raw = documents(spark, sf).select(
        F.col("lang").alias("medical_specialty"), F.col("doc_id").alias("Unnamed: 0"), F.col("text").alias("transcription"), *filler
    )
    raw.write.csv(f"{root}/notes", header=True, quote='"', escape='"')
    folders = prepare.prepare_csv(spark, f"{root}/notes", f"{root}/raw", f"{root}/splits")
    return read_splits(spark, folders, "transcription string, medical_specialty string").withColumnsRenamed(
        {"transcription": "text", "medical_specialty": "lang"}
    )


def read_splits(spark: SparkSession, folders: dict[str, str], columns: str) -> DataFrame:
    parts = [
        spark.read.schema(columns).csv(folder, header=True, multiLine=True, quote='"', escape='"').withColumn("split", F.lit(name))
        for name, folder in folders.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def profile_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return profile.profile(documents(spark, sf_dir), **NOTES)


@query
def profile_top_terms(spark, sf):
    return profile_tables(spark, sf)["top_terms"]


@query
def profile_exclusive_terms(spark, sf):
    return profile_tables(spark, sf)["exclusive_terms"]


@query
def profile_cloud_weights(spark, sf):
    return profile_tables(spark, sf)["cloud_weights"].withColumn("weight", round_even(F.col("weight"), 8))


@query
def prepared_splits(spark, sf):
    root = f"{shared_folder(spark)}/corpuscope/prepared-{uuid.uuid4().hex}"
    folders = prepare.prepare_splits(documents(spark, sf), f"{root}/raw", f"{root}/splits", **NOTES)
    return read_splits(spark, folders, "text string, lang string")
