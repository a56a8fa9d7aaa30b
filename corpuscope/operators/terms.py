"""Term statistics, vocabularies, TF-IDF and vocabulary comparison.

Term counts are taken inside each document's own token array, so document-term pairs are
never shuffled: tasks combine their terms first and only (term, count) rows move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from corpuscope.functions import text as T
from corpuscope.functions.numeric import percent, round_even
from corpuscope.functions.stopwords import CLOUD_EXTRA, ENGLISH
from corpuscope.operators import counting, dictionary, heavy
from corpuscope.operators.cleaning import KEY, LABEL, TEXT
from corpuscope.operators.labels import keep_top_labels, label_counts, top_labels
from corpuscope.staging import measured, stage

COUNTERS = 80_000  # of a task's summary where few n-grams are wanted
SCORE_DIGITS = 10  # scores are ranked at this precision, so float noise breaks no tie


def with_terms(
    df: DataFrame, text: str, keep: Sequence[str], ngram_range: tuple[int, int], stop_words: Sequence[str]
) -> DataFrame:
    """``(keep..., terms)``: each row's n-grams. Tokens are a column of their own first, so
    that the n-grams, which use them several times, do not tokenise again. ``text`` may also name a column of
    tokens, as :func:`token_table` has; stop words then leave it too. Where these are ids, as
    :func:`corpuscope.operators.dictionary.encode` makes them, n-grams are made of ids."""
    if dictionary.holds_ids(df, text):
        tokenised = df.select(*keep, F.coalesce(dictionary.without(df, text, stop_words), F.array()).alias("terms"))
        bits = df.schema[text].metadata[dictionary.BITS]
        return tokenised if ngram_range == (1, 1) else tokenised.select(*keep, dictionary.grams(F.col("terms"), bits, *ngram_range).alias("terms"))
    if isinstance(df.schema[text].dataType, ArrayType):
        found = F.filter(F.col(text), lambda token: ~token.isin(list(stop_words))) if stop_words else F.col(text)
    else:
        found = T.tokens(F.coalesce(F.col(text).cast("string"), F.lit("")), stop_words)
    tokenised = df.select(*keep, found.alias("terms"))
    if ngram_range == (1, 1):
        return tokenised
    return tokenised.select(*keep, T.ngrams(F.col("terms"), *ngram_range).alias("terms"))


def token_table(
    df: DataFrame, text: str = TEXT, label: str = LABEL, key: str = KEY, stop_words: Sequence[str] = ENGLISH
) -> DataFrame:
    """``(key, label, tokens)``. Staged, it gives all term work one tokenisation of the corpus."""
    return with_terms(df, text, [key, label], (1, 1), stop_words).withColumnRenamed("terms", "tokens")


def unnest(df: DataFrame, keep: Sequence[str], items: Column, name: str = "term") -> DataFrame:
    """One row per array item. The outer form plus a filter, since for the inner one Spark
    adds a filter on the array's size below, and so builds every array twice."""
    return df.select(*keep, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())


def term_stats(
    df: DataFrame,
    text: str = TEXT,
    by: Sequence[str] = (),
    ngram_range: tuple[int, int] = (1, 1),
    stop_words: Sequence[str] = ENGLISH,
    only: DataFrame | None = None,
) -> DataFrame:
    """``(by..., term, df, total)``: documents with the term, and all its occurrences; of ``only`` the terms of that table.

    A document's terms are sorted and each is paired with its predecessor, which marks
    the first of equal terms and gives both counts from one pass. Those of ``only`` are counted as :func:`counted_terms` does.
    """
    if only is not None:
        counts = counted_terms(df, text, by, ngram_range, stop_words).join(only.select("term"), "term", "left_semi")
        return counts.groupBy(*by, "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    found = with_terms(df, text, by, ngram_range, stop_words)
    ordered = found.select(*by, F.sort_array("terms").alias("terms"))
    rest = F.slice("terms", F.lit(1), F.greatest(F.size("terms") - 1, F.lit(0)))
    before = F.concat(F.array(F.lit(None).cast(found.schema["terms"].dataType.elementType)), rest)
    pairs = ordered.select(
        *by, F.explode(F.arrays_zip(F.col("terms").alias("term"), before.alias("before"))).alias("pair")
    ).where(F.col("pair.term").isNotNull())
    repeated = F.col("pair.term").eqNullSafe(F.col("pair.before"))
    return pairs.groupBy(*by, F.col("pair.term").alias("term")).agg(
        F.count_if(~repeated).alias("df"), F.count(F.lit(1)).alias("total")
    )


def document_terms(
    df: DataFrame,
    text: str = TEXT,
    key: str = KEY,
    ngram_range: tuple[int, int] = (1, 1),
    stop_words: Sequence[str] = ENGLISH,
) -> DataFrame:
    """``(key, term, tf)``. Counted inside each row: nothing is shuffled."""
    return counted_terms(df.select(key, text), text, [key], ngram_range, stop_words)


def counted_terms(
    df: DataFrame, text: str, keep: Sequence[str], ngram_range: tuple[int, int], stop_words: Sequence[str],
    extra: Sequence[str] = (), native: bool = False,
) -> DataFrame:
    """``(keep..., term, tf)`` counted inside each row, in Arrow batches. ``extra`` terms are added to every row once.

    ``native``, and where n-grams of ids are lists, a row's terms are sorted instead, without Python: where a run of equal terms begins,
    and how far the next is."""
    as_ids = dictionary.holds_ids(df, text)
    lists = as_ids and ngram_range != (1, 1) and not dictionary.packs(df.schema[text].metadata[dictionary.BITS], ngram_range[1])
    if not native and not lists:
        found = with_terms(df, text, keep, ngram_range if as_ids else (1, 1), stop_words)
        return counting.counted(found, keep, (1, 1) if as_ids else ngram_range, extra)
    found = with_terms(df, text, keep, ngram_range, stop_words)
    added = F.array(*[F.lit(x) for x in extra]).cast("array<string>")
    ordered = found.select(*keep, F.sort_array(F.concat("terms", added) if extra else F.col("terms")).alias("terms"))
    places = F.when(F.size("terms") > 0, F.sequence(F.lit(0), F.size("terms") - 1)).otherwise(F.array().cast("array<int>"))
    begins = F.filter(places, lambda i: (i == 0) | (F.get("terms", i) != F.get("terms", i - 1)))
    runs = ordered.select(*keep, "terms", begins.alias("begins"))
    after = lambda k: F.coalesce(F.get("begins", k + 1), F.size("terms"))
    pairs = F.transform("begins", lambda i, k: F.struct(F.get("terms", i).alias("term"), (after(k) - i).cast("long").alias("tf")))
    return unnest(runs, keep, pairs, "pair").select(*keep, "pair.term", "pair.tf")


def _bound(limit: int | float, documents: Column) -> Column:
    return F.lit(limit).cast("double") if isinstance(limit, int) else F.lit(limit) * documents


def document_count(df: DataFrame) -> Column:
    """Number of rows as a value other frames can use (a scalar subquery)."""
    return df.agg(F.count(F.lit(1)).alias("documents")).scalar()


def prune(stats: DataFrame, documents: Column, min_df: int | float = 1, max_df: int | float = 1.0) -> DataFrame:
    """Document-frequency bounds, both inclusive; floats are shares of ``documents``."""
    return stats.where(
        (F.col("df") >= _bound(min_df, documents)) & (F.col("df") <= _bound(max_df, documents))
    )


def most_frequent(stats: DataFrame, top: int) -> DataFrame:
    """The ``top`` terms by total count, then name.

    The count that the last of the top terms reaches is read off the frequencies of counts, and only
    terms at or above it are sorted, so no task sends ``top`` rows of its own. The terms' shuffle is used by
    both steps: the first reads the same columns, so that it is the same plan.
    """
    same = F.concat(*[F.col(name).cast("string") for name in stats.columns if name != "total"]).isNotNull()
    totals = stats.groupBy("total").agg(F.count_if(same).alias("n"))
    higher = Window.orderBy(F.desc("total")).rowsBetween(Window.unboundedPreceding, -1)
    above = F.coalesce(F.sum("n").over(higher), F.lit(0))
    reached = totals.withColumn("_above", above).where(F.col("_above") < top)
    stats = stats.where(F.col("total") >= reached.agg(F.min("total").alias("least")).scalar())
    return stats.orderBy(F.desc("total"), F.asc("term")).limit(top)


def vocabulary(
    df: DataFrame,
    text: str = TEXT,
    ngram_range: tuple[int, int] = (1, 1),
    min_df: int | float = 1,
    max_df: int | float = 1.0,
    max_features: int = 10_000,
    stop_words: Sequence[str] = ENGLISH,
) -> DataFrame:
    """``(term, df, total, idf)``, the ``max_features`` most frequent terms within bounds.

    idf = ln((1 + documents) / (1 + df)) + 1. Of vocabularies with n-grams, summaries find the candidates first (jobs), and only
    these are counted; where that cannot be shown to leave out no term of the vocabulary, all terms are.
    """
    found = frequent_terms(df, text, ngram_range, max_features, min_df, max_df, stop_words)
    return found.withColumn("idf", F.log((1.0 + document_count(df)) / (1.0 + F.col("df"))) + 1.0)


def frequent_terms(
    df: DataFrame, text: str, ngram_range: tuple[int, int], top: int, min_df: int | float, max_df: int | float,
    stop_words: Sequence[str], room: int = 1, capacity: int | None = None,
) -> DataFrame:
    """``(term, df, total)`` of the ``top`` most frequent terms within bounds. n-grams that are words or packed ids are first
    summarised: candidates for ``room`` times as many terms, as the bounds may take some away."""
    documents = document_count(df)

    def found(only: DataFrame | None = None) -> DataFrame:
        stats = term_stats(df, text, (), ngram_range, stop_words, only)
        stats = stats if only is None else stage(stats, "counted")  # few terms, read twice; plans built on them run no Python
        return most_frequent(prune(stats, documents, min_df, max_df), top)

    as_ids = dictionary.holds_ids(df, text)
    if ngram_range[1] == 1 or (as_ids and not dictionary.packs(df.schema[text].metadata[dictionary.BITS], ngram_range[1])):
        return found()
    made = ngram_range if as_ids else (1, 1)  # n-grams of ids are numbers, those of words are made of the words
    tokens = with_terms(df, text, [], made, stop_words)
    likely = heavy.candidates(tokens, (1, 1) if as_ids else ngram_range, room * top, capacity)
    if likely is None:
        return found()
    vocab = measured(found(likely.terms))
    least = vocab.agg(F.count("total").alias("terms"), F.min("total").alias("least")).first()
    certain = likely.limit == 0 or (least.terms == top and least.least > likely.limit)
    return vocab if certain else found()


def weighted_terms(
    df: DataFrame,
    vocab: DataFrame,
    text: str = TEXT,
    key: str = KEY,
    keep: Sequence[str] = (),
    ngram_range: tuple[int, int] = (1, 1),
    stop_words: Sequence[str] = ENGLISH,
    sublinear: bool = False,
) -> DataFrame:
    """``(key, keep..., term, tf, weight)`` of vocabulary terms, L2-normalised per document.

    Terms are counted in the row and meet the vocabulary, whose measured size (a job) picks the join. Each task then
    folds a document's known terms into one row, and that row alone moves.
    """
    counted = counted_terms(df.select(key, *keep, text), text, [key, *keep], ngram_range, stop_words)
    tf = F.col("tf").cast("double")
    known = counted.join(measured(vocab.select("term", "idf")), "term").withColumn(
        "_raw", (1.0 + F.log(tf) if sublinear else tf) * F.col("idf")
    )
    folded = known.groupBy(key, *keep).agg(
        F.collect_list(F.struct("term", "tf", "_raw")).alias("cells"), F.sqrt(F.sum(F.col("_raw") * F.col("_raw"))).alias("norm")
    )
    cells = folded.select(key, *keep, "norm", F.explode("cells").alias("cell"))
    return cells.select(key, *keep, "cell.term", "cell.tf", (F.col("cell._raw") / F.col("norm")).alias("weight"))


def _ranked(df: DataFrame, by: str, score: str, top: int) -> DataFrame:
    """The ``top`` rows per group by falling score, then term. Spark keeps each task's own
    top rows before the shuffle, so no group is gathered whole."""
    order = Window.partitionBy(by).orderBy(F.desc(score), F.asc("term"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn(
        "rank", F.col("rank").cast("long")
    )


def top_tfidf_terms(
    df: DataFrame,
    text: str = TEXT,
    label: str = LABEL,
    key: str = KEY,
    top: int = 15,
    max_features: int = 10_000,
    min_df: int | float = 3,
    max_df: int | float = 0.85,
    stop_words: Sequence[str] = ENGLISH,
) -> DataFrame:
    """``(label, rank, term, tfidf_score)``: mean weight over all documents of the label.

    The vocabulary and idf come from every row, also those without a label; scores are
    rounded to 4 decimals after ranking.
    """
    vocab = vocabulary(df, text, (1, 1), min_df, max_df, max_features, stop_words)
    weights = weighted_terms(df, vocab, text, key, [label], (1, 1), stop_words)
    sums = weights.where(F.col(label).isNotNull()).groupBy(label, "term").agg(F.sum("weight").alias("_sum"))
    scores = sums.join(label_counts(df, label), label).select(
        label, "term", round_even(F.col("_sum") / F.col("n"), SCORE_DIGITS).alias("_score")
    )
    return _ranked(scores, label, "_score", top).select(
        label, "rank", "term", round_even(F.col("_score"), 4).alias("tfidf_score")
    )


def tfidf_heatmap(top_terms: DataFrame, df: DataFrame, label: str = LABEL, labels: int = 10, ranks: int = 10) -> DataFrame:
    """One row per term, one column per large label: the label's score if the term is among
    its best ``ranks``, else 0."""
    chosen = top_terms.where(F.col("rank") <= ranks).join(
        F.broadcast(top_labels(df, label, labels).select(label)), label, "left_semi"
    )
    return pivot_scores(chosen, "term", label, _names(df, label, labels), "tfidf_score")


def pivot_scores(df: DataFrame, rows: str, columns: str, names: Sequence[str], score: str) -> DataFrame:
    """One row per ``rows`` value, one column per name, mean score, missing as 0."""
    return df.groupBy(rows).pivot(columns, list(names)).agg(F.avg(score)).na.fill(0.0)


def _names(df: DataFrame, label: str, top: int) -> list[str]:
    """Names of at most ``top`` labels, largest first."""
    return [row[0] for row in top_labels(df, label, top).select(label).collect()]


def top_ngrams(
    df: DataFrame,
    n: int = 2,
    top: int = 20,
    text: str = TEXT,
    min_df: int | float = 2,
    max_df: int | float = 0.9,
    stop_words: Sequence[str] = ENGLISH,
    summarised: bool = True,
) -> DataFrame:
    """``(term, total)``: the corpus-wide most frequent n-grams. Where they are ``summarised`` first (jobs), only candidates are
    shuffled, else every distinct n-gram of each task."""
    if summarised:
        return frequent_terms(df, text, (n, n), top, min_df, max_df, stop_words, 4, COUNTERS).select("term", "total")
    stats = prune(term_stats(df, text, (), (n, n), stop_words), document_count(df), min_df, max_df)
    return most_frequent(stats.select("term", "total"), top)


def top_ngrams_by_label(
    df: DataFrame,
    n: int = 2,
    labels: int = 5,
    top: int = 10,
    text: str = TEXT,
    label: str = LABEL,
    min_df: int = 2,
    max_df: float = 0.9,
    stop_words: Sequence[str] = ENGLISH,
) -> DataFrame:
    """``(label, rank, term, total)`` for the largest labels; bounds hold inside the label."""
    sizes = F.broadcast(top_labels(df, label, labels))
    stats = term_stats(keep_top_labels(df, label, labels), text, [label], (n, n), stop_words)
    kept = prune(stats.join(sizes, label), F.col("n"), min_df, max_df)
    return _ranked(kept, label, "total", top).select(label, "rank", "term", "total")


def label_vocabularies(
    df: DataFrame,
    text: str = TEXT,
    label: str = LABEL,
    labels: int = 10,
    min_docs: int = 3,
    stop_words: Sequence[str] = ENGLISH,
) -> DataFrame:
    """``(label, term, df)`` of terms in at least ``min_docs`` documents of a large label."""
    rows = keep_top_labels(df, label, labels)
    found = with_terms(rows, text, [label], (1, 1), stop_words)
    terms = unnest(found, [label], F.array_distinct("terms"))
    return terms.groupBy(label, "term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_docs)


def label_sets(vocabularies: DataFrame, label: str = LABEL) -> DataFrame:
    """``(labels, n)``: how many terms occur in exactly this set of labels.

    A term's set is as long as the list of compared labels, and there are few distinct
    sets, so overlaps and unions are worked out on this table and terms are never paired.
    """
    per_term = vocabularies.groupBy("term").agg(F.sort_array(F.collect_set(label)).alias("labels"))
    return per_term.groupBy("labels").agg(F.count(F.lit(1)).alias("n"))


def vocabulary_sizes(sets: DataFrame, label: str = LABEL) -> DataFrame:
    """``(label, n_terms, n_unique)``: all terms, and those in no other label."""
    return sets.select(F.explode("labels").alias(label), "n", F.size("labels").alias("_shared")).groupBy(label).agg(
        F.sum("n").alias("n_terms"),
        F.sum(F.when(F.col("_shared") == 1, F.col("n")).otherwise(0)).alias("n_unique"),
    )


def jaccard(
    df: DataFrame, text: str = TEXT, label: str = LABEL, labels: int = 10, min_docs: int = 3,
    stop_words: Sequence[str] = ENGLISH, sets: DataFrame | None = None,
) -> DataFrame:
    """``(label_a, label_b, n_shared, n_union, jaccard)`` for every ordered pair, own pair too.

    ``sets`` may bring :func:`label_sets` of the same labels, computed before.
    """
    if sets is None:
        sets = label_sets(label_vocabularies(df, text, label, labels, min_docs, stop_words), label)
    sizes = vocabulary_sizes(sets, label)
    shared = (
        sets.select("n", F.explode("labels").alias("label_a"), "labels")
        .select("n", "label_a", F.explode("labels").alias("label_b"))
        .groupBy("label_a", "label_b").agg(F.sum("n").alias("n_shared"))
    )
    # The grid of compared labels: `labels` names at most, unfolded twice.
    names = top_labels(df, label, labels).agg(F.collect_list(label).alias("names"))
    grid = names.select("names", F.explode("names").alias("label_a")).select(
        "label_a", F.explode("names").alias("label_b")
    )
    sized = (
        grid.join(shared, ["label_a", "label_b"], "left")
        .join(sizes.select(F.col(label).alias("label_a"), F.col("n_terms").alias("_a")), "label_a", "left")
        .join(sizes.select(F.col(label).alias("label_b"), F.col("n_terms").alias("_b")), "label_b", "left")
        .na.fill(0, ["n_shared", "_a", "_b"])
    )
    union = F.col("_a") + F.col("_b") - F.col("n_shared")
    return sized.select(
        "label_a", "label_b", "n_shared", union.alias("n_union"),
        F.when(union > 0, round_even(F.col("n_shared").cast("double") / union, 3)).otherwise(F.lit(0.0)).alias("jaccard"),
    )


def exclusive_terms(
    df: DataFrame, text: str = TEXT, label: str = LABEL, labels: int = 10, min_docs: int = 3,
    stop_words: Sequence[str] = ENGLISH, sets: DataFrame | None = None,
) -> DataFrame:
    """``(label, n_terms, n_unique, unique_pct, n_all)`` of every compared label; ``n_all`` counts the union.

    ``sets`` as in :func:`jaccard`.
    """
    if sets is None:
        sets = label_sets(label_vocabularies(df, text, label, labels, min_docs, stop_words), label)
    everything = sets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_all")).scalar()
    sizes = top_labels(df, label, labels).select(label).join(vocabulary_sizes(sets, label), label, "left").na.fill(
        0, ["n_terms", "n_unique"]
    )
    share = F.when(F.col("n_terms") > 0, round_even(percent(F.col("n_unique"), F.col("n_terms")), 1)).otherwise(F.lit(0.0))
    return sizes.select(label, "n_terms", "n_unique", share.alias("unique_pct"), everything.alias("n_all"))


def cloud_weights(
    df: DataFrame,
    text: str = TEXT,
    label: str = LABEL,
    labels: int = 6,
    words: int = 80,
    stop_words: Sequence[str] = (*ENGLISH, *CLOUD_EXTRA),
    plurals: bool = False,
    phrases: bool = False,
    threshold: float = 30.0,
) -> DataFrame:
    """``(label, rank, term, total, weight)``: a label's most frequent terms over its top count.

    With ``plurals``, a word in s counts as the word without it where the label has both. With ``phrases``, two neighbouring words whose
    log-likelihood ratio is over ``threshold`` are a term of their own, and its occurrences leave the counts of
    both words. Either runs jobs that count the words (and pairs) of each label, and takes words, not ids.
    """
    if (plurals or phrases) and dictionary.holds_ids(df, text):
        raise ValueError("Plurals and phrases are found in words, not in their ids.")
    rows = keep_top_labels(df, label, labels)
    if phrases or plurals:
        counted = _folded_counts(rows, text, label, stop_words, plurals, phrases, threshold)
    else:
        terms = unnest(with_terms(rows, text, [label], (1, 1), stop_words), [label], F.col("terms"))
        counted = terms.groupBy(label, "term").agg(F.count(F.lit(1)).alias("total"))
    most = F.max("total").over(Window.partitionBy(label))
    return _ranked(counted, label, "total", words).select(
        label, "rank", "term", "total", (F.col("total").cast("double") / most).alias("weight")
    )


def _folded_counts(
    rows: DataFrame, text: str, label: str, stop_words: Sequence[str], plurals: bool, phrases: bool, threshold: float
) -> DataFrame:
    """``(label, term, total)`` of words, with plurals folded and phrases taken out.

    Words and pairs are counted as they are written first; only distinct ones are joined.
    """
    all_tokens = with_terms(rows, text, [label], (1, 1), ())
    kept = lambda token: ~token.isin(list(stop_words))
    found = unnest(all_tokens, [label], F.filter("terms", kept)).groupBy(label, "term").agg(F.count(F.lit(1)).alias("total"))
    found = measured(found)
    forms = found.select(label, "term", F.col("term").alias("form"))
    if plurals:
        singular = F.when(F.col("term").rlike("[^s]s$"), F.expr("left(term, length(term) - 1)"))
        known = found.select(F.col(label).alias("_label"), F.col("term").alias("_singular"))
        forms = found.select(label, "term", singular.alias("_form")).join(
            known, (F.col(label) == F.col("_label")) & (F.col("_form") == F.col("_singular")), "left"
        ).select(label, "term", F.coalesce("_singular", "term").alias("form"))
    counted = measured(found.join(forms, [label, "term"]).groupBy(label, F.col("form").alias("term")).agg(F.sum("total").alias("total")))
    if not phrases:
        return counted
    neighbours = F.arrays_zip(F.col("terms").alias("first"), F.slice("terms", F.lit(2), F.greatest(F.size("terms") - 1, F.lit(0))).alias("second"))
    pairs = unnest(
        all_tokens, [label], F.filter(neighbours, lambda p: p["second"].isNotNull() & kept(p["first"]) & kept(p["second"])), "pair"
    ).groupBy(label, "pair.first", "pair.second").agg(F.count(F.lit(1)).alias("both"))
    if plurals:  # only words that change are joined: a short list, which moves to the pairs and not the pairs to it
        changed = measured(forms.where(F.col("form") != F.col("term")))
        for side in ("first", "second"):
            named = changed.select(label, F.col("term").alias(side), F.col("form").alias(f"{side}_form"))
            pairs = pairs.join(named, [label, side], "left").withColumn(side, F.coalesce(f"{side}_form", side)).drop(f"{side}_form")
        pairs = pairs.groupBy(label, "first", "second").agg(F.sum("both").alias("both"))
    for side in ("first", "second"):
        pairs = pairs.join(counted.select(label, F.col("term").alias(side), F.col("total").alias(f"n_{side}")), [label, side])
    sizes = counted.groupBy(label).agg(F.sum("total").alias("n"))
    scored = pairs.join(sizes, label).where(_likelihood_ratio(*map(F.col, ("both", "n_first", "n_second", "n"))) > threshold)
    phrase = measured(scored.select(label, "first", "second", "both"))
    lost = phrase.select(label, F.explode(F.array("first", "second")).alias("term"), "both").groupBy(label, "term").agg(F.sum("both").alias("lost"))
    single = counted.join(lost, [label, "term"], "left").select(label, "term", (F.col("total") - F.coalesce("lost", F.lit(0))).alias("total"))
    return single.where("total > 0").unionByName(phrase.select(label, F.concat_ws(" ", "first", "second").alias("term"), F.col("both").alias("total")))


def _likelihood_ratio(both: Column, first: Column, second: Column, words: Column) -> Column:
    """Dunning's ratio of the second word coming after the first against it coming anywhere; zero if a word is all there is."""
    def log_likelihood(hits: Column, trials: Column, chance: Column) -> Column:
        least = F.lit(1e-10)
        return F.log(F.greatest(chance, least)) * hits + F.log(F.greatest(1.0 - chance, least)) * (trials - hits)

    both, first, second, words = (c.cast("double") for c in (both, first, second, words))
    elsewhere, rest = second - both, words - first
    ratio = 2.0 * (
        log_likelihood(both, first, both / first) + log_likelihood(elsewhere, rest, elsewhere / rest)
        - log_likelihood(both, first, second / words) - log_likelihood(elsewhere, rest, second / words)
    )
    return F.when((words > first) & (words > second), ratio).otherwise(0.0)


def vocabulary_lookup(df: DataFrame, vocab: DataFrame, text: str = TEXT, key: str = KEY,
                      stop_words: Sequence[str] = ENGLISH) -> DataFrame:
    """``(key, n_known, n_distinct_known)``: a document's tokens that the vocabulary holds."""
    known = counted_terms(df.select(key, text), text, [key], (1, 1), stop_words).join(
        measured(vocab.select("term")), "term", "left_semi"
    )
    return known.groupBy(key).agg(F.sum("tf").alias("n_known"), F.count(F.lit(1)).alias("n_distinct_known"))
