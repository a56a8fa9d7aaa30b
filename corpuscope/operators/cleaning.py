"""Row filters, exact deduplication and the three cleaning recipes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscope.functions import text as T
from corpuscope.operators.labels import frequent_labels, keep_frequent_labels
from corpuscope.operators.schema import normalise_columns, require_columns
from corpuscope.staging import measured

TEXT = "transcription"
LABEL = "medical_specialty"
KEY = "doc_id"


def fill_missing(df: DataFrame, text: str = TEXT) -> DataFrame:
    return df.withColumn(text, F.coalesce(F.col(text), F.lit("")))


def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows where any of the columns is NULL; the scan itself can apply this test."""
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df


def drop_empty(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows where any of the columns is the empty string."""
    for name in columns:
        df = df.where(F.length(name) > 0)
    return df


def min_words(df: DataFrame, least: int, text: str = TEXT) -> DataFrame:
    """Rows with at least ``least`` words."""
    return df.where(T.at_least_words(F.col(text), least))


def text_digest(text: Column) -> Column:
    """32 bytes that stand for a text when texts are compared or grouped."""
    return F.unhex(F.sha2(text, 256))


def usable_rows(
    df: DataFrame, text: str = TEXT, label: str = LABEL, key: str = KEY, keep_empty: bool = False
) -> DataFrame:
    """``(key, text, label)`` as stripped strings, without missing or empty texts.

    An empty label stays: only the train-ready step drops it.
    """
    present = drop_missing(df.select(key, text, label), text, label)
    stripped = present.select(
        key,
        T.strip(F.col(text).cast("string")).alias(text),
        T.strip(F.col(label).cast("string")).alias(label),
    )
    return stripped if keep_empty else drop_empty(stripped, text)


def first_copies(
    df: DataFrame, facts: dict[str, Column], text: str = TEXT, key: str = KEY
) -> DataFrame:
    """Per distinct text the row with the smallest key, as its key and the given facts.

    Only keys, facts and digests move, and copies of a text meet inside each task before
    the shuffle, so a text that makes up a third of the rows costs no more than any other. Facts
    should be numbers or booleans (and so should the key): then the copies are hashed, not sorted.
    """
    named = [fact.alias(name) for name, fact in facts.items()]
    narrow = df.select(key, *named, text_digest(F.col(text)).alias("digest"))
    first = [F.min_by(name, key).alias(name) for name in facts]
    return narrow.groupBy("digest").agg(F.min(key).alias(key), *first).drop("digest")


def drop_duplicate_texts(df: DataFrame, text: str = TEXT, key: str = KEY) -> DataFrame:
    """Keep, of equal texts, the row with the smallest key (keys must be unique)."""
    return df.join(first_copies(df, {}, text, key), key, "left_semi").select(*df.columns)


def clean(
    df: DataFrame,
    *,
    min_class_samples: int = 50,
    min_doc_length: int = 20,
    dedup: bool = False,
    counts: bool = False,
    normalise: bool = True,
    keep_empty: bool = False,
    text: str = TEXT,
    label: str = LABEL,
    key: str = KEY,
) -> DataFrame:
    """Normalise and filter raw notes. Steps, in this order:

    column names (``normalise``), required columns, missing values, strip, empty texts
    (unless ``keep_empty``), duplicates (``dedup``), short texts, rare labels, length columns (``counts``).

    ``key`` names a unique column that stands for the row order: of equal texts the
    smallest key wins.
    """
    if normalise:
        df = normalise_columns(df)
    require_columns(df, {text, label, key})
    rows = usable_rows(df, text, label, key, keep_empty)
    if dedup:
        kept = _distinct_survivors(rows, min_class_samples, min_doc_length, text, label, key)
        rows = rows.join(kept, key, "left_semi")
    else:
        rows = keep_frequent_labels(min_words(rows, min_doc_length, text), label, min_class_samples)
    rows = rows.select(key, text, label)
    if counts:
        rows = rows.withColumns({
            "word_count": T.word_count(F.col(text)), "char_len": T.char_len(F.col(text)),
        })
    return rows


def _distinct_survivors(
    rows: DataFrame, min_class_samples: int, min_doc_length: int, text: str, label: str, key: str
) -> DataFrame:
    """Keys of the rows that survive dedup, length and label filters.

    Decided on narrow rows alone, where a 64-bit hash stands for the label; the texts are shuffled once,
    by unique key, when the caller joins the survivors back. The frequent labels are computed first (a job), so
    their measured size picks the join and no row moves by its label.
    """
    facts = {label: F.xxhash64(label), "long_enough": T.at_least_words(F.col(text), min_doc_length)}
    firsts = first_copies(rows, facts, text, key).where("long_enough")
    frequent = measured(frequent_labels(firsts, label, min_class_samples))
    return firsts.join(frequent, label, "left_semi").select(key)


def clean_pair(df: DataFrame, min_class_samples: int = 50, min_doc_length: int = 20, **names: str) -> DataFrame:
    """Text and label, column names normalised, duplicates kept."""
    return clean(df, min_class_samples=min_class_samples, min_doc_length=min_doc_length, **names)


def clean_pair_as_named(
    df: DataFrame, min_class_samples: int = 50, min_doc_length: int = 20, **names: str
) -> DataFrame:
    """As :func:`clean_pair`, with the column names taken as they are; only the minimum
    length keeps empty texts out."""
    return clean(
        df, min_class_samples=min_class_samples, min_doc_length=min_doc_length,
        normalise=False, keep_empty=True, **names,
    )


def clean_distinct(
    df: DataFrame, min_class_samples: int = 50, min_doc_length: int = 20, **names: str
) -> DataFrame:
    """Text, label and both length columns, duplicates dropped."""
    return clean(
        df, min_class_samples=min_class_samples, min_doc_length=min_doc_length,
        dedup=True, counts=True, **names,
    )


def clean_order(label: str = LABEL, key: str = KEY) -> list[Column]:
    """Sort keys of the clean table: label, longest first, key."""
    return [F.asc(label), F.desc("word_count"), F.asc(key)]


def clean_summary(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: rows, labels, smallest and largest word count."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(label).alias("n_labels"),
        F.min("word_count").alias("min_word_count"),
        F.max("word_count").alias("max_word_count"),
    )
