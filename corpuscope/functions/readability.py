"""Readability scores from counts of words, sentences, syllables and letters.

Syllables are vowel groups, at least one per word. Vowel groups never span a space,
so a text's total is (vowel groups) + (words without a vowel): two counts over the whole
text in place of a loop over its words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.functions import text as T
from corpuscope.functions.numeric import round_even

SCORES = ("flesch_reading_ease", "flesch_kincaid_grade", "gunning_fog", "coleman_liau")
USES = {
    "flesch_reading_ease": ("s", "groups", "voiceless"), "flesch_kincaid_grade": ("s", "groups", "voiceless"),
    "gunning_fog": ("s", "complex"), "coleman_liau": ("s", "letters"),
}
MIN_WORDS = 10


def with_readability(
    df: DataFrame, text: str = "transcription", scores: Sequence[str] = SCORES, words: str | None = None, sentences: str | None = None,
) -> DataFrame:
    """Add the ``scores``, 2 decimals; NULL for NULL texts and below ten words. What no score uses is not counted.

    Two decimals also bound the number of distinct scores, which is what keeps exact
    quantiles over them affordable. Words are counted once, and the text is lower-cased once, for all that need it.
    ``words`` and ``sentences`` may name columns that have these counts already, as :func:`with_text_stats` adds them.
    """
    source, lowered = F.col(text), F.col("_lowered")
    kept = df.columns
    counts = {
        "s": F.greatest(T.sentence_count(source) if sentences is None else F.col(sentences), F.lit(1)),
        "groups": T.vowel_groups(lowered),
        "voiceless": F.regexp_count(lowered, F.lit(T.WORD_WITHOUT_VOWEL)),
        "complex": F.regexp_count(lowered, F.lit(T.COMPLEX_WORD)),
        "letters": F.length(F.regexp_replace(source, T.NOT_LETTER_OR_DIGIT, "")),
    }
    wanted = {name for score in scores for name in USES[score]}
    counted = df.select(*kept, F.lower(source).alias("_lowered"), (T.word_count(source) if words is None else F.col(words)).alias("_words")).select(
        *kept,
        F.when(F.col("_words") >= MIN_WORDS, F.struct(
            F.col("_words").cast("double").alias("w"),
            *[count.cast("double").alias(name) for name, count in counts.items() if name in wanted],
        )).alias("_counts"),
    )
    w, s = F.col("_counts.w"), F.col("_counts.s")
    syllables = F.col("_counts.groups") + F.col("_counts.voiceless")
    formulas = {
        "flesch_reading_ease": 206.835 - 1.015 * (w / s) - 84.6 * (syllables / w),
        "flesch_kincaid_grade": 0.39 * (w / s) + 11.8 * (syllables / w) - 15.59,
        "gunning_fog": 0.4 * ((w / s) + 100.0 * (F.col("_counts.complex") / w)),
        "coleman_liau": 0.0588 * (100.0 * F.col("_counts.letters") / w) - 0.296 * (100.0 * s / w) - 15.8,
    }
    return counted.select(*kept, *[round_even(formulas[name], 2).alias(name) for name in scores])


def with_text_stats(df: DataFrame, text: str = "transcription") -> DataFrame:
    """Add ``char_len``, ``word_count``, ``sentence_count`` and ``avg_word_len``."""
    source = F.col(text)
    counted = df.select(
        *df.columns,
        T.char_len(source).alias("char_len"),
        T.word_count(source).alias("word_count"),
        T.sentence_count(source).alias("sentence_count"),
    )
    return counted.select("*", T.avg_word_len(source, F.col("word_count")).alias("avg_word_len"))
