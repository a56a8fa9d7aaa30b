"""Text measures and tokens as native expressions; no Python runs per row.

The character classes are spelled out rather than taken from ``\\s`` and ``\\w``:
Java's short forms are ASCII-only by default, and even its Unicode mode misses the
separators U+001C to U+001F which count as whitespace here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuscope.functions.numeric import round_even
from corpuscope.functions.stopwords import ENGLISH

SPACE = r"\t-\r\x1c-\x20\x{85}\p{Z}"
WORD = rf"[^{SPACE}]+"
SENTENCE = rf"[^{SPACE}.!?][^.!?]*"
TOKEN = r"[\p{L}\p{N}_]{2,}"

# Every whitespace code point, the members of SPACE.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

VOWEL_GROUP = "[aeiouy]+"
_WORD_START = rf"(?<![^{SPACE}])"
_OTHER = rf"[^aeiouy{SPACE}]"
# Possessive runs and the anchor at a word's start leave nothing to back-track into.
WORD_WITHOUT_VOWEL = rf"{_WORD_START}{_OTHER}++(?![aeiouy])"
COMPLEX_WORD = rf"{_WORD_START}{_OTHER}*+[aeiouy]++{_OTHER}++[aeiouy]++{_OTHER}++[aeiouy]"
NOT_LETTER_OR_DIGIT = r"[^\p{L}\p{Nd}]+"


def _count(text: Column, piece: str, between: str) -> Column:
    """How many pieces there are, where ``between`` is the class of all that stands before, between and after them.

    Each piece becomes one character, with what follows it; counting matches would make a string of each.
    """
    marked = F.regexp_replace(text, f"{piece}+[{between}]*+", "x")
    return (F.length(marked) - F.length(F.regexp_extract(text, f"^[{between}]*+", 0))).cast("long")


def strip(text: Column) -> Column:
    """Remove Unicode whitespace from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def char_len(text: Column) -> Column:
    """Code points; 0 for NULL."""
    return F.coalesce(F.length(text), F.lit(0)).cast("long")


def word_count(text: Column) -> Column:
    """Runs of non-whitespace; 0 for NULL."""
    return F.coalesce(_count(text, WORD, SPACE), F.lit(0).cast("long"))


def at_least_words(text: Column, least: int) -> Column:
    """Whether the text has ``least`` words or more; splits off no more than that many words."""
    if least <= 0:
        return text.isNotNull()
    word = F.get(F.split(strip(text), f"[{SPACE}]+", least), F.lit(least - 1))
    return F.coalesce(F.length(word) > 0, F.lit(False))


def sentence_count(text: Column) -> Column:
    """Non-blank pieces between runs of ``.``, ``!`` and ``?``; 0 for NULL."""
    return F.coalesce(_count(text, SENTENCE, rf"{SPACE}.!?"), F.lit(0).cast("long"))


def vowel_groups(text: Column) -> Column:
    """Runs of vowels in a lower-cased text."""
    return _count(text, VOWEL_GROUP, "^aeiouy")


def avg_word_len(text: Column, words: Column) -> Column:
    """Mean code points per word, 2 decimals; 0 when there are no words."""
    solid = F.length(F.regexp_replace(text, f"[{SPACE}]+", ""))
    return F.when(words > 0, round_even(solid.cast("double") / words, 2)).otherwise(F.lit(0.0))


def tokens(text: Column, stop_words: Sequence[str] = ENGLISH, lowercase: bool = True,
           max_length: int | None = None) -> Column:
    """Lower-cased runs of two or more word characters, without stop words.

    ``max_length`` keeps that many leading tokens; it is an option of the caller and
    off by default.
    """
    source = F.lower(text) if lowercase else text
    found = F.regexp_extract_all(source, F.lit(TOKEN), F.lit(0))
    if stop_words:
        words = list(stop_words)
        found = F.filter(found, lambda token: ~token.isin(words))
    return F.slice(found, 1, max_length) if max_length is not None else found


def ngrams(token_list: Column, low: int, high: int) -> Column:
    """All n-grams for n in ``low..high``, joined with single spaces.

    ``token_list`` should be a plain column: it is used several times over.
    """
    if not 1 <= low <= high:
        raise ValueError("n-gram range must satisfy 1 <= low <= high.")
    parts = [_ngrams_of(token_list, n) for n in range(low, high + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _ngrams_of(token_list: Column, n: int) -> Column:
    if n == 1:
        return token_list
    starts = F.greatest(F.size(token_list) - (n - 1), F.lit(0))
    grams = F.slice(token_list, F.lit(1), starts)
    for shift in range(1, n):
        following = F.slice(token_list, F.lit(1 + shift), starts)
        grams = F.zip_with(grams, following, lambda left, right: F.concat(left, F.lit(" "), right))
    return grams
