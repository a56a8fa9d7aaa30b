from __future__ import annotations

import random

import pytest

CLASHING = ("row", "words", "hashes", "keys", "key", "doc", "h", "ids", "score", "items", "n_hit", "kept", "fp", "blob", "spans", "same", "t")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def build(spark, rows):
    """Documents of (doc_id, text) or (doc_id, text, lang, source), with columns named like the operators' own."""
    full = []
    for doc_id, text, *rest in rows:
        lang, source = rest or (None, None)
        full.append((doc_id, text, lang, source, len(text) if text is not None else None, *CLASHING))
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture
def documents(spark):
    return lambda rows: build(spark, rows)


@pytest.fixture(scope="session")
def prose():
    """Random texts of short words, some with lines, capitals and accents."""
    def make(seed, count, words=(0, 60), vocabulary=300):
        rng = random.Random(seed)
        known = ["".join(rng.choice("aeioubcdlmnrsté") for _ in range(rng.randint(1, 7))) for _ in range(vocabulary)]
        texts = []
        for _ in range(count):
            n = rng.randint(*words)
            texts.append("".join(
                (w.capitalize() if rng.random() < 0.1 else w) + rng.choice([" ", " ", " ", ", ", ".\n", "\t"])
                for w in (known[min(int(rng.expovariate(0.02)), vocabulary - 1)] for _ in range(n))
            ))
        return texts
    return make


ODD = [
    (1, None), (2, ""), (3, " \n\t"), (None, "a row without a key, but with enough words to be a text of its own kind"),
    (4, "ab " * 60_000), (5, "same text in a repeated row, same words, same key"), (5, "same text in a repeated row, same words, same key"),
    (6, "x" * 5000), (7, "日本語 のテキスト 🎉 ünïcödé\x1c\x85 end"),
]


@pytest.fixture
def odd(documents):
    return documents(ODD)


@pytest.fixture
def none(documents):
    return documents([])
