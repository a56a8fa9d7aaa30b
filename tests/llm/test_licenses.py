from __future__ import annotations

import random
import re

import pytest

from corpuscope.llm import licenses as L


def shingles(text):
    w = [x.lower() for x in re.findall("[A-Za-z0-9]+", text or "")]
    return [" ".join(w[k:k + 5]) for k in range(len(w) - 4)]


def brute(docs, notices):
    out = []
    for doc_id, text in docs:
        own = shingles(text)
        for name, notice in notices.items():
            wanted = set(shingles(notice))
            matched = wanted & set(own)
            if len(matched) >= 0.8 * len(wanted):
                out.append((doc_id, name, len(matched), min(own.index(s) for s in matched)))
    return sorted(out, key=repr)


def cases(prose):
    rng = random.Random(8)
    docs = []
    for k, text in enumerate(prose(11, 60, (0, 120))):
        for _ in range(rng.randint(0, 2)):
            words = rng.choice(list(L.NOTICES.values())).split()
            for _ in range(rng.choice([0, 0, 1, 3])):  # edits, some too many
                words[rng.randrange(len(words))] = rng.choice(["edited", "THE", ""])
            at = rng.randint(0, len(text))
            text = f"{text[:at]} {' '.join(words)} {text[at:]}"
        docs.append((k, text))
    return docs


def test_matches_are_those_of_exact_containment(documents, prose):
    docs = cases(prose)
    got = L.scan(documents(docs)).select("row.doc_id", "license", "matched", "first_word").collect()
    want = brute(docs, L.NOTICES)
    assert sorted(map(tuple, got), key=repr) == want and len({n for _, n, _, _ in want}) > 6


def test_no_python_runs(documents):
    plan = L.scan(documents([(1, "text")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange|Join", plan)


def test_templates_of_one_shingle_and_too_short_ones(spark, documents):
    docs = documents([(1, "so this is five words, really"), (2, "this is five"), (2, "this is five")])
    assert [r.row.doc_id for r in L.scan(docs, notices={"five": "This is five words really"}).collect()] == [1]
    with pytest.raises(ValueError):
        L.scan(docs, notices={"four": "only four words here"})


def test_odd_and_empty_tables(odd, none):
    assert L.scan(odd).count() == 0
    assert L.scan(none).count() == 0
