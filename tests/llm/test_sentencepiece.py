from __future__ import annotations

import random

import numpy as np
import pytest
import sentencepiece

from corpuscope.llm import sentencepiece as S
from corpuscope.llm.common import read_file
from corpuscope.llm.queries import PIECES


@pytest.fixture(scope="module")
def model(spark):
    return read_file(spark, PIECES)


@pytest.fixture(scope="module")
def vocabulary(model):
    return S.Vocabulary(model)


def whole_viterbi(v, text):
    """Best segmentation by one table over the whole text; ties go to the longest last piece."""
    best, back = [0.0] + [-np.inf] * len(text), [None] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - v.longest), end):
            piece = text[start:end]
            score = v.plain[piece][1] if piece in v.plain else v.unknown_score if end - start == 1 else None
            if score is not None and best[start] + score > best[end]:
                best[end], back[end] = best[start] + score, start
    ids, end = [], len(text)
    while end:
        piece = text[back[end]:end]
        ids = ([v.plain[piece][0]] if piece in v.plain else v.bytes_of(piece)) + ids
        end = back[end]
    return ids


def samples():
    rng = random.Random(4)
    parts = ["the", "ing", "Straße", " ", "  ", "\n", "été", "日本", "🎉", "x" * 70, "tion", "\t", "?", "0x1F", "▁", "\x00"]
    return ["", " ", "a", *("".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(60))]


def test_spans_stream_and_whole_text_agree(vocabulary):
    texts = samples()
    for text, coded in zip(texts, S.Encoder(vocabulary).encode(texts)):
        ids = np.frombuffer(coded, "<i4").tolist()
        marked = S.SPACE + text.replace(" ", S.SPACE) if text else ""
        assert ids == whole_viterbi(vocabulary, marked), repr(text)
        assert np.frombuffer(S.Encoder(vocabulary).stream(marked), "<i4").tolist() == ids


def test_texts_read_back(vocabulary):
    encoder = S.Encoder(vocabulary)
    for text in samples():
        back = encoder.decode(np.frombuffer(encoder.encode([text])[0], "<i4"))
        assert back == text.replace(S.SPACE, " ")


def test_decoding_agrees_with_the_library(model, vocabulary):
    reference = sentencepiece.SentencePieceProcessor(model_proto=model)
    for text in ("A plain text, with 3 numbers.", " leading", "tail ", "été 日本"):
        ids = reference.encode(text)
        assert S.decode(vocabulary, ids) == reference.decode(ids) == text


def test_window_stays_bounded(vocabulary):
    viterbi = S.StreamingViterbi(vocabulary)
    rng = random.Random(1)
    text = "".join(rng.choice("abcdeiloprstuvé") for _ in range(20_000))  # one word without a cut
    out = viterbi.feed(text) + viterbi.finish()
    assert viterbi.most_held < 12 * vocabulary.longest
    assert S.decode(vocabulary, out) == text


def test_tables(spark, model, documents, odd, none):
    rows = S.encode_table(odd, model, check=True).select("row.doc_id", "row.text", "ids", "decoded").collect()
    assert all(r.decoded == r.text for r in rows) and [r["ids"] for r in rows if r.doc_id in (1, 2)] == [None, []]
    twice = [r["ids"] for r in rows if r.doc_id == 5]
    assert len(twice) == 2 and twice[0] == twice[1]
    coded = S.encode_table(odd, model).select("row.doc_id", "row.text", "ids")
    assert all(r["decoded"] == r["row"].text for r in S.decode_table(coded, model).collect())
    assert S.encode_table(none, model).count() == 0
