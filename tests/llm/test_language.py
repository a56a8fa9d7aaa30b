from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpuscope.llm import language as L

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ein", "der"], "cc": ["oux", "eau", "qui", "ée"]}


def text(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture
def labelled(documents):
    rng = random.Random(1)
    return documents([(100 * k + i, text(lang, 40, rng), lang, f"host{k}") for k, lang in enumerate(SYLLABLES) for i in range(30)])


def judge(docs, model, declared=None, host=None):
    none = F.lit(None).cast("string")
    found = L.identify(docs, model, text=F.col("text"), declared=F.col(declared) if declared else none,
                       host=F.col(host) if host else none, keep={"doc_id": F.col("doc_id")})
    return {r.doc_id: r for r in found.collect()}


def test_held_out_texts_are_told_apart(documents, labelled):
    rng = random.Random(2)
    docs = [(i, text(lang, n, rng), lang, None) for i, (lang, n) in enumerate((lang, n) for lang in SYLLABLES for n in (1, 2, 5, 30) for _ in range(8))]
    got = judge(documents(docs), L.fit(labelled))
    right = sum(got[i].language == lang for i, _, lang, _ in docs)
    assert right >= 0.97 * len(docs) and all(r.accepted for r in got.values())


def test_other_evidence_decides_where_the_text_cannot(documents, labelled):
    model = L.fit(labelled)
    rng = random.Random(3)
    docs = [(i, text("bb", 30, rng), "bb", "b.example.xx") for i in range(40)] + [(i, text("aa", 30, rng), "aa", "a.example.yy") for i in range(40, 80)]
    docs += [(100, "123 ?!", None, "b.example.xx"), (101, "", "cc", None), (102, None, None, "new.example.yy"), (103, "%%%", None, "c.other.xx")]
    got = judge(documents(docs), model, "lang", "source")
    assert got[100].language == "bb"          # its host
    assert got[101].language == "cc"          # what it declares
    assert got[102].language in ("aa", "bb")  # its domain and suffix, which both have
    assert got[103].language == "bb"          # its suffix
    assert not any(got[i].accepted for i in (100, 101, 102, 103)) and all(got[i].accepted for i in range(80))


def test_model_counts_what_a_plain_loop_counts(labelled):
    model = L.fit(labelled)
    counts = {lang: {} for lang in SYLLABLES}
    for r in labelled.collect():
        for b in L.trigram_buckets(r.text.encode()).tolist():
            counts[r.lang][b] = counts[r.lang].get(b, 0) + 1
    import math
    for k, lang in enumerate(model.languages):
        total = sum(counts[lang].values()) + 0.1 * L.BUCKETS
        for b, n in list(counts[lang].items())[:50]:
            assert model.log_p[b, k] == pytest.approx(math.log((n + 0.1) / total), rel=1e-5)


def test_pages_parts(spark):
    html = "<html><head></head><body lang='x'></body>"
    rows = [("https://u@A.Example.COM:80/p?q", '<!DOCTYPE html><HTML class="k" lang = "de-AT"><script>var x="<p>";</script><p>Ein &amp; Text</p>'), ("nothing", html), (None, None)]
    df = spark.createDataFrame(rows, "url string, html string").select(
        L.host_of(F.col("url")).alias("h"), L.suffix_of(L.host_of(F.col("url"))).alias("s"), L.domain_of(L.host_of(F.col("url"))).alias("d"),
        L.declared_in(F.col("html")).alias("l"), L.visible_text(F.col("html")).alias("t"))
    a, b, c = df.collect()
    assert (a.h, a.s, a.d, a.l, a.t.split()) == ("a.example.com", "com", "example.com", "de", ["Ein", "Text"])
    assert (b.h, b.s, b.l) == ("", None, None) and tuple(c) == (None,) * 5


def test_rejected_documents_go_and_columns_stay(documents, labelled):
    docs = documents([(1, "ka lo mi tu", "aa", "h"), (2, "...", "aa", "h"), (3, None, None, None), (4, "ein der ung", None, None), (4, "ein der ung", None, None), (2, "tu mi lo", "aa", "h")])
    left = L.accepted_documents(docs, L.fit(labelled))
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(1, "ka lo mi tu"), (2, "tu mi lo"), (4, "ein der ung"), (4, "ein der ung")]


def test_odd_and_empty_tables(odd, none, labelled):
    model = L.fit(labelled)
    assert L.accepted_documents(odd, model).count() == 6  # NULL, empty and blank texts go
    assert judge(none, model, "lang", "source") == {}
    assert {r.language for r in judge(odd, L.fit(none)).values()} == {"und"}


def test_unseen_trigrams_favour_no_language(documents):
    rng = random.Random(4)
    rows = [(100 * k + i, text(lang, 40, rng), lang, None) for k, (lang, n) in enumerate((("aa", 90), ("bb", 5), ("cc", 30))) for i in range(n)]
    (*total, und), _ = L.fit(documents(rows), unknown=True).log_likelihood("zzgz wgzw".encode())
    assert total[0] == pytest.approx(total[1]) == pytest.approx(total[2])
    assert und > total[0] + 1


FOREIGN = ["Questo testo non appartiene a nessuna delle lingue", "vzpg hwqj xgzv pphw jjgz qwvz", "это русский текст", "日本語のテキストです", "x" * 5000, "aGVsbG8gd29ybGQgdGhpcyBpcw=="]


def test_foreign_and_random_text_goes_and_short_clean_text_stays(documents, labelled):
    rng = random.Random(5)
    model = L.fit(labelled, unknown=True)
    clean = [(i, text(lang, n, rng), lang, "h") for i, (lang, n) in enumerate((lang, n) for lang in SYLLABLES for n in (1, 2, 5, 30) for _ in range(5))]
    # Whatever they declare, and whether or not other rows of their host are clean.
    junk = [(200 + 10 * i + j, t, lang, host) for i, t in enumerate(FOREIGN) for j, (lang, host) in enumerate([("aa", "h"), (None, None), ("zz", "new")])]
    docs = documents([*clean, *junk])
    found = L.identify(docs, model, text=F.col("text"), declared=F.col("lang"), host=F.col("source"), keep={"doc_id": F.col("doc_id")})
    got = {r.doc_id: r for r in found.collect()}
    assert all((got[i].language, got[i].accepted) == (lang, True) for i, _, lang, _ in clean)
    assert {(got[r[0]].language, got[r[0]].accepted) for r in junk} == {("und", False)}
    kept = L.accepted_documents(docs, model)
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in clean]


def test_a_single_language_rejects_others_too(documents):
    rng = random.Random(6)
    model = L.fit(documents([(i, text("bb", 40, rng), "bb", None) for i in range(30)]), unknown=True)
    docs = documents([(1, text("bb", 3, rng), None, None), (2, text("cc", 20, rng), None, None), (3, FOREIGN[1], "bb", None)])
    assert [r.doc_id for r in L.accepted_documents(docs, model).collect()] == [1]


def test_the_stage_and_the_queries_reject_unknown_text(spark, documents, tmp_path):
    import corpus_pipeline
    from corpuscope.llm.queries import QUERIES

    rng = random.Random(7)
    rows = [(100 * k + i, text(lang, 40, rng), lang, "h") for k, lang in enumerate(SYLLABLES) for i in range(30)] + [(900 + i, t, "aa", "h") for i, t in enumerate(FOREIGN)]
    docs = documents(rows)
    assert {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()} == {r[0] for r in rows if r[0] < 900}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "https://a.b/", f"<p>{rows[0][1]}</p>"), (2, "https://a.b/c", "<p>hvvq xxzp wjgk qpzv jwxg zzhv</p>")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {r.doc_id for r in QUERIES["op4_language"](spark, str(tmp_path)).collect() if not r.accepted} == {r[0] for r in rows if r[0] >= 900}
    assert {r.page_id: r.accepted for r in QUERIES["language_of_pages"](spark, str(tmp_path)).collect()} == {1: True, 2: False}


def test_regional_dirty_and_many_labels(documents, monkeypatch):
    monkeypatch.setattr(L, "MOST_LANGUAGES", 3)
    rng = random.Random(8)
    tags = {"aa": ["aa-US", "AA_gb", "aa"], "bb": ["bb"], "cc": ["cc-x"]}
    rows = [(100 * k + i, text(lang, 40, rng), tags[lang][i % len(tags[lang])], "h") for k, lang in enumerate(SYLLABLES) for i in range(30)]
    rows += [(400 + i, text("aa", 40, rng), tag, "h") for i, tag in enumerate(["free text, no tag", "zz", "yy", "und", "", "7"])]
    docs = documents(rows)
    model = L.fit(docs, unknown=True)
    assert model.languages == ["aa", "bb", "cc"]
    got = judge(docs, model, "lang", "source")
    assert all(r.accepted for r in got.values()) and all(got[i].language == "aa" for i in [*range(30), *range(400, 406)])
