from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from corpuscope.llm import language, sentencepiece
from corpuscope.llm.common import read_file

from .test_decontamination import brute as hits
from .test_line_dedup import brute as lines
from .test_sentencepiece import whole_viterbi
from .test_simhash import brute_print, roots


def test_stages_against_plain_loops(spark, documents, tmp_path, prose):
    texts = prose(21, 40, (3, 25))
    bench = [(1, " ".join(texts[3].split()[:12])), (2, "ten words that no text has in this order at all ever")]
    rows = [(k, t, "en" if k % 2 else "fr", f"src{k % 3}") for k, t in enumerate(texts)]
    rows += [(50, texts[5], "en", "src0"), (51, "...", "en", "src0"), (52, None, "en", "src0"), (53, texts[6] + "\nand a line of its own", "fr", "src1")]
    docs = documents(rows).select("doc_id", "text", "lang", "source", F.col("n_chars"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    none = language.identify(
        docs, language.fit(docs), text=F.col("text"), declared=F.col("lang"), host=F.col("source"), keep={"doc_id": F.col("doc_id")}
    ).filter("accepted").collect()
    kept = [(r[0], r[1]) for r in rows if r[0] in {x.doc_id for x in none}]
    assert {51, 52}.isdisjoint(k for k, _ in kept) and len(kept) == len(rows) - 2
    kept = [(k, t) for k, _, _, t in lines(kept)]
    prints = {k: brute_print(t) for k, t in kept}
    root = roots(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    kept = [(k, t) for k, t in kept if root[k] == k]
    kept = [(k, t) for (k, t), (_, n_hit, _) in zip(kept, hits(kept, bench)) if not n_hit]
    assert set(got) == {k for k, _ in kept} and 3 not in got
    v = sentencepiece.Vocabulary(read_file(spark, corpus_pipeline.PIECES))
    for k, t in kept:
        assert (got[k].text, got[k].n_chars) == (t, len(t))
        assert got[k]["ids"] == (whole_viterbi(v, "▁" + t.replace(" ", "▁")) if t else [])
    assert np.all([len(got[k]["ids"]) > 0 for k, t in kept if t])


def test_stages_keep_the_columns_and_take_empty_tables(spark, none):
    docs = none.select("doc_id", "text", "lang", "source", "n_chars")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "decontaminate", "encode"]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.count() == 0 and out.columns[:5] == docs.columns
