from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpuscope.operators import dictionary, heavy, logistic
from corpuscope.operators.batches import bounded_slices
from corpuscope.staging import stage


def test_slices_hold_every_row_once_and_few_items():
    rows = [["a", "b"], None, [], ["c"], list("defghij"), ["k"], ["l", "m"]]
    lists = pa.array(rows, pa.list_(pa.string())).slice(0)
    found = [part.to_pylist() for part in bounded_slices(lists, 3)]
    assert [row for part in found for row in part] == rows
    assert all(len(part) == 1 or sum(len(row or []) for row in part) <= 3 for part in found)
    assert [*bounded_slices(pa.array([], pa.list_(pa.string())), 3)] == []


def test_grams_are_made_of_few_words_at_once(spark, monkeypatch):
    tokens = spark.range(400, numPartitions=1).select(F.array_repeat(F.lit("w"), 50).alias("terms"))
    rows = {r.term: r.n for r in heavy.summaries(tokens, (1, 2), 10, words=100).collect()}
    assert rows == {"w": 20_000, "w w": 400 * 49, None: 0}
    seen, grams = [], heavy._grams
    monkeypatch.setattr(heavy, "_grams", lambda lists, low, high: seen.append(len(lists)) or grams(lists, low, high))
    monkeypatch.setattr(type(tokens), "mapInArrow", lambda self, run, schema: [*run([pa.record_batch({"terms": pa.array([["w"] * 50] * 400)})])])
    heavy.summaries(tokens, (1, 2), 10, words=100)
    assert seen == [2] * 200


def test_a_block_ends_inside_a_large_batch(spark):
    docs = spark.range(300, numPartitions=1).select("id", F.transform(F.sequence(F.lit(1), F.lit(20)), lambda k: F.concat(F.lit("w"), (k + F.col("id")).cast("string"))).alias("tokens"))
    before = {r.id: r.tokens for r in docs.collect()}
    ids = dictionary.encode(docs, looked_up=(), block_tokens=200)
    names = {r.id: r.term for r in ids.terms.collect()}
    assert {r.id: [names[t] for t in r.tokens] for r in ids.rows.collect()} == before


def test_a_pass_reads_few_chunks_at_once_and_adds_all(spark):
    rng = np.random.default_rng(1)
    size, n = 5000, 60
    rows = [(sorted(rng.choice(size, 40, replace=False).tolist()), rng.random(40).tolist(), "ab"[k % 2]) for k in range(n)]
    table = spark.createDataFrame(rows, "indices array<int>, values array<double>, label string").repartition(7)
    chunks = logistic.pack(stage(table, "rows"), F.col("indices"), F.col("values"), F.col("label"), ["a", "b"])
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 30))
    point = rng.random((size, 2))
    tasks, ones = np.array([0, 1], dtype=np.int32), np.ones(2)
    losses, gradient = logistic.evaluate(chunks, point, tasks, ones, ones)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 16 << 20
    want_loss, want = np.zeros(2), np.zeros((size, 2))
    for cells, numbers, label in rows:
        sign = np.where(np.array(["a", "b"]) == label, 1.0, -1.0)
        margin = sign * (point[cells] * np.array(numbers)[:, None]).sum(0)
        want_loss += np.log1p(np.exp(-margin))
        want[cells] += np.array(numbers)[:, None] * (-sign / (1 + np.exp(margin)))
    assert np.allclose(losses, want_loss) and np.allclose(gradient, want)


def test_a_csv_file_is_written_for_so_many_bytes(spark):
    from checks import queries

    docs = spark.range(100, numPartitions=4).select("id", F.repeat(F.lit("é"), 50).alias("text"))
    assert queries.few_files(docs, "text", 10_000).rdd.getNumPartitions() == 2
    parts = queries.few_files(docs, "text", 1000)
    assert parts.rdd.getNumPartitions() == 11 and sorted(r.id for r in parts.collect()) == [*range(100)]
    assert queries.few_files(docs, "text", 10_001).rdd.getNumPartitions() == 1
    assert queries.few_files(docs.where("id < 0"), "text", 10).rdd.getNumPartitions() == 1
