from __future__ import annotations

import random

import pytest

from corpuscope.llm import line_dedup as L

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(docs):
    first, holders = {}, {}
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= 10:
                first[key(line)] = min(first.get(key(line), doc_id), doc_id)
                holders.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or len(key(x)) < 10 or len(holders[key(x)]) < 2 or first[key(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(2)
    lines = [f"{'Line' if k % 2 else 'line'} number {k % 9} é with text" for k in range(18)] + ["short", "ninechars", "tencharsxx", "éééééééééé", "", " "]
    lines += ["\tLINE number 1 é with text \x0b", " line number 1 é with text", "line\x85separator here"]
    return [(k, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 6)))) for k in range(60)] + [
        (None, "line number 1 é with text"), (60, None), (61, ""), (3, "line number 1 é with text\nagain line number 1"), (62, "same line here\nsame line here")]


@pytest.mark.parametrize("batches, fanout", [(1, 4), (3, 4), (5, 2)])
def test_batches_give_what_one_look_at_all_gives(documents, batches, fanout):
    docs = cases()
    got = L.dedup(documents(docs), batches=batches, fanout=fanout, buckets=4)
    rows = got.select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in rows), key=repr) == brute(docs)


def test_runs_level_up_hold_each_hash_once_and_are_found_again(spark, documents, tmp_path):
    path = f"file://{tmp_path}/index"
    index = L.LineIndex(spark, path, fanout=2, buckets=4)
    for k in range(4):
        index.add(documents([(k, f"a line of batch {k} alone\na line of every batch")])).count()
    assert sorted(level for level, _ in index.runs) == [2]
    hashes = [bytes(r.h) for _, name in index.runs for r in spark.table(f"`{name}`").collect()]
    assert len(hashes) == len(set(hashes)) == 5
    index.close()
    for _, name in index.runs:  # another session knows no table
        spark.sql(f"DROP TABLE `{name}`")
    (tmp_path / "index" / "level_0_unfinished").mkdir()
    again = L.LineIndex(spark, path, fanout=2, buckets=4)
    assert again.runs == index.runs
    row = again.add(documents([(9, "a line of batch 2 alone\nand a new line here")])).first()
    assert (row.n_dropped, row.kept) == (1, "and a new line here")
    again.drop_runs()


def test_runs_are_not_shuffled(spark, documents, tmp_path):
    index = L.LineIndex(spark, f"file://{tmp_path}/index", buckets=8)
    index.add(documents([(1, "a first line of text")])).count()
    held = spark.table(f"`{index.runs[0][1]}`").withColumnRenamed("h", "known")
    batch = spark.createDataFrame([(bytearray(b"0" * 16), 1)], "h binary, doc long").groupBy("h").count()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = batch.join(held, batch.h == held.known, "left")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(known" not in plan
    index.drop_runs()


def test_columns_stay_and_lengths_follow(documents):
    docs = documents([(1, "a line that repeats"), (2, "a line that repeats\nown line"), (3, None)])
    got = L.deduplicated(docs)
    assert got.columns == docs.columns
    assert {(r.doc_id, r.text, r.n_chars) for r in got.collect()} == {(1, "a line that repeats", 19), (2, "own line", 8), (3, None, None)}


def test_odd_and_empty_tables(odd, none):
    rows = {(r.doc_id, r.n_lines, r.n_dropped) for r in L.dedup(odd).select("row.doc_id", "n_lines", "n_dropped").collect()}
    assert (1, 1, 0) in rows and (2, 1, 0) in rows and (5, 1, 0) in rows and (None, 1, 0) in rows
    assert L.dedup(none).count() == 0


def test_every_run_is_read_by_a_later_batch(documents, monkeypatch):
    made, read = [], []
    write, add = L.LineIndex._write, L.LineIndex.add

    def noted_write(self, hashes, level, parts=()):
        read.extend(parts)
        write(self, hashes, level, parts)
        made.append(self.runs[-1])

    def noted_add(self, *args, **options):
        read.extend(name for _, name in self.runs)
        return add(self, *args, **options)

    monkeypatch.setattr(L.LineIndex, "_write", noted_write)
    monkeypatch.setattr(L.LineIndex, "add", noted_add)
    docs = cases()
    rows = L.dedup(documents(docs), buckets=4).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in rows), key=repr) == brute(docs)
    assert [level for level, _ in made] == [0, 0, 1] and {name for _, name in made} <= set(read)


def test_a_bucket_is_one_file_however_many_partitions_a_shuffle_has(spark, documents, tmp_path, monkeypatch):
    frame = type(spark.range(1))
    deal = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, n, *by: deal(self, max(n, 9) if by else n, *by))
    index = L.LineIndex(spark, f"file://{tmp_path}/index", fanout=2, buckets=4)
    for k in range(2):  # two runs, which are merged
        index.add(documents([(200 * k + j, f"a line of document {200 * k + j} alone") for j in range(200)])).count()
    assert [level for level, _ in index.runs] == [1]
    files = [p for p in (tmp_path / "index").rglob("part-*") if p.parent.name == index.runs[0][1]]
    assert len(files) == 4 and spark.read.parquet(*map(str, files)).distinct().count() == 400
    index.close()
