from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpuscope.sources import tables


def failing(spark):
    """A table whose job fails after some of its files are written."""
    return spark.range(100, numPartitions=4).select(
        F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id")
    )


def names(folder: Path):
    return sorted(p.name for p in folder.iterdir())


def test_a_failed_writer_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(Exception, match="lost"):
        tables.ensure_table(failing(spark), path)
    assert names(tmp_path) == []  # neither a table nor anything aside
    tables.ensure_table(spark.range(5), path)
    with pytest.raises(Exception, match="lost"):
        tables.ensure_table(failing(spark), path, force=True)
    assert spark.read.parquet(path).count() == 5 and names(tmp_path) == ["table"]


def test_the_first_of_two_writers_stays_unless_replaced(spark, tmp_path):
    path = str(tmp_path / "table")

    def slow(at):
        spark.range(3).write.parquet(at)
        tables.ensure_table(spark.range(7), path)  # another writer ends while this one still works

    tables.write_aside(spark, path, slow, replace=False)
    assert spark.read.parquet(path).count() == 7

    def slower(at):
        spark.range(3).write.parquet(at)
        tables.ensure_table(spark.range(8), path, force=True)

    tables.write_aside(spark, path, slower)
    assert spark.read.parquet(path).count() == 3 and names(tmp_path) == ["table"]


def test_a_table_that_appears_at_the_last_moment_is_not_mixed(spark, tmp_path, monkeypatch):
    path, moved = str(tmp_path / "table"), tables._moved
    calls = []

    def late(session, source, target):
        if not calls:
            calls.append(1)
            session.range(9).write.mode("overwrite").parquet(target)
        return moved(session, source, target)

    monkeypatch.setattr(tables, "_moved", late)
    tables.write_aside(spark, path, lambda at: spark.range(3).write.parquet(at), replace=False)
    assert spark.read.parquet(path).count() == 9
    calls.clear()
    tables.write_aside(spark, path, lambda at: spark.range(3).write.parquet(at))
    assert spark.read.parquet(path).count() == 3 and names(tmp_path) == ["table"]


def test_files_in_name_order_are_sorted_and_a_large_label_spreads(spark, tmp_path):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "big").otherwise(F.concat(F.lit("l"), F.col("id") % 40)).alias("label"),
        (F.xxhash64("id") % 50).alias("word_count"), F.when(F.col("id") % 5 < 3, "train").otherwise("val").alias("split"),
    )
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "6"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        tables.write_clean(rows, str(tmp_path / "clean"), label="label")
        tables.write_train_ready(rows, str(tmp_path / "ready"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

    def stored(folder):
        files = sorted(folder.glob("part-*.parquet"))
        return [[tuple(r) for r in spark.read.parquet(str(f)).select("label", "word_count", "doc_id").collect()] for f in files]

    files = stored(tmp_path / "clean")
    found = [row for rows_ in files for row in rows_]
    assert found == sorted(found, key=lambda r: (r[0], -r[1], r[2])) and len(found) == 3000
    assert sum(any(r[0] == "big" for r in rows_) for rows_ in files) >= 3 and max(map(len, files)) < 1000
    for split in ("train", "val"):
        found = [row for rows_ in stored(tmp_path / "ready" / f"split={split}") for row in rows_]
        assert found == sorted(found) and len(found) == (1800 if split == "train" else 1200)
