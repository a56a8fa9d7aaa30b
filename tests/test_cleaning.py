from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpuscope.operators import cleaning, labels, quality, schema


def pairs(df):
    return sorted((r.doc_id, r.medical_specialty) for r in df.collect())


def test_short_texts_and_rare_labels_go(spark):
    """Labels of 1 to 6 rows; row k of a label has k words."""
    rows = [(10 * size + k, " ".join(["w"] * k), f"of {size}") for size in range(1, 7) for k in range(1, size + 1)]
    raw = spark.createDataFrame(rows, "doc_id long, transcription string, medical_specialty string")
    for least_words in (1, 3, 6):
        for least_rows in (1, 2, 4):
            long_enough = [(key, label) for key, text, label in rows if len(text.split()) >= least_words]
            counts = {label: sum(own == label for _, own in long_enough) for _, label in long_enough}
            want = sorted((key, label) for key, label in long_enough if counts[label] >= least_rows)
            assert pairs(cleaning.clean_pair(raw, least_rows, least_words)) == want


def test_bounds_are_inclusive(notes):
    raw = notes([(1, "a b c", "X"), (2, "d e f", "X"), (3, "g h", "X"), (4, "i j k", "Y")])
    assert pairs(cleaning.clean_pair(raw, 2, 3)) == [(1, "X"), (2, "X")]


def test_missing_and_blank_cells(notes):
    raw = notes([
        (1, None, "X"), (2, "a b", None), (3, "  \t", "X"), (4, " a b\x1c", " X "), (5, "c d", "  "),
    ])
    assert pairs(cleaning.clean_pair(raw, 1, 1)) == [(4, "X"), (5, "")]
    row = cleaning.clean_pair(raw, 1, 1).where("doc_id = 4").first()
    assert row.transcription == "a b"


def test_only_the_minimum_length_keeps_empty_texts_out_of_the_second_recipe(notes):
    raw = notes([(1, "  ", "X"), (2, "a b", "X"), (3, None, "X")])
    assert pairs(cleaning.clean_pair_as_named(raw, 1, 0)) == [(1, "X"), (2, "X")]
    assert pairs(cleaning.clean_pair_as_named(raw, 1, 1)) == [(2, "X")]
    assert pairs(cleaning.clean_pair(raw, 1, 0)) == [(2, "X")]


def test_first_copy_wins_and_brings_its_label(notes):
    raw = notes([(7, "same text here", "Late"), (3, " same text here ", "Early"), (5, "other text here", "Early")])
    cleaned = cleaning.clean_distinct(raw, 1, 1)
    assert pairs(cleaned) == [(3, "Early"), (5, "Early")]
    assert {(r.word_count, r.char_len) for r in cleaned.collect()} == {(3, 14), (3, 15)}


def test_dedup_comes_before_label_counts(notes):
    raw = notes([(1, "same text", "X"), (2, "same text", "X"), (3, "one more", "Y"), (4, "yet another", "Y")])
    assert pairs(cleaning.clean_distinct(raw, 2, 1)) == [(3, "Y"), (4, "Y")]


def test_one_text_on_a_third_of_the_rows(spark):
    raw = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 1000, "the same text").otherwise(F.concat(F.lit("text "), F.col("id"))).alias("transcription"),
        F.lit("X").alias("medical_specialty"),
    )
    assert cleaning.clean_distinct(raw, 1, 1).count() == 2001


@pytest.mark.parametrize("least", [1, 2, 199, 200, 201])
def test_word_bound_at_any_length(spark, least):
    texts = [" " + "a\u2003" * n for n in (least - 1, least, least + 1)] + ["", "  ", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, transcription string")
    assert [r.doc_id for r in cleaning.min_words(df, least).orderBy("doc_id").collect()] == [1, 2]


def test_distinct_recipe_moves_no_row_by_label_and_sorts_no_copies(spark, notes):
    raw = notes([(k, f"text {k % 7}", "XY"[k % 2]) for k in range(40)])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        cleaned = cleaning.clean_distinct(raw, 1, 1)
        cleaned.collect()
        plan = cleaned._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortAggregate" not in plan and "SortMergeJoin [medical_specialty" not in plan


def test_column_names(spark):
    raw = spark.createDataFrame([(1, "a b", "X")], "` Doc ID ` long, Transcription string, `Medical Specialty` string")
    assert cleaning.clean_pair(raw, 1, 1).columns == ["doc_id", "transcription", "medical_specialty"]
    with pytest.raises(ValueError, match=r"\['doc_id', 'medical_specialty', 'transcription'\]"):
        cleaning.clean_pair_as_named(raw.withColumnRenamed("Transcription", "x"), 1, 1)
    with pytest.raises(ValueError, match="collide"):
        schema.normalise_columns(spark.createDataFrame([(1, 2)], "`a b` int, `A B ` int"))
    with pytest.raises(ValueError, match="none"):
        schema.require_rows(raw.limit(0), "none")


def test_missing_texts_repeat_one_another(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), (None,), ("b",)], "t string")
    row = quality.duplicate_profile(df, "t").first()
    assert (row.n_rows, row.duplicate_rows, row.duplicate_pct) == (5, 2, 40.0)


def test_missing_profile_lists_only_incomplete_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, "y", "z")], "id long, p string, q string")
    rows = [tuple(r) for r in quality.missing_profile(df).collect()]
    assert rows == [("p", 2, 66.67), ("q", 1, 33.33)]


def test_equal_counts_are_ordered_by_name(notes):
    raw = notes([(1, "t", "b"), (2, "t", "a"), (3, "t", "c"), (4, "t", "c"), (5, "t", None)])
    got = labels.label_frequency(raw, "medical_specialty").orderBy(F.desc("n"), "medical_specialty").collect()
    assert [tuple(r) for r in got] == [("c", 2, 50.0, 50.0), ("a", 1, 25.0, 75.0), ("b", 1, 25.0, 100.0)]
    row = labels.imbalance(raw, "medical_specialty").first()
    assert (row.majority_label, row.minority_label, row.n_classes, row.imbalance_ratio) == ("c", "b", 3, 2.0)
    assert [r[0] for r in labels.top_labels(raw, "medical_specialty", 2).collect()] == ["c", "a"]


def test_frequent_labels_join_without_moving_rows(notes):
    raw = notes([(1, "t", "b"), (2, "t", "a"), (3, "t", "a")])
    kept = labels.keep_frequent_labels(raw, "medical_specialty", 2)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert kept.count() == 2
