"""Sources, sinks, distributions and whole jobs on small data."""

from __future__ import annotations

import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuscope import staging
from corpuscope.operators import distributions
from corpuscope.plans import prepare, profile
from corpuscope.sources import tables
from corpuscope.staging import stage

CSV = (
    ',description,transcription,sample_name,keywords,medical_specialty\n'
    '0,d,"line one\nline ""two""",s,,Heart\n'
    '1,d,NA,s,k,Brain\n'
    '2,d, padded ,s,n/a,null\n'
)


def test_csv_dialect(spark, tmp_path):
    path = tmp_path / "notes.csv"
    path.write_text(CSV)
    rows = tables.read_notes_csv(spark, str(path)).orderBy("`Unnamed: 0`").collect()
    assert [r["Unnamed: 0"] for r in rows] == [0, 1, 2]
    assert [r.transcription for r in rows] == ['line one\nline "two"', None, " padded "]
    assert [r.keywords for r in rows] == [None, "k", None]
    assert [r.medical_specialty for r in rows] == ["Heart", "Brain", None]


def test_stored_table_is_kept_unless_forced(spark, tmp_path):
    path = str(tmp_path / "table")
    assert tables.ensure_table(spark.range(3), path).count() == 3
    assert tables.ensure_table(spark.range(5), path).count() == 3
    assert tables.ensure_table(spark.range(5), path, force=True).count() == 5


def test_an_unfinished_table_is_written_anew(spark, tmp_path):
    path = tmp_path / "table"
    tables.ensure_table(spark.range(4), str(path))
    (path / "_SUCCESS").unlink()
    assert tables.ensure_table(spark.range(6), str(path)).count() == 6
    (tmp_path / "empty").mkdir()
    assert tables.ensure_table(spark.range(2), str(tmp_path / "empty")).count() == 2


@pytest.mark.parametrize("header, row, found", [
    (",medical_specialty,keywords,sample_name,description,transcription", "4,L,k,s,d,T", ("T", "L", "d")),
    ("Unnamed: 0,transcription,medical_specialty,description,sample_name,keywords,more", "4,T,L,d,s,k,m", ("T", "L", "d")),
])
def test_csv_columns_are_found_by_name(spark, tmp_path, header, row, found):
    path = tmp_path / "notes.csv"
    path.write_text(f"{header}\n{row}\n")
    got = tables.read_notes_csv(spark, str(path))
    r = got.first()
    assert (r["Unnamed: 0"], r.transcription, r.medical_specialty, r.description) == (4, *found)
    assert ("more" in got.columns) == ("more" in header)


def test_csv_with_missing_columns_or_cells_is_refused(spark, tmp_path):
    path = tmp_path / "notes.csv"
    path.write_text(",transcription,medical_specialty\n1,T,L\n")
    with pytest.raises(ValueError, match=r"\['description', 'keywords', 'sample_name'\]"):
        tables.read_notes_csv(spark, str(path))
    path.write_text(CSV + "3,too,few\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_notes_csv(spark, str(path)).collect()


def test_csv_to_splits_by_row_number(spark, tmp_path):
    lines = ["".join(f'{k},d,"note {k}\nwith ""five"" words here",s,k,{"AB"[k % 2]}\n' for k in range(40))]
    (tmp_path / "notes.csv").write_text(CSV.splitlines()[0] + "\n" + lines[0])
    folders = prepare.prepare_csv(
        spark, str(tmp_path / "notes.csv"), str(tmp_path / "raw"), str(tmp_path / "out"), min_class_samples=2, min_doc_length=5, val_size=0,
    )
    assert set(folders) == {"train", "test"}
    assert sum(spark.read.csv(at, header=True, multiLine=True, escape='"').count() for at in folders.values()) == 40
    with pytest.raises(ValueError, match="unique"):
        prepare.prepare_splits(sample(spark).union(sample(spark, 1)), str(tmp_path / "r2"), str(tmp_path / "o2"))


def test_jobs_give_back_what_they_staged(spark, tmp_path):
    kept, folder = len(staging._kept), Path(staging.shared_folder(spark).removeprefix("file://")) / "corpuscope"
    before = set(folder.glob("*")) if folder.exists() else set()
    prepare.prepare_splits(sample(spark), str(tmp_path / "raw"), str(tmp_path / "out"), min_class_samples=2, min_doc_length=5)
    prepare.prepare_train_ready(sample(spark), str(tmp_path / "c"), str(tmp_path / "r"), min_class_samples=2, min_doc_length=5)
    with staging.staged_work(spark):
        profile.profile(sample(spark))["jaccard"].collect()
    assert len(staging._kept) == kept
    assert (set(folder.glob("*")) if folder.exists() else set()) == before


def test_deviation_of_values_far_from_zero(spark):
    df = spark.range(1000).select((F.col("id") % 2 + 1e9).alias("v"))
    assert distributions.describe(df, ["v"], digits=6).first().std == pytest.approx(0.50025, abs=1e-5)


def sample(spark, n=60):
    return spark.createDataFrame(
        [(i, f"note number {i} says patient {'heart pain' if i % 2 else 'brain tremor'}, \"quoted\"\nnext line",
          "Heart" if i % 2 else "Brain") for i in range(n)],
        "doc_id long, transcription string, medical_specialty string",
    )


def test_prepare_writes_three_csv_folders(spark, tmp_path):
    folders = prepare.prepare_splits(
        sample(spark), str(tmp_path / "raw"), str(tmp_path / "splits"), min_class_samples=2, min_doc_length=5
    )
    sizes = {
        name: spark.read.csv(folder, header=True, multiLine=True, escape='"').count() for name, folder in folders.items()
    }
    val = math.ceil(51 * (0.15 / (1 - 0.15)))
    assert sizes == {"train": 51 - val, "val": val, "test": 9}


def test_train_ready_job(spark, tmp_path):
    ready = prepare.prepare_train_ready(
        sample(spark), str(tmp_path / "clean"), str(tmp_path / "ready"), min_class_samples=2, min_doc_length=5
    )
    assert ready.count() == 60 and {r.split for r in ready.select("split").distinct().collect()} == {"train", "val", "test"}
    plan = ready.where("split = 'val'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_describe_and_quantiles_match_numpy(spark):
    values = [3, 7, 7, 7, 12, 40, 41, 1000, 5]
    df = spark.createDataFrame([(v, "g") for v in values] + [(None, "g")], "v long, g string")
    row = distributions.describe(df, ["v"], digits=6).first()
    expected = [len(values), np.mean(values), np.std(values, ddof=1), min(values), *np.percentile(values, [25, 50, 75]), max(values)]
    assert [row[n] for n in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(expected, abs=1e-5)
    q1, q3 = np.percentile(values, [25, 75])
    high = q3 + 1.5 * (q3 - q1)
    assert sorted(r.v for r in distributions.outlier_rows(df, "v").collect()) == [v for v in values if v > high]
    box = distributions.box_summary(df, "v", "g").first()
    assert (box.whisker_low, box.whisker_high, box.outliers) == (3, max(v for v in values if v <= high), 1)


def test_histogram_matches_numpy_and_keeps_empty_bins(spark):
    values = [0, 1, 1, 5, 9, 10, 100, 100]
    df = spark.createDataFrame([(v, 4) for v in values], "v long, same long")
    got = {(r.metric, r.bin): r.n for r in distributions.histogram(df, ["v", "same"], bins=10).collect()}
    assert [got["v", b] for b in range(1, 11)] == list(np.histogram(values, bins=10)[0])
    assert [got["same", b] for b in range(1, 11)] == list(np.histogram([4] * 8, bins=10)[0])


def test_staged_table_reads_only_its_columns(spark):
    kept = stage(sample(spark), "test")
    plan = kept.groupBy("medical_specialty").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<medical_specialty:string>" in plan


def test_whole_profile(spark):
    raw = sample(spark).unionByName(spark.createDataFrame([(99, None, "Heart")], sample(spark, 1).schema))
    found = profile.profile(raw)
    sizes = {name: df.count() for name, df in found.items()}
    assert sizes["label_frequency"] == 2 and sizes["missing"] == 1 and sizes["length_histogram"] == 150
    summary = found["summary"].first()
    assert (summary.n_rows, summary.n_labels, summary.imbalance_ratio, summary.labels_below_50) == (60, 2, 1.0, 2)
    assert all(name in sizes for name in ("jaccard", "cloud_weights", "term_heatmap", "readability_by_label"))
