"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Each query runs to the end (no rows are dropped) into a sink that discards them, after one
small warm-up job for the session.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from checks.queries import QUERIES
from corpuscope.session import tuned
from corpuscope.staging import release

HEADLINE = (
    "clean_pair", "clean_distinct", "exact_dedup", "duplicate_profile", "label_frequency", "imbalance",
    "text_stats", "describe_lengths", "outlier_summary", "length_histogram", "box_summary",
    "readability", "readability_by_label", "corpus_summary",
    "vocabulary", "tfidf_weights", "tfidf_top_terms", "sublinear_tfidf", "top_bigrams", "top_trigrams",
    "bigrams_by_label", "jaccard", "exclusive_terms", "cloud_weights",
    "split_assignment", "train_ready", "classification_report", "baseline_predictions",
)


def main(names: list[str]) -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    work = tempfile.mkdtemp(prefix="bench-")
    spark = tuned(
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.checkpoint.dir", f"{work}/shared").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The supplied files have one row group each, which one task must read. As a load step they are stored with
    # as many files as there are tasks; at real sizes the default split size does that.
    for name in ("documents", "labels"):
        source = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        source.repartition(2 * int(cpus), "doc_id").write.parquet(f"{work}/tables/{name}.parquet")
    spark.read.parquet(f"{work}/tables/documents.parquet").groupBy("lang").count().collect()
    times: dict[str, float] = {}
    for name in names or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, f"{work}/tables").write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        release(spark)
    print(json.dumps({
        "metric": "total seconds over headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()
    shutil.rmtree(work)


if __name__ == "__main__":
    main(sys.argv[1:])
