from __future__ import annotations

import math
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from corpuscope.operators import distributions, labels, ordering, splitting


@contextmanager
def many_ranges(spark, ranges=7):
    """Every sort is cut into ranges, however small the table."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": str(ranges)}
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def doubles(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(4000):
        group = rng.choice(["a", "a", "a", "a", "b", "c", None])
        value = rng.choice([rng.gauss(0, 1e6), rng.random(), float(rng.randint(0, 5)), -0.0])
        rows.append((group, value, rng.choice([None, rng.expovariate(1e-3)])))
    rows += [("one", 4.5, None), ("two", 1.0, 3.0), ("two", 2.0, 9.0), ("none", None, None)]
    return spark.createDataFrame(rows, "g string, v double, w double").cache()


def test_quantiles_equal_the_built_in_aggregate(spark, doubles):
    shares = {"least": 0.0, "low": 0.1, "q1": 0.25, "mid": 0.5, "odd": 0.777, "high": 0.999, "most": 1.0}
    expected = {r[0]: tuple(r[1:]) for r in doubles.where("v is not null").groupBy("g").agg(*[F.percentile("v", F.lit(s)) for s in shares.values()]).collect()}
    with many_ranges(spark):
        counted = ordering.in_order(distributions.value_frequencies(doubles, ["v"], ["g"]), "g", "value")
        assert counted.select(ordering.RANGE).distinct().count() == 7
        found = ordering.quantiles(counted, shares, ["g"])
        got = {r[0]: tuple(r[1:]) for r in found.collect()}
        assert "percentile" not in plan_of(found).lower()
        whole = ordering.quantiles(ordering.in_order(distributions.value_frequencies(doubles, ["v"]), "value"), shares).first()
    assert got == expected and set(got) == {"a", "b", "c", None, "one", "two"}
    assert tuple(whole) == tuple(doubles.agg(*[F.percentile("v", F.lit(s)) for s in shares.values()]).first())


def test_quantiles_read_few_ranges(spark, doubles):
    with many_ranges(spark, 8):
        counted = ordering.in_order(distributions.value_frequencies(doubles, ["v"]), "value")
        plan = plan_of(ordering.quantiles(counted, {"mid": 0.5}))
    assert "_range" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_nan_is_the_largest_value(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, float("nan"))], "v double")
    row = ordering.quantiles(ordering.in_order(distributions.value_frequencies(df, ["v"]), "value"), {"mid": 0.5, "most": 1.0}).first()
    assert row.mid == 2.0 and math.isnan(row.most)


def test_describe_and_boxes_with_a_missing_group(spark, doubles):
    with many_ranges(spark):
        rows = {(r.g, r.metric): r for r in distributions.describe(doubles, ["v", "w"], ["g"], digits=6).collect()}
        medians = {r.g: (r.median_v, r.median_w) for r in distributions.medians(doubles, ["v", "w"], ["g"]).collect()}
        boxes = distributions.box_summary(doubles.where("v is not null"), "v", "g").collect()
    assert (rows["one", "v"].q25, rows["one", "v"].std, rows["one", "v"]["count"]) == (4.5, None, 1)
    assert ("one", "w") not in rows and (None, "v") in rows and ("none", "v") not in rows
    assert (rows["two", "w"].q25, rows["two", "w"].q75) == (4.5, 7.5)
    assert medians["two"] == (1.5, 6.0) and medians["one"] == (4.5, None)
    assert {b.g for b in boxes} == {"a", "b", "c", "one", "two"}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "g string, v double")
    assert distributions.describe(none, ["v"], ["g"]).collect() == []
    assert tuple(distributions.iqr_bounds(none, "v").first()) == (None,) * 4
    assert distributions.outlier_rows(none, "v").collect() == []
    assert distributions.outlier_summary(none, "v").first().q1 is None
    assert labels.label_frequency(none, "g").collect() == [] and labels.pareto(none, "g").collect() == []


def test_running_sums_and_positions(spark):
    rng = random.Random(2)
    rows = [(k, rng.randint(-5, 20)) for k in rng.sample(range(10**6), 3000)]
    with many_ranges(spark):
        ordered = ordering.in_order(spark.createDataFrame(rows, "k long, n long"), F.desc("k"))
        summed = ordering.running_sums(ordered, {"n": F.col("n")})
        placed = ordering.numbered(ordered, "position")
        assert all("_here" in line for line in plan_of(placed).splitlines() if "Window [" in line)
        got = {r.k: (r.n_upto, r.n_total) for r in summed.collect()}
        places = {r.k: r.position for r in placed.collect()}
    upto, total = 0, sum(n for _, n in rows)
    for position, (k, n) in enumerate(sorted(rows, reverse=True), 1):
        upto += n
        assert got[k] == (upto, total) and places[k] == position


def test_frequency_of_many_labels(spark):
    rng = random.Random(3)
    rows = [(f"label {min(int(rng.paretovariate(0.6)), 5000)}",) for _ in range(20_000)] + [(None,)]
    with many_ranges(spark):
        df = spark.createDataFrame(rows, "label string")
        frequency, pareto = labels.label_frequency(df, "label"), labels.pareto(df, "label")
        for found in (frequency, pareto):  # what one task sums is a range, or one row for each range
            windows = [line for line in plan_of(found).splitlines() if "Window [" in line]
            assert windows and all("_range" in line or "_here" in line for line in windows)
        frequency, pareto = frequency.collect(), pareto.collect()
    counts = {}
    for (label,) in rows[:-1]:
        counts[label] = counts.get(label, 0) + 1
    upto = hundredths = 0
    by_label, shares = {r.label: r for r in frequency}, {r.label: r for r in pareto}
    for position, (label, n) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0])), 1):
        upto += n
        hundredths += round(n / 20_000 * 100.0 * 100.0)
        assert by_label[label].n == n and by_label[label].cumulative_pct == pytest.approx(hundredths / 100)
        assert shares[label].position == position and shares[label].cumulative_pct == upto / 20_000 * 100.0


def test_quotas_do_not_depend_on_the_ranges(spark):
    rng = random.Random(4)
    counts = [(f"l{k:03}", rng.randint(2, 90)) for k in range(200)]
    df = spark.createDataFrame(counts, "label string, n long")
    plain = sorted(map(tuple, splitting.split_quotas(df, "label", 0.15, 0.15).collect()))
    with many_ranges(spark):
        assert sorted(map(tuple, splitting.split_quotas(df, "label", 0.15, 0.15).collect())) == plain
    assert sum(r[2] for r in plain) == math.ceil(0.15 * sum(n for _, n in counts))
