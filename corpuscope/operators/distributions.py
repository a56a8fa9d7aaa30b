"""Describe, quantiles, outliers, histograms and box plots of numeric columns.

Everything but the row filter works on a frequency table ``(group, metric, value, n)``.
It is built by one aggregation spread over all values, and is as long as the number of
distinct values, not of documents. For quantiles it is stored in order of value, cut into
ranges, and read again only where a wanted rank lies (:mod:`corpuscope.operators.ordering`), so a metric
of arbitrary doubles spreads like any other. What takes quantiles runs these jobs when called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscope.functions.numeric import percent, round_even
from corpuscope.operators import ordering
from corpuscope.staging import measured

WHISKER = 1.5


def value_frequencies(df: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., metric, value, n)`` over the non-NULL values of the metric columns."""
    doubles = df.select(*by, *[F.col(name).cast("double").alias(name) for name in metrics])
    long = doubles.unpivot(list(by), list(metrics), "metric", "value")
    return long.where(F.col("value").isNotNull()).groupBy(*by, "metric", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe(df: DataFrame, metrics: Sequence[str], by: Sequence[str] = (), digits: int = 1) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles, max; one row per metric (and group).

    The deviation is summed about the mean in a second pass over the frequencies, which are computed once (a job).
    """
    value, n = F.col("value"), F.col("n").cast("double")
    keys = [*by, "metric"]
    frequencies = ordering.in_order(value_frequencies(df, metrics, by), *keys, "value")
    means = frequencies.groupBy(*keys).agg((F.sum(value * n) / F.sum(n)).alias("_mean"))
    centred = frequencies.join(ordering.prefixed(means, keys), ordering.same(keys)).withColumn("_off", value - F.col("_mean"))
    stats = centred.groupBy(*keys, "_mean").agg(
        F.sum("n").alias("count"),
        F.sum(F.col("_off") * F.col("_off") * n).alias("_s2"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = ordering.quantiles(frequencies, QUARTILES, keys)
    stats = stats.join(ordering.prefixed(quartiles, keys), ordering.same(keys))
    count = F.col("count").cast("double")
    std = F.when(count > 1, F.sqrt(F.col("_s2") / (count - 1)))
    ordered = {"mean": F.col("_mean"), "std": std}
    ordered |= {name: F.col(name) for name in ("min", *QUARTILES, "max")}
    return stats.select(
        *by, "metric", "count",
        *[round_even(expr, digits).alias(name) for name, expr in ordered.items()],
    )


def medians(df: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact median of each metric per group, as one column ``median_<metric>`` each."""
    keys = [*by, "metric"]
    long = ordering.quantiles(ordering.in_order(value_frequencies(df, metrics, by), *keys, "value"), {"median": 0.5}, keys)
    return long.groupBy(*by).agg(
        *[F.max(F.when(F.col("metric") == name, F.col("median"))).alias(f"median_{name}") for name in metrics]
    )


def iqr_bounds(df: DataFrame, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles and the bounds 1.5 interquartile ranges outside them."""
    return _bounds(ordering.in_order(value_frequencies(df, [metric], by), *by, "value"), by)


def _bounds(frequencies: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    quartiles = ordering.quantiles(frequencies, {"q1": 0.25, "q3": 0.75}, by)
    reach = WHISKER * (F.col("q3") - F.col("q1"))
    return quartiles.select(
        *by, "q1", "q3", (F.col("q1") - reach).alias("lower_bound"), (F.col("q3") + reach).alias("upper_bound")
    )


def _one_row(df: DataFrame) -> Column:
    """A one-row frame as a struct that other frames can read (a scalar subquery)."""
    return df.select(F.struct(*df.columns).alias("row")).scalar()


def outlier_rows(df: DataFrame, metric: str) -> DataFrame:
    """Rows strictly outside the bounds of the whole column."""
    bounds = _one_row(iqr_bounds(df, metric))
    return df.where((F.col(metric) < bounds["lower_bound"]) | (F.col(metric) > bounds["upper_bound"]))


def outlier_summary(df: DataFrame, metric: str) -> DataFrame:
    """One row: bounds, number and percent of outliers, how many are short and long."""
    frequencies = ordering.in_order(value_frequencies(df, [metric]), "value")
    counted = frequencies.select("value", "n", _one_row(_bounds(frequencies)).alias("b"))
    short = F.col("value") < F.col("b.lower_bound")
    long = F.col("value") > F.col("b.upper_bound")
    totals = counted.agg(
        *[F.max(f"b.{name}").alias(name) for name in ("q1", "q3", "lower_bound", "upper_bound")],
        F.sum("n").alias("n_rows"),
        F.sum(F.when(short | long, F.col("n")).otherwise(0)).alias("outliers"),
        F.sum(F.when(short, F.col("n")).otherwise(0)).alias("short"),
        F.sum(F.when(long, F.col("n")).otherwise(0)).alias("long"),
    )
    return totals.select(
        "q1", "q3", "lower_bound", "upper_bound", "n_rows", "outliers",
        round_even(percent(F.col("outliers"), F.col("n_rows")), 1).alias("outlier_pct"), "short", "long",
    )


def histogram(df: DataFrame, metrics: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width bins between each metric's min and max, empty bins included.

    Bins are closed on the left; the last also on the right. A constant column falls in
    the middle bin of a unit-wide range around its value.
    """
    frequencies = measured(value_frequencies(df, metrics))
    ends = frequencies.groupBy("metric").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    constant = F.col("low") == F.col("high")
    ends = ends.select(
        "metric",
        F.when(constant, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(constant, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )
    width = F.col("high") - F.col("low")
    position = F.floor((F.col("value") - F.col("low")) * float(bins) / width) + 1
    # One row per metric column: the frame of ends is never larger than the metric list.
    placed = frequencies.join(F.broadcast(ends), "metric").groupBy(
        "metric", F.least(position, F.lit(bins)).alias("bin")
    ).agg(F.sum("n").alias("n"))
    grid = ends.select("metric", "low", width.alias("width"), F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return grid.select("metric", F.col("bin").cast("long").alias("bin"), "low", "width").join(
        placed, ["metric", "bin"], "left"
    ).select(
        "metric", "bin",
        (F.col("low") + (F.col("bin") - 1) * F.col("width") / float(bins)).alias("bin_low"),
        (F.col("low") + F.col("bin") * F.col("width") / float(bins)).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_summary(df: DataFrame, metric: str, by: str) -> DataFrame:
    """Per group: quartiles, whiskers at the furthest inliers, outlier count.

    Whiskers reach no further in than the quartiles. Ordered by falling median.
    """
    frequencies = ordering.in_order(value_frequencies(df.where(F.col(by).isNotNull()), [metric], [by]), by, "value")
    quartiles = ordering.quantiles(frequencies, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by])
    reach = WHISKER * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        frequencies.join(quartiles, by)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.sum("n").alias("n_rows"),
            F.least(F.min(F.when(inside, F.col("value"))), F.col("q1")).alias("whisker_low"),
            F.greatest(F.max(F.when(inside, F.col("value"))), F.col("q3")).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        )
        .orderBy(F.desc("median"), F.asc(by))
    )
