"""Label frequency, balance and label-based row selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscope.functions.numeric import percent, round_even
from corpuscope.operators import ordering
from corpuscope.staging import measured


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """``(label, n)``; NULL labels are left out."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def _ranking(label: str) -> list[Column]:
    return [F.desc("n"), F.asc(label)]


def label_frequency(df: DataFrame, label: str) -> DataFrame:
    """Counts with percent and cumulative percent, rounded before they are summed.

    Runs the jobs that count the labels and store them in order, so that no task sums over all labels.
    """
    ranked = ordering.in_order(label_counts(df, label), *_ranking(label))
    total = ranked.agg(F.sum("n")).scalar()
    # Hundredths are whole numbers, which have the same sum in any order.
    hundredths = F.rint(percent(F.col("n"), total) * 100.0).cast("long")
    summed = ordering.running_sums(ranked.withColumn("_pct", hundredths), {"pct": F.col("_pct")})
    return summed.select(
        label, "n", (F.col("_pct") / F.lit(100.0)).alias("pct"), (F.col("pct_upto") / F.lit(100.0)).alias("cumulative_pct")
    )


def pareto(df: DataFrame, label: str, cut: float = 80.0) -> DataFrame:
    """Unrounded cumulative percent by falling count, and whether it reaches ``cut``; runs jobs as :func:`label_frequency`."""
    ranked = ordering.in_order(label_counts(df, label), *_ranking(label))
    summed = ordering.running_sums(ranked, {"n": F.col("n"), "rows": F.lit(1)})
    return summed.select(
        label, "n", F.col("rows_upto").alias("position"), percent(F.col("n_upto"), F.col("n_total")).alias("cumulative_pct"),
    ).withColumn("reaches_cut", F.col("cumulative_pct") >= F.lit(cut))


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """One row: classes, largest and smallest class, their ratio, rows per class, band."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    named = F.when(F.col(label).isNotNull(), F.col("n"))
    falling = F.when(F.col(label).isNotNull(), F.struct((-F.col("n")).alias("key"), F.col(label).alias("name")))
    base = counts.agg(
        F.count(label).alias("n_classes"),
        F.min(falling)["name"].alias("majority_label"),
        F.max(named).alias("majority_n"),
        F.max(falling)["name"].alias("minority_label"),
        F.min(named).alias("minority_n"),
        F.sum(named).alias("labelled"),
        F.sum("n").alias("n_rows"),
    )
    ratio = F.col("majority_n").cast("double") / F.col("minority_n")
    return base.select(
        "n_classes", "majority_label", "majority_n",
        round_even(percent(F.col("majority_n"), F.col("labelled")), 2).alias("majority_pct"),
        "minority_label", "minority_n",
        round_even(percent(F.col("minority_n"), F.col("labelled")), 2).alias("minority_pct"),
        ratio.alias("imbalance_ratio"),
        (F.col("n_rows").cast("double") / F.col("n_classes")).alias("rows_per_class"),
        imbalance_band(ratio).alias("band"),
    )


def imbalance_band(ratio: Column) -> Column:
    """Band of the ratio of the largest to the smallest class: below 5, 5 to 20, above 20."""
    return F.when(ratio < 5, "low").when(ratio <= 20, "medium").otherwise("high")


def thin_labels(df: DataFrame, label: str, below: int = 50) -> DataFrame:
    return label_counts(df, label).where(F.col("n") < below)


def thin_label_totals(df: DataFrame, label: str, thresholds: tuple[int, ...] = (50, 100)) -> DataFrame:
    """One row with the number of labels under each threshold."""
    return label_counts(df, label).agg(
        *[F.count_if(F.col("n") < k).alias(f"labels_below_{k}") for k in thresholds]
    )


def top_share(df: DataFrame, label: str, top: int = 5) -> DataFrame:
    """One row: summed rounded percent of the ``top`` largest labels."""
    largest = label_frequency(df, label).orderBy(*_ranking(label)).limit(top)
    return largest.agg(round_even(F.sum("pct"), 2).alias("top_share_pct"))


def top_labels(df: DataFrame, label: str, top: int) -> DataFrame:
    """The ``top`` largest labels with their counts: at most ``top`` rows."""
    return label_counts(df, label).orderBy(*_ranking(label)).limit(top)


def keep_top_labels(df: DataFrame, label: str, top: int) -> DataFrame:
    """Rows of the ``top`` largest labels. The broadcast side has at most ``top`` rows."""
    return df.join(F.broadcast(top_labels(df, label, top).select(label)), label, "left_semi").select(
        *df.columns
    )


def frequent_labels(df: DataFrame, label: str, min_rows: int) -> DataFrame:
    """Labels with at least ``min_rows`` rows."""
    return label_counts(df, label).where(F.col("n") >= min_rows).select(label)


def keep_frequent_labels(df: DataFrame, label: str, min_rows: int) -> DataFrame:
    """Rows whose label has at least ``min_rows`` rows; nothing else of ``df`` moves.

    The list of labels is computed first (a job), so its measured size picks the join.
    """
    frequent = measured(frequent_labels(df, label, min_rows))
    return df.join(frequent, label, "left_semi").select(*df.columns)


def distinct_labels(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count_distinct(label).alias("n_labels"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights: rows / (labels x rows of the label); runs the job that counts the labels."""
    counts = measured(label_counts(df, label))
    whole = counts.agg(F.struct(F.sum("n").cast("double").alias("rows"), F.count(F.lit(1)).alias("labels"))).scalar()
    return counts.select(label, "n", (whole["rows"] / (whole["labels"] * F.col("n"))).alias("weight"))
