"""Classification metrics, all from the small table of (truth, prediction) counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, truth: str = "label", predicted: str = "prediction") -> DataFrame:
    """``(truth, prediction, n)``."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def label_scores(counts: DataFrame) -> DataFrame:
    """``(label, precision, recall, f1, support, hits)`` over true and predicted labels.

    Each confusion cell is read once as its true label and once as its predicted one, so
    the union of both label sets needs no join. Undefined ratios are 0.
    """
    hit = F.when(F.col("truth") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = counts.select(F.explode(F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("predicted"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("label"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hits")),
    )).alias("side")).select("side.*")
    totals = sides.groupBy("label").agg(
        *[F.sum(name).alias(name) for name in ("support", "predicted", "hits")]
    )
    return totals.select(
        "label",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
        "support", "hits",
    )


def macro_f1(counts: DataFrame) -> DataFrame:
    return label_scores(counts).agg(F.avg("f1").alias("macro_f1"))


def classification_report(counts: DataFrame) -> DataFrame:
    """Per-label rows, then accuracy (in the f1 column), macro and weighted averages."""
    scores = label_scores(counts)
    names = ("precision", "recall", "f1")
    totals = scores.agg(
        F.sum("support").alias("support"), F.sum("hits").alias("hits"),
        *[F.avg(name).alias(f"macro_{name}") for name in names],
        *[_ratio(F.sum(F.col(name) * F.col("support")), F.sum("support")).alias(f"weighted_{name}") for name in names],
    )
    none = F.lit(None).cast("double")
    averages = totals.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("label"), none.alias("precision"), none.alias("recall"),
                 _ratio(F.col("hits"), F.col("support")).alias("f1"), F.col("support")),
        *[
            F.struct(F.lit(f"{kind} avg").alias("label"), *[F.col(f"{kind}_{name}").alias(name) for name in names],
                     F.col("support"))
            for kind in ("macro", "weighted")
        ],
    )).alias("row")).select("row.*")
    return scores.select("label", *names, "support").unionByName(averages)


def record_of(counts: DataFrame) -> DataFrame:
    """One row: ``macro_f1``, sorted true ``labels``, ``validation_rows``."""
    score = macro_f1(counts).scalar()
    return counts.agg(
        F.sort_array(F.collect_set("truth")).alias("labels"), F.sum("n").alias("validation_rows")
    ).select(score.alias("macro_f1"), "labels", "validation_rows")


def metrics_record(df: DataFrame, truth: str = "label", predicted: str = "prediction") -> DataFrame:
    return record_of(confusion(df, truth, predicted))
