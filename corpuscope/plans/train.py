"""Train-ready table to a stored model and its metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from corpuscope.operators import metrics
from corpuscope.operators.classifier import BaselineModel, fit_baseline
from corpuscope.operators.cleaning import KEY
from corpuscope.operators.schema import require_columns
from corpuscope.operators.splitting import select_split
from corpuscope.sources.tables import write_metrics
from corpuscope.staging import measured


@dataclass(frozen=True)
class TrainingRun:
    """A fitted model and its counts on the scored split, ``(truth, prediction, n)``."""

    model: BaselineModel
    counts: DataFrame

    @property
    def report(self) -> DataFrame:
        return metrics.classification_report(self.counts)


def evaluate(model: BaselineModel, df: DataFrame, key: str = KEY) -> DataFrame:
    """``(truth, prediction, n)`` counts of a model on labelled rows: one row per pair of labels."""
    return measured(metrics.confusion(model.predict(df, ["label"], "text", key)))


def train_baseline(
    train_ready: DataFrame,
    model_path: str,
    metrics_path: str,
    max_features: int = 20_000,
    ngram_range: tuple[int, int] = (1, 2),
    score_split: str = "val",
    key: str = KEY,
    **options,
) -> TrainingRun:
    """Fit on the train rows, score another split, store the model and the metrics record."""
    require_columns(train_ready, {"text", "label", "split"}, "Train-ready dataset")
    train, held_out = select_split(train_ready, "train"), select_split(train_ready, score_split)
    for name, rows in (("train", train), (score_split, held_out)):
        if rows.isEmpty():
            raise ValueError(f"the {name} side has no rows")
    model = fit_baseline(train, max_features, ngram_range, key=key, **options)
    counts = evaluate(model, held_out, key)
    model.save(model_path)
    write_metrics(metrics.record_of(counts), metrics_path)
    return TrainingRun(model, counts)
