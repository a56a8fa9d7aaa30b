"""Raw notes to stored splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from corpuscope.operators import cleaning, splitting
from corpuscope.operators.schema import require_unique_key
from corpuscope.sources import tables
from corpuscope.staging import stage, staged_work


@dataclass(frozen=True)
class PrepareOptions:
    """Thresholds, shares and column names of the preparing jobs."""

    min_class_samples: int = 50
    min_doc_length: int = 20
    test_size: float = 0.15
    val_size: float = 0.15
    seed: int = 42
    text: str = cleaning.TEXT
    label: str = cleaning.LABEL
    key: str = cleaning.KEY

    @property
    def names(self) -> dict[str, str]:
        return {"text": self.text, "label": self.label, "key": self.key}

    @property
    def cleaning(self) -> dict[str, int]:
        return {"min_class_samples": self.min_class_samples, "min_doc_length": self.min_doc_length}


def prepare_splits(raw: DataFrame, table_path: str, splits_path: str, *, force: bool = False, **options) -> dict[str, str]:
    """Store the raw table if absent, clean it, split it, write one CSV folder per split.

    ``options`` are those of :class:`PrepareOptions`. The key must be unique: a repeated one raises ValueError.
    """
    o = PrepareOptions(**options)
    with staged_work(raw.sparkSession):
        stored = tables.ensure_table(raw, table_path, force)
        require_unique_key(stored, o.key)
        cleaned = stage(cleaning.clean_pair(stored, **o.cleaning, **o.names), "clean")
        assigned = splitting.add_splits(cleaned, o.test_size, o.val_size, o.seed, o.label, o.key)
        return tables.write_split_csv(assigned.drop(o.key), splits_path)


def prepare_csv(spark: SparkSession, csv_path: str, table_path: str, splits_path: str, **options) -> dict[str, str]:
    """From the raw CSV file; its row number is the key."""
    with staged_work(spark):
        raw = tables.keyed_by_row_number(tables.read_notes_csv(spark, csv_path))
        return prepare_splits(raw, table_path, splits_path, **options)


def prepare_train_ready(raw: DataFrame, clean_path: str, train_ready_path: str, **options) -> DataFrame:
    """Clean with duplicates dropped, store, split, store; returns the train-ready table."""
    o, spark = PrepareOptions(**options), raw.sparkSession
    with staged_work(spark):
        cleaned = cleaning.clean_distinct(raw, **o.cleaning, **o.names)
        tables.write_clean(cleaned, clean_path, o.label, o.key)
        ready = splitting.train_ready(tables.read_table(spark, clean_path), o.test_size, o.val_size, o.seed, **o.names)
        tables.write_train_ready(ready, train_ready_path, o.key)
    return tables.read_table(spark, train_ready_path)
