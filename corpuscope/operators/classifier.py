"""Baseline classifier: sub-linear TF-IDF and one-vs-rest logistic regression.

The objective is 1/2 |w|^2 + C * sum(weight * loss), with the intercept inside the
penalty: it is a feature of constant value 1. All labels are fitted together (:mod:`corpuscope.operators.logistic`),
so the passes over the training rows do not grow with the labels.

Terms are counted in the row, and looked up there where the vocabulary is small enough to be sent to every task: a document then moves
once, and its terms never. Prediction needs no vector and no Python: it joins terms with their coefficients and sums per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpuscope.functions.stopwords import ENGLISH
from corpuscope.operators import counting, dictionary, logistic
from corpuscope.operators.batches import bounded_batches, bounded_slices
from corpuscope.operators.cleaning import KEY
from corpuscope.operators.labels import class_weights
from corpuscope.operators.terms import counted_terms, token_table, vocabulary, with_terms
from corpuscope.staging import measured, stage

INTERCEPT = ""  # no token is empty
SENT = 4_000_000  # numbers of a table of terms that is sent to every task: 32 MB
VECTOR = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"  # how a vector is stored


@dataclass(frozen=True)
class TextFeatures:
    """A fitted vocabulary: ``(term, idf, index)``, at most ``max_features`` rows and the intercept, which is last."""

    terms: DataFrame
    size: int
    ngram_range: tuple[int, int]
    stop_words: tuple[str, ...]

    @classmethod
    def fit(
        cls, train: DataFrame, max_features: int = 20_000, ngram_range: tuple[int, int] = (1, 2),
        stop_words: Sequence[str] = ENGLISH, text: str = "text",
    ) -> TextFeatures:
        """Runs the job that counts the vocabulary."""
        vocab = vocabulary(train, text, ngram_range, max_features=max_features, stop_words=stop_words)
        by_term = F.row_number().over(Window.orderBy("term")) - 1  # a window over max_features rows
        terms = measured(vocab.select("term", "idf", by_term.alias("index")))
        size = terms.count()
        intercept = train.sparkSession.createDataFrame([(INTERCEPT, 1.0, size)], terms.schema)
        return cls(measured(terms.unionByName(intercept)), size + 1, tuple(ngram_range), tuple(stop_words))

    def values(self, df: DataFrame, terms: DataFrame, keep: Sequence[str], text: str, key: str, native: bool = False) -> DataFrame:
        """``(key, keep..., index, value, columns of terms...)`` of each row's known terms, and of the intercept;
        values are not yet divided by the row's norm."""
        counted = counted_terms(df.select(key, *keep, text), text, [key, *keep], self.ngram_range, self.stop_words, (INTERCEPT,), native)
        known = counted.join(terms, "term")
        return known.withColumn("value", (1.0 + F.log(F.col("tf").cast("double"))) * F.col("idf"))

    def folded(
        self, df: DataFrame, terms: DataFrame, numbers: Callable[[pa.Table], np.ndarray], keep: Sequence[str], text: str, key: str,
        fold: Callable[..., pa.RecordBatch], columns: str,
    ) -> DataFrame:
        """``(key, keep..., columns...)`` of each row, which ``fold`` makes of its known terms and the intercept; runs the job that reads ``terms``.

        ``fold`` is given, for a slice of rows, the number of rows, then by term its row, place and undivided value, and ``numbers`` of the
        terms; places are those of the terms and in order in a row. Rows of NULL tokens are left out.
        """
        spark = df.sparkSession
        bounded_batches(spark)
        table = terms.toArrow().sort_by("index")
        index = table.column("index").to_numpy().astype(np.int32)
        sent = spark.sparkContext.broadcast((table.column("term").combine_chunks(), table.column("idf").to_numpy(), index, numbers(table)))
        low, high = self.ngram_range
        found = with_terms(df, text, [key, *keep], (1, 1), self.stop_words)
        source = found.select(F.struct(key, *keep).alias("row"), "terms").where(F.col("terms").isNotNull())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, idf, index, own = sent.value
            for batch in batches:
                first = 0
                for part in bounded_slices(batch.column("terms"), counting.WORDS):
                    row, code, names, counts = counting.row_codes(part, low, high, (INTERCEPT,))
                    place = pc.index_in(names.cast(known.type), known).fill_null(-1).to_numpy(zero_copy_only=False)[code]
                    row, place, counts = row[place >= 0], place[place >= 0], counts[place >= 0]
                    order = np.lexsort((place, row))
                    row, place, counts = row[order], place[order], counts[order]
                    made = fold(len(part), row, place, index, (1.0 + np.log(counts)) * idf[place], own)
                    rows = batch.column("row").slice(first, len(part))
                    yield pa.RecordBatch.from_arrays([rows, *made.columns], names=["row", *made.schema.names])
                    first += len(part)

        schema = StructType().add("row", source.schema["row"].dataType)
        for field in StructType.fromDDL(columns):
            schema = schema.add(field)
        return source.mapInArrow(run, schema).select("row.*", *StructType.fromDDL(columns).names)

    def transform(self, df: DataFrame, keep: Sequence[str] = (), text: str = "text", key: str = KEY) -> DataFrame:
        """``(key, keep..., features)`` with the vector as a struct; every row gets one, also without known terms. Rows that share
        key and ``keep`` share a vector."""
        if self.size <= SENT and not dictionary.holds_ids(df, text):
            return self._transformed(df, keep, text, key)
        is_term = F.col("index") < self.size - 1
        folded = self.values(df, self.terms, keep, text, key).groupBy(key, *keep).agg(
            F.sort_array(F.collect_list(F.struct("index", "value"))).alias("cells"),
            F.sqrt(F.sum(F.when(is_term, F.col("value") * F.col("value")))).alias("norm"),
        )
        values = F.transform(
            "cells", lambda c: F.when(c["index"] == self.size - 1, F.lit(1.0)).otherwise(c["value"] / F.col("norm"))
        )
        return folded.select(key, *keep, vector(self.size, F.col("cells.index"), values).alias("features"))

    def _transformed(self, df: DataFrame, keep: Sequence[str], text: str, key: str) -> DataFrame:
        last = self.size - 1

        def fold(rows: int, row, place, index, value, _) -> pa.RecordBatch:
            is_term = index[place] < last
            squares = np.bincount(row, np.where(is_term, value * value, 0.0), rows)
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]), pa.int32())
            values = np.where(is_term, value / np.sqrt(np.where(squares > 0, squares, 1.0))[row], 1.0)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (index[place], values)]
            return pa.RecordBatch.from_arrays([*lists, pa.array(squares)], names=["indices", "values", "squares"])

        single = self.folded(df, self.terms, lambda _: np.zeros(0), keep, text, key, fold, "indices array<int>, values array<double>, squares double")
        parts = single.groupBy(key, *keep).agg(F.collect_list(F.struct("indices", "values", "squares")).alias("parts"))
        norm = F.sqrt(F.aggregate("parts", F.lit(0.0), lambda total, p: total + p["squares"]))
        cells = F.array_sort(F.flatten(F.transform("parts", lambda p: F.transform(
            F.arrays_zip(p["indices"].alias("index"), p["values"].alias("value")),
            lambda c: F.struct(c["index"].alias("index"), F.when(c["index"] == last, F.lit(1.0)).otherwise(c["value"] * F.sqrt(p["squares"]) / norm).alias("value")),
        ))))
        one, first = F.size("parts") == 1, F.col("parts")[0]
        indices = F.when(one, first["indices"]).otherwise(F.transform(cells, lambda c: c["index"]))
        values = F.when(one, first["values"]).otherwise(F.transform(cells, lambda c: c["value"]))
        return parts.select(key, *keep, vector(self.size, indices, values).alias("features"))


def vector(size: int, indices, values):
    """A sparse vector's stored form."""
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values")
    ).cast(VECTOR)


@dataclass(frozen=True)
class BaselineModel:
    """Vocabulary, labels in order, and ``(term, idf, index, weights)``: a term's coefficient for each binary model."""

    features: TextFeatures
    labels: list[str]
    coefficients: DataFrame

    def margins(self, df: DataFrame, keep: Sequence[str] = (), text: str = "text", key: str = KEY) -> DataFrame:
        """``(key, keep..., margins)``: decision value per label; of two labels only the second has a model of its own.

        Runs the job that reads the coefficients, if they are few enough to be sent to every task."""
        models = 1 if len(self.labels) == 2 else len(self.labels)
        if self.features.size * models > SENT or dictionary.holds_ids(df, text):
            return self._joined_margins(df, keep, text, key)
        last = self.features.size - 1

        def numbers(table: pa.Table) -> np.ndarray:
            return np.array(table.column("weights").to_pylist(), dtype=float).reshape(len(table), -1)

        def fold(rows: int, row, place, index, value, weights) -> pa.RecordBatch:
            is_term = index[place] < last
            sums = lambda chosen, numbers: np.bincount(row, np.where(chosen, numbers, 0.0), rows)
            cells = [sums(chosen, value * weights[place, i]) for chosen in (is_term, ~is_term) for i in range(models)]
            names = [f"{kind}_{i}" for kind in ("terms", "constant") for i in range(models)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (sums(is_term, value * value), *cells)], names=["squares", *names])

        names = [f"{kind}_{i}" for kind in ("terms", "constant") for i in range(models)]
        columns = ", ".join(f"{name} double" for name in ("squares", *names))
        single = self.features.folded(df, self.coefficients, numbers, keep, text, key, fold, columns)
        sums = single.groupBy(key, *keep).agg(F.sqrt(F.sum("squares")).alias("norm"), *[F.sum(name).alias(name) for name in names])
        return self._scaled(sums, models, keep, key)

    def _joined_margins(self, df: DataFrame, keep: Sequence[str], text: str, key: str) -> DataFrame:
        """:meth:`margins` by a join, without Python and with coefficients of any number."""
        models = 1 if len(self.labels) == 2 else len(self.labels)
        is_term = F.col("index") < self.features.size - 1
        value, term_value = F.col("value"), F.when(is_term, F.col("value")).otherwise(0.0)
        sums = self.features.values(df, self.coefficients, keep, text, key, native=True).groupBy(key, *keep).agg(
            F.sqrt(F.sum(term_value * term_value)).alias("norm"),
            *[F.sum(term_value * F.col("weights")[i]).alias(f"terms_{i}") for i in range(models)],
            *[F.sum(F.when(~is_term, value * F.col("weights")[i])).alias(f"constant_{i}") for i in range(models)],
        )
        return self._scaled(sums, models, keep, key)

    @staticmethod
    def _scaled(sums: DataFrame, models: int, keep: Sequence[str], key: str) -> DataFrame:
        scaled = [
            F.col(f"constant_{i}") + F.when(F.col("norm") > 0, F.col(f"terms_{i}") / F.col("norm")).otherwise(0.0)
            for i in range(models)
        ]
        return sums.select(key, *keep, F.array(*([-scaled[0], scaled[0]] if models == 1 else scaled)).alias("margins"))

    def predict(self, df: DataFrame, keep: Sequence[str] = (), text: str = "text", key: str = KEY) -> DataFrame:
        """``(key, keep..., prediction)``; equal scores go to the first label."""
        scored = self._joined_margins(df, keep, text, key)
        best = F.array_position("margins", F.array_max("margins")).cast("int")
        names = F.array(*[F.lit(name) for name in self.labels])
        return scored.select(key, *keep, F.element_at(names, best).alias("prediction"))

    def save(self, path: str) -> None:
        self.coefficients.coalesce(1).write.mode("overwrite").parquet(f"{path}/coefficients")
        spark = self.coefficients.sparkSession
        setup = [(self.labels, list(self.features.ngram_range), list(self.features.stop_words), self.features.size)]
        spark.createDataFrame(setup, SETUP).coalesce(1).write.mode("overwrite").json(f"{path}/setup")


SETUP = "labels array<string>, ngram_range array<int>, stop_words array<string>, size int"


def load_model(spark: SparkSession, path: str) -> BaselineModel:
    setup = spark.read.schema(SETUP).json(f"{path}/setup").first()
    coefficients = spark.read.parquet(f"{path}/coefficients")
    features = TextFeatures(
        coefficients.select("term", "idf", "index"), setup.size, tuple(setup.ngram_range), tuple(setup.stop_words)
    )
    return BaselineModel(features, list(setup.labels), coefficients)


def fit_baseline(
    train: DataFrame,
    max_features: int = 20_000,
    ngram_range: tuple[int, int] = (1, 2),
    c: float = 1.0,
    max_iter: int = 1000,
    tol: float = 1e-4,
    stop_words: Sequence[str] = ENGLISH,
    text: str = "text",
    label: str = "label",
    key: str = KEY,
    on_pass: Callable[[int], None] = lambda unfinished: None,
) -> BaselineModel:
    """Fit vocabulary, idf, class weights and one binary model per label on ``train`` only.

    Balanced weights fall on the positive rows of each binary task; with two labels there
    is one task and both sides are weighted. ``on_pass`` is told how many labels each pass over the rows still fits.
    """
    weights = {row[label]: row.weight for row in class_weights(train, label).collect()}
    labels = sorted(weights)
    if len(labels) < 2:
        raise ValueError("The classifier needs at least two labels.")
    tokens = stage(token_table(train, text, label, key, stop_words), "fit-tokens", compression="zstd")  # read by three jobs
    features = TextFeatures.fit(tokens, max_features, ngram_range, (), "tokens")
    vectors = features.transform(tokens.where(F.col(label).isNotNull()), [label], "tokens", key)
    features = replace(features, stop_words=tuple(stop_words))
    chunks = logistic.pack(vectors, F.col("features.indices"), F.col("features.values"), F.col(label), labels)
    tasks = [1] if len(labels) == 2 else list(range(len(labels)))
    positive = [weights[labels[k]] for k in tasks]
    other = [weights[labels[0]]] if len(labels) == 2 else [1.0] * len(tasks)
    found = logistic.fit(chunks, features.size, tasks, positive, other, c, tol, max_iter, on_pass)
    by_index = pa.table({"index": pa.array(range(features.size), pa.int32()), "weights": pa.array(list(found), pa.list_(pa.float64()))})
    table = train.sparkSession.createDataFrame(by_index)
    return BaselineModel(features, labels, measured(features.terms.join(table, "index").select("term", "idf", "index", "weights")))
