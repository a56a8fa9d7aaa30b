"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + sum_(i<j) <v_i, v_j> x_i x_j). The pairwise part takes linear time: for each factor
it is half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2.

A text's features are its words' hash buckets (square roots of counts, scaled to length 1), measures of its structure,
the declared length, and the interval each measure falls in. The machine is fitted on at most ``max_rows`` labelled
texts, those with the smallest hashes of ``doc_id`` outside the held-out fold, and at most ``max_features`` non-zero features of
these, in the same order; it then scores all rows where they are.

Defined cases: a NULL or empty text has no words and all measures zero, and is scored by what is left. A missing
declared length counts as 0. Labels other than 0 and 1, and labels without a text row, are not used. Without labels
of both classes every text gets the same score, (ones + 1) / (labels + 2). Repeated rows are scored alike, and rows of one
document with equal features are learnt once.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import Scratch, as_bytes, bounded_batches, packed

WORD_BUCKETS = 1 << 14
FACTORS = 8
MAX_ROWS = 8000
MAX_FEATURES = 1 << 25  # 12 bytes each
FOLDS = 5
INTERVALS = 10
CUT = 0.3

MEASURES = (
    "chars", "words", "word_length", "longest_word", "upper", "digits", "stops", "symbols", "bars", "marks", "spaces",
    "line_length", "distinct_words", "top_word", "same_beside", "distinct_lines", "ended", "declared", "gap", "empty",
)
FIRST_MEASURE = WORD_BUCKETS
FIRST_INTERVAL = FIRST_MEASURE + len(MEASURES)
SIZE = FIRST_INTERVAL + len(MEASURES) * INTERVALS

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_UPPER, _LOWER, _DIGIT, _STOP, _SYMBOL, _BAR, _MARK, _SPACE, _TAIL = range(9)


def _kind(b: int) -> int:
    """Class of a byte; continuation bytes of UTF-8 are a class of their own."""
    c = chr(b)
    if 0x80 <= b < 0xC0:
        return _TAIL
    if b >= 0xC0 or c.islower():
        return _LOWER
    for kind, chars in ((_STOP, ".,;:?'\"()-"), (_BAR, "|"), (_MARK, "!")):
        if c in chars:
            return kind
    return _UPPER if c.isupper() else _DIGIT if c.isdigit() else _SPACE if c.isspace() else _SYMBOL


_KINDS = np.array([_kind(b) for b in range(256)], dtype=np.uint8)


class _Buckets(dict):
    """Hash bucket by word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        bucket = self[word] = zlib.crc32(word) % WORD_BUCKETS
        return bucket


_buckets = _Buckets()


def features(text: bytes | None, declared: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the non-zero features."""
    text = text or b""
    words = text.translate(_FOLD).split()
    counts = np.bincount(_KINDS[np.frombuffer(text, dtype=np.uint8)], minlength=9)
    chars = int(counts.sum() - counts[_TAIL])
    n = len(words)
    measures = np.zeros(len(MEASURES))
    if n:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
        ids = np.fromiter(map(_buckets.__getitem__, words), dtype=np.int64, count=n)
        tf = np.bincount(ids, minlength=WORD_BUCKETS)
        at = np.flatnonzero(tf)
        values = np.sqrt(tf[at])
        values /= np.sqrt(tf.sum())
        lines = text.split(b"\n")
        share = lambda kind: counts[kind] / chars
        measures[:-1] = (
            np.log1p(chars) / 12, np.log1p(n) / 10, min(lengths.mean() / 15, 1), np.log1p(lengths.max()) / 8,
            share(_UPPER), share(_DIGIT), min(4 * share(_STOP), 1), min(4 * share(_SYMBOL), 1), min(8 * share(_BAR), 1),
            min(4 * share(_MARK), 1), share(_SPACE), np.log1p(chars / len(lines)) / 12,
            len(set(words)) / n, tf.max() / n, float(np.mean(ids[1:] == ids[:-1])) if n > 1 else 0.0,
            len(set(lines)) / len(lines), sum(w[-1:] in (b".", b"!", b"?") for w in words) / n,
            np.log1p(max(declared or 0, 0)) / 12, min(abs((declared or 0) - chars) / chars, 1),
        )
    else:
        at, values = np.zeros(0, dtype=np.int64), np.zeros(0)
        measures[-3] = np.log1p(max(declared or 0, 0)) / 12
        measures[-1] = 1.0
    place = np.minimum((measures * INTERVALS).astype(np.int64), INTERVALS - 1) + np.arange(len(MEASURES)) * INTERVALS
    here = np.flatnonzero(measures)
    return (
        np.concatenate([at, FIRST_MEASURE + here, FIRST_INTERVAL + place]),
        np.concatenate([values, measures[here], np.full(len(place), 0.25)]),
    )


@dataclass
class Machine:
    bias: float
    linear: np.ndarray  # SIZE
    factors: np.ndarray  # SIZE x FACTORS

    def margins(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and the factor sums, of rows that begin at ``starts`` (none is empty)."""
        weighted = self.factors[index] * value[:, None]
        sums = np.add.reduceat(weighted, starts)
        squares = np.add.reduceat(weighted * weighted, starts)
        return self.bias + np.add.reduceat(self.linear[index] * value, starts) + 0.5 * (sums**2 - squares).sum(axis=1), sums

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        margin, _ = self.margins(index, value, np.zeros(1, dtype=np.int64))
        return float(1 / (1 + np.exp(-np.clip(margin[0], -30, 30))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], *, epochs: int = 12, rate: float = 0.02, decay: float = 1e-4, seed: int = 1) -> Machine:
    """Logistic loss, minimised with Adam over batches of 128 rows; the same rows give the same machine."""
    labels = np.array([y for _, _, y in rows], dtype=float)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Machine(float(np.log(share / (1 - share))), np.zeros(SIZE), np.zeros((SIZE, FACTORS)))
    rng = np.random.default_rng(seed)
    mean = labels.mean()
    machine = Machine(float(np.log(mean / (1 - mean))), np.zeros(SIZE), rng.normal(0, 0.05, (SIZE, FACTORS)))
    table = np.hstack([machine.linear[:, None], machine.factors])
    first, second = np.zeros_like(table), np.zeros_like(table)
    bias_first = bias_second = 0.0
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 128):
            chosen = order[at:at + 128]
            sizes = np.array([len(rows[k][0]) for k in chosen])
            starts = np.cumsum(sizes) - sizes
            index = np.concatenate([rows[k][0] for k in chosen])
            value = np.concatenate([rows[k][1] for k in chosen])
            machine.linear, machine.factors = table[:, 0], table[:, 1:]
            margin, sums = machine.margins(index, value, starts)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]) / len(chosen)
            each = np.repeat(error, sizes) * value
            by_factor = each[:, None] * (np.repeat(sums, sizes, axis=0) - machine.factors[index] * value[:, None])
            slope = np.stack(
                [np.bincount(index, each, SIZE)] + [np.bincount(index, by_factor[:, f], SIZE) for f in range(FACTORS)], axis=1
            ) + decay * table
            step += 1
            first = 0.9 * first + 0.1 * slope
            second = 0.999 * second + 0.001 * slope**2
            table -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            bias_first = 0.9 * bias_first + 0.1 * error.sum()
            bias_second = 0.999 * bias_second + 0.001 * error.sum() ** 2
            machine.bias -= rate * (bias_first / (1 - 0.9**step)) / (np.sqrt(bias_second / (1 - 0.999**step)) + 1e-8)
    machine.linear, machine.factors = table[:, 0].copy(), table[:, 1:].copy()
    return machine


def held_out(key: Column) -> Column:
    """One of ``FOLDS`` folds, by the checksum of the key as text; a NULL key is in none."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(
    documents: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", declared: str = "n_chars",
    label: str = "quality", max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES,
) -> Machine:
    """Fit on at most ``max_rows`` labelled rows with at most ``max_features`` features in all; runs jobs.

    The chosen labels (at most ``max_rows`` short rows) are sent to the texts. Features are made where the texts are and
    stored; their sizes tell which come to the driver, however often a key or a row repeats.
    """
    usable = labels.select(F.col(key).cast("long").alias("labelled"), F.col(label).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("labelled").isNotNull()
    )
    usable = usable.filter(~held_out(F.col("labelled"))).orderBy(F.xxhash64("labelled"), "labelled", "label").limit(max_rows)
    chosen = documents.sparkSession.createDataFrame(usable.collect(), "labelled long, label int")

    def run(batches):
        for batch in batches:
            made = [features(t, n) for t, n in zip(as_bytes(batch.column("text")), batch.column("declared").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("label"), pa.array([i.astype("<i4").tobytes() for i, _ in made], pa.binary()),
                 pa.array([v.astype("<f8").tobytes() for _, v in made], pa.binary())],
                names=["doc", "label", "index", "value"],
            )

    bounded_batches(documents.sparkSession)
    source = documents.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"), F.col(declared).cast("long").alias("declared"))
    source = source.join(F.broadcast(chosen), F.col("doc") == F.col("labelled")).select("doc", "label", "text", "declared")
    scratch = Scratch(documents.sparkSession, "quality")
    made = source.mapInArrow(run, "doc long, label int, index binary, value binary")
    made = scratch.keep(made.withColumn("same", F.xxhash64("index", "value")), "features")
    keys = ["doc", "label", "same"]
    sizes = made.groupBy(*keys).agg(F.max(F.length("index") / 4).cast("long").alias("size"))
    first = sizes.orderBy(F.xxhash64("doc"), *keys).limit(max_rows).collect()
    upto = np.cumsum([r["size"] for r in first])
    within = [(r["doc"], r["label"], r["same"]) for r, n in zip(first, upto) if n <= max_features]
    picked = documents.sparkSession.createDataFrame(within, "doc long, label int, same long")
    once = made.join(F.broadcast(picked), keys).groupBy(*keys).agg(F.min(F.struct("index", "value")).alias("features"))
    rows = once.select("doc", "label", "features.*").collect()
    scratch.drop()
    rows.sort(key=lambda r: (r["doc"], r["label"], r["index"], r["value"]))
    return train([(np.frombuffer(r["index"], "<i4"), np.frombuffer(r["value"], "<f8"), r["label"]) for r in rows])


def score(documents: DataFrame, machine: Machine, *, text: str = "text", declared: str = "n_chars") -> DataFrame:
    """``row`` (the whole row) and ``score``, from 0 to 1."""
    shared = documents.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        own: Machine = shared.value
        for batch in batches:
            row = batch.column("row")
            scores = [own.score(*features(t, n)) for t, n in zip(as_bytes(row.field(text)), row.field(declared).to_pylist())]
            yield pa.RecordBatch.from_arrays([row, pa.array(scores, pa.float64())], names=["row", "score"])

    source = packed(documents)
    return source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, score double")
