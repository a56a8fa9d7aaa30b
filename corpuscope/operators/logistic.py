"""Logistic regression for many binary tasks at once over the same sparse rows.

Every task minimises 1/2 |w|^2 + C * sum(weight * loss), which is strictly convex. All tasks share the passes over the
rows: a pass takes one trial point of each unfinished task, folds the losses and gradients of all of them in every Spark task, and
adds the blocks up by slices of the terms. So the number of passes is that of the slowest task, not the sum over tasks; a task that
is done drops out of the next pass. Each task steps by its own limited-memory BFGS on the driver.

Rows are packed once into chunks of bounded size and stored; a pass reads chunks, never single rows. The driver holds
the points and histories of one block of tasks, at most ``BLOCK`` coefficients; further tasks form further blocks.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscope.operators.batches import bounded_batches
from corpuscope.staging import stage

BLOCK = 4_000_000  # coefficients of the tasks that share passes: 32 MB for each vector kept
CHUNK = 1 << 17  # cells of a chunk of rows, and about the numbers handled at once for each task
SLICE = 4096  # terms whose gradients are added up together
MEMORY = 8
CHUNKS = "starts binary, cells binary, numbers binary, classes binary"
PARTS = "slice int, part binary"


def pack(rows: DataFrame, indices: Column, values: Column, label: Column, labels: Sequence) -> DataFrame:
    """Stored chunks of rows: row starts, indices and values of their cells, and the place of each row's label."""
    place = {name: k for k, name in enumerate(labels)}

    def run(batches):
        for batch in batches:
            lengths = batch.column("indices").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lengths)
            classes = np.array([place[x] for x in batch.column("label").to_pylist()], dtype=np.int32)
            cells = pc.list_flatten(batch.column("indices")).to_numpy(zero_copy_only=False).astype(np.int32)
            numbers = pc.list_flatten(batch.column("values")).to_numpy(zero_copy_only=False)
            first = 0
            while first < len(lengths):
                before = ends[first] - lengths[first]
                last = max(first + 1, int(np.searchsorted(ends, before + CHUNK, "right")))
                inside = slice(before, ends[last - 1])
                starts = (ends[first:last] - lengths[first:last] - before).astype(np.int32)
                parts = [starts, cells[inside], numbers[inside], classes[first:last]]
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=["starts", "cells", "numbers", "classes"])
                first = last

    bounded_batches(rows.sparkSession)
    source = rows.select(indices.alias("indices"), values.alias("values"), label.alias("label")).where(F.col("label").isNotNull())
    return stage(source.mapInArrow(run, CHUNKS), "logistic-rows")


def fold(chunk: dict[str, np.ndarray], points: np.ndarray, tasks: np.ndarray, positive: np.ndarray, other: np.ndarray):
    """Sum of losses and its gradient at ``points`` (terms x tasks) over a chunk; every row must have a cell."""
    losses, gradient = np.zeros(len(tasks)), np.zeros_like(points)
    starts, cells, numbers, classes = (chunk[k] for k in ("starts", "cells", "numbers", "classes"))
    cells, lengths = cells.astype(np.intp), np.diff(np.append(starts, len(cells)))
    # A task at a time: its point is a plain vector, which stays in the processor's cache.
    for k, task in enumerate(tasks):
        margins = np.add.reduceat(points[:, k].take(cells) * numbers, starts)
        is_label = classes == task
        signed = np.where(is_label, margins, -margins)
        weights = np.where(is_label, positive[k], other[k])
        losses[k] = (weights * np.logaddexp(0, -signed)).sum()
        pull = np.where(is_label, -weights, weights) * np.exp(-np.logaddexp(0, signed))
        gradient[:, k] = np.bincount(cells, numbers * np.repeat(pull, lengths), len(points))
    return losses, gradient


def evaluate(chunks: DataFrame, points: np.ndarray, tasks: np.ndarray, positive: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One pass: losses of the tasks, and gradients as terms x tasks."""
    size, count = points.shape
    shared = chunks.sparkSession.sparkContext.broadcast((points, tasks, positive, other))
    kinds = {"starts": np.int32, "cells": np.int32, "numbers": np.float64, "classes": np.int32}

    def run(batches):
        points, *task = shared.value
        losses, gradient, some = np.zeros(count), np.zeros((size, count)), False
        for batch in batches:
            for k in range(batch.num_rows):
                some = True
                chunk = {name: np.frombuffer(batch.column(name)[k].as_py(), kind) for name, kind in kinds.items()}
                more, steeper = fold(chunk, points, *task)
                losses += more
                gradient += steeper
        if some:
            parts = [losses.tobytes()] + [gradient[at:at + SLICE].tobytes() for at in range(0, size, SLICE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(parts) - 1), pa.int32()), pa.array(parts, pa.binary())], names=["slice", "part"])

    def add(batches):
        totals = {}  # of the task's own slices: together at most a point of each task
        for batch in batches:
            for k, part in zip(batch.column("slice").to_pylist(), batch.column("part")):
                numbers = np.frombuffer(part.as_buffer())
                if k in totals:
                    totals[k] += numbers
                else:
                    totals[k] = numbers.copy()
        for k, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slice", "part"])

    # A chunk is a row of megabytes: batches bounded by bytes, not a task's chunks all at once.
    bounded_batches(chunks.sparkSession)
    summed = chunks.mapInArrow(run, PARTS).repartition("slice").mapInArrow(add, PARTS)
    found = {r.slice: np.frombuffer(r.part) for r in summed.collect()}
    shared.destroy()
    if not found:
        return np.zeros(count), np.zeros((size, count))
    return found[-1], np.concatenate([found[k].reshape(-1, count) for k in range(len(found) - 1)])


class Descent:
    """Limited-memory BFGS of one task: asks for the value at ``trial`` and is told it.

    The objective is strongly convex, so every step has curvature and halving the step until it gains enough is all
    the line search needed. It is done when the largest entry of the gradient is ``tol`` times that at the start, or when rounding hides any gain.
    """

    def __init__(self, size: int, tol: float):
        self.point = self.trial = np.zeros(size)
        self.tol, self.done, self.value, self.enough = tol, False, np.inf, None
        self.gradient = self.direction = np.zeros(size)
        self.length, self.slope = 1.0, 0.0
        self.history: deque[tuple[np.ndarray, np.ndarray, float]] = deque(maxlen=MEMORY)

    def tell(self, value: float, gradient: np.ndarray) -> None:
        if value > self.value + 1e-4 * self.length * self.slope:
            curve = 2 * (value - self.value - self.length * self.slope)
            self.length *= float(np.clip(-self.slope * self.length / curve, 0.1, 0.5))
            trial = self.point + self.length * self.direction
            gain = -self.length * self.slope
            self.done = gain <= 1e-15 * max(1.0, abs(self.value)) or np.array_equal(trial, self.point)
            self.trial = trial
            return
        step, change = self.trial - self.point, gradient - self.gradient
        if np.isfinite(self.value) and step @ change > 0:
            self.history.append((step, change, 1 / (step @ change)))
        self.point, self.value, self.gradient = self.trial, value, gradient
        steepest = np.abs(gradient).max(initial=0.0)
        self.enough = self.tol * steepest if self.enough is None else self.enough
        if steepest <= self.enough:
            self.done = True
            return
        self.direction = -self._scaled(gradient)
        self.slope = float(self.direction @ gradient)
        self.length = 1.0 if self.history else 1 / max(1.0, float(np.linalg.norm(gradient)))
        self.trial = self.point + self.length * self.direction

    def _scaled(self, gradient: np.ndarray) -> np.ndarray:
        """The inverse curvature of the last steps, applied to the gradient."""
        q, kept = gradient.copy(), []
        for step, change, rho in reversed(self.history):
            share = rho * (step @ q)
            q -= share * change
            kept.append(share)
        if self.history:
            step, change, rho = self.history[-1]
            q /= rho * (change @ change)
        for (step, change, rho), share in zip(self.history, reversed(kept)):
            q += (share - rho * (change @ q)) * step
        return q


def fit(
    chunks: DataFrame, size: int, tasks: Sequence[int], positive: Sequence[float], other: Sequence[float], c: float, tol: float, max_iter: int,
    on_pass: Callable[[int], None] = lambda unfinished: None,
) -> np.ndarray:
    """Coefficients as terms x tasks. A task tells rows of class ``tasks[k]``, weighted ``positive[k]``, from all others, weighted ``other[k]``.

    ``on_pass`` is told the number of unfinished tasks of each pass; ``max_iter`` bounds the passes.
    """
    block = max(1, BLOCK // max(size, 1))
    tasks, positive, other = np.array(tasks, dtype=np.int32), np.array(positive, dtype=float), np.array(other, dtype=float)
    found = []
    for at in range(0, len(tasks), block):
        own = np.arange(at, min(at + block, len(tasks)))
        descents = [Descent(size, tol) for _ in own]
        for _ in range(max_iter):
            open_ = [k for k, d in enumerate(descents) if not d.done]
            if not open_:
                break
            on_pass(len(open_))
            points = np.column_stack([descents[k].trial for k in open_])
            now = own[open_]
            losses, gradients = evaluate(chunks, points, tasks[now], positive[now], other[now])
            for column, k in enumerate(open_):
                trial = descents[k].trial
                descents[k].tell(0.5 * float(trial @ trial) + c * losses[column], trial + c * gradients[:, column])
        found += [d.point for d in descents]
    return np.column_stack(found)
