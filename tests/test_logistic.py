from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuscope.operators import logistic


def rows_of(seed, count, size, classes):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(classes, size))
    rows = []
    for _ in range(count):
        label = int(rng.integers(classes))
        cells = np.sort(rng.choice(size - 1, rng.integers(0, 6), replace=False))
        values = centres[label, cells] + rng.normal(size=len(cells))
        rows.append((f"c{label:02}", [*cells.tolist(), size - 1], [*values.tolist(), 1.0]))  # the last cell is the intercept
    return rows


def dense(rows, size):
    x = np.zeros((len(rows), size))
    for k, (_, cells, values) in enumerate(rows):
        x[k, cells] = values
    return x


def newton(x, y, weight, c):
    """The optimum by Newton steps on the dense matrix."""
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-y * (x @ w)))
        gradient = w - c * (weight * y * (1 - p)) @ x
        hessian = np.eye(len(w)) + c * (x * (weight * p * (1 - p))[:, None]).T @ x
        w -= np.linalg.solve(hessian, gradient)
    assert np.abs(gradient).max() < 1e-9
    return w


def fitted(spark, rows, size, classes, c=1.5, tol=1e-10):
    names = [f"c{k:02}" for k in range(classes)]
    df = spark.createDataFrame(rows, "label string, i array<int>, v array<double>").repartition(3)
    chunks = logistic.pack(df, F.col("i"), F.col("v"), F.col("label"), names)
    positive, passes = [1.0 + 0.5 * k for k in range(classes)], []
    found = logistic.fit(chunks, size, range(classes), positive, [1.0] * classes, c, tol, 500, passes.append)
    return found, names, positive, passes


@pytest.mark.parametrize("classes, small", [(3, False), (12, False), (12, True)])
def test_all_tasks_reach_their_optimum(spark, monkeypatch, classes, small):
    if small:  # many chunks, slices and blocks of tasks
        monkeypatch.setattr(logistic, "CHUNK", 40)
        monkeypatch.setattr(logistic, "SLICE", 7)
        monkeypatch.setattr(logistic, "BLOCK", 5 * 25)
    rows, size, c = rows_of(classes, 300, 25, classes), 25, 1.5
    found, names, positive, passes = fitted(spark, rows, size, classes, c)
    x = dense(rows, size)
    for k, name in enumerate(names):
        y = np.array([1.0 if label == name else -1.0 for label, _, _ in rows])
        weight = np.where(y > 0, positive[k], 1.0)
        assert np.abs(found[:, k] - newton(x, y, weight, c)).max() < 1e-6
    if not small:
        # One block: every pass serves all tasks that are not done, so the first serves them all and some end before others.
        assert passes[0] == classes and passes == sorted(passes, reverse=True) and len(passes) < 80


def test_passes_do_not_grow_with_the_labels(spark):
    few = fitted(spark, rows_of(5, 300, 25, 2), 25, 2, tol=1e-5)[3]
    many = fitted(spark, rows_of(5, 300, 25, 10), 25, 10, tol=1e-5)[3]
    assert len(many) < 2 * len(few)


def test_losses_and_gradients_of_a_chunk():
    rows = rows_of(7, 40, 9, 3)
    x, rng = dense(rows, 9), np.random.default_rng(1)
    lengths = [len(cells) for _, cells, _ in rows]
    chunk = {
        "starts": np.cumsum([0, *lengths[:-1]]), "cells": np.concatenate([c for _, c, _ in rows]),
        "numbers": np.concatenate([v for _, _, v in rows]), "classes": np.array([int(label[1:]) for label, _, _ in rows]),
    }
    points, tasks = rng.normal(size=(9, 3)), np.arange(3)
    losses, gradient = logistic.fold(chunk, points, tasks, np.array([2.0, 1.0, 3.0]), np.ones(3))
    for k in range(3):
        y = np.where(chunk["classes"] == k, 1.0, -1.0)
        weight = np.where(y > 0, [2.0, 1.0, 3.0][k], 1.0)
        margin = y * (x @ points[:, k])
        assert losses[k] == pytest.approx((weight * np.log1p(np.exp(-margin))).sum())
        assert np.allclose(gradient[:, k], -(weight * y / (1 + np.exp(margin))) @ x)


def test_margins_far_out_do_not_overflow():
    chunk = {"starts": np.array([0, 1]), "cells": np.array([0, 0]), "numbers": np.array([1e4, -1e4]), "classes": np.array([0, 1])}
    for sign in (1.0, -1.0):
        losses, gradient = logistic.fold(chunk, np.full((1, 1), sign), np.array([0]), np.ones(1), np.ones(1))
        assert np.isfinite(losses).all() and np.isfinite(gradient).all()
