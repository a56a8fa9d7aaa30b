from __future__ import annotations

import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuscope.functions import text as T
from corpuscope.operators import classifier, labels, metrics
from corpuscope.plans.train import train_baseline

WORDS = {
    "harbour": ("crane", "quay", "tide", "berth", "pilot"), "orchard": ("apple", "graft", "blossom", "ladder"),
    "quarry": ("granite", "blast", "gravel"),
}


def texts(fields, rows, start=1):
    """Row k of a field: its words from the k-th on, the first one twice, and words that all fields share."""
    out = []
    for f, field in enumerate(fields):
        words = WORDS[field]
        for k in range(rows + f):
            own = [words[(k + j) % len(words)] for j in range(1 + k % 3)]
            out.append((start + len(out), " ".join([own[0], *own, "morning", "report"][: 3 + k]), field))
    return out


TWO, THREE = texts(["harbour", "orchard"], 3), texts(["harbour", "orchard", "quarry"], 3)
NEW = [(101, "tide and pilot at the quay", "harbour"), (102, "blossom on the ladder", "orchard"), (103, "unseen", "orchard"), (104, None, "harbour")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, label string")


@pytest.mark.parametrize("rows", [TWO, THREE], ids=["two labels", "three labels"])
def test_fit_reaches_the_optimum(spark, rows):
    """The gradient of 1/2|w|^2 + C * sum(weight * loss), intercept included, is zero."""
    df, c = frame(spark, rows), 2.0
    model = classifier.fit_baseline(df, ngram_range=(1, 1), c=c, tol=1e-12)
    size = model.features.size
    x = np.zeros((len(rows), size))
    place = {key: k for k, (key, _, _) in enumerate(rows)}
    for r in model.features.transform(df, ["label"]).collect():
        x[place[r.doc_id], r.features["indices"]] = r.features["values"]
    assert np.all(x[:, -1] == 1.0) and np.allclose(np.linalg.norm(x[:, :-1], axis=1), 1.0)
    fitted = np.array([r.weights for r in model.coefficients.orderBy("index").collect()])
    balanced = {r.label: r.weight for r in labels.class_weights(df, "label").collect()}
    tasks = model.labels[1:] if len(model.labels) == 2 else model.labels
    assert fitted.shape == (size, len(tasks))
    for positive, w in zip(tasks, fitted.T):
        y = np.array([1.0 if lab == positive else -1.0 for _, _, lab in rows])
        weight = np.array([balanced[lab] if lab == positive or len(model.labels) == 2 else 1.0 for _, _, lab in rows])
        gradient = w - c * (weight * y / (1 + np.exp(y * (x @ w)))) @ x
        assert np.abs(gradient).max() < 1e-4 * max(1.0, np.abs(w).max())
    margins = {r.doc_id: r.margins for r in model.margins(df).collect()}
    expected = x @ fitted if len(tasks) > 1 else (x @ fitted) * np.array([[-1.0, 1.0]])
    for key, k in place.items():
        assert margins[key] == pytest.approx(expected[k].tolist())


def test_every_row_gets_a_prediction_and_survives_a_round_trip(spark, tmp_path):
    model = classifier.fit_baseline(frame(spark, THREE))
    before = {r.doc_id: r.prediction for r in model.predict(frame(spark, NEW), ["label"]).collect()}
    assert set(before) == {101, 102, 103, 104} and (before[101], before[102]) == ("harbour", "orchard")
    model.save(str(tmp_path / "model"))
    again = classifier.load_model(spark, str(tmp_path / "model"))
    assert {r.doc_id: r.prediction for r in again.predict(frame(spark, NEW)).collect()} == before


def test_prediction_runs_no_python(spark):
    predicted = classifier.fit_baseline(frame(spark, TWO)).predict(frame(spark, NEW))
    plan = predicted._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_one_label_cannot_be_fitted(spark):
    with pytest.raises(ValueError):
        classifier.fit_baseline(frame(spark, texts(["quarry"], 3)))


def test_training_job_stores_model_and_metrics(spark, tmp_path):
    ready = frame(spark, TWO).withColumn("split", F.lit("train")).unionByName(
        frame(spark, NEW[:2]).withColumn("split", F.lit("val"))
    )
    model_path, metrics_path = str(tmp_path / "model"), str(tmp_path / "metrics")
    got = train_baseline(ready, model_path, metrics_path, max_features=100, ngram_range=(1, 2))
    record = json.loads(next(Path(metrics_path).glob("part-*.json")).read_text())
    assert record == {"macro_f1": 1.0, "labels": ["harbour", "orchard"], "validation_rows": 2}
    assert got.report.count() == 5 and got.model.labels == ["harbour", "orchard"]
    assert classifier.load_model(spark, model_path).labels == ["harbour", "orchard"]
    with pytest.raises(ValueError, match=r"\['split'\]"):
        train_baseline(ready.drop("split"), model_path, metrics_path)
    with pytest.raises(ValueError, match="val side"):
        train_baseline(ready.where("split = 'train'"), model_path, metrics_path)


def test_metrics_cover_labels_that_are_never_true_or_never_predicted(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b"), ("a", "x")]
    counts = metrics.confusion(spark.createDataFrame(rows, "label string, prediction string"))
    scores = {r.label: (r.precision, r.recall, r.f1, r.support) for r in metrics.label_scores(counts).collect()}
    assert scores["a"] == pytest.approx((1.0, 1 / 3, 0.5, 3))
    assert scores["b"] == pytest.approx((1 / 3, 1.0, 0.5, 1))
    assert scores["c"] == scores["x"][:3] + (1,) == (0.0, 0.0, 0.0, 1)
    assert metrics.macro_f1(counts).first().macro_f1 == pytest.approx(0.25)
    report = {r.label: r for r in metrics.classification_report(counts).collect()}
    assert report["accuracy"].f1 == pytest.approx(0.4) and report["accuracy"].support == 5
    assert report["weighted avg"].recall == pytest.approx(0.4)


def test_a_fit_tokenises_the_rows_once(spark, monkeypatch):
    calls, tokens = [], T.tokens
    monkeypatch.setattr(T, "tokens", lambda *a, **k: calls.append(a) or tokens(*a, **k))
    rows = [(k, f"{'alpha' if k % 2 else 'beta'} word{k % 5} the common", "ab"[k % 2]) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    model = classifier.fit_baseline(df)
    assert len(calls) == 1 and "the" in model.features.stop_words
    assert {(r.label, r.prediction) for r in model.predict(df, ["label"]).collect()} == {("a", "a"), ("b", "b")}


def test_known_terms_are_looked_up_in_the_row(spark, monkeypatch):
    """No join and no row for each term; the same numbers as by the join, also where keys repeat, are NULL, or have no text."""
    df = frame(spark, [*THREE, (1, "tide quay tide", "harbour"), (None, "apple", "orchard"), (None, None, "orchard"), (500, "unseen", "quarry")])
    model = classifier.fit_baseline(frame(spark, THREE))
    vectors, margins = model.features.transform(df, ["label"]), model.margins(df, ["label"])
    for found in (vectors, margins):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Generate" not in plan
    monkeypatch.setattr(classifier, "SENT", 0)
    for found, joined, name in ((vectors, model.features.transform(df, ["label"]), "features.values"), (margins, model.margins(df, ["label"]), "margins")):
        assert "Join" in joined._jdf.queryExecution().executedPlan().toString()
        rows = [sorted(((r[0] is None, r[0] or 0, r[1], r[2]) for r in x.select("doc_id", "label", name).collect()), key=lambda r: r[:3]) for x in (found, joined)]
        assert [r[:3] for r in rows[0]] == [r[:3] for r in rows[1]] and len(rows[0]) == len(THREE) + 2
        for a, b in zip(*rows):
            assert a[3] == pytest.approx(b[3])
    assert sorted(map(str, vectors.select("doc_id", "label", "features.indices").collect())) == sorted(
        map(str, model.features.transform(df, ["label"]).select("doc_id", "label", "features.indices").collect()))
