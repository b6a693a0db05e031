"""Model outputs against an independent fit, choice of the model to serve, lag per partition."""

from __future__ import annotations

import json
from datetime import datetime

import numpy as np
import pytest

from riskweave.catalog import queries
from riskweave.operators import model
from riskweave.settings import DEFAULTS
from riskweave.streaming import progress


def newton(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression on scaled columns: mean, deviation, weights."""
    mean, dev = x.mean(0), x.std(0, ddof=1)
    z = np.c_[np.ones(len(x)), (x - mean) / dev]
    w, ridge = np.zeros(z.shape[1]), np.r_[0, np.full(x.shape[1], DEFAULTS.reg_param)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        gradient = z.T @ (p - y) / len(y) + ridge * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z / len(y) + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-10:
            break
    return mean, dev, w


def matrix(rows, features) -> np.ndarray:
    return np.array([[float(r[f] or 0) for f in features] for r in rows])


def auc(score: np.ndarray, y: np.ndarray) -> float:
    ranks = np.empty(len(score))
    for value in np.unique(score):  # ties share their mean rank
        hit = score == value
        ranks[hit] = (score < value).sum() + (hit.sum() + 1) / 2
    n = y.sum()
    return (ranks[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.fixture(scope="module")
def labelled(spark, sf_dir):
    rows = model.training_set(queries.batch_rows(spark, sf_dir)).withColumn(
        "chosen", model.in_train_part(DEFAULTS.train_share))
    return rows.collect()


def fitted(rows, features):
    train = [r for r in rows if r.chosen]
    return newton(matrix(train, features), np.array([r.label for r in train]))


def probability(rows, features, fit) -> np.ndarray:
    mean, dev, w = fit
    return 1 / (1 + np.exp(-(w[0] + ((matrix(rows, features) - mean) / dev) @ w[1:])))


def test_held_out_predictions_are_those_of_an_independent_fit(spark, sf_dir, labelled):
    got = {(r.features, r.transaction_id): r
           for r in queries.all_queries()["model_eval"](spark, sf_dir).collect()}
    held_out = [r for r in labelled if not r.chosen]
    assert len(got) == 2 * len(held_out) > 200
    for name, features in (("history", model.HISTORY_FEATURES),
                           ("online", model.ONLINE_FEATURES)):
        want = probability(held_out, features, fitted(labelled, features))
        for r, p in zip(held_out, want):
            row = got[name, r.transaction_id]
            assert row.label == r.label
            assert row.fraud_probability == pytest.approx(p, abs=2e-3)
            if abs(p - 0.5) > 5e-3:
                assert row.prediction == float(p > 0.5)


def test_reported_area_under_the_curve(spark, sf_dir, labelled):
    rows = queries.batch_rows(spark, sf_dir)
    trained = model.train(rows, model.HISTORY_FEATURES, queries.SMALL_TRAINING)
    held_out = [r for r in labelled if not r.chosen]
    p = probability(held_out, model.HISTORY_FEATURES, fitted(labelled, model.HISTORY_FEATURES))
    assert trained.auc == pytest.approx(auc(p, np.array([r.label for r in held_out])), abs=5e-3)
    assert trained.auc > 0.8


def test_stream_predictions_are_those_of_an_independent_fit(spark, sf_dir):
    from riskweave.functions import scoring

    features = scoring.score(queries.unique(spark, sf_dir), "stream")
    rows = model.training_set(features).withColumn(
        "chosen", model.in_train_part(DEFAULTS.train_share)).collect()
    fit = fitted(rows, model.STREAM_FEATURES)
    known = {r.transaction_id: r for r in features.collect()}
    got = queries.all_queries()["stream_model_score"](spark, sf_dir).collect()
    assert len(got) > 900
    want = probability([known[r.transaction_id] for r in got], model.STREAM_FEATURES, fit)
    for r, p in zip(got, want):
        assert r.fraud_probability == pytest.approx(p, abs=2e-3)
        assert r.fraud_score == pytest.approx(known[r.transaction_id].fraud_score, abs=1e-6)


def test_a_worse_newer_model_is_not_served(spark, tmp_path):
    root = str(tmp_path)
    assert model.champion(spark, root) is None

    def add(day, area):
        model.register(spark, root, f"m{day}", datetime(2024, 1, day), area)
        return model.champion(spark, root)

    assert add(1, float("nan")) is None  # nothing could be measured
    assert add(2, 0.90) == "m2"
    assert add(3, 0.80) == "m2"
    assert add(4, 0.895) == "m4"  # as good, and has seen newer rows
    assert add(5, 0.885) == "m4"  # small losses do not add up
    assert add(6, 0.95) == "m6"
    assert model.newest(spark, root) == "m6"
    won = {r.path for r in model.standings(spark, root).where("won").collect()}
    assert won == {"m2", "m4", "m6"}
    assert model.champion(spark, root, tolerance=1.0) == "m6"


def test_lag_is_kept_by_partition(spark, tmp_path):
    def report(batch, latest):
        return {"id": "q", "batchId": batch, "timestamp": "t", "numInputRows": 1,
                "durationMs": {"triggerExecution": 1500},
                "sources": [{"latestOffset": {"topic": latest},
                             "endOffset": {"topic": {"0": 5, "1": 7}}}]}

    progress.append(spark, str(tmp_path), report(0, {"0": 100, "1": 7}))
    progress.append(spark, str(tmp_path), report(1, {"0": 6, "1": 9}))
    progress.append(spark, str(tmp_path), {"id": "file", "batchId": 0, "timestamp": "t"})
    rows = progress.read_progress(spark, str(tmp_path))
    assert {(r.batch_id, r.lag) for r in rows.where("query_id = 'q'").collect()} == {
        (0, 95), (1, 3)}
    assert {tuple(r) for r in progress.lag_by_partition(rows).collect()} == {
        ("q", "topic-0", 1), ("q", "topic-1", 2)}
    assert json.dumps(rows.where("query_id = 'file'").first().lag_by_partition) == "{}"
