from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tabloom.operators.selection import fold_of, select_features
from tabloom.plans.models import (
    CLASSIFIERS,
    CLUSTERERS,
    JOB_CLASSIFIERS,
    REGRESSORS,
    REPORT_REGRESSORS,
    Training,
    class_probabilities,
    coefficient_table,
    model_spec,
    predictions_table,
    top_features,
)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    n, d = 240, 4
    x = rng.normal(size=(n, d))
    y = (x[:, 0] + 0.3 * rng.normal(size=n) > 0.4).astype(int) + (x[:, 1] > 0.8)
    r = 3 * x[:, 0] - 2 * x[:, 1] + 0.5 * rng.normal(size=n) + 7
    df = spark.createDataFrame(pd.DataFrame({"row_id": np.arange(n), "a": list(x), "y": y.astype(float), "r": r}))
    table = df.select("row_id", array_to_vector(F.col("a")).alias("features"), "y", "r").cache()
    return x, y, r, table


def test_model_lists():
    assert len(CLASSIFIERS) + len(CLUSTERERS) == 18
    assert len(REGRESSORS) == len(REPORT_REGRESSORS) == 8
    assert [s.slug for s in JOB_CLASSIFIERS] == ["random_forest", "xgboost"]
    assert model_spec("xgboost", JOB_CLASSIFIERS).params["rounds"] == 600
    with pytest.raises(KeyError):
        model_spec("absent", CLASSIFIERS)


def soft(v, a):
    return np.sign(v) * max(abs(v) - a, 0)


def coordinate_descent(x, y, alpha, ratio, rounds=3000):
    xc, yc = x - x.mean(0), y - y.mean()
    w, n = np.zeros(x.shape[1]), len(y)
    for _ in range(rounds):
        for j in range(len(w)):
            rest = yc - xc @ w + xc[:, j] * w[j]
            w[j] = soft(xc[:, j] @ rest / n, alpha * ratio) / (xc[:, j] @ xc[:, j] / n + alpha * (1 - ratio))
    return w


@pytest.mark.parametrize(("slug", "params"), [("linear_regression", {}), ("ridge_regression", {"alpha": 20.0}), ("lasso_regression", {"alpha": 0.3}), ("elasticnet_regression", {"alpha": 0.4})])
def test_linear_fits_solve_their_problem(data, slug, params):
    x, _, r, table = data
    model = model_spec(slug, REGRESSORS).train(table, Training(label_col="r"), **params)
    xc, rc = x - x.mean(0), r - r.mean()
    want = {
        "linear_regression": lambda: np.linalg.solve(xc.T @ xc, xc.T @ rc),
        "ridge_regression": lambda: np.linalg.solve(xc.T @ xc + 20 * np.eye(4), xc.T @ rc),
        "lasso_regression": lambda: coordinate_descent(x, r, 0.3, 1.0),
        "elasticnet_regression": lambda: coordinate_descent(x, r, 0.4, 0.5),
    }[slug]()
    assert np.allclose(model.coefficients.toArray(), want, atol=1e-5)


def logistic_loss(x, y, weight, coefs, bias):
    z = x @ coefs.T + bias
    z -= z.max(1, keepdims=True)
    log_p = z - np.log(np.exp(z).sum(1, keepdims=True))
    return -(weight * log_p[np.arange(len(y)), y]).sum() + 0.5 * (coefs**2).sum()


def test_balanced_logistic_regression_is_at_its_minimum(data):
    """Summed weighted loss plus half the squared norm: the gradient at the fit is 0."""
    x, y, _, table = data
    model = model_spec("logistic_regression", CLASSIFIERS).train(table, Training(classes=("a", "b", "c"), label_col="y"))
    weight = (len(y) / (3 * np.bincount(y)))[y]
    coefs, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    best = logistic_loss(x, y, weight, coefs, bias)
    rng = np.random.default_rng(0)
    for _ in range(20):
        assert logistic_loss(x, y, weight, coefs + 0.02 * rng.normal(size=coefs.shape), bias) > best - 1e-6


def test_linear_one_vs_rest_takes_the_largest_score(data):
    x, y, _, table = data
    model = model_spec("linear_regression", CLASSIFIERS).train(table, Training(classes=("a", "b", "c"), label_col="y"))
    design = np.column_stack([np.ones(len(y)), x])
    scores = design @ np.linalg.lstsq(design, np.eye(3)[y], rcond=None)[0]
    got = [r["prediction"] for r in model.transform(table).orderBy("row_id").collect()]
    assert got == scores.argmax(1).tolist()


@pytest.mark.parametrize(
    ("slug", "params"),
    [
        ("plsr", {"components": 2}),
        ("pcr", {"components": 3}),
        ("svm", {"max_iter": 30}),
        ("decision_trees", {}),
        ("random_forests", {"trees": 5}),
        ("knn", {}),
        ("gradient_boosting", {"rounds": 10}),
        ("xgboost", {"rounds": 10}),
        ("forward_selection", {"keep": 2, "folds": 2}),
    ],
)
def test_classifiers_beat_chance(data, slug, params):
    _, y, _, table = data
    context = Training(classes=("a", "b", "c"), label_col="y")
    scored = model_spec(slug, CLASSIFIERS).train(table, context, **params).transform(table)
    assert scored.count() == len(y)
    accuracy = scored.agg(F.avg((F.col("prediction") == F.col("y")).cast("int"))).first()[0]
    assert accuracy > np.bincount(y).max() / len(y) + 0.05
    if "rawPrediction" in scored.columns:
        total = scored.select(F.aggregate(class_probabilities(scored), F.lit(0.0), lambda a, v: a + v)).first()[0]
        assert np.isclose(total, 1.0)


@pytest.mark.parametrize(("slug", "params"), [("knn_regression", {}), ("random_forest_regression", {"trees": 5}), ("gradient_boosting_regression", {"rounds": 10}), ("xgboost_regression", {"rounds": 10})])
def test_regressors_beat_the_mean(data, slug, params):
    _, _, r, table = data
    scored = model_spec(slug, REGRESSORS).train(table, Training(label_col="r"), **params).transform(table)
    error = scored.agg(F.avg(F.pow(F.col("prediction") - F.col("r"), 2))).first()[0]
    assert error < 0.8 * r.var()


def by_refits(x, y, weight, fold, classes, keep, direction, ridge=1.0):
    """The same greedy search, with each option fitted anew."""
    width, marks = x.shape[1], np.eye(classes)[y]

    def accuracy(kept):
        a = np.column_stack([np.ones(len(x)), x[:, sorted(kept)]])
        shares = []
        for f in np.unique(fold):
            t = fold != f
            penalty = ridge * np.diag([0.0] + [1.0] * len(kept))
            w = np.linalg.pinv(a[t].T @ (a[t] * weight[t, None]) + penalty) @ (a[t].T @ (marks[t] * weight[t, None]))
            shares.append(((a[~t] @ w).argmax(1) == y[~t]).mean())
        return np.mean(shares)

    chosen, scores = ([] if direction == "forward" else [*range(width)]), []
    while len(chosen) != keep:
        options = [k for k in range(width) if (k in chosen) != (direction == "forward")]
        got = [accuracy([*chosen, k] if direction == "forward" else [c for c in chosen if c != k]) for k in options]
        best = options[int(np.argmax(got))]
        chosen = [*chosen, best] if direction == "forward" else [c for c in chosen if c != best]
        scores.append(max(got))
    return chosen, scores


@pytest.mark.parametrize("direction", ["forward", "backward"])
def test_selection_equals_full_refits(spark, direction):
    rng = np.random.default_rng(8)
    n, d = 260, 9
    x = rng.normal(size=(n, d))
    x[:, 5] = x[:, 0]  # a column that repeats another
    x[:, 6] = 3.0
    y = (x[:, 1] + 0.5 * x[:, 4] > 0.3).astype(int) + (x[:, 2] > 0.9)
    weight = n / (3 * np.bincount(y)[y])
    df = spark.createDataFrame(pd.DataFrame({"row_id": np.arange(n), "a": list(x), "y": y.astype(float), "weight": weight}))
    table = df.select("row_id", array_to_vector(F.col("a")).alias("features"), "y", "weight")
    fold = np.array([r[0] for r in df.orderBy("row_id").select(fold_of("row_id", 5)).collect()])
    got = select_features(table, id_col="row_id", label_col="y", classes=3, width=d, direction=direction, weight_col="weight", keep=4)
    kept, scores = by_refits(x, y, weight, fold, 3, 4, direction)
    assert np.allclose(got.scores, scores) and [*got.kept] == kept


def test_selection_defaults_and_limits(data):
    _, _, _, table = data
    common = dict(id_col="row_id", label_col="y", classes=3, width=4)
    assert len(select_features(table, **common).kept) == 3
    assert select_features(table, direction="backward", keep=2, **common).kept == (0, 1)
    assert select_features(table, **{**common, "width": 1}).kept == (0,)
    with pytest.raises(ValueError):
        select_features(table, direction="sideways", **common)
    with pytest.raises(ValueError):
        select_features(table, **{**common, "width": 5000})
    assert {r[0] for r in table.select(fold_of("row_id", 3)).distinct().collect()} == {0, 1, 2}


def test_clusterers(data):
    _, _, _, table = data
    for slug in ("k_means_clustering", "hierarchical_agglomerative_clustering"):
        out = model_spec(slug, CLUSTERERS).train(table, Training(classes=("a", "b", "c"))).transform(table)
        assert out.select("prediction").distinct().count() == 3


def test_prediction_table_and_top_features(spark):
    scored = spark.createDataFrame([(1, 1.0, "x", [0.2, 0.8]), (2, 7.0, "y", [0.6, 0.4])], "row_id int, prediction double, truth string, p array<double>")
    scored = scored.withColumn("probability", array_to_vector(F.col("p")))
    rows = predictions_table(scored, row_id_col="row_id", classes=["n", "m"], truth_col="truth").orderBy("row_id").collect()
    assert [tuple(r) for r in rows] == [(1, 1, "m", 0.8, "x"), (2, 7, "", 0.6, "y")]
    table = coefficient_table(scored, ["a", "b", "c"], [[3.0, 0.0, -1.0], [4.0, 0.0, 0.0]])
    assert [tuple(r) for r in top_features(table, "l2", 2).collect()] == [("a", 3.5, 5.0, 2), ("c", 0.5, 1.0, 1)]
