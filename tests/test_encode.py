from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.operators import encode
from tabloom.operators.pls import fit_pls, pls_rotation


def matrix(df, vector="features", order="id"):
    return np.array([r[0] for r in df.orderBy(order).select(vector_to_array(F.col(vector))).collect()])


def test_mixed_table_with_nulls(spark):
    df = spark.createDataFrame([(0, 1.0, "a"), (1, 2.5, "b"), (2, None, None)], "id int, num_feature double, cat_feature string")
    encoder = encode.fit_encoder(df, skip=["id"])
    assert encoder.names == ("num_feature", "cat_feature_a", "cat_feature_b")
    assert matrix(encoder.transform(df)).tolist() == [[1.0, 1.0, 0.0], [2.5, 0.0, 1.0], [1.75, 1.0, 0.0]]
    assert set(encoder.transform(df).columns) == {"id", "num_feature", "cat_feature", "features"}


def test_unequal_categories_quotes_and_unknown_values(spark):
    rows = [(0, "it's", "x\\y", True), (1, 'say "hi"', "z", False), (2, "it's", "w", None), (3, None, None, True)]
    df = spark.createDataFrame(rows, "id int, `odd name` string, b string, flag boolean")
    encoder = encode.fit_encoder(df, skip=["id"])
    assert encoder.names == ("flag", "odd name_it's", 'odd name_say "hi"', "b_w", "b_x\\y", "b_z")
    got = matrix(encoder.transform(df))
    assert got[3].tolist() == [1.0, 1.0, 0.0, 1.0, 0.0, 0.0]
    unseen = spark.createDataFrame([(0, "new", "z", False)], df.schema)
    assert matrix(encoder.transform(unseen)).tolist() == [[0.0, 0.0, 0.0, 0.0, 0.0, 1.0]]
    named = encode.fit_encoder(df, skip=["id"], missing_as_category=True)
    assert "b_(missing)" in named.names
    by_kind = encode.fit_encoder(df, skip=["id"], booleans_numeric=False)
    assert "flag_true" in by_kind.names


def test_constant_missing_and_nan_columns_when_scaling(spark):
    df = spark.createDataFrame([(0, 3.0, None, 1.0), (1, 3.0, None, float("nan")), (2, 3.0, None, 4.0)], "id int, c double, gone double, n double")
    encoder = encode.fit_encoder(df, skip=["id"], scale=True)
    assert encoder.numeric == ("c", "n")
    filled = np.array([1.0, 2.5, 4.0])
    assert np.allclose(matrix(encoder.transform(df)), np.column_stack([np.zeros(3), (filled - 2.5) / filled.std()]))


def test_saved_encoder_gives_the_same_vectors(spark, tmp_path):
    df = spark.createDataFrame([(0, 1.0, "a"), (1, 2.0, "b"), (2, 4.0, "c")], "id int, x double, k string")
    encoder = encode.fit_encoder(df, skip=["id"], scale=True)
    encoder.model.write().overwrite().save(str(tmp_path / "enc"))
    loaded = PipelineModel.load(str(tmp_path / "enc"))
    assert np.allclose(matrix(loaded.transform(df)), matrix(encoder.transform(df)))
    assert len(encode.feature_names(loaded.transform(df))) == 4


def test_mode_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "k string")
    assert encode.modes(encode.category_counts(df, ["k"])).first()["value"] == "a"


def test_balanced_weights_add_up_to_the_rows(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "y string")
    assert {r[0]: r[1] for r in encode.balanced_weights(df, "y").collect()} == {"a": 4 / 6, "b": 2.0}
    assert encode.with_balanced_weights(df, "y").agg(F.sum("weight")).first()[0] == 4.0


def points(spark, n=80, d=5, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + 3
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=n) > 4.5).astype(int) + (x[:, 2] > 3)
    from pyspark.ml.functions import array_to_vector

    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "a": list(x), "label": y.astype(float)}))
    return x, y, df.select("id", "label", array_to_vector(F.col("a")).alias("features"))


def test_pca_matches_a_plain_one(spark):
    x, _, df = points(spark)
    fitted = encode.fit_pca(df, components=3)
    c = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    vt *= np.where(np.abs(vt).max(axis=1) == vt.max(axis=1), 1, -1)[:, None]
    assert np.allclose(matrix(fitted.transform(df), "pca"), c @ vt[:3].T, atol=1e-8)
    shares = fitted.explained_variance(df).orderBy("component").toPandas()
    assert np.allclose(shares["ratio"], (s**2 / (s**2).sum())[:3]) and np.allclose(shares["cumulative"], shares["ratio"].cumsum())
    assert encode.fit_pca(df, components=50).model.getK() == 5


def plain_pls(x, y, components):
    """Deflation on the data itself, as a check of the deflation on correlations."""
    x = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    y = (y - y.mean(axis=0)) / y.std(axis=0, ddof=1)
    start, scores = x.copy(), []
    weights, loads = [], []
    for _ in range(components):
        w = np.linalg.svd(x.T @ y, full_matrices=False)[0][:, 0]
        w *= 1.0 if w[np.abs(w).argmax()] >= 0 else -1.0
        t = x @ w
        p, q = x.T @ t / (t @ t), y.T @ t / (t @ t)
        x, y = x - np.outer(t, p), y - np.outer(t, q)
        weights.append(w)
        loads.append(p)
        scores.append(t)
    w, p = np.array(weights).T, np.array(loads).T
    assert np.allclose(start @ w @ np.linalg.pinv(p.T @ w), np.array(scores).T)
    return np.array(scores).T


def test_pls_scores(spark):
    x, y, df = points(spark)
    marks = np.column_stack([(y == k).astype(float) for k in range(3)])
    fitted = fit_pls(df, label_col="label", classes=["0.0", "1.0", "2.0"], components=2)
    assert np.allclose(matrix(fitted.transform(df), "pls"), plain_pls(x, marks, 2), atol=1e-6)
    assert pls_rotation(np.eye(2), np.array([[0.5], [0.0]]), 2).shape == (2, 1)
