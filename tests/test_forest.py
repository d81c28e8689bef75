"""Trees grown in the tasks, against Spark's and against a plain search."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tabloom.operators import forest
from tabloom.plans import models
from tabloom.plans.models import CLASSIFIERS, JOB_CLASSIFIERS, REGRESSORS, Training, model_spec

CONTEXT = Training(classes=("a", "b", "c"), label_col="y")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 600
    x = np.column_stack([rng.integers(0, 9, n), rng.integers(0, 7, n), rng.integers(0, 2, n), np.zeros(n)]).astype(float)
    y = ((x[:, 0] > 4).astype(int) + (x[:, 1] > 3) * x[:, 2].astype(int) + (rng.random(n) > 0.9)).clip(0, 2)
    df = spark.createDataFrame(pd.DataFrame({"row_id": np.arange(n), "a": list(x), "y": y.astype(float), "r": 2 * x[:, 0] - x[:, 1] + rng.normal(size=n) / 4}))
    return df.select("row_id", array_to_vector(F.col("a")).alias("features"), "y", "r").repartition(3).cache()


def test_a_tree_says_what_sparks_says(data, monkeypatch):
    """Few values a feature, so both have the same cuts."""
    spec = model_spec("decision_trees", CLASSIFIERS)
    theirs = spec.train(data, CONTEXT, max_depth=4)
    monkeypatch.setattr(models, "SPARK_TREE_ROWS", 0)
    ours = spec.train(data, CONTEXT, max_depth=4)
    assert isinstance(ours, forest.ForestModel)
    told = lambda m: {r[0]: (r[1], np.round(r[2], 9).tolist()) for r in m.transform(data).select("row_id", "prediction", vector_to_array("probability")).collect()}
    assert told(ours) == told(theirs)
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray())


@pytest.mark.parametrize(("slug", "specs", "label"), [("random_forests", CLASSIFIERS, "y"), ("random_forest_regression", REGRESSORS, "r")])
def test_forests_are_as_good_as_sparks_and_repeat(data, monkeypatch, slug, specs, label):
    spec, held = model_spec(slug, specs), data.filter("row_id % 4 = 0")
    error = lambda m: m.transform(held).agg(F.avg(F.abs(F.col("prediction") - F.col(label)))).first()[0]
    fit = lambda: spec.train(data.filter("row_id % 4 <> 0"), Training(classes=("a", "b", "c"), label_col=label), trees=20)
    theirs = error(fit())
    monkeypatch.setattr(models, "SPARK_TREE_ROWS", 0)
    ours = error(fit())
    assert ours < 1.25 * theirs + 0.02 and error(fit()) == ours


def test_a_saved_forest_scores_as_before(data, spark, monkeypatch, tmp_path):
    monkeypatch.setattr(models, "SPARK_TREE_ROWS", 0)
    model = model_spec("random_forest", JOB_CLASSIFIERS).train(data, CONTEXT, trees=7)
    PipelineModel([model]).write().save(f"{tmp_path}/model")
    again = PipelineModel.load(f"{tmp_path}/model")
    told = lambda m: sorted((r[0], r[1], np.round(r[2], 9).tolist()) for r in m.transform(data).select("row_id", "prediction", vector_to_array("probability")).collect())
    assert told(again) == told(model)
    data.write.parquet(f"{tmp_path}/rows")
    stream = again.transform(spark.readStream.schema(data.schema).parquet(f"{tmp_path}/rows")).select("row_id", "prediction")
    stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/at").trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == [r[:2] for r in told(model)]


def test_rows_scored_in_parts_and_without_any(data, monkeypatch):
    monkeypatch.setattr(models, "SPARK_TREE_ROWS", 0)
    model = model_spec("random_forest", JOB_CLASSIFIERS).train(data, CONTEXT, trees=4)
    told = lambda: sorted(map(tuple, model.transform(data).select("row_id", "prediction").collect()))
    whole = told()
    monkeypatch.setattr(forest, "WHOLE_BYTES", 250 * 8 * 3)
    assert told() == whole and len(whole) == 600
    assert model.transform(data.limit(0)).count() == 0


def test_missing_labels_are_refused(data, monkeypatch):
    monkeypatch.setattr(models, "SPARK_TREE_ROWS", 0)
    holes = data.withColumn("r", F.when(F.col("row_id") > 5, F.col("r")))
    with pytest.raises(Exception):
        model_spec("random_forest_regression", REGRESSORS).train(holes, Training(label_col="r"), trees=3)


def test_a_forest_that_was_saved_grows_no_trees_again(data, monkeypatch, tmp_path):
    monkeypatch.setattr(models, "SPARK_TREE_ROWS", 0)
    model = model_spec("random_forest", JOB_CLASSIFIERS).train(data, CONTEXT, trees=3)
    assert model.path is None
    PipelineModel([model]).write().save(f"{tmp_path}/model")
    assert model.path and model.transform(data).count() == 600


def test_features_of_a_node_are_drawn_in_parts(monkeypatch):
    whole = forest._chosen(np.random.default_rng(1), 50, 30, 6)
    monkeypatch.setattr(forest, "DRAWN_VALUES", 100)
    assert (forest._chosen(np.random.default_rng(1), 50, 30, 6) == whole).all()
    assert whole.shape == (50, 6) and (np.diff(whole, axis=1) > 0).all() and whole.max() < 30
