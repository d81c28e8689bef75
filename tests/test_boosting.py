"""Boosted trees against a plain fit on the same bins."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tabloom.operators import boosting
from tabloom.operators.boosting import Boosting, fit_boosted


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    n = 500
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), rng.random(n) > 0.9, np.zeros(n)])
    y = np.clip((x[:, 0] * 1.5 + x[:, 1]).astype(int), 0, 3)
    r = x[:, 0] ** 2 + x[:, 1] + rng.normal(size=n) / 10
    df = spark.createDataFrame(pd.DataFrame({"row_id": np.arange(n), "a": list(x), "y": y.astype(float), "r": r}))
    return x, y, r, df.select("row_id", array_to_vector(F.col("a")).alias("features"), "y", "r").repartition(3).cache()


def plain_fit(bins, label, classes, plan):
    """Margins of the training rows by recursion over rows, with no histograms."""
    margins = np.tile(np.log([(label == k).mean() for k in range(classes)]) if classes else [label.mean()], (len(label), 1))

    def grow(rows, g, h, depth, out):
        leaf = lambda r: -plan.rate * g[r].sum() / (h[r].sum() + plan.l2)
        out[rows] = leaf(rows)
        if depth == plan.max_depth:
            return
        score = lambda r: g[r].sum() ** 2 / (h[r].sum() + plan.l2)
        best, found = 1e-9, None
        for f in range(bins.shape[1]):
            for cut in range(bins[:, f].max()):
                left, right = rows[bins[rows, f] <= cut], rows[bins[rows, f] > cut]
                if not len(left) or not len(right) or min(h[left].sum(), h[right].sum()) < plan.least_weight:
                    continue
                gain = np.float32(score(left) + score(right) - score(rows))
                if gain > best:
                    best, found = gain, (left, right)
        for part in found or ():
            grow(part, g, h, depth + 1, out)

    for _ in range(plan.rounds):
        if classes:
            p = boosting.shares_of(margins)
            g, h = p - (label[:, None] == np.arange(classes)), 2 * p * (1 - p)
        else:
            g, h = margins - label[:, None], np.ones_like(margins)
        step = np.zeros_like(margins)
        for k in range(margins.shape[1]):
            grow(np.arange(len(label)), g[:, k], h[:, k], 0, step[:, k])
        margins = margins + step
    return margins


@pytest.mark.parametrize("block_rows", [50_000, 60])
def test_classes_equal_a_plain_fit(data, monkeypatch, block_rows):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", block_rows)
    x, y, _, table = data
    plan = Boosting(rounds=3, max_depth=3, rate=0.3, bins=16)
    model = fit_boosted(table, plan, classes=4, label_col="y")
    want = plain_fit(model.bins.place(x), y, 4, plan)
    rows = model.transform(table).select("row_id", vector_to_array("rawPrediction").alias("m"), vector_to_array("probability").alias("p"), "prediction").orderBy("row_id").collect()
    assert np.allclose([r["m"] for r in rows], want, atol=1e-8)
    assert np.allclose([r["p"] for r in rows], boosting.shares_of(want)) and [r["prediction"] for r in rows] == want.argmax(1).tolist()
    assert len(model.losses) == 4 and all(a > b for a, b in zip(model.losses, model.losses[1:]))
    assert model.losses[-1] == pytest.approx(-np.log(boosting.shares_of(want)[np.arange(len(y)), y]).mean())


def test_regression_equals_a_plain_fit(data):
    x, _, r, table = data
    plan = Boosting(rounds=4, max_depth=2, rate=0.5, l2=0.0, bins=20)
    model = fit_boosted(table, plan, label_col="r")
    want = plain_fit(model.bins.place(x), r, 0, plan)[:, 0]
    got = [row["prediction"] for row in model.transform(table).orderBy("row_id").collect()]
    assert np.allclose(got, want) and model.losses[-1] == pytest.approx(((want - r) ** 2).mean())


def test_samples_do_not_depend_on_partitions(data):
    _, _, _, table = data
    plan = Boosting(rounds=3, max_depth=3, rate=0.3, rows=0.6, columns=0.5)
    one, other = (fit_boosted(t, plan, classes=4, label_col="y") for t in (table, table.repartition(5)))
    assert np.allclose(one.losses, other.losses) and all((a.feature == b.feature).all() for a, b in zip(one.trees, other.trees))
    assert one.losses != fit_boosted(table, Boosting(rounds=3, max_depth=3, rate=0.3, rows=0.6, columns=0.5, seed=7), classes=4, label_col="y").losses


def test_many_partial_sums_and_checkpoints(data, monkeypatch):
    _, _, _, table = data
    plan = Boosting(rounds=5, max_depth=2, rate=0.3)
    plain = fit_boosted(table, plan, classes=4, label_col="y")
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 40)
    monkeypatch.setattr(boosting, "DIRECT_BLOCKS", 2)
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 2)
    assert np.allclose(fit_boosted(table, plan, classes=4, label_col="y").losses, plain.losses)


def test_saved_models_come_back(spark, data, tmp_path):
    _, _, _, table = data
    model = fit_boosted(table, Boosting(rounds=2, max_depth=2, rate=0.3), classes=4, label_col="y")
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    scores = lambda m: [r[0] for r in m.transform(table).orderBy("row_id").select(vector_to_array("probability")).collect()]
    assert np.allclose(scores(again), scores(model)) and again.stages[0].losses == model.losses


def test_odd_tables(spark, data):
    _, _, _, table = data
    empty = fit_boosted(table.limit(0), Boosting(rounds=2, max_depth=2, rate=0.3), classes=2, label_col="y")
    assert not empty.trees
    flat = fit_boosted(table.withColumn("y", F.lit(1.0)), Boosting(rounds=2, max_depth=2, rate=0.3), classes=3, label_col="y")
    assert {r["prediction"] for r in flat.transform(table).select("prediction").collect()} == {1.0}


def test_right_children_follow_from_parents_and_left_ones():
    """A level asks for the sums of left children alone; all nodes' sums are the same as by counting them."""
    rng = np.random.default_rng(2)
    n, starts = 400, np.array([0, 4, 9])
    bins = np.column_stack([rng.integers(0, 4, n), rng.integers(0, 5, n)]).astype(np.uint8)
    block = boosting.Block(np.arange(n, dtype=np.uint64), bins, rng.integers(0, 3, n).astype(float), rng.normal(size=(n, 3)))
    trees = boosting.Trees.empty(3, 2)
    trees.feature[:, 0], trees.bin[:, 0] = [0, 1, -1], [1, 2, 0]
    top, below = (boosting.level_sums(block, trees, level, starts, 0.9, 7) for level in (0, 1))
    left = boosting.level_sums(block, trees, 1, starts, 0.9, 7, left=True)
    assert left.shape == (2, 3, 1, 9)
    assert np.allclose(boosting.both_children(top, left, trees.feature[:, :1] >= 0), below)
