from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import curves, metrics, profile, slices


def pairs(spark, rows, schema="y string, p string"):
    return spark.createDataFrame(rows, schema)


def test_class_without_predictions_scores_zero(spark):
    df = pairs(spark, [("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")])
    scores = {r["label"]: r for r in metrics.class_scores(df, "y", "p").collect()}
    assert (scores["c"]["precision"], scores["c"]["recall"], scores["c"]["f1"], scores["c"]["support"]) == (0.0, 0.0, 0.0, 1)
    out = metrics.classification_metrics(df, "y", "p").first()
    assert out["accuracy"] == 0.5 and math.isclose(out["macro_f1"], (0.5 + 2 / 3 + 0) / 3)
    assert math.isclose(out["weighted_f1"], (2 * 0.5 + 2 / 3) / 4) and math.isclose(out["balanced_accuracy"], 0.5)


def test_label_seen_only_as_prediction_counts_for_macro_not_balanced(spark):
    out = metrics.classification_metrics(pairs(spark, [("a", "a"), ("a", "z")]), "y", "p").first()
    assert math.isclose(out["macro_f1"], (2 / 3 + 0) / 2) and out["balanced_accuracy"] == 0.5


def test_report_rows_are_consistent(spark):
    df = pairs(spark, [("a", "a"), ("b", "a"), ("b", "b"), ("c", "c"), ("c", "b"), ("a", "a")])
    report = {r["label"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert report["accuracy"]["f1"] == 4 / 6 and report["macro avg"]["support"] == 6
    mean = sum(report[k]["f1"] for k in "abc") / 3
    assert math.isclose(report["macro avg"]["f1"], mean)


def test_confusion_keeps_label_order_and_empty_rows(spark):
    cells = metrics.confusion(pairs(spark, [("a", "b")]), "y", "p", ["b", "a", "x"])
    assert [r["n"] for r in cells.orderBy("true_index", "pred_index").collect()] == [0, 0, 0, 1, 0, 0, 0, 0, 0]
    assert {r["y_true"]: r["s"] for r in metrics.row_shares(cells).groupBy("y_true").agg(F.sum("share").alias("s")).collect()} == {"a": 1.0, "b": 0.0, "x": 0.0}


def test_regression_edge_cases(spark):
    df = pairs(spark, [(1.0, 1.0), (1.0, 1.0), (None, 2.0)], "y double, p double")
    assert metrics.regression_metrics(df, "y", "p").first()["r2"] == 1.0
    off = pairs(spark, [(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    out = metrics.regression_metrics(off, "y", "p").first()
    assert (out["mae"], out["rmse"], out["r2"], out["rows"]) == (0.5, math.sqrt(0.5), 0.0, 2)


def plain_areas(score, hit):
    """Areas from every threshold in turn."""
    p, n = hit.sum(), (1 - hit).sum()
    points = [(0, 0)] + [(hit[score >= t].sum(), (1 - hit)[score >= t].sum()) for t in sorted(set(score), reverse=True)]
    roc = sum((b[1] - a[1]) * (a[0] + b[0]) / 2 for a, b in zip(points, points[1:])) / (p * n)
    prec = [1.0] + [t / (t + f) for t, f in points[1:]]
    rec = [t / p for t, _ in points]
    ap = sum((rec[i] - rec[i - 1]) * prec[i] for i in range(1, len(rec)))
    area = sum((rec[i] - rec[i - 1]) * (prec[i] + prec[i - 1]) / 2 for i in range(1, len(rec)))
    return roc, ap, area


@pytest.mark.parametrize("kind", ["ties", "all equal", "hot", "distinct"])
def test_curve_areas(spark, kind):
    rng = np.random.default_rng(1)
    n = 300
    score = {"ties": rng.integers(0, 9, n), "all equal": np.ones(n), "hot": np.where(rng.random(n) < 0.4, 0.5, rng.random(n)), "distinct": rng.random(n)}[kind].astype(float)
    hit = (rng.random(n) < 0.2 + 0.5 * (score > score.mean())).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"s": score, "h": hit}))
    out = curves.curve_areas(df, "s", F.col("h") == 1).first()
    assert np.allclose([out["roc_auc"], out["average_precision"], out["pr_auc"]], plain_areas(score, hit))
    assert (out["positives"], out["negatives"]) == (hit.sum(), n - hit.sum())


def test_one_sided_labels_have_no_area(spark):
    out = curves.curve_areas(pairs(spark, [(0.1, 1), (0.2, 1)], "s double, h int"), "s", F.col("h") == 1).first()
    assert out["roc_auc"] is None and out["average_precision"] == 1.0


def test_macro_curve_interpolates_like_the_plain_one(spark):
    rng = np.random.default_rng(4)
    n, classes = 250, ["a", "b", "c"]
    y = rng.choice(classes, n)
    scores = np.round(rng.random((n, 3)) + (y[:, None] == np.array(classes)) * 0.2, 2)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": list(scores)}))
    got = curves.macro_roc(df, "y", F.col("s"), classes, blocks=5).orderBy("fpr").toPandas()

    def roc(hit, score):
        cut = sorted(set(score), reverse=True)
        tp = np.array([hit[score >= t].sum() for t in cut])
        fp = np.array([(~hit)[score >= t].sum() for t in cut])
        keep = np.r_[True, (np.diff(fp, 2) != 0) | (np.diff(tp, 2) != 0), True]
        return np.r_[0, fp[keep]] / (~hit).sum(), np.r_[0, tp[keep]] / hit.sum()

    lines = [roc(y == k, scores[:, i]) for i, k in enumerate(classes)]
    grid = np.unique(np.concatenate([f for f, _ in lines]))
    mean = np.mean([np.interp(grid, f, t) for f, t in lines], axis=0)
    assert np.allclose(got["fpr"], grid) and np.allclose(got["tpr"], mean)
    area = curves.curve_area(curves.macro_roc(df, "y", F.col("s"), classes), "fpr", "tpr").first()[0]
    assert math.isclose(area, ((grid[1:] - grid[:-1]) * (mean[1:] + mean[:-1]) / 2).sum())


def test_cluster_agreement_extremes(spark):
    same = pairs(spark, [("a", "1"), ("a", "1"), ("b", "2")])
    assert tuple(metrics.cluster_agreement(same, "y", "p").first()) == (1.0, pytest.approx(1.0))
    one = pairs(spark, [("a", "1"), ("b", "1"), ("a", "1"), ("b", "1")])
    assert tuple(metrics.cluster_agreement(one, "y", "p").first()) == (0.0, 0.0)
    split = pairs(spark, [("a", "1"), ("a", "2"), ("b", "1"), ("b", "2")])
    ari, nmi = metrics.cluster_agreement(split, "y", "p").first()
    assert math.isclose(ari, -0.5) and math.isclose(nmi, 0.0, abs_tol=1e-12)


def test_noise_is_not_a_cluster(spark):
    df = pairs(spark, [(1, -1), (2, 0), (3, 0), (4, 3)], "i int, c int")
    assert tuple(metrics.cluster_summary(df, "c").first()) == (2, 1, 4)


def test_top_k_ties_go_to_the_smaller_key(spark):
    df = pairs(spark, [("b", "x"), ("a", "x"), ("c", "x"), ("c", "y"), (None, "y")])
    assert [r["y"] for r in slices.top_values(df, "y", 2).collect()] == ["c", "a"]
    other = {r["y"]: r["count"] for r in slices.other_bucket(slices.count_by(df.dropna(), ["y"]), "y", 1).collect()}
    assert other == {"c": 2, "(other)": 2}
    assert slices.keep_top(df, "y", 1).count() == 2


def test_pivot_of_an_empty_table(spark):
    empty = pairs(spark, [])
    assert slices.count_by(empty, ["y", "p"]).count() == 0
    assert slices.pivot_counts(slices.count_by(empty, ["y", "p"]), "y", "p", values=["u"]).count() == 0
    assert profile.null_fractions(empty).collect()[0]["missing_fraction"] == 0.0


def test_wide_pivots_are_refused_and_long_ones_are_not(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("r"), F.concat(F.lit("c"), F.col("id") % 1500).alias("c"))
    counts = slices.count_by(df, ["r", "c"])
    with pytest.raises(ValueError, match="1500 values"):
        slices.pivot_counts(counts, "r", "c")
    with pytest.raises(ValueError, match="3 values"):
        slices.column_values(df, "r", most=2)
    rows = slices.ranked_counts(counts, "r", "c").collect()
    assert len(rows) == counts.count() and {r["row_place"] for r in rows} == {0, 1, 2} and {r["column_place"] for r in rows} == set(range(1500))


def test_ranked_counts_take_null_as_a_key(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, "x"), ("b", "y")], "r string, c string")
    rows = {(r["r"], r["c"]): (r["row_place"], r["column_place"]) for r in slices.ranked_counts(slices.count_by(df, ["r", "c"]), "r", "c").collect()}
    assert rows == {("a", None): (0, 0), (None, "x"): (1, 1), ("b", "y"): (2, 2)}
