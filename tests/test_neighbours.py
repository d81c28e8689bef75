from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import neighbours as nb
from tabloom.operators.components import connected_components
from tabloom.operators.dbscan import assign_clusters, dbscan, dbscan_vectors
from tabloom.plans.models import CLUSTERERS, Training, model_spec


def with_copies(n=300, d=4, seed=0):
    """A third of all rows are copies of one point."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[: n // 3] = x[0]
    return x


@pytest.mark.parametrize("block_rows", [16, 100, 2048])
def test_nearest_is_exact(spark, block_rows):
    x, q = with_copies(), np.vstack([with_copies(90, seed=1), with_copies(3)])
    points = spark.createDataFrame(pd.DataFrame({"pid": np.arange(len(x)), "v": list(x)}))
    queries = spark.createDataFrame(pd.DataFrame({"qid": np.arange(len(q)), "u": list(q)}))
    got = nb.nearest(queries, points, k=7, query_id="qid", point_id="pid", query_vector="u", point_vector="v", block_rows=block_rows).toPandas().sort_values(["qid", "rank"])
    dist = np.sqrt(((q[:, None] - x[None]) ** 2).sum(-1))
    want = np.argsort(dist, axis=1, kind="stable")[:, :7]
    assert (got["neighbour"].to_numpy().reshape(-1, 7) == want).all()
    assert np.allclose(got["distance"].to_numpy().reshape(-1, 7), np.take_along_axis(dist, want, 1))


def test_radius_and_few_points(spark):
    points = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [5.0])], "pid int, v array<double>")
    queries = spark.createDataFrame([(1, [0.4]), (2, [9.0])], "qid int, v array<double>")
    near = nb.nearest(queries, points, k=5, query_id="qid", point_id="pid", query_vector="v", radius=1.0)
    assert sorted((r["qid"], r["neighbour"]) for r in near.collect()) == [(1, 1), (1, 2)]
    everything = nb.nearest(queries, points, k=5, query_id="qid", point_id="pid", query_vector="v")
    assert everything.count() == 6
    assert nb.nearest(queries, points.limit(0), k=5, query_id="qid", point_id="pid", query_vector="v").count() == 0
    assert nb.nearest(queries.limit(0), points, k=5, query_id="qid", point_id="pid", query_vector="v").count() == 0


def test_vote_ties_and_exact_matches(spark):
    near = spark.createDataFrame([(1, 10, 0.5, 1), (1, 11, 0.6, 2), (2, 10, 0.0, 1), (2, 11, 0.6, 2)], "qid int, neighbour int, distance double, rank int")
    facts = spark.createDataFrame([(10, "b", 4.0), (11, "a", 8.0)], "pid int, y string, v double")
    votes = nb.vote(near, facts, query_id="qid", point_id="pid", label="y")
    assert {r["qid"]: r["y_pred"] for r in votes.collect()} == {1: "a", 2: "a"}
    mean = {r["qid"]: r["y_pred"] for r in nb.neighbour_mean(near, facts, query_id="qid", point_id="pid", value="v", weights="distance").collect()}
    assert mean[2] == 4.0 and np.isclose(mean[1], (4 / 0.5 + 8 / 0.6) / (1 / 0.5 + 1 / 0.6))
    plain = {r["qid"]: r["y_pred"] for r in nb.neighbour_mean(near, facts, query_id="qid", point_id="pid", value="v").collect()}
    assert plain == {1: 6.0, 2: 6.0}


def plain_dbscan(x, eps, least):
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= least
    label, found = np.full(len(x), -1), 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            todo, label[i] = [i], found
            while todo:
                u = todo.pop()
                for v in np.flatnonzero(near[u]):
                    if label[v] < 0:
                        label[v] = found
                        if core[v]:
                            todo.append(v)
            found += 1
    return label, core


@pytest.mark.parametrize(("d", "eps", "least", "hot"), [(2, 0.15, 5, 50), (1, 0.02, 4, 1000), (3, 0.5, 6, 40)])
def test_dbscan_is_exact(spark, d, eps, least, hot):
    rng = np.random.default_rng(d)
    spread = [rng.normal(0, 0.3, (150, d)), rng.uniform(-2, 2, (150, d)), np.ones((150, d)) + rng.integers(0, 2, (150, 1)) * eps]
    x = np.concatenate(spread)
    names = [f"x{i}" for i in range(d)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(id=np.arange(len(x))))
    got = dbscan(df, id_col="id", dims=names, eps=eps, min_points=least, hot_cell_rows=hot).toPandas().sort_values("id")
    label, core = plain_dbscan(x, eps, least)
    assert (got["cluster"].to_numpy() == label).all() and (got["core"].to_numpy() == core).all()


def test_touching_dense_cells_are_told_apart(spark):
    """Two rows of dense points whose gap is just above or just below eps."""
    along = np.repeat(np.linspace(0, 0.6, 25), 4)
    for gap, clusters in ((1.001, 2), (0.999, 1)):
        x = np.concatenate([along * 0, along * 0 + gap])
        y = np.concatenate([along, along])
        df = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "x": x, "y": y}))
        got = dbscan(df, id_col="id", dims=["x", "y"], eps=1.0, min_points=5)
        assert got.select("cluster").distinct().count() == clusters


def test_all_noise_and_assignment(spark):
    df = spark.createDataFrame([(i, float(10 * i)) for i in range(5)], "id int, x double")
    noise = dbscan(df, id_col="id", dims=["x"], eps=1.0, min_points=2)
    assert {r["cluster"] for r in noise.collect()} == {-1}
    assert {r["cluster"] for r in assign_clusters(df, noise, df, id_col="id", dims=["x"], eps=1.0).collect()} == {-1}
    train = spark.createDataFrame([(1, 0.0), (2, 0.1), (3, 5.0), (4, 5.1)], "id int, x double")
    fitted = dbscan(train, id_col="id", dims=["x"], eps=0.5, min_points=2)
    new = spark.createDataFrame([(7, 0.4), (8, 4.7), (9, 2.0)], "id int, x double")
    assert {r["id"]: r["cluster"] for r in assign_clusters(new, fitted, train, id_col="id", dims=["x"], eps=0.5).collect()} == {7: 0, 8: 1, 9: -1}
    with pytest.raises(ValueError):
        dbscan(train, id_col="id", dims=["x"] * 5)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)]
    nodes = spark.createDataFrame([(i,) for i in [*range(41), *range(100, 130), 500]], "node int")
    rng = np.random.default_rng(0)
    rng.shuffle(edges)
    out = connected_components(nodes, spark.createDataFrame([tuple(map(int, e)) for e in edges], "u int, v int"))
    labels = {r["node"]: r["lab"] for r in out.collect()}
    assert all(labels[i] == 0 for i in range(41)) and all(labels[i] == 100 for i in range(100, 130)) and labels[500] == 500
    assert out.filter(F.col("lab") > F.col("node")).count() == 0


@pytest.mark.parametrize("block_rows", [40, 2048])
def test_dbscan_on_wide_vectors(spark, block_rows):
    """One-hot columns beside scaled numbers, with a third of the rows equal."""
    rng = np.random.default_rng(8)
    n = 240
    hot = np.eye(4)[rng.integers(0, 4, n)]
    x = np.hstack([hot, rng.normal(0, 0.35, (n, 2)), np.zeros((n, 1))])
    x[: n // 3] = x[0]
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "v": list(x)}))
    got = dbscan_vectors(df, id_col="id", vector="v", eps=0.25, min_points=4, block_rows=block_rows).toPandas().sort_values("id")
    label, core = plain_dbscan(x, 0.25, 4)
    assert label.max() > 2
    assert (got["cluster"].to_numpy() == label).all() and (got["core"].to_numpy() == core).all()


def test_density_model_labels_new_rows(spark):
    train = spark.createDataFrame([(i, [0.0, 0.1 * i, 0.0, 0.0, 1.0]) for i in range(6)], "row_id int, features array<double>")
    new = spark.createDataFrame([(7, [0.0, 0.0, 0.0, 0.2, 1.0]), (8, [3.0, 0.0, 0.0, 0.0, 1.0])], "row_id int, features array<double>")
    model = model_spec("dbscan", CLUSTERERS).train(train, Training(), min_points=3)
    assert {r["row_id"]: r["prediction"] for r in model.transform(new).collect()} == {7: 0, 8: -1}


@pytest.mark.parametrize("rows", [900, 3600])
def test_queries_visit_few_cells_of_clustered_points(spark, monkeypatch, rows):
    rng = np.random.default_rng(rows)
    centers = rng.normal(size=(30, 6)) * 10
    x = centers[rng.integers(0, 30, rows)] + rng.normal(size=(rows, 6)) * 0.05
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(rows), "v": list(x)}))
    copies = []
    met = nb._met
    monkeypatch.setattr(nb, "_met", lambda q, *a: copies.append(q.select(F.size("_cells").alias("n")).agg(F.sum("n")).first()[0]) or met(q, *a))
    found = nb.nearest(df, df, k=3, query_id="id", point_id="id", query_vector="v", skip_same_id=True, block_rows=100).collect()
    # One home cell each, and then less than two thirds of the cells a cluster has on average.
    cells = math.isqrt(rows - 1) + 1
    assert copies[0] == rows and copies[1] < rows * max(2.0, cells / 15)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)) if rows < 1000 else None
    if d is not None:
        np.fill_diagonal(d, np.inf)
        want = np.sort(d, axis=1)[:, :3]
        got = np.zeros((rows, 3))
        for r in found:
            got[r["id"], r["rank"] - 1] = r["distance"]
        assert np.allclose(got, want)


def test_queries_are_sent_to_blocks_and_not_to_each_cell(spark, monkeypatch):
    """Points without clusters: nearly all cells are open, and a query still travels a few times only."""
    rng = np.random.default_rng(3)
    n = 1200
    x = rng.normal(size=(n, 12)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<float>")
    sent, met = [], nb._met

    def counted(*args):
        blocks = met(*args)
        sent.append((blocks[0].count(), blocks[1].count(), blocks[0].schema["_qv"].dataType.simpleString()))
        return blocks

    monkeypatch.setattr(nb, "_met", counted)
    found = nb.nearest(df, df, k=5, query_id="id", point_id="id", query_vector="v", skip_same_id=True, block_rows=64).toPandas().sort_values(["id", "rank"])
    assert sent[0][0] < 2 * n and max(max(s[:2]) for s in sent) <= 14 * n and {s[2] for s in sent} == {"array<float>"}
    dist = np.sqrt(((x[:, None].astype(float) - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(dist, np.inf)
    assert (found["neighbour"].to_numpy().reshape(n, 5) == np.argsort(dist, axis=1, kind="stable")[:, :5]).all()


def test_chains_of_many_parts_keep_groups():
    u, v = nb._joined_chains(np.array([5, 1, 9, 7, 3]), np.array([1, 3, 7, 9, 3]))
    assert [*zip(u.tolist(), v.tolist())] == [(1, 3), (3, 5), (7, 9)]
