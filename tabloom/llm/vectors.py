"""Near-duplicate vectors by an inverted multi-index.

Vectors are split in halves with a codebook each; the pair of nearest codewords is a vector's cell. A half is at least
as far from all vectors of another codeword as from the plane midway between its own codeword and that one. A query
visits the cells whose two distances, squared and added, are within a limit. At 2 - 2t, the largest squared distance of
a pair of cosine t, no link can be missed; a sample with enough groups of neighbours may show that less reaches the
target share. What is met in a visited cell is compared exactly. Neighbouring cells are worked on together as bins of about a
block's rows, so that a query is sent once to all it visits of a bin; bins are cut into blocks of bounded size. Tasks
hand on counts and one edge per vector and chunk of queries, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabloom.operators.components import connected_components
from tabloom.session import small_side, stash

THRESHOLD, TARGET_RECALL = 0.95, 0.995
BLOCK, CELL_ROWS, QUERY_ROWS = 4096, 200, 1024
MAX_CODEWORDS = 2048


def unit_rows(raw: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that no square overflows."""
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def squared_distances(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (rows * rows).sum(axis=1)[:, None] - 2 * rows @ words.T + (words * words).sum(axis=1))


def codebook(rows: np.ndarray, size: int, rounds: int = 12) -> np.ndarray:
    """K-means from evenly spread rows; a codeword without rows keeps its place."""
    words = rows[np.linspace(0, len(rows) - 1, size).astype(int)].copy()
    for _ in range(rounds):
        nearest = squared_distances(rows, words).argmin(axis=1)
        sums = np.zeros_like(words)
        np.add.at(sums, nearest, rows)
        counts = np.bincount(nearest, minlength=size)
        words[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return words


def _crossings(rows: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest codewords, and squared lower bounds of the rows' distances to what is nearest to each codeword."""
    far = squared_distances(rows, words)
    own = far.argmin(axis=1)
    apart = np.sqrt(squared_distances(words, words))[own]
    over = np.maximum(0.0, far - far[np.arange(len(rows)), own][:, None])
    return own, np.where(apart > 1e-6, over / np.maximum(2 * apart, 1e-6), 0.0) ** 2


@dataclass
class MultiIndex:
    first: np.ndarray
    second: np.ndarray
    limit: float

    def crossings(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        half = rows.shape[1] // 2
        return *_crossings(rows[:, :half], self.first), *_crossings(rows[:, half:], self.second)

    def visits(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Home cell and visited cells, nearest first."""
        home_first, a, home_second, b = self.crossings(rows)
        visited = []
        for k in range(len(rows)):
            i, j = np.flatnonzero(a[k] <= self.limit), np.flatnonzero(b[k] <= self.limit)
            sums = a[k][i][:, None] + b[k][j][None, :]
            p, q = np.nonzero(sums <= self.limit)
            cells = i[p] * len(self.second) + j[q]
            visited.append(cells[np.argsort(sums[p, q], kind="stable")].astype(np.int64))
        return home_first * len(self.second) + home_second, visited


def _share_within(over: np.ndarray, weights: np.ndarray, share: float) -> float:
    order = np.argsort(over)
    reached = np.cumsum(weights[order])
    return float(over[order][np.searchsorted(reached, share * reached[-1] * (1 - 1e-12))])


def fit_index(distinct: DataFrame, rows: int, *, fit_rows: int = 20_000, queries: int = 400, rounds: int = 2, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> MultiIndex:
    """Codebooks from at most about fit_rows vectors, the limit from samples of queries against all vectors.

    Samples are chosen by a hash of the id; codewords grow with the square root of the rows, up to 2,048 a half. What
    counts is each query's worst neighbour: the limit covers the recall's share of the groups of queries that are
    neighbours themselves, each group counting once by its worst, and the same share of all pairs. Samples grow tenfold
    until 1 / (1 - recall) groups have neighbours; if the last one has fewer, the limit stays at the exact bound.
    """
    space = 1 << 30
    chance = F.pmod(F.xxhash64("rep"), F.lit(space))
    fit = unit_rows(_matrix(distinct.filter(chance < F.lit(min(space, space * fit_rows // rows))).select("vector").toPandas()["vector"]))
    half = fit.shape[1] // 2
    size = int(min(MAX_CODEWORDS, len(fit), max(1, np.ceil(np.sqrt(rows / CELL_ROWS)))))
    exact = (2 - 2 * threshold) * (1 + 1e-9) + 1e-9
    index = MultiIndex(codebook(fit[:, :half], size), codebook(fit[:, half:], size), exact)
    least = int(np.ceil(1 / max(1e-9, 1 - recall) - 1e-9))

    for number in (queries * 10**k for k in range(rounds)):
        if number // 10 >= rows:
            break
        asked = distinct.filter(chance >= F.lit(space - min(space, space * number // rows))).select("rep", "vector").toPandas()
        if len(asked) < least:
            continue
        ask, asked_ids = unit_rows(_matrix(asked["vector"])), asked["rep"].to_numpy()
        _, near_first, _, near_second = index.crossings(ask)

        def worst(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """For each sampled query with true neighbours: their number and how far the worst one's cell lies."""
            for batch in batches:
                for lo in range(0, len(batch), 1000):
                    part = batch.iloc[lo : lo + 1000]
                    mine = unit_rows(_matrix(part["vector"]))
                    a, _, b, _ = index.crossings(mine)
                    q, v = np.nonzero((ask @ mine.T >= threshold) & (asked_ids[:, None] != part["rep"].to_numpy()[None, :]))
                    yield pd.DataFrame({"query": q, "over": near_first[q, a[v]] + near_second[q, b[v]]}).groupby("query")["over"].agg(["max", "size"]).reset_index()

        found = distinct.select("rep", "vector").mapInPandas(worst, "query long, max double, size long")
        met = found.groupBy("query").agg(F.max("max").alias("over"), F.sum("size").alias("pairs")).toPandas()
        group = _roots(len(ask), *np.nonzero(ask @ ask.T >= threshold))[met["query"].to_numpy(dtype=np.int64)]
        groups = met["over"].groupby(group).max().to_numpy()
        if len(groups) >= least:
            over, pairs = met["over"].to_numpy(), met["pairs"].to_numpy(dtype=np.float64)
            index.limit = min(exact, max(_share_within(groups, np.ones(len(groups)), recall), _share_within(over, pairs, recall)) * 1.1 + 1e-9)
            break
    return index


def _roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component in a small graph."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        label = label[label]
        if np.array_equal(before, label):
            return label


def _compare(points: pd.DataFrame, queries: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between the queries and the points of one bin: counts per vector and an edge to the smallest one reached.

    A pair is met twice if each vector visits the other's bin; then each meeting counts for its query alone.
    """
    p, q = points["rep"].to_numpy(), queries["rep"].to_numpy()
    a, b = np.nonzero(_matrix(queries["unit"]) @ _matrix(points["unit"]).T >= threshold)
    other = q[a] != p[b]
    a, b = a[other], b[other]
    cells = 1 + max(int(queries["home"].max()), int(max(max(v) for v in points["visits"])))
    lengths = points["visits"].map(len).to_numpy()
    seen = np.repeat(np.arange(len(points)), lengths) * cells + np.concatenate(points["visits"].to_numpy())
    back = np.isin(b * cells + queries["home"].to_numpy()[a], seen)
    nodes, place = np.unique(np.concatenate([q, p]), return_inverse=True)
    at_q, at_p = place[: len(q)][a], place[len(q) :][b]
    links = np.bincount(at_q, weights=points["copies"].to_numpy()[b], minlength=len(nodes))
    links += np.bincount(at_p[~back], weights=queries["copies"].to_numpy()[a][~back], minlength=len(nodes))
    met = np.unique(np.concatenate([at_q, at_p]))
    return pd.DataFrame({"rep": nodes[met], "links": links[met].astype(np.int64), "root": nodes[_roots(len(nodes), at_q, at_p)[met]]})


def link_vectors(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, recall: float = TARGET_RECALL, block: int = BLOCK) -> DataFrame:
    """id, n_links, component_id, kept for every row; ids must be unique integers.

    Two vectors are linked if their cosine in double precision is at least the threshold; copies of a vector are linked
    with each other. Vectors that are null, empty, zero, or hold null, NaN or infinity link with nothing, and so do
    those whose length is not the most frequent one. An empty table gives no rows. The index finds about the recall's
    share of the links where a sample shows that share, else all of them; none below the threshold.
    """
    spark = df.sparkSession
    wide = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("vector", lambda x: x != 0)
    rows = stash(df.select(F.col(id_col).alias("id"), wide.alias("vector")).withColumn("fine", F.coalesce(fine, F.lit(False))))
    width = rows.filter("fine").groupBy(F.size("vector").alias("w")).count().orderBy(F.desc("count"), "w").first()
    alone = rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"), F.lit(True).alias("kept"))
    if width is None:
        return alone
    usable = F.col("fine") & (F.size("vector") == width["w"])
    distinct = stash(rows.filter(usable).groupBy("vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    different = distinct.count()
    fitted = fit_index(distinct, different, threshold=threshold, recall=recall)
    together = max(1, block * len(fitted.first) * len(fitted.second) // different)
    index = spark.sparkContext.broadcast(fitted)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 2000):
                part = batch.iloc[lo : lo + 2000]
                units = unit_rows(_matrix(part["vector"]))
                homes, visited = index.value.visits(units)
                yield pd.DataFrame({"rep": part["rep"].to_numpy(), "copies": part["copies"].to_numpy(), "unit": list(units), "home": homes // together, "visits": [np.unique(x // together) for x in visited]})

    placed = stash(distinct.mapInPandas(assign, "rep long, copies long, unit array<double>, home long, visits array<long>"))
    points = placed.groupBy(F.col("home").alias("cell")).agg(F.ceil(F.count("*") / block).cast("int").alias("p_blocks"))
    asked = placed.select(F.explode("visits").alias("cell")).groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("q_blocks"))
    cells = small_side(points.join(asked, "cell"))
    span = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    deal = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    as_points = placed.withColumn("cell", F.col("home")).join(cells, "cell").select("cell", deal("p_blocks").alias("p"), span("q_blocks").alias("q"), F.lit(True).alias("point"), "rep", "copies", "unit", "home", "visits")
    as_queries = placed.withColumn("cell", F.explode("visits")).withColumn("visits", F.expr("cast(array() as array<bigint>)")).join(cells, "cell").select("cell", span("p_blocks").alias("p"), deal("q_blocks").alias("q"), F.lit(False).alias("point"), "rep", "copies", "unit", "home", "visits")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        points, queries = group[group["point"]], group[~group["point"]]
        if points.empty or queries.empty:
            return pd.DataFrame({"rep": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "root": pd.Series(dtype="int64")})
        return pd.concat([_compare(points, queries.iloc[lo : lo + QUERY_ROWS], threshold) for lo in range(0, len(queries), QUERY_ROWS)])

    met = stash(as_points.union(as_queries).groupBy("cell", "p", "q").applyInPandas(compare, "rep long, links long, root long"))
    links = met.groupBy("rep").agg(F.sum("links").alias("links"))
    edges = met.filter("rep <> root").select(F.least("rep", "root").alias("u"), F.greatest("rep", "root").alias("v")).distinct()
    linked = edges.select(F.col("u").alias("node")).union(edges.select(F.col("v").alias("node"))).distinct()
    labels = connected_components(linked, edges)
    known = distinct.join(links, "rep", "left").join(labels, F.col("rep") == F.col("node"), "left")
    known = known.select(F.col("vector").alias("_known"), "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("lab", F.col("rep")).alias("component"))
    joined = rows.join(known, usable & (F.col("vector") == F.col("_known")), "left")
    component = F.coalesce(F.col("component"), F.col("id")).cast("long")
    return joined.select(F.col("id").alias(id_col), F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (component == F.col("id")).alias("kept"))
