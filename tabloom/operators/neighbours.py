"""Exact k-nearest-neighbour and radius joins by blocks.

Points stand in cells around pivots, the square root of their number, and cells in groups around fewer pivots, so a row
finds its cell by a search in two levels. A query first searches its home cell, which gives its true k-th distance there; of
all other cells only those are searched whose ring of points around the pivot comes nearer than that. Neighbouring cells
stand together in blocks of bounded size, and a query is sent once to each block that holds a cell it must search, not once
to each cell. In a block, points are met in windows, and windows without an open cell are passed over. Large cells and the
queries of a block are cut as well, and a block hands on at most k rows per query, so neither a hot cell nor a group of
copies reaches one task as a whole and pairs are never listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabloom.operators.clean import col
from tabloom.session import stash

BLOCK_ROWS = 2048  # points of a window
QUERY_ROWS = 1024  # queries that meet a window at a time
# A block has at most so many rows and bytes of vectors on each side; a table is cut into SIDES blocks at least.
WIDE_ROWS, WIDE_BYTES, SIDES = 131_072, 24 << 20, 8
PAIR_SLICE = 100_000
LINKS_HELD = 1_000_000


def as_array(df: DataFrame, vector: str) -> Column:
    c = vector_to_array(col(vector)) if isinstance(df.schema[vector].dataType, VectorUDT) else col(vector)
    return c.cast("array<double>")


def as_sent(df: DataFrame, vector: str) -> Column:
    """The vector as it is sent to blocks: float columns stay as they are, since their doubles have the same values."""
    return col(vector) if df.schema[vector].dataType.simpleString() == "array<float>" else as_array(df, vector)


def _stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float)


def pack(cols: Sequence[str]) -> Column:
    return F.array(*(col(c).cast("double") for c in cols))


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(centers)))
    for j, c in enumerate(centers):
        out[:, j] = np.sqrt(((x - c) ** 2).sum(axis=1))
    return out


@dataclass(frozen=True)
class Pivots:
    """Cells around pivots, in groups around some of them; ordered so that a group's cells stand together.

    near and far bound the distances of a cell's points from its pivot, reach those of a group's points from its center.
    """

    cells: np.ndarray
    centers: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    near: np.ndarray
    far: np.ndarray
    reach: np.ndarray

    @staticmethod
    def around(points: np.ndarray) -> Pivots:
        centers = points[: math.isqrt(max(0, len(points) - 1)) + 1]
        group = _distances(points, centers).argmin(axis=1)
        order = np.argsort(group, kind="stable")
        zeros = np.zeros(len(points))
        return Pivots(points[order], centers, np.searchsorted(group[order], np.arange(len(centers) + 1)), zeros.astype(np.int64), zeros, zeros, np.zeros(len(centers)))

    def members(self, group: int) -> slice:
        return slice(int(self.starts[group]), int(self.starts[group + 1]))

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell of each row, its distance from the cell's pivot and from the group's center."""
        to_center = _distances(x, self.centers)
        filled = np.diff(self.starts) > 0
        group = np.where(filled[None, :], to_center, np.inf).argmin(axis=1)
        cell, reach = np.empty(len(x), dtype=np.int64), np.empty(len(x))
        for g in np.unique(group):
            rows = np.flatnonzero(group == g)
            d = _distances(x[rows], self.cells[self.members(g)])
            best = d.argmin(axis=1)
            cell[rows], reach[rows] = best + self.starts[g], d[np.arange(len(rows)), best]
        return cell, reach, to_center[np.arange(len(x)), group]

    def within(self, x: np.ndarray, bound: np.ndarray) -> list[np.ndarray]:
        """Cells that can hold a point within its bound of each row."""
        to_center = _distances(x, self.centers)
        found: list[list[np.ndarray]] = [[] for _ in x]
        for g in range(len(self.centers)):
            own = self.members(g)
            rows = np.flatnonzero(to_center[:, g] - self.reach[g] - _slack(to_center[:, g], self.reach[g]) <= bound)
            if own.start == own.stop or not len(rows):
                continue
            d = _distances(x[rows], self.cells[own])
            lower = np.maximum(d - self.far[own], self.near[own] - d) - _slack(d, self.far[own])
            open_ = (lower <= bound[rows, None]) & (self.sizes[own] > 0)
            for k, row in enumerate(rows.tolist()):
                found[row].append(np.flatnonzero(open_[k]) + own.start)
        return [np.concatenate(f).astype(np.int32) if f else np.empty(0, np.int32) for f in found]

    def enough(self, x: np.ndarray, k: int) -> np.ndarray:
        """A distance within which each row has k points for sure, infinity if there are not so many."""
        bound = np.full(len(x), np.inf)
        order = np.argsort(self.sizes > 0, kind="stable")[::-1]
        for s in range(0, len(x), 256):
            part = _distances(x[s : s + 256], self.cells[order]) + self.far[order]
            by = np.argsort(part, axis=1)
            upto = np.cumsum(self.sizes[order][by], axis=1) >= k
            place = upto.argmax(axis=1)
            at = np.arange(len(part))
            bound[s : s + 256] = np.where(upto.any(axis=1), part[at, by[at, place]], np.inf)
        return bound


def _slack(d: np.ndarray, reach: np.ndarray | float) -> np.ndarray:
    return 1e-9 * (d + reach) + 1e-12


def _home_cells(pivots: Pivots):
    @F.pandas_udf("cell int, reach double, center double")
    def home(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for vectors in parts:
            cell, reach, center = pivots.home(_stacked(vectors)) if len(vectors) else (np.empty(0, np.int64), np.empty(0), np.empty(0))
            yield pd.DataFrame({"cell": cell.astype(np.int32), "reach": reach, "center": center})

    return home


def _open_cells(pivots: Pivots, k: int | None, radius: float | None):
    """Cells other than the home cell that can hold a point within the bound of a row."""

    @F.pandas_udf("array<int>")
    def cells(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for vectors, bounds, homes in parts:
            if not len(vectors):
                yield pd.Series([], dtype=object)
                continue
            x, bound = _stacked(vectors), bounds.to_numpy(dtype=float, na_value=np.inf)
            unknown = np.flatnonzero(np.isinf(bound))
            if k is not None and len(unknown):
                bound = bound.copy()
                bound[unknown] = pivots.enough(x[unknown], k)
            if radius is not None:
                bound = np.minimum(bound, radius)
            yield pd.Series([c[c != h] for c, h in zip(pivots.within(x, bound), homes.to_numpy())])

    return cells


class _Windows:
    """Points of a block in windows of bounded size, ordered by cell."""

    def __init__(self, p: pd.DataFrame, pivots: Pivots, rows: int) -> None:
        cells = p["cell"].to_numpy()
        order = np.argsort(cells, kind="stable")
        self.points, self.pivots = p.iloc[order], pivots
        self.vectors, self.cells = _stacked(self.points["_pv"]), cells[order]
        self.norms = (self.vectors**2).sum(axis=1)
        self.own, place = np.unique(self.cells, return_inverse=True)
        self.cuts = [slice(lo, min(lo + rows, len(cells))) for lo in range(0, len(cells), rows)]
        self.spans = [slice(int(place[w.start]), int(place[w.stop - 1]) + 1) for w in self.cuts]

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """[rows, windows]: no point of the window is nearer to the row."""
        if len(self.pivots.cells) == 1:
            return np.zeros((len(x), len(self.cuts)))
        d, far = _distances(x, self.pivots.cells[self.own]), self.pivots.far[self.own]
        lower = np.maximum(d - far, self.pivots.near[self.own] - d) - _slack(d, far)
        return np.stack([lower[:, s].min(axis=1) for s in self.spans], axis=1)


def _first_by_query(i: np.ndarray, dist: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of each query's first k rows by distance and then id, and their ranks from 0; i counts queries."""
    order = np.lexsort((ids, dist, i))
    rank = np.arange(len(i)) - np.searchsorted(i[order], i[order], side="left")
    return order[rank < k], rank[rank < k]


def _nearest_in_block(q: pd.DataFrame, p: pd.DataFrame, k: int, radius: float | None, skip_same: bool, pivots: Pivots, block_rows: int, home_only: bool = False) -> pd.DataFrame:
    """The k nearest points of one block for each of its queries, by distance and then point id.

    Points beyond a query's bound are left out. With home_only, points of a query's home cell alone are met.
    """
    windows = _Windows(p, pivots, block_rows)
    b_all, b_norm, p_ids = windows.vectors, windows.norms, windows.points["_pid"].to_numpy()
    a_all, q_ids = _stacked(q["_qv"]), q["_qid"].to_numpy()
    bounds = q["bound"].to_numpy(dtype=float, na_value=np.inf) if "bound" in q else np.full(len(q), np.inf)
    homes = q["home"].to_numpy() if home_only else None
    found = []
    for start in range(0, len(a_all), QUERY_ROWS):
        a, own_ids = a_all[start : start + QUERY_ROWS], q_ids[start : start + QUERY_ROWS]
        a_norm, limit = (a**2).sum(axis=1), bounds[start : start + QUERY_ROWS].copy()
        if radius is not None:
            limit = np.minimum(limit, radius)
        lower = None if home_only else windows.bounds(a)
        i_held, j_held, d_held = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        # Windows that come near to most rows are first, so that limits fall early.
        order = range(len(windows.cuts)) if home_only else np.argsort(lower.mean(axis=0), kind="stable").tolist()
        for w in order:
            window = windows.cuts[w]
            if home_only:
                home = homes[start : start + QUERY_ROWS]
                rows = np.flatnonzero((home >= windows.cells[window.start]) & (home <= windows.cells[window.stop - 1]))
            else:
                rows = np.flatnonzero(lower[:, w] <= limit)
            if not len(rows):
                continue
            b = b_all[window]
            approx = a_norm[rows, None] + b_norm[window][None, :] - 2.0 * (a[rows] @ b.T)
            if skip_same:
                approx[own_ids[rows][:, None] == p_ids[window][None, :]] = np.inf
            if home_only:
                approx[home[rows][:, None] != windows.cells[window][None, :]] = np.inf
            # The product form rounds, so keep everything within its error of the k-th value and measure those exactly.
            error = 1e-9 * (a_norm[rows].max() + b_norm[window].max()) + 1e-300
            most = limit[rows] ** 2
            unknown = np.flatnonzero(np.isinf(most))
            if len(unknown):
                kth = min(k, approx.shape[1]) - 1
                most[unknown] = np.partition(approx[unknown], kth, axis=1)[:, kth]
            i, j = np.nonzero((approx <= most[:, None] + error) & np.isfinite(approx))
            if not len(i):
                continue
            i, j = rows[i], j + window.start
            d = np.concatenate([np.sqrt(((a[i[s : s + PAIR_SLICE]] - b_all[j[s : s + PAIR_SLICE]]) ** 2).sum(axis=1)) for s in range(0, len(i), PAIR_SLICE)])
            if radius is not None:
                i, j, d = i[d <= radius], j[d <= radius], d[d <= radius]
            i_held, j_held, d_held = np.concatenate([i_held, i]), np.concatenate([j_held, j]), np.concatenate([d_held, d])
            keep, rank = _first_by_query(i_held, d_held, p_ids[j_held], k)
            i_held, j_held, d_held = i_held[keep], j_held[keep], d_held[keep]
            last = rank == k - 1
            limit[i_held[last]] = np.minimum(limit[i_held[last]], d_held[last])
        if len(i_held):
            found.append(pd.DataFrame({"_qid": own_ids[i_held], "_pid": p_ids[j_held], "distance": d_held}))
    if not found:
        return pd.DataFrame({"_qid": q_ids[:0], "_pid": p_ids[:0], "distance": np.empty(0)})
    return pd.concat(found, ignore_index=True)


BLOCK_KEYS = ["block", "chunk", "slice"]


def _cells(p: DataFrame, block_rows: int) -> tuple[DataFrame, Pivots] | None:
    """Points (_pid, _pv) with their cell, and the pivots; None without points. Points of one block are one cell."""
    p = stash(p)
    n = p.count()
    if n == 0:
        return None
    wanted = 1 if n <= block_rows else math.isqrt(n - 1) + 1
    if wanted == 1:
        first = np.array([p.first()["_pv"]], dtype=float)
        return p.withColumn("cell", F.lit(0)), replace(Pivots.around(first), sizes=np.array([n]), far=np.array([np.inf]), reach=np.array([np.inf]))
    chosen = p.orderBy(F.md5(F.col("_pid").cast("string")), "_pid").limit(wanted).select("_pv").collect()
    pivots = Pivots.around(np.array([r["_pv"] for r in chosen], dtype=float))
    homed = stash(p.withColumn("_h", _home_cells(pivots)("_pv")).select(*p.columns, "_h.*"))
    sizes, near, far = (np.zeros(wanted, dtype=kind) for kind in (np.int64, float, float))
    reach = np.zeros(len(pivots.centers))
    group_of = np.repeat(np.arange(len(pivots.centers)), np.diff(pivots.starts))
    for r in homed.groupBy("cell").agg(F.count("*").alias("n"), F.min("reach").alias("near"), F.max("reach").alias("far"), F.max("center").alias("center")).collect():
        c = r["cell"]
        sizes[c], near[c], far[c] = r["n"], r["near"], r["far"]
        reach[group_of[c]] = max(reach[group_of[c]], r["center"])
    return homed.drop("reach", "center"), replace(pivots, sizes=sizes, near=near, far=far, reach=reach)


def _span(rows: int, width: int, block_rows: int) -> int:
    """Rows of one side of a block, so that a table gives work to several tasks and a block stays in bounds."""
    return max(block_rows, min(WIDE_ROWS, WIDE_BYTES // (8 * max(width, 1)), -(-rows // SIDES)))


def _visited(block_of: np.ndarray):
    """Blocks of the cells that a query visits, each once."""

    @F.pandas_udf("array<int>")
    def blocks(cells: pd.Series) -> pd.Series:
        return pd.Series([np.unique(block_of[np.asarray(c, dtype=np.int64)]).astype(np.int32) for c in cells], dtype=object)

    return blocks


def _met(q: DataFrame, p: DataFrame, pivots: Pivots, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Queries with the cells they visit (_cells, and home) and points with their cell, cut into pairs of blocks."""
    width = pivots.cells.shape[1]
    span = _span(int(pivots.sizes.sum()), width, block_rows)
    upto, block, block_of = 0, 0, np.zeros(len(pivots.cells), dtype=np.int32)
    for c, size in enumerate(pivots.sizes.tolist()):
        if upto and upto + size > span:
            block, upto = block + 1, 0
        block_of[c] = block
        upto += size
    held = np.bincount(block_of, weights=pivots.sizes).astype(np.int64)
    cells = F.array_append("_cells", F.col("home")) if "home" in q.columns else F.col("_cells")
    blocks = F.array(F.lit(0)) if block == 0 else _visited(block_of)(cells)
    q = stash(q.withColumn("_blocks", blocks).drop("_cells"))
    asked = {r["block"]: r["n"] for r in q.select(F.explode("_blocks").alias("block")).groupBy("block").agg(F.count("*").alias("n")).collect()}
    side = _span(max(asked.values(), default=0), width, block_rows)
    # One row per pivot, and one per block: into how many parts the block's points and its queries are cut.
    parts = {b: (-(-int(held[b]) // span), -(-n // side)) for b, n in asked.items() if held[b]}
    spark = p.sparkSession
    of_cell = spark.createDataFrame([(c, int(b), *parts[int(b)]) for c, b in enumerate(block_of) if int(b) in parts], "cell int, block int, chunks int, slices int")
    of_block = spark.createDataFrame([(b, *n) for b, n in parts.items()], "block int, chunks int, slices int")
    p_blocks = (
        p.join(F.broadcast(of_cell), "cell")
        .withColumn("chunk", F.pmod(F.xxhash64("_pid"), F.col("chunks")).cast("int"))
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        .select(*BLOCK_KEYS, *p.columns)
    )
    q_blocks = (
        q.select(*(c for c in q.columns if c != "_blocks"), F.explode("_blocks").alias("block"))
        .join(F.broadcast(of_block), "block")
        .withColumn("slice", F.pmod(F.xxhash64("_qid"), F.col("slices")).cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(*BLOCK_KEYS, *(c for c in q.columns if c != "_blocks"))
    )
    # Pairs are long work on few rows, so they are not left to partitions sized by bytes.
    places = max(1, min(4096, 2 * sum(chunks * slices for chunks, slices in parts.values())))
    return q_blocks.repartition(places, *BLOCK_KEYS), p_blocks.repartition(places, *BLOCK_KEYS)


def _blocks(q: DataFrame, p: DataFrame, *, radius: float, block_rows: int) -> tuple[DataFrame, DataFrame, Pivots] | None:
    """Queries (_qid, _qv) and points (_pid, _pv) cut into block pairs that can hold points within radius, and the pivots; None without points."""
    made = _cells(p, block_rows)
    if made is None:
        return None
    homed, pivots = made
    none = F.lit(None).cast("double")
    cells = F.array(F.lit(0)) if len(pivots.cells) == 1 else _open_cells(pivots, None, radius)("_qv", none, F.lit(-1))
    return *_met(q.withColumn("_cells", cells), homed, pivots, block_rows), pivots


def nearest(
    queries: DataFrame,
    points: DataFrame,
    *,
    k: int,
    query_id: str,
    point_id: str,
    query_vector: str,
    point_vector: str | None = None,
    radius: float | None = None,
    skip_same_id: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, neighbour, distance, rank): the k nearest points per query, within radius when one is given."""
    point_vector = point_vector or query_vector
    q_type, p_type = queries.schema[query_id].dataType, points.schema[point_id].dataType
    out_type = T.StructType([T.StructField(query_id, q_type), T.StructField("neighbour", p_type), T.StructField("distance", T.DoubleType()), T.StructField("rank", T.IntegerType())])
    p = points.select(col(point_id).alias("_pid"), as_sent(points, point_vector).alias("_pv"))
    q = queries.select(col(query_id).alias("_qid"), as_sent(queries, query_vector).alias("_qv"))
    made = _cells(p, block_rows)
    if made is None:
        return queries.sparkSession.createDataFrame([], out_type)
    homed, pivots = made
    schema = T.StructType([T.StructField("_qid", q_type), T.StructField("_pid", p_type), T.StructField("distance", T.DoubleType())])
    bound_schema = T.StructType([T.StructField("_qid", q_type), T.StructField("distance", T.DoubleType())])

    def best_in(table: DataFrame, home_only: bool = False) -> DataFrame:
        def block(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if len(left) == 0 or len(right) == 0:
                found = pd.DataFrame({"_qid": left["_qid"].iloc[:0], "_pid": right["_pid"].iloc[:0], "distance": np.empty(0)})
            else:
                found = _nearest_in_block(left, right, k, radius, skip_same_id, pivots, block_rows, home_only)
            return found.groupby("_qid", as_index=False, sort=False)["distance"].agg(["size", "max"]).query("size >= @k")[["_qid", "max"]].rename(columns={"max": "distance"}) if home_only else found

        blocks = _met(table, homed, pivots, block_rows)
        return blocks[0].groupBy(*BLOCK_KEYS).cogroup(blocks[1].groupBy(*BLOCK_KEYS)).applyInPandas(block, bound_schema if home_only else schema)

    order = Window.partitionBy("_qid").orderBy("distance", "_pid")
    if len(pivots.cells) == 1:
        best = best_in(q.withColumn("_cells", F.array(F.lit(0))))
    else:
        homes = stash(q.withColumn("home", _home_cells(pivots)("_qv")["cell"]))
        first = best_in(homes.select("_qid", "_qv", "home", F.array("home").alias("_cells")), home_only=True)
        # The k-th distance at home; a query that met fewer points has none.
        kth = stash(first.groupBy(F.col("_qid").alias("_of")).agg(F.min("distance").alias("bound")))
        bounded = homes.join(kth, F.col("_qid") == F.col("_of"), "left")
        cells = _open_cells(pivots, k + 1 if skip_same_id else k, radius)("_qv", "bound", "home")
        best = best_in(bounded.select("_qid", "_qv", "bound", "home", cells.alias("_cells")))
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(F.col("_qid").alias(query_id), F.col("_pid").alias("neighbour"), "distance", "rank")
    )


def _within(a: np.ndarray, b: np.ndarray, radius: float) -> np.ndarray:
    """Which rows of b lie within radius of which rows of a; values near the border are measured exactly."""
    a_norm, b_norm = (a**2).sum(axis=1), (b**2).sum(axis=1)
    approx = a_norm[:, None] + b_norm[None, :] - 2.0 * (a @ b.T)
    error = 1e-9 * (a_norm.max() + b_norm.max()) + 1e-300
    near = approx <= radius * radius
    i, j = np.nonzero(np.abs(approx - radius * radius) <= error)
    for s in range(0, len(i), PAIR_SLICE):
        u, v = i[s : s + PAIR_SLICE], j[s : s + PAIR_SLICE]
        near[u, v] = ((a[u] - b[v]) ** 2).sum(axis=1) <= radius * radius
    return near


def _near_parts(q: pd.DataFrame, p: pd.DataFrame, radius: float, pivots: Pivots, block_rows: int) -> Iterator[tuple[np.ndarray, pd.DataFrame, np.ndarray]]:
    """Of one block, by parts of bounded size: places of queries, points, and which of them lie within radius of which."""
    windows, x = _Windows(p, pivots, block_rows), _stacked(q["_qv"])
    for start in range(0, len(x), QUERY_ROWS):
        lower = windows.bounds(x[start : start + QUERY_ROWS])
        for w, window in enumerate(windows.cuts):
            rows = start + np.flatnonzero(lower[:, w] <= radius)
            if len(rows):
                yield rows, windows.points.iloc[window], _within(x[rows], windows.vectors[window], radius)


def count_within(table: DataFrame, *, radius: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, near) for a table of (id, v): rows within radius, the row itself included."""
    blocks = _blocks(table.select(F.col("id").alias("_qid"), F.col("v").alias("_qv")), table.select(F.col("id").alias("_pid"), F.col("v").alias("_pv")), radius=radius, block_rows=block_rows)
    schema = T.StructType([T.StructField("id", table.schema["id"].dataType), T.StructField("near", T.LongType())])
    if blocks is None:
        return table.sparkSession.createDataFrame([], schema)
    q_blocks, p_blocks, pivots = blocks

    def block(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) == 0 or len(right) == 0:
            return pd.DataFrame({"id": left["_qid"].iloc[:0], "near": np.empty(0, np.int64)})
        counts = np.zeros(len(left), np.int64)
        for rows, _, near in _near_parts(left, right, radius, pivots, block_rows):
            counts[rows] += near.sum(axis=1)
        return pd.DataFrame({"id": left["_qid"].to_numpy(), "near": counts})

    counted = q_blocks.groupBy(*BLOCK_KEYS).cogroup(p_blocks.groupBy(*BLOCK_KEYS)).applyInPandas(block, schema)
    return counted.groupBy("id").agg(F.sum("near").alias("near"))


def _block_chains(q_ids: np.ndarray, p_ids: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that keep every group of a block connected: each group as one chain in id order."""
    ids, place = np.unique(np.concatenate([q_ids, p_ids]), return_inverse=True)
    q_place, p_place = place[: len(q_ids)], place[len(q_ids) :]
    label = np.arange(len(ids))
    while True:
        was = label.copy()
        low = np.where(near, label[p_place][None, :], len(ids)).min(axis=1)
        np.minimum.at(label, q_place, low)
        low = np.where(near, label[q_place][:, None], len(ids)).min(axis=0)
        np.minimum.at(label, p_place, low)
        label = np.minimum(label, label[label])
        if (label == was).all():
            break
    order = np.lexsort((np.arange(len(ids)), label))
    linked = label[order][1:] == label[order][:-1]
    return ids[order][:-1][linked], ids[order][1:][linked]


def _joined_chains(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same groups as these links make, each as one chain in id order."""
    ids, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, label = place[: len(u)], place[len(u) :], np.arange(len(ids))
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == label[b]).all():
            break
        was = label.copy()
        for end in (a, b):
            np.minimum.at(label, was[end], low)
        while (label[label] != label).any():
            label = label[label]
    order = np.lexsort((np.arange(len(ids)), label))
    linked = label[order][1:] == label[order][:-1]
    return ids[order][:-1][linked], ids[order][1:][linked]


def links_within(table: DataFrame, *, radius: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(u, v) links that connect exactly the rows joined by steps of at most radius; at most one chain per block."""
    blocks = _blocks(table.select(F.col("id").alias("_qid"), F.col("v").alias("_qv")), table.select(F.col("id").alias("_pid"), F.col("v").alias("_pv")), radius=radius, block_rows=block_rows)
    kind = table.schema["id"].dataType
    schema = T.StructType([T.StructField("u", kind), T.StructField("v", kind)])
    if blocks is None:
        return table.sparkSession.createDataFrame([], schema)
    q_blocks, p_blocks, pivots = blocks

    def block(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) == 0 or len(right) == 0:
            return pd.DataFrame({"u": left["_qid"].iloc[:0], "v": left["_qid"].iloc[:0]})
        ids, chains, held = left["_qid"].to_numpy(), [], 0
        for rows, points, near in _near_parts(left, right, radius, pivots, block_rows):
            chains.append(_block_chains(ids[rows], points["_pid"].to_numpy(), near))
            held += len(chains[-1][0])
            if held > LINKS_HELD:
                chains = [_joined_chains(*(np.concatenate(x) for x in zip(*chains)))]
                held = 0
        u, v = _joined_chains(*(np.concatenate(x) for x in zip(*chains))) if chains else (ids[:0], ids[:0])
        return pd.DataFrame({"u": u, "v": v})

    return q_blocks.groupBy(*BLOCK_KEYS).cogroup(p_blocks.groupBy(*BLOCK_KEYS)).applyInPandas(block, schema).distinct()


def smallest_within(queries: DataFrame, points: DataFrame, *, radius: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, number): smallest number of the points (id, v, number) within radius of each query (id, v) that has one."""
    q = queries.select(F.col("id").alias("_qid"), F.col("v").alias("_qv"))
    p = points.select(F.col("id").alias("_pid"), F.col("v").alias("_pv"), F.col("number").cast("bigint").alias("_number"))
    blocks = _blocks(q, p, radius=radius, block_rows=block_rows)
    schema = T.StructType([T.StructField("id", queries.schema["id"].dataType), T.StructField("number", T.LongType())])
    if blocks is None:
        return queries.sparkSession.createDataFrame([], schema)
    q_blocks, p_blocks, pivots = blocks

    def block(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) == 0 or len(right) == 0:
            return pd.DataFrame({"id": left["_qid"].iloc[:0], "number": np.empty(0, np.int64)})
        none = np.iinfo(np.int64).max
        low = np.full(len(left), none)
        for rows, points, near in _near_parts(left, right, radius, pivots, block_rows):
            low[rows] = np.minimum(low[rows], np.where(near, points["_number"].to_numpy()[None, :], none).min(axis=1))
        hit = low < none
        return pd.DataFrame({"id": left["_qid"].to_numpy()[hit], "number": low[hit]})

    return q_blocks.groupBy(*BLOCK_KEYS).cogroup(p_blocks.groupBy(*BLOCK_KEYS)).applyInPandas(block, schema).groupBy("id").agg(F.min("number").alias("number"))


def vote(neighbours: DataFrame, labels: DataFrame, *, query_id: str, point_id: str, label: str) -> DataFrame:
    """Majority label of the neighbours; ties go to the smallest label."""
    named = neighbours.join(labels.select(col(point_id).alias("neighbour"), col(label).alias("y_pred")), "neighbour")
    counts = named.groupBy(col(query_id), "y_pred").agg(F.count("*").alias("votes"))
    rank = F.row_number().over(Window.partitionBy(col(query_id)).orderBy(F.desc("votes"), "y_pred"))
    return counts.withColumn("_r", rank).filter("_r = 1").drop("_r")


def neighbour_mean(neighbours: DataFrame, values: DataFrame, *, query_id: str, point_id: str, value: str, weights: str = "uniform") -> DataFrame:
    """Mean of the neighbours' values, uniform or by inverse distance; exact matches outweigh all others."""
    named = neighbours.join(values.select(col(point_id).alias("neighbour"), col(value).cast("double").alias("_v")), "neighbour")
    if weights == "uniform":
        return named.groupBy(col(query_id)).agg(F.avg("_v").alias("y_pred"))
    same = F.col("distance") == 0
    w = 1 / F.when(~same, F.col("distance"))
    return named.groupBy(col(query_id)).agg(F.coalesce(F.avg(F.when(same, F.col("_v"))), F.sum(F.col("_v") * w) / F.sum(w)).alias("y_pred"))
