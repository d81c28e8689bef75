"""Gradient boosting on binned features: one softmax ensemble for all classes, or one for a regression.

Features are cut into bins once and kept in blocks of rows. A round grows the trees of all classes together, level by
level: each block sums gradients by class, node and bin, the sums of all blocks are added up, and the best split of
each node follows from the sums alone. What reaches the driver is one histogram per class and node, or the partial sums of
a few blocks; rows stay where they are. Samples of rows and columns depend on ids, round and seed only. Margins are
part of the blocks' state, which is checkpointed every few rounds, so a lost executor costs those rounds and not the fit.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, functions as F

from tabloom.operators.clean import col
from tabloom.session import shared_dir, stash

BLOCK_ROWS = 50_000
MOST_BINS = 256
CHECKPOINT_ROUNDS = 20
DIRECT_BLOCKS = 16  # up to so many partial sums are added on the driver, more of them by a shuffle first
TINY = 1e-16


@dataclass(frozen=True)
class Boosting:
    """rows and columns are the shares of rows per round and of columns per tree; l2 and least_weight bound the leaves."""

    rounds: int
    max_depth: int
    rate: float
    rows: float = 1.0
    columns: float = 1.0
    l2: float = 1.0
    least_weight: float = 1.0
    bins: int = MOST_BINS
    seed: int = 42


@dataclass(frozen=True)
class Bins:
    """Cut points of each feature, ascending: a value is in the bin of the first cut that is not below it."""

    cuts: tuple[tuple[float, ...], ...]

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum([len(c) + 1 for c in self.cuts])]).astype(np.int64)

    def place(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(values.shape, dtype=np.uint8)
        for f, cuts in enumerate(self.cuts):
            out[:, f] = np.searchsorted(cuts, values[:, f], side="left")
        return out


def find_bins(df: DataFrame, features_col: str, most: int = MOST_BINS) -> Bins:
    """At most `most` bins a feature, at its quantiles; one row a feature comes to the driver."""
    values = df.select(F.posexplode(vector_to_array(col(features_col))).alias("feature", "value"))
    shares = [k / most for k in range(1, most)]
    found = values.groupBy("feature").agg(F.percentile_approx("value", shares, 20 * most).alias("cuts"), F.max("value").alias("top"))
    return Bins(tuple(tuple(sorted({c for c in r["cuts"] if c < r["top"]})) for r in sorted(found.collect(), key=lambda r: r["feature"])))


@dataclass(frozen=True)
class Block:
    keys: np.ndarray
    bins: np.ndarray
    label: np.ndarray
    margins: np.ndarray


@dataclass(frozen=True)
class Trees:
    """Trees of one round, one row a class, in heap order: children of i are 2i + 1 and 2i + 2; feature -1 is a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    @staticmethod
    def empty(classes: int, depth: int) -> Trees:
        shape = (classes, (1 << (depth + 1)) - 1)
        return Trees(np.full(shape, -1, dtype=np.int32), np.zeros(shape, dtype=np.int32), np.zeros(shape))

    def places(self, bins: np.ndarray, steps: int) -> np.ndarray:
        """Node of each row in each class's tree after so many steps."""
        at = np.zeros((len(self.feature), len(bins)), dtype=np.intp)
        flat, first = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
        for own, feature, cut in zip(at, self.feature, self.bin):
            for _ in range(steps):
                f = feature.take(own)
                # A leaf looks up the bin before the row's first one, which is left unused.
                own[:] = np.where(f >= 0, 2 * own + 1 + (flat.take(first + f, mode="clip") > cut.take(own)), own)
        return at.T

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return self.value[np.arange(len(self.feature))[None, :], self.places(bins, self.feature.shape[1].bit_length() - 1)]


def shares_of(margins: np.ndarray) -> np.ndarray:
    by_class = np.ascontiguousarray(margins.T)
    odds = np.exp(by_class - by_class.max(axis=0))
    return (odds / odds.sum(axis=0)).T


def gradients(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss: softmax over several margins, half the squared error of one."""
    if block.margins.shape[1] == 1:
        return block.margins - block.label[:, None], np.ones_like(block.margins)
    p = shares_of(block.margins)
    truth = np.arange(p.shape[1])[None, :] == block.label[:, None]
    return p - truth, np.maximum(2 * p * (1 - p), TINY)


def block_loss(block: Block) -> np.ndarray:
    """(summed loss, rows)."""
    if block.margins.shape[1] == 1:
        return np.array([((block.margins[:, 0] - block.label) ** 2).sum(), len(block.label)])
    p = shares_of(block.margins)
    return np.array([-np.log(np.maximum(p[np.arange(len(p)), block.label.astype(np.int64)], TINY)).sum(), len(p)])


def sampled(keys: np.ndarray, share: float, salt: int) -> np.ndarray:
    if share >= 1:
        return np.ones(len(keys), dtype=bool)
    # Multipliers of a public 64-bit mixing function.
    x = keys + np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(share * ((1 << 64) - 1)))


def level_sums(block: Block, trees: Trees, level: int, starts: np.ndarray, share: float, salt: int, left: bool = False) -> np.ndarray:
    """[2, classes, nodes of the level, bins of all features]: sums of both derivatives; with left, of left children alone."""
    chosen = sampled(block.keys, share, salt)
    first, nodes, width = (1 << level) - 1, 1 << level, int(starts[-1])
    at = trees.places(block.bins, level) - first
    g, h = gradients(block)
    columns = np.ascontiguousarray(block.bins.T)
    if left:
        at, nodes = np.where(at % 2 == 0, at >> 1, -1), nodes // 2
    out = np.zeros((2, at.shape[1], nodes, width))
    for k in range(at.shape[1]):
        rows = np.flatnonzero(chosen & (at[:, k] >= 0))
        node, weights = at[:, k].take(rows), (g[:, k].take(rows), h[:, k].take(rows))
        # One feature at a time: its few counters stay in the processor's cache.
        for f, (lo, hi) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
            index = node * (hi - lo) + columns[f].take(rows)
            for side in (0, 1):
                out[side, k, :, lo:hi] = np.bincount(index, weights=weights[side], minlength=nodes * (hi - lo)).reshape(nodes, hi - lo)
    return out


def both_children(parents: np.ndarray, left: np.ndarray, split: np.ndarray) -> np.ndarray:
    """Sums of a level's nodes from those of their parents and of the left ones; split tells which parents were split."""
    right = np.where(split[None, :, :, None], parents - left, 0.0)
    return np.stack([left, right], axis=3).reshape(*left.shape[:2], -1, left.shape[3])


def best_splits(sums: np.ndarray, starts: np.ndarray, allowed: np.ndarray, plan: Boosting) -> dict[str, np.ndarray]:
    """Feature, bin and both sides' leaf values for each class and node; feature -1 where no split gains."""
    total = sums[..., starts[0] : starts[1]].sum(axis=-1)
    run = np.cumsum(sums, axis=-1)
    before = np.concatenate([np.zeros_like(run[..., :1]), run[..., starts[1:-1] - 1]], axis=-1)
    feature_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    left = run - before[..., feature_of]
    right = total[..., None] - left
    last = np.zeros(int(starts[-1]), dtype=bool)
    last[starts[1:] - 1] = True
    score = lambda s: s[0] ** 2 / np.maximum(s[1] + plan.l2, TINY)
    gain = score(left) + score(right) - score(total)[..., None]
    fits = (left[1] >= plan.least_weight) & (right[1] >= plan.least_weight) & ~last & allowed[:, None, feature_of]
    gain = np.where(fits, gain, -np.inf)
    # Gains that differ by rounding alone count as equal, so that the first one wins whatever the order of the sums.
    best = gain.astype(np.float32).argmax(axis=-1)
    pick = lambda x: np.take_along_axis(x, best[..., None], axis=-1)[..., 0]
    leaf = lambda s: -plan.rate * s[0] / np.maximum(s[1] + plan.l2, TINY)
    found = np.where(pick(gain) > 1e-9, feature_of[best], -1)
    sides = [leaf(np.stack([pick(side[0]), pick(side[1])])) for side in (left, right)]
    return {"feature": found, "bin": best - starts[feature_of[best]], "left": sides[0], "right": sides[1], "own": leaf(total)}


def summed_margins(placed: np.ndarray, base: np.ndarray, rounds: list[Trees]) -> np.ndarray:
    out = np.tile(base, (len(placed), 1))
    for trees in rounds:
        out += trees.margins(placed)
    return out


def _added(parts: RDD, blocks: int) -> np.ndarray:
    if blocks <= DIRECT_BLOCKS:
        return reduce(np.add, parts.collect())
    return parts.treeReduce(np.add, depth=max(2, (blocks - 1).bit_length() // 4))


def _blocks(df: DataFrame, bins: Bins, *, features_col: str, label_col: str, id_col: str, base: np.ndarray) -> RDD:
    """The rows with their bins and first margins, in blocks of bounded size, written to the shared folder first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            values = lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            columns = [batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.float64), bins.place(values)]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in columns], names=["keys", "label", "bins"])

    rows = df.select(F.xxhash64(col(id_col)).alias("key"), col(label_col).cast("double").alias("label"), vector_to_array(col(features_col)).alias("values"))
    wanted, cores = max(1, -(-df.count() // BLOCK_ROWS)), df.sparkSession.sparkContext.defaultParallelism
    if wanted > 1:  # every core gets as many blocks
        wanted = -(-wanted // cores) * cores
    written = stash(rows.repartition(wanted, "key").mapInArrow(run, "keys binary, label binary, bins binary"))
    width = len(bins.cuts)

    def whole(parts) -> Iterator[Block]:
        found = [[np.frombuffer(x, dtype=kind) for x, kind in zip(r, (np.uint64, np.float64, np.uint8))] for r in parts]
        if found:
            keys, label, placed = (np.concatenate(x) for x in zip(*found))
            yield Block(keys, placed.reshape(-1, width), label, np.tile(base, (len(keys), 1)))

    return written.rdd.mapPartitions(whole)


class BoostedModel(Model, MLReadable, MLWritable):
    """Fitted trees. transform adds prediction and, for classes, rawPrediction (margins) and probability.

    losses has the mean training loss before the first round and after each: log loss, or squared error.
    """

    def __init__(self, bins: Bins, base: np.ndarray, trees: list[Trees], losses: list[float], features_col: str = "features") -> None:
        super().__init__()
        self.bins, self.base, self.losses, self.features_col = bins, base, losses, features_col
        self.trees = trees

    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast((self.bins, self.base, self.trees))

        @F.pandas_udf("array<double>")
        def margins(features: pd.Series) -> pd.Series:
            bins, base, trees = shared.value
            if not len(features):
                return pd.Series([], dtype=object)
            return pd.Series([*summed_margins(bins.place(np.stack(features.to_numpy())), base, trees)])

        # Margins are kept in one column, so they are computed once for all that is derived from them.
        scored = df.withColumn("_margins", margins(vector_to_array(col(self.features_col))))
        if len(self.base) == 1:
            return scored.withColumn("prediction", F.col("_margins")[0]).drop("_margins")
        odds = F.transform("_margins", lambda m: F.exp(m - F.array_max("_margins")))
        shares = F.transform(odds, lambda v: v / F.aggregate(odds, F.lit(0.0), lambda a, x: a + x))
        best = (F.array_position("_margins", F.array_max("_margins")) - 1).cast("double")
        return scored.withColumns({"rawPrediction": array_to_vector("_margins"), "probability": array_to_vector(shares), "prediction": best}).drop("_margins")

    def write(self) -> MLWriter:
        return _BoostedWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _BoostedReader()


class _BoostedWriter(MLWriter):
    """Metadata as other models have it, and the trees as a table with one row a round."""

    def __init__(self, model: BoostedModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, spark = self.model, self.sparkSession
        extra = {"cuts": m.bins.cuts, "base": m.base.tolist(), "losses": m.losses, "features_col": m.features_col}
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={"boosted": json.dumps(extra)})
        rows = [(k, t.feature.tolist(), t.bin.tolist(), t.value.tolist()) for k, t in enumerate(m.trees)]
        schema = "round int, feature array<array<int>>, bin array<array<int>>, value array<array<double>>"
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/trees")


class _BoostedReader(MLReader):
    def load(self, path: str) -> BoostedModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        extra = json.loads(metadata["boosted"])
        rows = sorted(spark.read.parquet(f"{path}/trees").collect(), key=lambda r: r["round"])
        trees = [Trees(np.array(r["feature"], dtype=np.int32), np.array(r["bin"], dtype=np.int32), np.array(r["value"])) for r in rows]
        model = BoostedModel(Bins(tuple(map(tuple, extra["cuts"]))), np.array(extra["base"]), trees, extra["losses"], extra["features_col"])
        model._resetUid(metadata["uid"])
        return model


def fit_boosted(df: DataFrame, plan: Boosting, *, classes: int = 0, features_col: str = "features", label_col: str = "label", id_col: str = "row_id") -> BoostedModel:
    """Trees of all classes (labels 0 .. classes - 1), or of a regression where classes is 0.

    First margins are the log shares of the classes, or the label's mean. A class that does not occur keeps a tiny share.
    Rows are told apart by the hash of id_col; all of them must have a label.
    """
    spark = df.sparkSession
    if classes:
        counts = {int(r["label"]): r["rows"] for r in df.groupBy(col(label_col).alias("label")).agg(F.count("*").alias("rows")).collect()}
        total = max(1, sum(counts.values()))
        base = np.log(np.maximum([counts.get(k, 0) / total for k in range(classes)], TINY))
    else:
        base = np.array([df.agg(F.avg(col(label_col))).first()[0] or 0.0])
    bins = find_bins(df, features_col, plan.bins)
    starts = bins.starts
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    state = _blocks(df, bins, features_col=features_col, label_col=label_col, id_col=id_col, base=base).persist(StorageLevel.MEMORY_AND_DISK)
    blocks, width = state.getNumPartitions(), len(bins.cuts)
    before: RDD | None = None
    done: list[Trees] = []
    losses: list[float] = []
    nothing = [np.zeros((2, len(base), 1, int(starts[-1]))), np.zeros(2)]

    def loss_and_first_sums(parts: Iterator[Block], trees: Trees, salt: int) -> Iterator[np.ndarray]:
        out = list(nothing)
        for block in parts:
            out = [out[0] + level_sums(block, trees, 0, starts, plan.rows, salt), out[1] + block_loss(block)]
        yield np.concatenate([out[0].ravel(), out[1]])

    def sums_of(parts: Iterator[Block], trees: Trees, level: int, salt: int) -> Iterator[np.ndarray]:
        yield reduce(np.add, (level_sums(b, trees, level, starts, plan.rows, salt, left=True) for b in parts), np.zeros((2, len(base), 1 << (level - 1), int(starts[-1]))))

    for turn in range(plan.rounds if width else 0):
        trees = Trees.empty(len(base), plan.max_depth)
        salt = plan.seed * 1_000_003 + turn
        draw = np.random.default_rng([plan.seed, turn])
        used = max(1, int(width * plan.columns))
        allowed = np.zeros((len(base), width), dtype=bool)
        for k in range(len(base)):
            allowed[k, draw.permutation(width)[:used]] = True
        for level in range(plan.max_depth):
            if level:
                # Right children have what the left ones leave of their parents: half the rows to add, half the sums to send.
                sums = both_children(sums, _added(state.mapPartitions(lambda p, t=trees, n=level, s=salt: sums_of(p, t, n, s)), blocks), found["feature"] >= 0)
            else:
                flat = _added(state.mapPartitions(lambda p, t=trees, s=salt: loss_and_first_sums(p, t, s)), blocks)
                losses.append(float(flat[-2] / max(flat[-1], 1)))
                if before is not None:
                    before.unpersist()
                sums = flat[:-2].reshape(nothing[0].shape)
            found = best_splits(sums, starts, allowed, plan)
            first = (1 << level) - 1
            at = np.arange(first, 2 * first + 1)
            if not level:
                trees.value[:, 0] = found["own"][:, 0]
            trees.feature[:, at], trees.bin[:, at] = found["feature"], found["bin"]
            for side, name in ((1, "left"), (2, "right")):
                trees.value[:, 2 * at + side] = np.where(found["feature"] >= 0, found[name], 0.0)
            if (found["feature"] < 0).all():
                break
        done.append(trees)
        before, state = state, state.map(lambda b, t=trees: replace(b, margins=b.margins + t.margins(b.bins))).persist(StorageLevel.MEMORY_AND_DISK)
        if len(done) % CHECKPOINT_ROUNDS == 0:
            state.checkpoint()
    last = _added(state.mapPartitions(lambda p: iter([reduce(np.add, map(block_loss, p), np.zeros(2))])), blocks)
    losses.append(float(last[0] / max(last[1], 1)))
    for kept in filter(None, (before, state)):
        kept.unpersist()
    return BoostedModel(bins, base, done, losses, features_col)
