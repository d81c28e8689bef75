"""Sequential forward and backward feature selection by cross-validated accuracy.

The classifier of the search is a weighted ridge fit of one score per class, the largest score winning. Its fits need
only sums of products, so one pass gathers these for each fold. From the inverse for the features kept so far, the fit
with one feature more, or one less, is a single update: to each score it adds a multiple of one combination of the
features. So a step is one more pass, which counts the hits of all options in all folds at once, and no fit at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.operators.clean import col
from tabloom.session import stash

WIDEST = 4096  # sums of products are a square of the width


@dataclass(frozen=True)
class Selection:
    """Kept vector positions in the order they were chosen, and the accuracy after each step."""

    kept: tuple[int, ...]
    scores: tuple[float, ...]
    features_col: str
    output_col: str

    def transform(self, df: DataFrame) -> DataFrame:
        return VectorSlicer(inputCol=self.features_col, outputCol=self.output_col, indices=sorted(self.kept)).transform(df)


def fold_of(id_col: str, folds: int, seed: int = 42) -> Column:
    """Fold number from a seeded digest of the row id, so folds do not depend on partitioning."""
    digest = F.md5(F.concat_ws(":", F.lit(f"fold{seed}"), col(id_col).cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % folds).cast("int")


@dataclass(frozen=True)
class Step:
    """Scores of the features kept so far (base), and of each option: base + (row . shift) * factor."""

    base: np.ndarray
    shift: np.ndarray
    factor: np.ndarray


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """Features with a one in front."""
    values = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    return np.concatenate([np.ones((batch.num_rows, 1)), values], axis=1)


def fold_products(table: DataFrame, *, classes: int, width: int, folds: int) -> tuple[np.ndarray, np.ndarray]:
    """Weighted sums of products of the features with each other and with the class marks, for each fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((folds, width + 1, width + 1 + classes))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, fold, label, weight = _matrix(batch), *(batch.column(c).to_numpy() for c in ("fold", "label", "weight"))
            marks = (label[:, None] == np.arange(classes)[None, :]).astype(float)
            for f in range(folds):
                own = fold == f
                sums[f] += (x[own] * weight[own, None]).T @ np.concatenate([x[own], marks[own]], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(folds), width + 1)), pa.array(np.tile(np.arange(width + 1), folds)), pa.array([*sums.reshape(-1, width + 1 + classes)])], names=["fold", "row", "sums"]
        )

    def add(group: pa.Table) -> pa.Table:
        total = np.stack(group.column("sums").to_pylist()).sum(axis=0)
        return pa.table({"fold": group.column("fold").slice(0, 1), "row": group.column("row").slice(0, 1), "sums": pa.array([total])})

    schema = "fold long, row long, sums array<double>"
    out = np.zeros((folds, width + 1, width + 1 + classes))
    for r in table.mapInArrow(run, schema).groupBy("fold", "row").applyInArrow(add, schema).collect():
        out[r["fold"], r["row"]] = r["sums"]
    return out[..., : width + 1], out[..., width + 1 :]


def step_of(gram: np.ndarray, target: np.ndarray, kept: list[int], options: list[int], *, forward: bool, ridge: float) -> Step:
    """The fit on the kept features and its update for each option; positions count from the intercept's 0."""
    penalty = ridge * (np.arange(len(gram)) > 0)
    full = gram + np.diag(penalty)
    own = [0, *(k + 1 for k in kept)]
    inverse = np.linalg.pinv(full[np.ix_(own, own)], hermitian=True)
    fit = inverse @ target[own]
    base = np.zeros((len(gram), target.shape[1]))
    base[own] = fit
    shift = np.zeros((len(gram), len(options)))
    at = [k + 1 for k in options]
    if forward:
        # What is left of an option's feature after the kept ones explain it, and what that explains of the marks.
        explained = inverse @ full[np.ix_(own, at)]
        rest = full[at, at] - (full[np.ix_(at, own)] * explained.T).sum(axis=1)
        left = target[at] - full[np.ix_(at, own)] @ fit
        shift[own] = -explained
        shift[at, np.arange(len(at))] += 1.0
        factor = np.where(rest[:, None] > 1e-9 * np.maximum(full[at, at], 1e-300)[:, None], left / np.where(rest > 0, rest, 1.0)[:, None], 0.0)
    else:
        place = [own.index(k) for k in at]
        shift[own] = -inverse[:, place] / inverse[place, place]
        factor = fit[place]
    return Step(base, shift, factor)


def _hits(table: DataFrame, steps: list[Step], folds: int) -> np.ndarray:
    """Rows of each fold that each option's fit gets right."""
    shared = table.sparkSession.sparkContext.broadcast(steps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = np.zeros((folds, steps_wide), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, fold, label = _matrix(batch), batch.column("fold").to_numpy(), batch.column("label").to_numpy()
            for f, step in enumerate(shared.value):
                rows = x[fold == f]
                base, moved = rows @ step.base, rows @ step.shift
                for k in range(steps_wide):
                    told = (base + moved[:, k : k + 1] * step.factor[k]).argmax(axis=1)
                    hits[f, k] += int((told == label[fold == f]).sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(folds), steps_wide)), pa.array(np.tile(np.arange(steps_wide), folds)), pa.array(hits.ravel())], names=["fold", "option", "hits"])

    steps_wide = steps[0].shift.shape[1]
    out = np.zeros((folds, steps_wide))
    for r in table.mapInArrow(run, "fold long, option long, hits long").groupBy("fold", "option").agg(F.sum("hits").alias("hits")).collect():
        out[r["fold"], r["option"]] = r["hits"]
    return out


def select_features(
    df: DataFrame,
    *,
    id_col: str,
    label_col: str,
    classes: int,
    width: int,
    keep: int | None = None,
    direction: str = "forward",
    folds: int = 5,
    ridge: float = 1.0,
    weight_col: str | None = None,
    features_col: str = "features",
    output_col: str = "selected",
) -> Selection:
    """Greedy search over labels 0 .. classes - 1; keep defaults to min(50, width - 1); ties go to the first feature.

    An option's score is the mean over folds of the share of a fold's rows that the fit on all other folds gets right,
    rows without weights, folds without rows left out. ridge weighs squared coefficients against the weighted summed loss.
    """
    if direction not in ("forward", "backward"):
        raise ValueError("direction must be forward or backward")
    if width > WIDEST:
        raise ValueError(f"{width} features; sums of products are held for {WIDEST} at most")
    keep = min(50, max(1, width - 1)) if keep is None else keep
    if width <= 1:
        return Selection(tuple(range(width)), (), features_col, output_col)
    weight = col(weight_col).cast("double") if weight_col else F.lit(1.0)
    table = stash(df.select(vector_to_array(col(features_col)).alias("features"), col(label_col).cast("double").alias("label"), weight.alias("weight"), fold_of(id_col, folds).alias("fold")))
    gram, target = fold_products(table, classes=classes, width=width, folds=folds)
    sizes = {r["fold"]: r["rows"] for r in table.groupBy("fold").agg(F.count("*").alias("rows")).collect()}
    present = [f for f in range(folds) if sizes.get(f)]
    forward = direction == "forward"
    chosen: list[int] = [] if forward else [*range(width)]
    scores: list[float] = []
    while len(chosen) != keep:
        options = [k for k in range(width) if k not in chosen] if forward else sorted(chosen)
        steps = [step_of(gram.sum(axis=0) - gram[f], target.sum(axis=0) - target[f], chosen, options, forward=forward, ridge=ridge) for f in range(folds)]
        hits = _hits(table, steps, folds)
        shares = np.mean([hits[f] / sizes[f] for f in present], axis=0) if present else np.zeros(len(options))
        best = int(np.argmax(shares))
        chosen = [*chosen, options[best]] if forward else [k for k in chosen if k != options[best]]
        scores.append(float(shares[best]))
    return Selection(tuple(chosen), tuple(scores), features_col, output_col)
