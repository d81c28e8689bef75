"""Partial least squares projection on class indicators.

One distributed pass gives the correlation matrix of features and indicators. The components follow from that
feature x feature matrix alone, whose size does not depend on the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame, functions as F

from tabloom.functions.labels import indicators
from tabloom.operators.clean import col


@dataclass(frozen=True)
class PlsProjection:
    mean: np.ndarray
    std: np.ndarray
    rotation: np.ndarray
    features_col: str
    output_col: str

    def transform(self, df: DataFrame) -> DataFrame:
        matrix = self.rotation / self.std[:, None]
        shift = self.mean @ matrix

        @F.pandas_udf("array<double>")
        def project(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for vectors in parts:
                if len(vectors) == 0:
                    yield pd.Series([], dtype=object)
                else:
                    yield pd.Series(list(np.stack(vectors.to_numpy()) @ matrix - shift))

        return df.withColumn(self.output_col, array_to_vector(project(vector_to_array(col(self.features_col)))))


def pls_rotation(sxx: np.ndarray, sxy: np.ndarray, components: int) -> np.ndarray:
    """Rotation from standardised features to scores, from their correlations with each other and with the targets."""
    weights, loadings = [], []
    sxx, sxy = sxx.copy(), sxy.copy()
    for _ in range(components):
        left, strength, _ = np.linalg.svd(sxy, full_matrices=False)
        if strength[0] < 1e-10:
            break
        w = left[:, 0] * (1.0 if left[np.abs(left[:, 0]).argmax(), 0] >= 0 else -1.0)
        variance = w @ sxx @ w
        if variance < 1e-12:
            break
        p, q = sxx @ w / variance, sxy.T @ w / variance
        sxx -= variance * np.outer(p, p)
        sxy -= variance * np.outer(p, q)
        weights.append(w)
        loadings.append(p)
    if not weights:
        raise ValueError("The features carry no information about the label")
    w, p = np.array(weights).T, np.array(loadings).T
    return w @ np.linalg.pinv(p.T @ w)


def fit_pls(df: DataFrame, *, label_col: str, classes: Sequence[str], components: int = 10, features_col: str = "features", output_col: str = "pls") -> PlsProjection:
    marks = indicators(col(label_col), classes)
    if len(classes) == 2:
        marks = marks[1:]
    names = [f"_y{i}" for i in range(len(marks))]
    wide = df.select(col(features_col), *(m.cast("double").alias(n) for m, n in zip(marks, names)))
    joint = VectorAssembler(inputCols=[features_col, *names], outputCol="_xy").transform(wide)
    stats = joint.select(Summarizer.metrics("mean", "std").summary(F.col("_xy")).alias("s")).select("s.mean", "s.std").first()
    matrix = np.nan_to_num(Correlation.corr(joint, "_xy").first()[0].toArray(), nan=0.0)
    d = matrix.shape[0] - len(names)
    std = stats["std"].toArray()[:d]
    std = np.where(std == 0, 1.0, std)
    rotation = pls_rotation(matrix[:d, :d], matrix[:d, d:], min(components, d))
    return PlsProjection(stats["mean"].toArray()[:d], std, rotation, features_col, output_col)
