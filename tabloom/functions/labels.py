"""Label indices, indicators and class probabilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F


def _array(classes: Sequence[str]) -> Column:
    return F.array(*(F.lit(str(c)) for c in classes))


def encode_label(c: Column, classes: Sequence[str]) -> Column:
    """Index of the label in class order; a label outside the list gives null."""
    place = F.array_position(_array(classes), c.cast("string"))
    return F.nullif(place, F.lit(0)).cast("int") - 1


def decode_label(c: Column, classes: Sequence[str]) -> Column:
    """Label at the index; an index outside the list gives an empty text."""
    index = c.cast("int")
    return F.when(index >= 0, F.coalesce(F.get(_array(classes), index), F.lit(""))).otherwise(F.lit(""))


def indicators(c: Column, classes: Sequence[str]) -> list[Column]:
    return [F.coalesce(c.cast("string") == F.lit(str(k)), F.lit(False)).cast("int") for k in classes]


def top_probability(probability: Column) -> Column:
    return F.array_max(vector_to_array(probability))


def l2_norm(values: Column) -> Column:
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x * x))


def mean_abs(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + F.abs(x)) / F.size(values)


def json_or(c: Column, path: str, dtype: str, default: object) -> Column:
    """Value at a JSON path cast to dtype, or the default when the path is absent."""
    return F.coalesce(F.get_json_object(c, path).try_cast(dtype), F.lit(default).cast(dtype))
