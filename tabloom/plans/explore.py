"""The exploration tables behind each chart, for any event table with the named columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.agents import device_of
from tabloom.functions.text import first_part, label_or
from tabloom.operators.clean import col
from tabloom.operators.encode import fit_pca
from tabloom.operators.metrics import cluster_sizes
from tabloom.operators.slices import (
    column_values,
    count_by,
    cross_counts,
    keep_top,
    pivot_counts,
    rows_by_total,
    top_per_group,
    value_counts,
    values_by_total,
    with_share,
)


def label_by_period(df: DataFrame, label: str, time_col: str, period: str = "year") -> DataFrame:
    """Label x period counts; periods ascend, labels are ordered by total for years and by period for months."""
    part = {"year": F.year, "month": F.month}[period](col(time_col))
    counts = df.select(label_or(col(label)).alias("label"), part.alias("period")).groupBy("label", "period").agg(F.count("*").alias("count"))
    if period == "year":
        return rows_by_total(pivot_counts(counts, "label", "period", values=column_values(counts, "period")), "label")
    return pivot_counts(counts, "period", "label", values=column_values(counts, "label")).orderBy("period")


def browser_totals(df: DataFrame, agent: str) -> DataFrame:
    return value_counts(df.select(first_part(col(agent), "/").alias("browser")), "browser")


def device_shares(df: DataFrame, agent: str, k: int = 25) -> DataFrame:
    """Top device words with their percent of the rows shown."""
    top = value_counts(df.select(device_of(col(agent)).alias("device_os")), "device_os").limit(k)
    return with_share(top).withColumn("percent", F.round(F.col("share") * 100, 1)).drop("share")


def paired_counts(df: DataFrame, row: Column, column: Column, *, missing: str = "Unknown", merge_unknown: bool = False) -> DataFrame:
    return cross_counts(df.select(row.alias("row"), column.alias("column")), "row", "column", missing=missing, merge_unknown=merge_unknown)


def devices_per_source(df: DataFrame, source: str, agent: str, k: int = 15) -> DataFrame:
    """Pivot of the k most frequent devices of each source; columns by total, sources in order."""
    counts = count_by(df.select(col(source).alias("source"), device_of(col(agent)).alias("device")), ["source", "device"], missing="Unknown")
    top = top_per_group(counts, "source", "device", k).drop("rank")
    return pivot_counts(top, "source", "device").orderBy("source")


def top_values_by_label(df: DataFrame, value: str, label: str, *, k: int = 25, missing: str = "Unknown", merge_unknown: bool = False) -> DataFrame:
    """Counts per (value, label) for the k largest values; the rows are counted once and the rest works on counts."""
    named = df.select(label_or(col(value), missing, merge_unknown=merge_unknown).alias("value"), label_or(col(label)).alias("label"))
    return keep_top(named.groupBy("value", "label").agg(F.count("*").alias("count")), "value", k, weight="count")


def top_values_pivot(df: DataFrame, value: str, label: str, **options) -> DataFrame:
    counts = top_values_by_label(df, value, label, **options)
    return rows_by_total(pivot_counts(counts, "value", "label", values=values_by_total(counts, "label")), "value")


def class_balance(df: DataFrame, label: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Counts and shares of each label, overall or within a split."""
    return with_share(count_by(df, [*by, label]), by)


def cluster_report(clustered: DataFrame, cluster: str, label: str) -> DataFrame:
    """Label x cluster counts; clusters ascend."""
    counts = count_by(clustered, [label, cluster])
    return rows_by_total(pivot_counts(counts, label, cluster, values=column_values(counts, cluster)), label)


def cluster_points(df: DataFrame, features_col: str = "features") -> DataFrame:
    """Every row with its place on the first two principal components."""
    return fit_pca(df, components=2, features_col=features_col, output_col="point").transform(df)


def cluster_size_table(clustered: DataFrame, cluster: str) -> DataFrame:
    return cluster_sizes(clustered, cluster)
