"""Group, pivot and top-k tables for exploration. Ties are always broken by the key, so results are stable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.functions.text import label_or
from tabloom.operators.clean import col
from tabloom.operators.ordered import number_rows
from tabloom.session import small_side


def count_by(df: DataFrame, keys: Sequence[str], *, missing: str | None = None, merge_unknown: bool = False) -> DataFrame:
    """Rows per key combination; nulls form a group of their own, or are named by missing."""
    named = [label_or(col(k), missing, merge_unknown=merge_unknown).alias(k) if missing is not None else col(k) for k in keys]
    return df.groupBy(*named).agg(F.count("*").alias("count"))


def value_counts(df: DataFrame, key: str, *, missing: str | None = "Unknown") -> DataFrame:
    return count_by(df, [key], missing=missing).orderBy(F.desc("count"), col(key))


def with_share(counts: DataFrame, by: Sequence[str] = (), *, value: str = "count", name: str = "share") -> DataFrame:
    """Each count as a share of its group's total; a group total of 0 gives 0.

    Totals are aggregated and joined back, so a group with many values is never gathered in one task.
    """
    whole = F.col("_total")
    share = col(value) / F.when(whole == 0, 1).otherwise(whole)
    if not by:
        total = counts.agg(F.sum(value)).scalar()
        return counts.withColumn("_total", total).withColumn(name, share).drop("_total")
    totals = counts.groupBy(*(col(b).alias(f"_by{i}") for i, b in enumerate(by))).agg(F.sum(value).alias("_total"))
    on = col(by[0]).eqNullSafe(F.col("_by0"))
    for i, b in enumerate(by[1:], 1):
        on = on & col(b).eqNullSafe(F.col(f"_by{i}"))
    return counts.join(totals, on).withColumn(name, share).drop("_total", *(f"_by{i}" for i in range(len(by))))


MOST_COLUMNS = 1000


def _listed(values: DataFrame, key: str, most: int) -> list:
    """The rows of values, which become columns; more than `most` are refused before anything is pivoted."""
    found = [r[0] for r in values.limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{key} has {values.count()} values; a wide table takes {most} at most, ranked_counts has no limit")
    return found


def column_values(df: DataFrame, key: str, *, most: int = MOST_COLUMNS) -> list:
    """Distinct values in order: the column list of a pivot."""
    return _listed(df.select(col(key)).distinct().orderBy(col(key)), key, most)


def values_by_total(counts: DataFrame, key: str, *, value: str = "count", most: int = MOST_COLUMNS) -> list:
    """Distinct values, largest total first: the column list of a pivot ordered by size."""
    totals = counts.groupBy(col(key)).agg(F.sum(value).alias("_t"))
    return _listed(totals.orderBy(F.desc("_t"), col(key)).select(col(key)), key, most)


def ranked_counts(counts: DataFrame, row: str, column: str, *, value: str = "count") -> DataFrame:
    """The pivot in long form: counts with row_place and column_place from 0, by total, largest first, then by key.

    For any number of rows and columns: places are numbered by ranges, and cells that would be 0 have no row. Null is a
    key like any other, the first among equals.
    """
    out = counts
    for key, place in ((row, "row_place"), (column, "column_place")):
        totals = counts.groupBy(col(key).alias("_key")).agg(F.sum(value).alias("_total"))
        placed = small_side(number_rows(totals, [F.desc("_total"), F.asc("_key")], name=place).select("_key", place))
        out = out.join(placed, col(key).eqNullSafe(F.col("_key"))).drop("_key")
    return out


def pivot_counts(counts: DataFrame, row: str, column: str, *, values: Sequence | None = None, value: str = "count") -> DataFrame:
    """Wide table of counts with missing cells 0. counts is already grouped, so the pivot handles few rows."""
    listed = list(values) if values is not None else values_by_total(counts, column, value=value)
    wide = counts.groupBy(col(row)).pivot(column, listed).agg(F.sum(value))
    cells = [c for c in wide.columns if c != row]
    return wide.fillna(0, subset=cells) if cells else wide


def rows_by_total(pivot: DataFrame, row: str) -> DataFrame:
    """Pivot rows with their total, largest first."""
    cells: list[Column] = [col(c) for c in pivot.columns if c != row]
    total = cells[0]
    for c in cells[1:]:
        total = total + c
    return pivot.withColumn("total", total).orderBy(F.desc("total"), col(row))


def cross_counts(df: DataFrame, row: str, column: str, *, missing: str | None = "Unknown", merge_unknown: bool = False) -> DataFrame:
    """Pivot of row by column counts; both axes are ordered by their totals."""
    return rows_by_total(pivot_counts(count_by(df, [row, column], missing=missing, merge_unknown=merge_unknown), row, column), row)


def top_values(df: DataFrame, key: str, k: int, *, weight: str | None = None) -> DataFrame:
    """The k most frequent non-null values, or the k with the largest summed weight."""
    size = F.count("*") if weight is None else F.sum(weight)
    return df.filter(col(key).isNotNull()).groupBy(col(key)).agg(size.alias("count")).orderBy(F.desc("count"), col(key)).limit(k)


def keep_top(df: DataFrame, key: str, k: int, *, weight: str | None = None) -> DataFrame:
    """Rows whose key is one of the top k values; the k values are the broadcast side."""
    return df.join(F.broadcast(top_values(df, key, k, weight=weight).select(col(key))), key, "left_semi")


def top_by_label(df: DataFrame, key: str, label: str, k: int = 10) -> DataFrame:
    """Counts of each label for the k most frequent values of key, most frequent first."""
    counts = df.filter(col(key).isNotNull()).groupBy(col(key), col(label)).agg(F.count("*").alias("count"))
    return rows_by_total(pivot_counts(keep_top(counts, key, k, weight="count"), key, label, values=column_values(counts, label)), key)


def top_per_group(counts: DataFrame, group: str, item: str, k: int = 15, *, value: str = "count") -> DataFrame:
    """The k largest items of each group, with their rank."""
    rank = F.row_number().over(Window.partitionBy(col(group)).orderBy(F.desc(value), col(item)))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= k)


def other_bucket(counts: DataFrame, key: str, k: int = 15, *, value: str = "count", other: str = "(other)") -> DataFrame:
    """The k largest values and one row for all the rest.

    The top k are found with a bounded heap per task and matched by broadcast; the full count table is never sorted.
    """
    top = counts.orderBy(F.desc(value), col(key)).limit(k).select(col(key).alias("_top"))
    name = F.when(F.col("_top").isNotNull(), col(key)).otherwise(F.lit(other))
    return counts.join(F.broadcast(top), col(key) == F.col("_top"), "left").groupBy(name.alias(key)).agg(F.sum(value).alias(value))


def full_label_counts(df: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """Counts for exactly the listed labels, 0 where a label is absent."""
    wanted = df.sparkSession.createDataFrame([(i, str(v)) for i, v in enumerate(labels)], "position int, _label string")
    counts = df.groupBy(col(key).cast("string").alias("_label")).agg(F.count("*").alias("count"))
    return wanted.join(counts, "_label", "left").select("position", F.col("_label").alias(key), F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def class_index(df: DataFrame, label: str) -> DataFrame:
    """Sorted distinct labels with their index from 0. The list of classes is small by nature."""
    classes = df.select(col(label).cast("string").alias("class")).filter(F.col("class").isNotNull()).distinct()
    return classes.withColumn("index", F.row_number().over(Window.orderBy("class")) - 1)


def label_union(*tables: DataFrame, label: str) -> DataFrame:
    """Distinct labels over several tables, sorted."""
    out = tables[0].select(col(label)).distinct()
    for t in tables[1:]:
        out = out.union(t.select(col(label)).distinct())
    return out.distinct().orderBy(col(label))


def best_row(table: DataFrame, metric: str, *, largest: bool, name: str = "model") -> DataFrame:
    """The single best row; ties go to the first name."""
    order = F.desc(metric) if largest else F.asc(metric)
    return table.orderBy(order, col(name)).limit(1)


def leaderboard(rows: DataFrame, metric: str, *, largest: bool, name: str = "model") -> DataFrame:
    return rows.orderBy(F.desc_nulls_last(metric) if largest else F.asc_nulls_last(metric), col(name))


def series_over_time(df: DataFrame, time_col: str, cols: Sequence[str]) -> DataFrame:
    """Actual and predicted values in time order, incomplete rows left out."""
    return df.select(col(time_col), *map(col, cols)).dropna().orderBy(col(time_col), *map(col, cols))
