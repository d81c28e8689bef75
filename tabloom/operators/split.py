"""Train/validation/test splits: by time, by label, and their joins back to the table."""

from __future__ import annotations

from dataclasses import dataclass
from math import floor

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabloom.operators.clean import check_fractions, col, require_columns, require_times
from tabloom.session import stash

SPLITS = ("train", "val", "test")


@dataclass(frozen=True)
class TimeCuts:
    """Last time of train and of val in text form, with the row targets they were derived from."""

    rows: int
    train_target: int
    val_target: int
    train_last: str | None
    val_last: str | None


def _as_text(df: DataFrame, time_col: str, c: Column) -> Column:
    """Instants as microseconds, so no session time zone can blur them; other times as they print."""
    return F.unix_micros(c).cast("string") if isinstance(df.schema[time_col].dataType, T.TimestampType) else c.cast("string")


def _at(df: DataFrame, time_col: str, value: str) -> Column:
    kind = df.schema[time_col].dataType
    return F.timestamp_micros(F.lit(int(value))) if isinstance(kind, T.TimestampType) else F.lit(value).cast(kind)


def _day_and_second(df: DataFrame, time_col: str) -> tuple[Column, Column]:
    """Calendar units that grow with the time; instants are counted from the epoch."""
    t = col(time_col)
    if isinstance(df.schema[time_col].dataType, T.TimestampType):
        return F.floor(F.unix_seconds(t) / 86400), F.unix_seconds(t)
    if isinstance(df.schema[time_col].dataType, T.DateType):
        return t, t
    return F.to_date(t), F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def _between(df: DataFrame, time_col: str, low: str, high: str) -> Column:
    return (col(time_col) >= _at(df, time_col, low)) & (col(time_col) <= _at(df, time_col, high))


def _unit_counts(df: DataFrame, time_col: str, unit: Column) -> DataFrame:
    t = col(time_col)
    return df.groupBy(unit.alias("u")).agg(F.count("*").alias("n"), F.min(t).alias("lo"), F.max(t).alias("hi"))


def _last_start_before(df: DataFrame, time_col: str, target: int, days: DataFrame) -> str:
    """Latest time with fewer than target rows before it, or the first time when there is none.

    Walks from days to seconds to single times, so each ordered window sees calendar units and never raw rows:
    the days of the table, then 86,400 seconds, then a million microseconds.
    """
    t = col(time_col)
    seconds = _day_and_second(df, time_col)[1]
    counts, base, part = days, 0, df
    for unit in (seconds, t, None):
        before = F.sum("n").over(Window.orderBy("u")) - F.col("n") + F.lit(base)
        item = F.struct(_as_text(df, time_col, F.col("lo")), _as_text(df, time_col, F.col("hi")), F.col("before"))
        early = F.max_by(item, F.when(F.col("before") < target, F.col("u")))
        first = F.min_by(item, F.col("u"))
        low, high, base = counts.withColumn("before", before).agg(F.coalesce(early, first)).first()[0]
        if low == high or unit is None:
            return low
        part = df.filter(_between(df, time_col, low, high))
        counts = _unit_counts(part, time_col, unit)
    raise AssertionError("unreachable")


def time_cuts(df: DataFrame, time_col: str, *, train: float = 0.7, val: float = 0.15, test: float = 0.15) -> TimeCuts:
    check_fractions(train, val, test)
    times = df.select(col(time_col))
    days = stash(_unit_counts(times, time_col, _day_and_second(df, time_col)[0]))
    n = days.agg(F.sum("n")).first()[0] or 0
    train_target, val_target = int(n * train), int(n * (train + val))
    if n == 0:
        return TimeCuts(0, 0, 0, None, None)
    train_last = _last_start_before(times, time_col, train_target, days)
    after = times.filter(col(time_col) > _at(df, time_col, train_last))
    next_time = after.agg(_as_text(df, time_col, F.min(col(time_col)))).first()[0]
    if next_time is None:
        return TimeCuts(n, train_target, val_target, train_last, None)
    late = _last_start_before(times, time_col, val_target, days)
    # The group after train is always val, also when val's target was already reached.
    later = F.greatest(_at(df, time_col, late), _at(df, time_col, next_time))
    val_last = df.sparkSession.range(1).select(_as_text(df, time_col, later)).first()[0]
    return TimeCuts(n, train_target, val_target, train_last, val_last)


def split_by_cuts(df: DataFrame, time_col: str, cuts: TimeCuts) -> Column:
    if cuts.train_last is None:
        return F.lit("train")
    label = F.when(col(time_col) <= _at(df, time_col, cuts.train_last), "train")
    if cuts.val_last is None:
        return label.otherwise("val")
    return label.when(col(time_col) <= _at(df, time_col, cuts.val_last), "val").otherwise("test")


def time_split(
    df: DataFrame,
    *,
    time_col: str,
    row_id_col: str = "row_id",
    train: float = 0.7,
    val: float = 0.15,
    test: float = 0.15,
) -> tuple[DataFrame, TimeCuts]:
    """Chronological split that keeps equal times together: (row id, time, split) and the cuts.

    The result is a plain projection of df against two constants; no row is shuffled.
    """
    check_fractions(train, val, test)
    require_columns(df, [time_col, row_id_col])
    if not isinstance(df.schema[time_col].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        df = df.withColumn(time_col, F.try_to_timestamp(col(time_col).cast("string")))
    require_times(df, time_col)
    cuts = time_cuts(df, time_col, train=train, val=val, test=test)
    return df.select(col(row_id_col), col(time_col), split_by_cuts(df, time_col, cuts).alias("split")), cuts


def split_report(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count("*").alias("rows"))


def split_targets(rows: int, train: float, val: float) -> tuple[int, int]:
    return int(rows * train), int(rows * (train + val))


def largest_remainder(counts: dict[str, int], total: int) -> dict[str, int]:
    """Share total among classes in proportion to counts; the largest remainders are rounded up."""
    n = sum(counts.values())
    if n == 0:
        return dict.fromkeys(counts, 0)
    whole = {c: counts[c] * total // n for c in counts}
    left = total - sum(whole.values())
    by_remainder = sorted(counts, key=lambda c: (-(counts[c] * total % n), c))
    return {c: whole[c] + (c in by_remainder[:left]) for c in counts}


def stratified_quotas(counts: dict[str, int], train: float, val: float, test: float) -> dict[str, tuple[int, int]]:
    """Rows per class for train and val; test takes the rest."""
    n = sum(counts.values())
    in_train = largest_remainder(counts, floor(n * train))
    rest = {c: counts[c] - in_train[c] for c in counts}
    val_share = val / (val + test) if val + test else 0.0
    in_val = largest_remainder(rest, floor(sum(rest.values()) * val_share))
    return {c: (in_train[c], in_val[c]) for c in counts}


def seeded_digest(seed: int, id_col: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), col(id_col).cast("string")))


def stratified_split(
    df: DataFrame,
    *,
    label_col: str,
    row_id_col: str = "row_id",
    seed: int = 42,
    train: float = 0.7,
    val: float = 0.15,
    test: float = 0.15,
) -> DataFrame:
    """Exact-size seeded split per label: (row id, label, split).

    Rows of a class are ranked by a seeded digest of their id. Counting digest prefixes finds, per class, the one
    prefix in which each quota ends; only the rows under those prefixes are ordered. Every other row is placed by
    comparing its digest with the class's two cut digests, so a hot class is never sorted in one task.
    """
    check_fractions(train, val, test)
    require_columns(df, [label_col, row_id_col])
    id_type = df.schema[row_id_col].dataType
    rows = df.select(col(row_id_col).alias("_id"), col(label_col).alias("_label")).filter(F.col("_label").isNotNull())
    hashed = rows.withColumns({"_digest": F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_id").cast("string"))), "_class": F.col("_label").cast("string")})
    prefix = F.substring("_digest", 1, 4)
    buckets = stash(hashed.groupBy("_class", prefix.alias("_prefix")).agg(F.count("*").alias("n")))
    counts = {r["_class"]: r["n"] for r in buckets.groupBy("_class").agg(F.sum("n").alias("n")).collect()}
    quotas = stratified_quotas(counts, train, val, test)
    spark = df.sparkSession
    ends = spark.createDataFrame(
        [(c, which, q) for c, (a, b) in quotas.items() for which, q in (("train", a), ("val", a + b))], "_class string, _which string, _end bigint"
    )
    upto = F.sum("n").over(Window.partitionBy("_class").orderBy("_prefix"))
    edge = (
        buckets.withColumn("_upto", upto)
        .join(F.broadcast(ends), "_class")
        .filter((F.col("_end") > F.col("_upto") - F.col("n")) & (F.col("_end") <= F.col("_upto")))
        .select("_class", "_which", "_prefix", (F.col("_end") - F.col("_upto") + F.col("n")).alias("_nth"))
    )
    nth = F.row_number().over(Window.partitionBy("_class", "_which").orderBy("_digest", "_id"))
    last = (
        hashed.withColumn("_prefix", prefix)
        .join(F.broadcast(edge), ["_class", "_prefix"])
        .withColumn("_rank", nth)
        .filter(F.col("_rank") == F.col("_nth"))
        .select("_class", "_which", "_digest", F.col("_id").cast("string").alias("_id"))
    )
    cut: dict[str, dict[str, tuple[str, str]]] = {c: {} for c in counts}
    for r in last.collect():
        cut[r["_class"]][r["_which"]] = (r["_digest"], r["_id"])
    # Two cuts per class; the class list is already on the driver.
    cuts = spark.createDataFrame(
        [(c, *cut[c].get("train", (None, None)), *cut[c].get("val", (None, None))) for c in cut],
        "_class string, _train_digest string, _train_id string, _val_digest string, _val_id string",
    )

    def upto_cut(which: str) -> Column:
        digest, last_id = F.col(f"_{which}_digest"), F.col(f"_{which}_id").cast(id_type)
        return (F.col("_digest") < digest) | ((F.col("_digest") == digest) & (F.col("_id") <= last_id))

    return (
        hashed.join(F.broadcast(cuts), "_class", "left")
        .select(
            F.col("_id").alias(row_id_col),
            F.col("_label").alias(label_col),
            F.when(upto_cut("train"), "train").when(upto_cut("val"), "val").otherwise("test").alias("split"),
        )
    )


def tagged_union(parts: dict[str, DataFrame]) -> DataFrame:
    """All parts in one table with a split column."""
    tagged = [df.withColumn("split", F.lit(name)) for name, df in parts.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out


def label_mismatches(left: DataFrame, right: DataFrame, *, row_id_col: str, label_col: str) -> DataFrame:
    """One row: joined rows, and rows whose labels differ."""
    other = right.select(col(row_id_col), col(label_col).cast("string").alias("_other"))
    differs = ~col(label_col).cast("string").eqNullSafe(F.col("_other"))
    return left.select(col(row_id_col), col(label_col)).join(other, row_id_col).agg(F.count("*").alias("rows"), F.count_if(differs).alias("mismatches"))


def join_split(df: DataFrame, split: DataFrame, *, row_id_col: str = "row_id", label_col: str | None = None) -> DataFrame:
    """Inner join of the split label; raises on an empty result or, when the split carries labels, on a label mismatch."""
    if not {row_id_col, "split"} <= set(split.columns):
        raise ValueError(f"No {row_id_col} or no split among the split table's columns: {split.columns}")
    checked = label_col is not None and label_col in split.columns
    told = F.lit(False)
    other = split.select(col(row_id_col), "split")
    if checked:
        other = split.select(col(row_id_col), "split", col(label_col).cast("string").alias("_other"))
        told = ~col(label_col).cast("string").eqNullSafe(F.col("_other"))
    # Joined once: the checks read what is handed on.
    joined = stash(df.join(other, row_id_col).withColumn("_differs", told))
    rows, bad = joined.agg(F.count("*"), F.count_if("_differs")).first()
    if rows == 0:
        raise ValueError(f"The table and its split have 0 rows in common; do both number {row_id_col} alike?")
    if bad:
        raise ValueError(f"Target label mismatch between the table and its split for {bad} rows.")
    return joined.drop("_other", "_differs")


def attach_split(df: DataFrame, split: DataFrame, *, row_id_col: str = "row_id", require_all: bool = True) -> DataFrame:
    """Left join of the split label; by default every row must have one."""
    known = split.select(col(row_id_col), "split", F.lit(True).alias("_known"))
    joined = df.join(known, row_id_col, "left")
    if require_all:
        joined = stash(joined)
        missing = joined.filter(F.col("_known").isNull()).count()
        if missing:
            raise ValueError(f"{missing} rows have no split")
    return joined.drop("_known")


def only_split(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("split") == name)


def fixed_sample(df: DataFrame, n: int, *, id_col: str, seed: int = 42) -> DataFrame:
    """Seeded sample of exactly n rows without replacement (all rows when there are fewer)."""
    return df.withColumn("_digest", seeded_digest(seed, id_col)).orderBy("_digest", col(id_col)).limit(n).drop("_digest")
