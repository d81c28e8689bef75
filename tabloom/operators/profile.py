"""Column profiles, the feature audit and numeric summaries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabloom.operators.clean import col, numeric_and_categorical
from tabloom.operators.quantiles import long_values, quantiles
from tabloom.operators.slices import top_values
from tabloom.session import small_side

LONG_VALUE = 64


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def null_fractions(df: DataFrame) -> DataFrame:
    """Null share per column from one aggregate."""
    shares = df.agg(*(F.avg(col(c).isNull().cast("int")).alias(c) for c in df.columns))
    pairs = F.array(*(F.struct(F.lit(c).alias("feature"), F.coalesce(col(c), F.lit(0.0)).alias("missing_fraction")) for c in df.columns))
    return shares.select(F.inline(pairs))


def top_missing(df: DataFrame, k: int = 15) -> DataFrame:
    return null_fractions(df).orderBy(F.desc("missing_fraction"), "feature").limit(k)


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*(F.count_if(col(c).isNull()).alias(c) for c in cols))


def _short_key(text: Column) -> Column:
    """The text, or a digest that is longer than any text that stands for itself."""
    return F.when(F.length(text) > LONG_VALUE, F.concat(F.lit("sha256:"), F.sha2(text, 256))).otherwise(text)


def value_counts_by_column(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(feature, value, count) for every non-null value of every column, in one shuffle of distinct values.

    Values longer than LONG_VALUE characters travel as their SHA-256 digest, so long texts are not shuffled.
    """
    names = list(cols or df.columns)
    pairs = F.array(*(F.struct(F.lit(c).alias("feature"), _short_key(col(c).cast("string")).alias("value")) for c in names))
    return df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count("*").alias("count"))


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(feature, n_unique), nulls not counted; a column of nulls has 0."""
    names = list(cols or df.columns)
    counted = value_counts_by_column(df, names).groupBy("feature").agg(F.count("*").alias("n_unique"))
    return _every_feature(df, names).join(counted, "feature", "left").select("feature", F.coalesce("n_unique", F.lit(0)).cast("bigint").alias("n_unique"))


def _every_feature(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(names)], "feature string, position int")


def text_lengths(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, avg_len, p95_len, max_len) over non-null values; 0 when there are none.

    The percentile runs over lengths, whose distinct values are bounded by the longest text.
    """
    stats = []
    for i, c in enumerate(cols):
        size = F.length(col(c).cast("string"))
        stats += [F.avg(size).alias(f"a{i}"), F.percentile(size, F.lit(0.95)).alias(f"p{i}"), F.max(size).alias(f"m{i}")]
    zero = F.lit(0.0)
    rows = F.array(
        *(
            F.struct(
                F.lit(c).alias("feature"),
                F.coalesce(F.col(f"a{i}"), zero).alias("avg_len"),
                F.coalesce(F.col(f"p{i}"), zero).alias("p95_len"),
                F.coalesce(F.col(f"m{i}").cast("double"), zero).alias("max_len"),
            )
            for i, c in enumerate(cols)
        )
    )
    return df.agg(*stats).select(F.inline(rows))


@dataclass(frozen=True)
class AuditRules:
    """Thresholds and name parts of the audit."""

    high_missing: float = 0.40
    high_cardinality: int = 500
    free_text_p95_len: float = 30
    free_text_max_len: float = 120
    id_parts: tuple[str, ...] = ("id", "uuid", "guid")
    ip_parts: tuple[str, ...] = ("ip",)
    time_parts: tuple[str, ...] = ("time", "date", "timestamp")
    port_parts: tuple[str, ...] = ("port",)


def feature_audit(df: DataFrame, *, target_col: str, row_id_col: str = "row_id", rules: AuditRules = AuditRules()) -> DataFrame:
    """One row per column with its statistics and the action the first matching rule suggests."""
    text_cols = [f.name for f in df.schema.fields if _is_text(f)]
    spark = df.sparkSession
    base = spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), _is_text(f)) for i, f in enumerate(df.schema.fields)],
        "position int, feature string, dtype string, is_text boolean",
    )
    table = base.join(F.broadcast(null_fractions(df)), "feature").join(F.broadcast(distinct_counts(df).drop("position")), "feature")
    if text_cols:
        table = table.join(F.broadcast(text_lengths(df, text_cols)), "feature", "left")
    else:
        table = table.withColumns({c: F.lit(None).cast("double") for c in ("avg_len", "p95_len", "max_len")})
    return audit_actions(table, target_col=target_col, row_id_col=row_id_col, rules=rules)


def audit_actions(stats: DataFrame, *, target_col: str, row_id_col: str = "row_id", rules: AuditRules = AuditRules()) -> DataFrame:
    name = F.lower("feature")

    def named(parts: tuple[str, ...]) -> Column:
        return name.rlike("|".join(parts))

    is_text = F.col("is_text")
    many = F.col("n_unique") >= rules.high_cardinality
    sparse = F.col("missing_fraction") >= rules.high_missing
    wordy = is_text & ((F.col("p95_len") >= rules.free_text_p95_len) | (F.col("max_len") >= rules.free_text_max_len))
    ordered = [
        (F.col("feature") == target_col, "target", "", "label column"),
        (name == row_id_col.lower(), "drop", "", "surrogate key"),
        (named(rules.ip_parts), "drop", "", "high-cardinality identifier (likely)"),
        (named(rules.id_parts) & many, "drop", "", "identifier-like + high cardinality"),
        (named(rules.time_parts), "transform", "timestamp", "extract time-based features"),
        (named(rules.port_parts), "transform", "port", "bucket/parse port features"),
        (wordy, "drop", "", "free-text/log-like (one-hot unfriendly)"),
        (sparse & is_text & (F.col("n_unique") <= 2), "keep", "", "binary-ish; treat missing as category"),
        (sparse, "drop", "", "too missing (baseline)"),
        (many & is_text, "drop", "", "high-cardinality categorical (baseline)"),
        (F.lit(True), "keep", "", "ok for baseline"),
    ]
    verdict = F.coalesce(
        *(F.when(test, F.struct(F.lit(a).alias("action"), F.lit(k).alias("kind"), F.lit(r).alias("reason"))) for test, a, k, r in ordered)
    )
    return (
        stats.withColumn("verdict", verdict)
        .select(
            "feature",
            "dtype",
            F.bround(F.col("missing_fraction") * 100, 2).alias("missing_pct"),
            "n_unique",
            *(F.when(is_text, F.bround(c, 2)).alias(c) for c in ("avg_len", "p95_len", "max_len")),
            F.col("verdict.action").alias("suggested_action"),
            F.col("verdict.kind").alias("transform_kind"),
            F.col("verdict.reason").alias("reason"),
            "position",
        )
        .orderBy("suggested_action", F.desc("missing_pct"), F.desc("n_unique"), "position")
    )


def audit_config(audit: DataFrame, *, target_col: str, row_id_col: str = "row_id", rules: AuditRules = AuditRules()) -> DataFrame:
    """One row with the drop, timestamp and port columns in audit order, shaped like the feature config document."""
    place = F.struct("suggested_action", (-F.col("missing_pct")).alias("m"), (-F.col("n_unique")).alias("u"), "position", "feature")

    def listed(test: Column) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.when(test, place))), lambda s: s["feature"])

    return audit.agg(
        F.lit(target_col).alias("target_col"),
        F.lit(row_id_col).alias("row_id_col"),
        listed(F.col("suggested_action") == "drop").alias("drop_cols"),
        F.struct(
            listed(F.col("transform_kind") == "timestamp").alias("timestamp_cols"),
            listed(F.col("transform_kind") == "port").alias("port_cols"),
        ).alias("transform"),
        F.struct(
            F.lit(rules.high_missing).alias("high_missing_threshold"),
            F.lit(rules.high_cardinality).alias("high_cardinality_threshold"),
            F.lit(rules.free_text_p95_len).cast("double").alias("free_text_p95_len"),
            F.lit(rules.free_text_max_len).cast("double").alias("free_text_max_len"),
        ).alias("heuristics"),
    )


QUARTILES = (0.25, 0.5, 0.75)


def describe_numeric(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), **options: int) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per column (and group), with exact quartiles."""
    group = [col(b) for b in by]
    moments = long_values(df, cols, by).groupBy(*group, "column").agg(
        F.count("*").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    q = quantiles(df, cols, QUARTILES, by, **options).select(
        *(col(b).alias(f"_by{i}") for i, b in enumerate(by)), F.col("column").alias("_column"), *(F.get("q", F.lit(i)).alias(n) for i, n in enumerate(("p25", "p50", "p75")))
    )
    on = F.col("column") == F.col("_column")
    for i, b in enumerate(by):
        on = on & col(b).eqNullSafe(F.col(f"_by{i}"))
    return moments.join(q, on).select(*group, "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_all(df: DataFrame, **options: int) -> DataFrame:
    """Numeric summary plus, for text columns, distinct count, most frequent value and its count.

    Of equally frequent values the smallest is reported.
    """
    numeric, _ = numeric_and_categorical(df, booleans_numeric=False)
    text_cols = [f.name for f in df.schema.fields if _is_text(f)]
    out = describe_numeric(df, numeric, **options).withColumns({"unique": F.lit(None).cast("bigint"), "top": F.lit(None).cast("string"), "freq": F.lit(None).cast("bigint")})
    if text_cols:
        pairs = F.array(*(F.struct(F.lit(c).alias("feature"), _short_key(col(c)).alias("key"), col(c).alias("value")) for c in text_cols))
        counts = df.select(F.inline(pairs)).filter(F.col("key").isNotNull()).groupBy("feature", "key").agg(F.count("*").alias("count"), F.any_value("value").alias("value"))
        first = F.min(F.struct((-F.col("count")).alias("less"), "value"))
        most = counts.groupBy("feature").agg(F.sum("count").alias("count"), F.count("*").alias("unique"), F.max("count").alias("freq"), first["value"].alias("top"))
        empty = {c: F.lit(None).cast("double") for c in ("mean", "std", "min", "p25", "p50", "p75", "max")}
        texts = most.withColumnRenamed("feature", "column").withColumns(empty)
        out = out.unionByName(texts.select(*out.columns))
    return out


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair over rows where both are present, in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*(F.corr(F.when(col(b).isNotNull(), col(a)).cast("double"), F.when(col(a).isNotNull(), col(b)).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)))
    cells = []
    for i, (a, b) in enumerate(pairs):
        cells.append((a, b, i))
        if a != b:
            cells.append((b, a, i))
    return row.select(F.inline(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("r")) for a, b, i in cells))))


def _widened(low: Column, high: Column) -> tuple[Column, Column]:
    """A single value gets a range of one unit around it."""
    flat = low == high
    return F.when(flat, low - 0.5).otherwise(low), F.when(flat, high + 0.5).otherwise(high)


def histogram(df: DataFrame, value: str, *, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over each group's own range; the last bin is closed. Empty bins are listed with 0.

    Nulls, NaN and infinities are in no bin and do not widen the range.
    """
    keys = [f"_by{i}" for i in range(len(by))]
    rows = df.select(*(col(b).alias(k) for b, k in zip(by, keys)), col(value).cast("double").alias("_v")).filter(F.abs("_v") < float("inf"))
    spans = rows.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi")).filter(F.col("_lo").isNotNull())
    lo, hi = F.col("_lo"), F.col("_hi")
    spans = small_side(spans.withColumns(dict(zip(("_lo", "_hi"), _widened(lo, hi)))))
    width = (hi - lo) / bins
    place = F.least(F.floor((F.col("_v") - lo) / width), F.lit(bins - 1)).cast("int")
    if by:
        spread = _match(rows, spans, keys)
    else:
        # The one range of the table becomes two constants.
        ends = spans.first() or (None, None)
        spread = rows.withColumns({n: F.lit(v).cast("double") for n, v in zip(("_lo", "_hi"), ends)})
    counted = spread.groupBy(*keys, place.alias("bin")).agg(F.count("*").alias("_n"))
    full = spans.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return _match(full, counted, [*keys, "bin"], "left").select(
        *(F.col(k).alias(b) for k, b in zip(keys, by)),
        "bin",
        (lo + F.col("bin") * width).alias("left"),
        (lo + (F.col("bin") + 1) * width).alias("right"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("count"),
    )


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on null-safe keys, keeping the left ones."""
    other = right.withColumnsRenamed({k: f"_m{i}" for i, k in enumerate(keys)})
    on = F.col(keys[0]).eqNullSafe(F.col("_m0"))
    for i, k in enumerate(keys[1:], 1):
        on = on & F.col(k).eqNullSafe(F.col(f"_m{i}"))
    return left.join(other, on, how).drop(*(f"_m{i}" for i in range(len(keys))))


def box_stats(df: DataFrame, category: str, value: str, *, top_k: int = 8, **options: int) -> DataFrame:
    """Quartiles and whisker ends (furthest values within 1.5 IQR) for the most frequent categories."""
    pairs = df.select(col(category), col(value)).dropna()
    top = top_values(pairs, category, top_k)
    kept = pairs.join(F.broadcast(top.select(col(category))), category, "left_semi")
    q = quantiles(kept, [value], QUARTILES, [category], **options).select(
        col(category), "n", *(F.get("q", F.lit(i)).alias(n) for i, n in enumerate(("q1", "median", "q3")))
    )
    iqr = F.col("q3") - F.col("q1")
    low, high = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    v = col(value)
    # One row per category, at most top_k rows.
    ends = kept.join(F.broadcast(q), category).groupBy(col(category)).agg(
        F.min(F.when(v >= low, v)).alias("whisker_low"), F.max(F.when(v <= high, v)).alias("whisker_high"), F.count_if((v < low) | (v > high)).alias("outliers")
    )
    return q.join(ends, category)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("cols", F.lit(len(df.columns)))


def schema_listing(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)], "position int, feature string, dtype string"
    )


def cardinalities(df: DataFrame, cols: Sequence[str], k: int = 20) -> DataFrame:
    return distinct_counts(df, cols).orderBy(F.desc("n_unique"), "feature").limit(k)
