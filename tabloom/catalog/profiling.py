"""Column profiles and numeric summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.catalog import Registry, load
from tabloom.operators import profile

registry = Registry()

ORDERS = "SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'F') AS o_orderstatus, o_totalprice, o_orderdate, nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders"


def orders_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "orders")
    return df.withColumns({c: F.nullif(F.col(c), F.lit(v)) for c, v in (("o_orderstatus", "F"), ("o_orderpriority", "5-LOW"))})


def _per_column(columns: list[str], body: str, source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {body.format(c=c)} FROM ({source})" for c in columns)


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@registry.add("null_fractions", _per_column(ORDER_COLUMNS, "round(avg(({c} IS NULL)::INT), 6) AS missing_fraction", ORDERS))
def null_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_fractions(orders_with_nulls(spark, sf_dir)).withColumn("missing_fraction", F.round("missing_fraction", 6))


@registry.add(
    "top_missing_columns",
    f"SELECT * FROM ({_per_column(ORDER_COLUMNS, 'round(avg(({c} IS NULL)::INT), 6) AS missing_fraction', ORDERS)}) ORDER BY missing_fraction DESC, feature LIMIT 3",
)
def top_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_missing(orders_with_nulls(spark, sf_dir), 3).withColumn("missing_fraction", F.round("missing_fraction", 6))


@registry.add("distinct_counts", _per_column(ORDER_COLUMNS, "count(DISTINCT {c}) AS n_unique", ORDERS))
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_counts(orders_with_nulls(spark, sf_dir))


@registry.add("distinct_long_texts", "SELECT 'text' AS feature, count(DISTINCT text) AS n_unique FROM documents")
def distinct_long_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_counts(load(spark, sf_dir, "documents"), ["text"])


@registry.add(
    "top_cardinalities",
    f"SELECT * FROM ({_per_column(['lang', 'source', 'text'], 'count(DISTINCT {c}) AS n_unique', 'SELECT * FROM documents')}) ORDER BY n_unique DESC, feature LIMIT 2",
)
def top_cardinalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.cardinalities(load(spark, sf_dir, "documents"), ["lang", "source", "text"], 2)


LENGTHS = "coalesce(round(avg(length({c})), 6), 0) AS avg_len, coalesce(round(quantile_cont(length({c}), 0.95), 6), 0) AS p95_len, coalesce(max(length({c})), 0)::DOUBLE AS max_len"


@registry.add("text_lengths", _per_column(["text", "lang", "source"], LENGTHS, "SELECT text, nullif(lang, 'de') AS lang, source FROM documents"))
def text_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "documents").withColumn("lang", F.nullif(F.col("lang"), F.lit("de")))
    out = profile.text_lengths(df, ["text", "lang", "source"])
    return out.select("feature", *(F.round(c, 6).alias(c) for c in ("avg_len", "p95_len", "max_len")))


# A table that reaches every audit rule: key, target, ip, id, time, port, free text, sparse and many-valued columns.
AUDIT_COLUMNS = {
    "row_id": "CAST(doc_id AS {text})",
    "quality": "CASE WHEN n_chars > 1000 THEN 'long' ELSE 'short' END",
    "source_ip": "source",
    "doc_uuid": "CAST(doc_id AS {text})",
    "lang_id": "lang",
    "created_time": "CAST(n_chars AS {text})",
    "import_lane": "n_chars",
    "text": "text",
    "flag": "CASE WHEN lang = 'fr' THEN 'yes' END",
    "note": "CASE WHEN lang = 'fr' THEN source END",
    "size_name": "concat('n', n_chars)",
    "source": "source",
    "n_chars": "n_chars",
}
AUDIT_TEXT = [c for c in AUDIT_COLUMNS if c not in ("import_lane", "n_chars")]


def audited_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "documents")
    return df.selectExpr(*(f"{e.format(text='string')} AS {c}" for c, e in AUDIT_COLUMNS.items()))


def _audit_sql() -> str:
    source = "SELECT " + ", ".join(f"{e.format(text='VARCHAR')} AS {c}" for c, e in AUDIT_COLUMNS.items()) + " FROM documents"
    parts = []
    for i, c in enumerate(AUDIT_COLUMNS):
        text = c in AUDIT_TEXT
        stats = f"avg(({c} IS NULL)::INT) AS missing, count(DISTINCT {c}) AS n_unique, {str(text).lower()} AS is_text, '{'string' if text else 'bigint'}' AS dtype"
        sizes = f"avg(length({c})) AS a, quantile_cont(length({c}), 0.95) AS p, max(length({c}))::DOUBLE AS m" if text else "NULL::DOUBLE AS a, NULL::DOUBLE AS p, NULL::DOUBLE AS m"
        parts.append(f"SELECT {i} AS position, '{c}' AS feature, {stats}, {sizes} FROM src")
    return f"""WITH src AS ({source}), stats AS ({' UNION ALL '.join(parts)}),
ruled AS (SELECT *, CASE WHEN feature = 'quality' THEN 1 WHEN feature = 'row_id' THEN 2 WHEN feature LIKE '%ip%' THEN 3
WHEN (feature LIKE '%id%' OR feature LIKE '%uuid%' OR feature LIKE '%guid%') AND n_unique >= 500 THEN 4
WHEN feature LIKE '%time%' OR feature LIKE '%date%' THEN 5 WHEN feature LIKE '%port%' THEN 6
WHEN is_text AND (p >= 30 OR m >= 120) THEN 7 WHEN missing >= 0.4 AND is_text AND n_unique <= 2 THEN 8
WHEN missing >= 0.4 THEN 9 WHEN n_unique >= 500 AND is_text THEN 10 ELSE 11 END AS rule FROM stats)
SELECT feature, dtype, round_even(missing * 100, 2)::DOUBLE AS missing_pct, n_unique, round_even(a, 2)::DOUBLE AS avg_len, round_even(p, 2)::DOUBLE AS p95_len, round_even(m, 2)::DOUBLE AS max_len,
['target', 'drop', 'drop', 'drop', 'transform', 'transform', 'drop', 'keep', 'drop', 'drop', 'keep'][rule] AS suggested_action,
CASE rule WHEN 5 THEN 'timestamp' WHEN 6 THEN 'port' ELSE '' END AS transform_kind,
['label column', 'surrogate key', 'high-cardinality identifier (likely)', 'identifier-like + high cardinality', 'extract time-based features',
'bucket/parse port features', 'free-text/log-like (one-hot unfriendly)', 'binary-ish; treat missing as category', 'too missing (baseline)',
'high-cardinality categorical (baseline)', 'ok for baseline'][rule] AS reason, position FROM ruled"""


@registry.add("feature_audit", _audit_sql())
def feature_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.feature_audit(audited_documents(spark, sf_dir), target_col="quality")


@registry.add(
    "audit_config",
    f"""SELECT string_agg(feature, ',' ORDER BY suggested_action, missing_pct DESC, n_unique DESC, position) FILTER (suggested_action = 'drop') AS drop_cols,
string_agg(feature, ',' ORDER BY suggested_action, missing_pct DESC, n_unique DESC, position) FILTER (transform_kind = 'timestamp') AS timestamp_cols,
string_agg(feature, ',' ORDER BY suggested_action, missing_pct DESC, n_unique DESC, position) FILTER (transform_kind = 'port') AS port_cols FROM ({_audit_sql()})""",
)
def audit_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = profile.feature_audit(audited_documents(spark, sf_dir), target_col="quality")
    return profile.audit_config(audit, target_col="quality").select(
        F.array_join("drop_cols", ",").alias("drop_cols"), F.array_join("transform.timestamp_cols", ",").alias("timestamp_cols"), F.array_join("transform.port_cols", ",").alias("port_cols")
    )


STATS = """count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min, round(quantile_cont({c}, 0.25), 6) AS p25,
round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, max({c})::DOUBLE AS max"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})


@registry.add(
    "describe_numeric",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {STATS.format(c=c)} FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
)
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile.describe_numeric(load(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@registry.add("describe_by_group", f"SELECT event_type, 'v' AS \"column\", {STATS.format(c='v')} FROM (SELECT event_type, CASE WHEN value >= 5 THEN value END AS v FROM events) GROUP BY 1")
def describe_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events").select("event_type", F.when(F.col("value") >= 5, F.col("value")).alias("v"))
    return _rounded(profile.describe_numeric(df, ["v"], ["event_type"]))


def _mixed_sql() -> str:
    numeric = [f"SELECT '{c}' AS \"column\", {STATS.format(c=c)}, NULL::DOUBLE AS \"unique\", NULL::VARCHAR AS top, NULL::DOUBLE AS freq FROM part" for c in ("p_partkey", "p_size", "p_retailprice")]
    text = [
        f"""SELECT '{c}' AS "column", sum(n)::BIGINT AS count, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS p25, NULL::DOUBLE AS p50,
NULL::DOUBLE AS p75, NULL::DOUBLE AS max, count(*)::DOUBLE AS "unique", (array_agg(v ORDER BY n DESC, v))[1] AS top, max(n)::DOUBLE AS freq FROM (SELECT {c} AS v, count(*) AS n FROM part GROUP BY 1)"""
        for c in ("p_name", "p_brand", "p_type")
    ]
    return " UNION ALL ".join(numeric + text)


@registry.add("describe_all", _mixed_sql())
def describe_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _rounded(profile.describe_all(load(spark, sf_dir, "part")))
    return out.withColumns({c: F.col(c).cast("double") for c in ("unique", "freq")})


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "disc_or_null"]
CORR_SOURCE = "SELECT l_quantity, l_extendedprice, l_discount, CASE WHEN l_tax > 0.02 THEN l_tax END AS disc_or_null FROM lineitem"


@registry.add("correlations", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM ({CORR_SOURCE})" for a in NUMERIC for b in NUMERIC))
def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "lineitem").withColumn("disc_or_null", F.when(F.col("l_tax") > 0.02, F.col("l_tax")))
    return profile.correlations(df, NUMERIC).withColumn("r", F.round("r", 6))


def _histogram_sql(source: str, value: str, bins: int, by: str | None = None) -> str:
    group, key = (f"{by},", by) if by else ("", None)
    joined = f"USING ({key})" if by else "ON true"
    return f"""WITH s AS (SELECT {group} min({value}) AS lo, max({value}) AS hi FROM {source} {f'GROUP BY {key}' if by else ''}),
b AS (SELECT {group} unnest(range({bins}))::INT AS bin, lo, (hi - lo) / {bins} AS w FROM s),
c AS (SELECT {f'{key},' if by else ''} least(floor(({value} - lo) / ((hi - lo) / {bins})), {bins - 1})::INT AS bin, count(*) AS n FROM {source} JOIN s {joined} GROUP BY ALL)
SELECT {f'b.{key},' if by else ''} b.bin, round(lo + b.bin * w, 6) AS "left", round(lo + (b.bin + 1) * w, 6) AS "right", coalesce(n, 0) AS count
FROM b LEFT JOIN c ON b.bin = c.bin {f'AND b.{key} = c.{key}' if by else ''}"""


def _rounded_edges(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("left", "right")})


@registry.add("histogram", _histogram_sql("lineitem", "l_extendedprice", 50))
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_edges(profile.histogram(load(spark, sf_dir, "lineitem"), "l_extendedprice", bins=50))


@registry.add("histogram_by_group", _histogram_sql("events", "value", 60, "event_type"))
def histogram_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_edges(profile.histogram(load(spark, sf_dir, "events"), "value", bins=60, by=["event_type"]))


@registry.add(
    "box_by_category",
    """WITH top AS (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 8),
q AS (SELECT p_brand, count(*) AS n, quantile_cont(p_size, 0.25) AS q1, quantile_cont(p_size, 0.5) AS median, quantile_cont(p_size, 0.75) AS q3 FROM part SEMI JOIN top USING (p_brand) GROUP BY 1)
SELECT p_brand, n, q1, median, q3, min(p_size) FILTER (p_size >= q1 - 1.5 * (q3 - q1)) AS whisker_low, max(p_size) FILTER (p_size <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
count(*) FILTER (p_size < q1 - 1.5 * (q3 - q1) OR p_size > q3 + 1.5 * (q3 - q1)) AS outliers FROM part JOIN q USING (p_brand) GROUP BY ALL""",
)
def box_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.box_stats(load(spark, sf_dir, "part"), "p_brand", "p_size")


@registry.add(
    "schema_listing",
    """SELECT (column_index - 1)::INT AS position, column_name AS feature,
    CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS dtype
    FROM duckdb_columns() WHERE table_name = 'orders'""",
)
def schema_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.schema_listing(load(spark, sf_dir, "orders"))
