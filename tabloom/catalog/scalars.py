"""Column functions."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.catalog import Registry, load
from tabloom.functions import agents, calendar, labels, ports, text
from tabloom.operators import clean

registry = Registry()

# Raw text values built from event types: blanks, null tokens and padded labels.
RAW_TEXT = """CASE event_type WHEN 'error' THEN ' nan ' WHEN 'view' THEN '   ' WHEN 'click' THEN 'None'
WHEN 'signup' THEN concat('  ', event_type, ' ') ELSE event_type END"""


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").withColumn("raw", F.expr(RAW_TEXT))


@registry.add(
    "text_null_tokens",
    f"""SELECT event_id, CASE WHEN trim(raw) IN ('', 'nan', 'None') THEN NULL ELSE trim(raw) END AS cleaned
FROM (SELECT event_id, {RAW_TEXT} AS raw FROM events)""",
)
def text_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events(spark, sf_dir).select("event_id", text.null_if_token(F.col("raw")).alias("cleaned"))


@registry.add(
    "time_coercion",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS parsed FROM events""",
)
def time_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(F.col("ts").cast("string"))
    df = load(spark, sf_dir, "events").select("event_id", raw.alias("parsed"))
    return clean.coerce_types(df, time_cols=["parsed"]).select("event_id", F.col("parsed").cast("timestamp_ntz").alias("parsed"))


@registry.add(
    "number_coercion",
    """SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE value END AS number FROM events""",
)
def number_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("event_type") == "error", "n/a").when(F.col("event_type") == "view", F.concat(F.col("value").cast("string"), F.lit("d")))
    df = load(spark, sf_dir, "events").select("event_id", raw.otherwise(F.concat(F.lit(" "), F.col("value").cast("string"))).alias("number"))
    return clean.coerce_types(df, number_cols=["number", "absent"])


@registry.add(
    "calendar_fields",
    """SELECT event_id, year(ts)::INT AS year, month(ts)::INT AS month, (isodow(ts) - 1)::INT AS dayofweek, day(ts)::INT AS day,
hour(ts)::INT AS hour, minute(ts)::INT AS minute, second(ts)::INT AS second FROM events""",
)
def calendar_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select("event_id", *calendar.calendar_fields(F.col("ts")))


@registry.add(
    "timestamp_features",
    """SELECT event_id, hour(t)::DOUBLE AS ts_hour, (isodow(t) - 1)::DOUBLE AS ts_dayofweek, month(t)::DOUBLE AS ts_month,
coalesce(isodow(t) >= 6, false)::INT AS ts_is_weekend
FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS t FROM events)""",
)
def timestamp_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events").withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts")))
    parts = df.select("event_id", *calendar.timestamp_features("ts"))
    return parts.withColumns({c: F.col(c).cast("double") for c in ("ts_hour", "ts_dayofweek", "ts_month")})


PORT = "CASE WHEN event_type <> 'error' THEN {k} * 710 - 100 END"


@registry.add(
    "port_flags",
    f"""SELECT event_id, coalesce(p BETWEEN 0 AND 1023, false)::INT AS port_is_well_known,
coalesce(p BETWEEN 1024 AND 49151, false)::INT AS port_is_registered, coalesce(p BETWEEN 49152 AND 65535, false)::INT AS port_is_dynamic
FROM (SELECT event_id, {PORT.format(k="CAST(json_extract_string(props, '$.k') AS INT)")} AS p FROM events)""",
)
def port_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    port = F.expr(PORT.format(k="cast(get_json_object(props, '$.k') AS int)"))
    return load(spark, sf_dir, "events").withColumn("port", port).select("event_id", *ports.port_features("port"))


@registry.add(
    "range_flags",
    """SELECT p_partkey, (p_size BETWEEN 1 AND 10)::INT AS size_small, (p_size BETWEEN 11 AND 35)::INT AS size_middle,
(p_size BETWEEN 36 AND 50)::INT AS size_large FROM part""",
)
def range_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = {"small": (1, 10), "middle": (11, 35), "large": (36, 50)}
    return load(spark, sf_dir, "part").select("p_partkey", *ports.range_flags(F.col("p_size"), "size", ranges))


# User agents built from the length of a document.
AGENT = """CASE WHEN n_chars < 475 THEN 'Mozilla/5.0 (Windows NT 10.0; Win64) Chrome/118.0 Safari/537.36 Edg/118.0'
WHEN n_chars < 740 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 16_0 like Mac OS X) Version/16.0 Safari/604.1'
WHEN n_chars < 990 THEN 'Mozilla/5.0 (Linux; Android 13) Chrome/118.0 Mobile Safari/537.36'
WHEN n_chars < 1200 THEN 'Opera/9.80 (X11; LINUX x86_64) Presto/2.12'
WHEN n_chars < 1480 THEN 'Mozilla/5.0 (Macintosh; Intel Mac OS X 13_0) Firefox/117.0'
WHEN n_chars < 1870 THEN 'Mozilla/5.0 (compatible; MSIE 9.0; windows nt 6.1; Trident/5.0)'
WHEN n_chars < 2400 THEN 'curl/8.1.2'
WHEN n_chars < 3260 THEN 'Mozilla/5.0 (iPad; U) CriOS/56.0 Safari/602.1'
WHEN n_chars < 5260 THEN '' ELSE NULL END"""


def agents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.expr(AGENT).alias("agent"))


@registry.add(
    "browser_from_agent",
    f"""SELECT doc_id, CASE WHEN regexp_matches(a, 'msie|trident') THEN 'Internet Explorer'
WHEN regexp_matches(a, 'safari') AND NOT regexp_matches(a, 'chrome|crios|chromium|edg|edge|opr|opera') THEN 'Safari'
WHEN regexp_matches(a, 'chrome|crios') THEN 'Chrome' WHEN regexp_matches(a, 'firefox') THEN 'Firefox'
WHEN regexp_matches(a, 'opr|opera') THEN 'Opera' WHEN regexp_matches(a, 'edg|edge') THEN 'Edge' ELSE 'Other' END AS browser
FROM (SELECT doc_id, lower(coalesce({AGENT}, '')) AS a FROM documents)""",
)
def browser_from_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agents_table(spark, sf_dir).select("doc_id", agents.browser_of(F.col("agent")).alias("browser"))


@registry.add(
    "os_from_agent",
    f"""SELECT doc_id, CASE WHEN regexp_matches(a, 'linux') THEN 'Linux' WHEN regexp_matches(a, 'iphone|ipad|ios') THEN 'iOS'
WHEN regexp_matches(a, 'android') THEN 'Android' WHEN regexp_matches(a, 'mac os x|macintosh') THEN 'macOS'
WHEN regexp_matches(a, 'windows nt|win64|win32|windows') THEN 'Windows' ELSE 'Other' END AS os
FROM (SELECT doc_id, lower(coalesce({AGENT}, '')) AS a FROM documents)""",
)
def os_from_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agents_table(spark, sf_dir).select("doc_id", agents.os_of(F.col("agent")).alias("os"))


@registry.add(
    "device_from_agent",
    f"""SELECT doc_id, coalesce(nullif(regexp_extract(a, '(?i)Windows', 0), ''), nullif(regexp_extract(a, '(?i)Linux', 0), ''),
nullif(regexp_extract(a, '(?i)Android', 0), ''), nullif(regexp_extract(a, '(?i)iPad', 0), ''), nullif(regexp_extract(a, '(?i)iPod', 0), ''),
nullif(regexp_extract(a, '(?i)iPhone', 0), ''), nullif(regexp_extract(a, '(?i)Macintosh', 0), ''), 'Unknown') AS device
FROM (SELECT doc_id, {AGENT} AS a FROM documents)""",
)
def device_from_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agents_table(spark, sf_dir).select("doc_id", agents.device_of(F.col("agent")).alias("device"))


@registry.add("agent_family", f"SELECT doc_id, split_part({AGENT}, '/', 1) AS family FROM documents")
def agent_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agents_table(spark, sf_dir).select("doc_id", text.first_part(F.col("agent"), "/").alias("family"))


@registry.add(
    "text_contains",
    """SELECT doc_id, regexp_matches(lower(text), 'license|email|benchmark') AS found FROM documents""",
)
def text_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", text.contains_any(F.col("text"), "license", "email", "benchmark").alias("found"))


@registry.add("text_length", "SELECT doc_id, length(coalesce(CASE WHEN lang <> 'de' THEN text END, ''))::INT AS size FROM documents")
def text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.when(F.col("lang") != "de", F.col("text"))
    return load(spark, sf_dir, "documents").select("doc_id", text.text_length(shown).alias("size"))


@registry.add("joined_labels", "SELECT p_partkey, concat_ws(' | ', coalesce(nullif(p_type, 'PROMO'), 'Unknown'), p_brand) AS label FROM part")
def joined_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.nullif(F.col("p_type"), F.lit("PROMO"))
    return load(spark, sf_dir, "part").select("p_partkey", text.join_labels(kind, F.col("p_brand")).alias("label"))


@registry.add(
    "name_keys",
    r"""SELECT p_partkey, regexp_replace(lower(p_brand || ' / ' || p_name), '[^a-z0-9]', '', 'g') AS key,
trim(regexp_replace(replace(regexp_replace(lower(' ' || p_name || ' (' || p_type || ') + ' || p_brand), '\([^)]*\)', '', 'g'), '+', 'plus'), '[^a-z0-9]+', '_', 'g'), '_') AS slug,
replace(replace(p_type || '/' || p_name, '/', '_'), ' ', '_') AS folder FROM part""",
)
def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, kind, brand = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    title = F.concat(F.lit(" "), name, F.lit(" ("), kind, F.lit(") + "), brand)
    return load(spark, sf_dir, "part").select(
        "p_partkey",
        text.alnum_key(F.concat(brand, F.lit(" / "), name)).alias("key"),
        text.slug(title).alias("slug"),
        text.folder_slug(F.concat(kind, F.lit("/"), name)).alias("folder"),
    )


@registry.add(
    "stamps",
    """SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS iso,
CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS parsed FROM events""",
)
def stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    stamp = calendar.format_stamp(ts)
    shown = F.when(F.col("event_type") == "error", F.concat(F.lit("run-"), stamp)).otherwise(stamp)
    return load(spark, sf_dir, "events").select(
        "event_id", stamp.alias("stamp"), calendar.format_iso(ts).alias("iso"), calendar.parse_stamp(shown).cast("timestamp_ntz").alias("parsed")
    )


@registry.add("half_even_rounding", "SELECT l_returnflag, count(*) AS n, round_even(avg(l_discount) * 100, 2)::DOUBLE AS pct FROM lineitem GROUP BY 1")
def half_even_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.bround(F.avg("l_discount") * 100, 2).alias("pct"))


@registry.add(
    "vector_norms",
    """SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS l2,
round(list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))) / len(embedding), 6) AS mean_abs,
list_max(embedding)::DOUBLE AS top FROM embeddings""",
)
def vector_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    return load(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.round(labels.l2_norm(v), 6).alias("l2"),
        F.round(labels.mean_abs(v), 6).alias("mean_abs"),
        labels.top_probability(array_to_vector(v)).alias("top"),
    )


KNOWN = ["click", "error", "purchase", "signup"]


@registry.add(
    "label_codes",
    """SELECT event_id, (nullif(list_position(['click', 'error', 'purchase', 'signup'], event_type), 0) - 1)::DOUBLE AS code,
CASE WHEN k BETWEEN 2 AND 5 THEN ['click', 'error', 'purchase', 'signup'][k - 1] ELSE '' END AS name
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
)
def label_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = F.get_json_object("props", "$.k").cast("int") - 2
    df = load(spark, sf_dir, "events")
    return df.select("event_id", labels.encode_label(F.col("event_type"), KNOWN).cast("double").alias("code"), labels.decode_label(index, KNOWN).alias("name"))


@registry.add(
    "label_indicators",
    """SELECT event_id, (event_type = 'click')::INT AS is_click, (event_type = 'error')::INT AS is_error,
(event_type = 'purchase')::INT AS is_purchase, (event_type = 'signup')::INT AS is_signup FROM events""",
)
def label_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks: list[Column] = [c.alias(f"is_{k}") for c, k in zip(labels.indicators(F.col("event_type"), KNOWN), KNOWN)]
    return load(spark, sf_dir, "events").select("event_id", *marks)


@registry.add(
    "json_with_defaults",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k,
coalesce(TRY_CAST(json_extract_string(props, '$.weight') AS DOUBLE), 1.5) AS weight FROM events""",
)
def json_with_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.col("props")
    return load(spark, sf_dir, "events").select("event_id", labels.json_or(props, "$.k", "int", 0).alias("k"), labels.json_or(props, "$.weight", "double", 1.5).alias("weight"))
