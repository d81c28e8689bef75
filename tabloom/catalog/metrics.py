"""Classification, regression, curve and cluster metrics on predictions derived from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.catalog import Registry, load
from tabloom.catalog.splits import EVENT_SPLIT, EVENT_TIME_SPLIT, event_split
from tabloom.operators import curves, metrics, slices, split
from tabloom.plans import explore

registry = Registry()

# Predicted event type from the JSON value; 'refund' is never a true label.
GUESS = "CASE WHEN k < 20 THEN 'click' WHEN k < 45 THEN 'error' WHEN k < 60 THEN 'view' WHEN k < 80 THEN 'signup' ELSE 'refund' END"
GUESSED = f"(SELECT event_id, event_type AS y_true, {GUESS} AS y_pred FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"
LABELS = ["click", "error", "purchase", "refund", "signup", "view"]


def guessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return df.select("event_id", F.col("event_type").alias("y_true"), F.expr(GUESS).alias("y_pred"))


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


LABEL_LIST = "[" + ", ".join(f"'{v}'" for v in LABELS) + "]"
GRID = f"(SELECT (i - 1)::INT AS true_index, (j - 1)::INT AS pred_index, {LABEL_LIST}[i] AS y_true, {LABEL_LIST}[j] AS y_pred FROM range(1, 7) a(i), range(1, 7) b(j))"
CONFUSION = f"SELECT true_index, pred_index, y_true, y_pred, coalesce(n, 0) AS n FROM {GRID} LEFT JOIN (SELECT y_true, y_pred, count(*) AS n FROM {GUESSED} GROUP BY 1, 2) USING (y_true, y_pred)"


@registry.add("confusion_matrix", CONFUSION)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(guessed(spark, sf_dir), "y_true", "y_pred", LABELS)


@registry.add(
    "confusion_row_shares",
    f"SELECT *, round(n / CASE WHEN sum(n) OVER (PARTITION BY y_true) = 0 THEN 1 ELSE sum(n) OVER (PARTITION BY y_true) END, 6) AS share FROM ({CONFUSION})",
)
def confusion_row_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.row_shares(metrics.confusion(guessed(spark, sf_dir), "y_true", "y_pred", LABELS)), "share")


def scores_sql(source: str, by: str = "") -> str:
    """Per-label scores as SQL."""
    group = f"{by}, " if by else ""
    return f"""SELECT {group}label, tp, support, predicted, p AS precision, r AS recall, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1 FROM (
SELECT {group}label, sum(tp)::BIGINT AS tp, sum(s)::BIGINT AS support, sum(q)::BIGINT AS predicted, CASE WHEN sum(q) = 0 THEN 0.0 ELSE sum(tp) / sum(q) END AS p,
CASE WHEN sum(s) = 0 THEN 0.0 ELSE sum(tp) / sum(s) END AS r FROM (
SELECT {group}y_true AS label, (y_true = y_pred)::INT AS tp, 1 AS s, 0 AS q FROM {source} UNION ALL SELECT {group}y_pred, 0, 0, 1 FROM {source}) GROUP BY ALL)"""


@registry.add("class_scores", f"SELECT label, tp, support, predicted, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM ({scores_sql(GUESSED)})")
def class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.class_scores(guessed(spark, sf_dir), "y_true", "y_pred"), "precision", "recall", "f1")


@registry.add("top_classes_by_support", f"SELECT label, support, round(f1, 6) AS f1 FROM ({scores_sql(GUESSED)}) ORDER BY support DESC, label LIMIT 3")
def top_classes_by_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = metrics.class_scores(guessed(spark, sf_dir), "y_true", "y_pred")
    return _rounded(table.orderBy(F.desc("support"), "label").limit(3).select("label", "support", "f1"), "f1")


SUMMARY = """round(sum(tp) / sum(support), 6) AS accuracy, round(avg(recall) FILTER (support > 0), 6) AS balanced_accuracy, round(avg(f1), 6) AS macro_f1,
round(sum(f1 * support) / sum(support), 6) AS weighted_f1, sum(support)::BIGINT AS rows"""


@registry.add("classification_metrics", f"SELECT {SUMMARY} FROM ({scores_sql(GUESSED)})")
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.classification_metrics(guessed(spark, sf_dir), "y_true", "y_pred"), "accuracy", "balanced_accuracy", "macro_f1", "weighted_f1")


SPLIT_GUESSED = f"(SELECT split, y_true, y_pred FROM {GUESSED} JOIN (SELECT event_id, split FROM ({EVENT_SPLIT})) USING (event_id))"


def split_guessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.attach_split(guessed(spark, sf_dir), event_split(spark, sf_dir), row_id_col="event_id")


@registry.add("metrics_per_split", f"SELECT split, {SUMMARY} FROM ({scores_sql(SPLIT_GUESSED, 'split')}) GROUP BY 1")
def metrics_per_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.classification_metrics(split_guessed(spark, sf_dir), "y_true", "y_pred", ["split"])
    return _rounded(out, "accuracy", "balanced_accuracy", "macro_f1", "weighted_f1")


@registry.add("class_f1_per_split", f"SELECT split, label, round(f1, 6) AS f1 FROM ({scores_sql(SPLIT_GUESSED, 'split')}) WHERE split <> 'train'")
def class_f1_per_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = split_guessed(spark, sf_dir).filter(F.col("split") != "train")
    return _rounded(metrics.class_scores(held, "y_true", "y_pred", ["split"]).select("split", "label", "f1"), "f1")


@registry.add(
    "classification_report",
    f"""WITH s AS ({scores_sql(GUESSED)}) SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM s
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), sum(support)::BIGINT FROM s
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM s
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM s""",
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.classification_report(guessed(spark, sf_dir), "y_true", "y_pred"), "precision", "recall", "f1")


# Regression: the prediction is the mean value of the event type.
PREDICTED = "(SELECT event_id, event_type, ts, value, avg(value) OVER (PARTITION BY event_type) AS pred FROM events)"


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    return df.join(df.groupBy("event_type").agg(F.avg("value").alias("pred")), "event_type")


ERRORS = "round(avg(abs(value - pred)), 6) AS mae, round(sqrt(avg((value - pred) * (value - pred))), 6) AS rmse, round(1 - sum((value - pred) * (value - pred)) / (var_pop(value) * count(*)), 6) AS r2, count(*) AS rows"


@registry.add("regression_metrics", f"SELECT {ERRORS} FROM {PREDICTED}")
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.regression_metrics(predicted(spark, sf_dir), "value", "pred"), "mae", "rmse", "r2")


TIMED = f"(SELECT s.split, e.value, e.event_type FROM events e JOIN (SELECT event_id, split FROM ({EVENT_TIME_SPLIT})) s USING (event_id))"


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events")
    return df.withColumn("split", split.split_by_cuts(df, "ts", split.time_cuts(df, "ts")))


@registry.add("mean_baseline", f"SELECT split, {ERRORS} FROM (SELECT split, value, (SELECT avg(value) FROM {TIMED} WHERE split = 'train') AS pred FROM {TIMED}) GROUP BY 1")
def mean_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.mean_baseline(timed(spark, sf_dir), "value"), "mae", "rmse", "r2")


@registry.add(
    "prediction_spread",
    f"SELECT split, round(stddev_pop(pred), 6) AS pred_std, count(pred) AS rows FROM (SELECT split, avg(value) OVER (PARTITION BY event_type) AS pred FROM {TIMED}) GROUP BY 1",
)
def prediction_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = timed(spark, sf_dir)
    means = df.groupBy("event_type").agg(F.avg("value").alias("pred"))
    return _rounded(metrics.prediction_spread(df.join(means, "event_type"), "pred"), "pred_std")


@registry.add("actual_and_predicted_series", f"SELECT ts, value, round(pred, 6) AS pred FROM {PREDICTED} ORDER BY ts")
def actual_and_predicted_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(slices.series_over_time(predicted(spark, sf_dir), "ts", ["value", "pred"]), "pred")


# One constant predictor per event type, scored on every event.
BOARD = f"(SELECT model, {ERRORS} FROM (SELECT m.model, e.value, m.pred FROM events e, (SELECT event_type AS model, avg(value) AS pred FROM events GROUP BY 1) m) GROUP BY 1)"


def constant_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events")
    means = df.groupBy("event_type").agg(F.avg("value").alias("pred")).collect()
    tagged = F.array(*(F.struct(F.lit(r["event_type"]).alias("model"), F.lit(r["pred"]).alias("pred")) for r in means))
    scored = df.select("value", F.inline(tagged))
    return _rounded(metrics.regression_metrics(scored, "value", "pred", ["model"]), "mae", "rmse", "r2")


@registry.add("leaderboard", f"SELECT * FROM {BOARD} ORDER BY rmse, model")
def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.leaderboard(constant_board(spark, sf_dir), "rmse", largest=False)


@registry.add("best_model", f"SELECT * FROM {BOARD} ORDER BY rmse, model LIMIT 1")
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.best_row(constant_board(spark, sf_dir), "rmse", largest=False)


SCORED = "(SELECT n_chars::DOUBLE AS score, quality AS hit FROM documents JOIN labels USING (doc_id))"


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", "n_chars").join(load(spark, sf_dir, "labels"), "doc_id")


def run_sql(source: str, by: str = "") -> str:
    """Cumulative counts per distinct score as SQL."""
    group = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""SELECT *, sum(pos) OVER ({part}) AS p, sum(neg) OVER ({part}) AS n, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
row_number() OVER w AS rn FROM (SELECT {group}score, sum(hit)::DOUBLE AS pos, sum(1 - hit)::DOUBLE AS neg FROM {source} GROUP BY ALL) WINDOW w AS ({part}ORDER BY score DESC)"""


AREAS = """round(sum(neg * (tp + tp - pos) / 2) / (max(p) * max(n)), 6) AS roc_auc, round(sum(pos * tp / (tp + fp)) / max(p), 6) AS average_precision,
round(sum(pos * (tp / (tp + fp) + CASE WHEN rn = 1 THEN 1.0 ELSE (tp - pos) / (tp - pos + fp - neg) END) / 2) / max(p), 6) AS pr_auc,
max(p)::BIGINT AS positives, max(n)::BIGINT AS negatives"""


def _areas(df: DataFrame) -> DataFrame:
    return _rounded(df, "roc_auc", "average_precision", "pr_auc")


@registry.add("curve_areas", f"SELECT {AREAS} FROM ({run_sql(SCORED)})")
def curve_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _areas(curves.curve_areas(scored_documents(spark, sf_dir), "n_chars", F.col("quality") == 1))


BENDS = "rn = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg"


@registry.add("roc_points", f"SELECT score AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM ({run_sql(SCORED)}) WHERE {BENDS}")
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(curves.roc_points(scored_documents(spark, sf_dir), "n_chars", F.col("quality") == 1), "fpr", "tpr")


@registry.add("precision_recall_points", f"SELECT score AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall FROM ({run_sql(SCORED)})")
def precision_recall_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(curves.pr_points(scored_documents(spark, sf_dir), "n_chars", F.col("quality") == 1), "precision", "recall")


# One score per event type, from the columns of the event.
CLASSES = ["click", "error", "purchase", "signup", "view"]
CLASS_SCORES = ["k / 100.0", "user_id / 150.0", "value / 500.0", "(100 - k) / 100.0", "(150 - user_id) / 150.0"]
LONG = "(" + " UNION ALL ".join(
    f"SELECT '{c}' AS class, ({s.replace('k', 'CAST(k AS DOUBLE)') if 'k' in s else s})::DOUBLE AS score, (event_type = '{c}')::INT AS hit FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)"
    for c, s in zip(CLASSES, CLASS_SCORES)
) + ")"


def class_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    scores = [F.col("k") / 100.0, F.col("user_id") / 150.0, F.col("value") / 500.0, (100 - F.col("k")) / 100.0, (150 - F.col("user_id")) / 150.0]
    return df.select("event_type", F.array(*scores).alias("scores"))


@registry.add("one_vs_rest_areas", f"SELECT class, {AREAS} FROM ({run_sql(LONG, 'class')}) GROUP BY 1")
def one_vs_rest_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _areas(curves.class_areas(class_scored(spark, sf_dir), "event_type", F.col("scores"), CLASSES))


@registry.add("micro_average_areas", f"SELECT {AREAS} FROM ({run_sql(LONG)})")
def micro_average_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _areas(curves.micro_areas(class_scored(spark, sf_dir), "event_type", F.col("scores"), CLASSES))


MACRO = f"""WITH p AS (SELECT class, fp / n AS x, min(tp / p) AS enter, max(tp / p) AS leave FROM (SELECT class, fp, n, tp, p FROM ({run_sql(LONG, 'class')}) WHERE {BENDS}
UNION ALL SELECT DISTINCT class, 0.0, 1.0, 0.0, 1.0 FROM {LONG}) GROUP BY ALL),
g AS (SELECT class, x FROM (SELECT DISTINCT x FROM p), (SELECT DISTINCT class FROM p)),
j AS (SELECT g.class, g.x, p.x AS kx, enter, leave FROM g LEFT JOIN p ON g.class = p.class AND g.x = p.x),
w AS (SELECT class, x, kx, leave, last_value(kx IGNORE NULLS) OVER b AS lx, last_value(leave IGNORE NULLS) OVER b AS ly, first_value(kx IGNORE NULLS) OVER a AS rx, first_value(enter IGNORE NULLS) OVER a AS ry FROM j
WINDOW b AS (PARTITION BY class ORDER BY x ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY class ORDER BY x ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
m AS (SELECT x AS fpr, avg(CASE WHEN kx IS NOT NULL THEN leave WHEN rx IS NULL THEN ly ELSE ly + (ry - ly) / (rx - lx) * (x - lx) END) AS tpr FROM w GROUP BY 1)"""


@registry.add("macro_average_roc", f"{MACRO} SELECT round(fpr, 6) AS fpr, round(tpr, 5) AS tpr FROM m")
def macro_average_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = curves.macro_roc(class_scored(spark, sf_dir), "event_type", F.col("scores"), CLASSES)
    return points.select(F.round("fpr", 6).alias("fpr"), F.round("tpr", 5).alias("tpr"))


@registry.add(
    "macro_average_area",
    f"{MACRO} SELECT round(sum((fpr - was) * (tpr + had) / 2), 6) AS area FROM (SELECT fpr, tpr, lag(fpr) OVER (ORDER BY fpr) AS was, lag(tpr) OVER (ORDER BY fpr) AS had FROM m)",
)
def macro_average_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = curves.macro_roc(class_scored(spark, sf_dir), "event_type", F.col("scores"), CLASSES)
    return _rounded(curves.curve_area(points, "fpr", "tpr"), "area")


CLUSTERED = "(SELECT vec_id, label, (embedding[1] > 0)::INT * 2 + (embedding[2] > 0)::INT - CASE WHEN embedding[3] > 0.2 THEN 5 ELSE 0 END AS c FROM embeddings)"
CLUSTER = f"(SELECT vec_id, label, CASE WHEN c < 0 THEN -1 ELSE c END AS cluster FROM {CLUSTERED})"


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    rule = (e[0] > 0).cast("int") * 2 + (e[1] > 0).cast("int")
    return load(spark, sf_dir, "embeddings").select("vec_id", "label", F.when(e[2] > F.lit(0.2), -1).otherwise(rule).alias("cluster"))


@registry.add(
    "cluster_agreement",
    f"""WITH c AS (SELECT label, cluster, count(*)::DOUBLE AS n FROM {CLUSTER} GROUP BY 1, 2), a AS (SELECT sum(n) AS n FROM c GROUP BY label), b AS (SELECT sum(n) AS n FROM c GROUP BY cluster),
s AS (SELECT (SELECT sum(n) FROM c) AS t, (SELECT sum(n * (n - 1) / 2) FROM c) AS pc, (SELECT sum(n * (n - 1) / 2) FROM a) AS pa, (SELECT sum(n * (n - 1) / 2) FROM b) AS pb,
(SELECT sum(n * ln(n)) FROM c) AS lc, (SELECT sum(n * ln(n)) FROM a) AS la, (SELECT sum(n * ln(n)) FROM b) AS lb)
SELECT round((pc - pa * pb / (t * (t - 1) / 2)) / ((pa + pb) / 2 - pa * pb / (t * (t - 1) / 2)), 6) AS ari,
round((ln(t) + (lc - la - lb) / t) / ((ln(t) - la / t + ln(t) - lb / t) / 2), 6) AS nmi FROM s""",
)
def cluster_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.cluster_agreement(clustered(spark, sf_dir), "label", "cluster"), "ari", "nmi")


@registry.add("cluster_sizes", f"SELECT cluster, count(*) AS count FROM {CLUSTER} GROUP BY 1")
def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.cluster_sizes(clustered(spark, sf_dir), "cluster")


@registry.add("cluster_summary", f"SELECT count(DISTINCT cluster) FILTER (cluster <> -1) AS clusters, count(*) FILTER (cluster = -1) AS noise, count(*) AS rows FROM {CLUSTER}")
def cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.cluster_summary(clustered(spark, sf_dir), "cluster")


@registry.add(
    "label_by_cluster",
    f"""SELECT label, {', '.join(f'count(*) FILTER (cluster = {c}) AS "{c}"' for c in (-1, 0, 1, 2, 3))}, count(*) AS total FROM {CLUSTER} GROUP BY 1 ORDER BY total DESC, label""",
)
def label_by_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.cluster_report(clustered(spark, sf_dir), "cluster", "label")
