"""Classification, regression and cluster metrics as tables. Every function takes optional group columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.operators.clean import col
from tabloom.operators.slices import with_share


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, and 0 for a zero denominator."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / F.when(bottom == 0, 1).otherwise(bottom))


def pair_counts(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., y_true, y_pred, n): all that the classification and cluster metrics need from the rows."""
    return (
        df.filter(col(truth).isNotNull() & col(pred).isNotNull())
        .groupBy(*map(col, by), col(truth).cast("string").alias("y_true"), col(pred).cast("string").alias("y_pred"))
        .agg(F.count("*").alias("n"))
    )


def confusion(df: DataFrame, truth: str, pred: str, labels: Sequence) -> DataFrame:
    """Counts for every pair of listed labels, 0 where absent, in label order."""
    names = [str(v) for v in labels]
    grid = df.sparkSession.createDataFrame([(i, j, a, b) for i, a in enumerate(names) for j, b in enumerate(names)], "true_index int, pred_index int, y_true string, y_pred string")
    cells = grid.join(pair_counts(df, truth, pred), ["y_true", "y_pred"], "left")
    return cells.select("true_index", "pred_index", "y_true", "y_pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def row_shares(cells: DataFrame) -> DataFrame:
    return with_share(cells, ["y_true"], value="n")


def class_scores(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every label that occurs as truth or prediction."""
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("y_true").alias("label"), hit.cast("bigint").alias("tp"), F.col("n").alias("support"), zero.alias("predicted")),
        F.struct(F.col("y_pred").alias("label"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("predicted")),
    )
    totals = (
        pair_counts(df, truth, pred, by)
        .select(*map(col, by), F.inline(sides))
        .groupBy(*map(col, by), "label")
        .agg(*(F.sum(c).alias(c) for c in ("tp", "support", "predicted")))
    )
    p, r = ratio(F.col("tp"), F.col("predicted")), ratio(F.col("tp"), F.col("support"))
    return totals.withColumns({"precision": p, "recall": r}).withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def classification_metrics(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, balanced accuracy (mean recall of labels that occur), macro and weighted F1, rows."""
    s = F.col("support")
    return class_scores(df, truth, pred, by).groupBy(*map(col, by)).agg(
        (F.sum("tp") / F.sum(s)).alias("accuracy"),
        F.avg(F.when(s > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * s) / F.sum(s)).alias("weighted_f1"),
        F.sum(s).alias("rows"),
    )


def classification_report(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Per-label rows plus 'accuracy', 'macro avg' and 'weighted avg'."""
    scores = class_scores(df, truth, pred, by)
    s = F.col("support")

    def averaged(weight: Column) -> list[Column]:
        return [F.sum(F.col(m) * weight) / F.sum(weight) for m in ("precision", "recall", "f1")]

    accuracy = F.sum("tp") / F.sum(s)
    rows = F.array(
        *(
            F.struct(F.lit(name).alias("label"), *(v.alias(m) for m, v in zip(("precision", "recall", "f1"), values)), F.sum(s).alias("support"))
            for name, values in (("accuracy", [accuracy] * 3), ("macro avg", averaged(F.lit(1))), ("weighted avg", averaged(s)))
        )
    )
    totals = scores.groupBy(*map(col, by)).agg(rows.alias("r")).select(*map(col, by), F.inline("r"))
    return scores.select(*map(col, by), "label", "precision", "recall", "f1", "support").unionByName(totals)


def regression_metrics(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R2 and rows in one pass; rows with a missing side are left out."""
    y, e = col(truth).cast("double"), col(truth).cast("double") - col(pred).cast("double")
    rows = df.filter(col(truth).isNotNull() & col(pred).isNotNull()).select(*map(col, by), y.alias("_y"), e.alias("_e"))
    out = rows.groupBy(*map(col, by)).agg(
        F.avg(F.abs("_e")).alias("mae"),
        F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("rmse"),
        F.sum(F.col("_e") * F.col("_e")).alias("_sse"),
        (F.var_pop("_y") * F.count("*")).alias("_sst"),
        F.count("*").alias("rows"),
    )
    flat = F.when(F.col("_sse") == 0, 1.0).otherwise(0.0)
    r2 = F.when(F.col("_sst") == 0, flat).otherwise(1 - F.col("_sse") / F.when(F.col("_sst") == 0, 1.0).otherwise(F.col("_sst")))
    return out.withColumn("r2", r2).select(*map(col, by), "mae", "rmse", "r2", "rows")


def with_residuals(df: DataFrame, truth: str, pred: str) -> DataFrame:
    residual = col(truth) - col(pred)
    return df.withColumns({"residual": residual, "abs_error": F.abs(residual)})


def mean_baseline(df: DataFrame, target: str, *, split_col: str = "split", fit_on: str = "train") -> DataFrame:
    """Metrics per split of always predicting the train mean."""
    mean = df.filter(col(split_col) == fit_on).agg(F.avg(col(target))).first()[0]
    return regression_metrics(df.withColumn("_pred", F.lit(mean)), target, "_pred", [split_col])


def prediction_spread(df: DataFrame, pred: str, by: Sequence[str] = ("split",)) -> DataFrame:
    return df.groupBy(*map(col, by)).agg(F.stddev_pop(col(pred)).alias("pred_std"), F.count(col(pred)).alias("rows"))


def cluster_agreement(df: DataFrame, truth: str, cluster: str, by: Sequence[str] = ()) -> DataFrame:
    """Adjusted Rand index and normalised mutual information (arithmetic mean) from the contingency table."""
    keys = list(by)
    cells = pair_counts(df, truth, cluster, by)
    rows = cells.groupBy(*map(col, keys), "y_true").agg(F.sum("n").alias("n")).withColumn("kind", F.lit("a")).drop("y_true")
    cols = cells.groupBy(*map(col, keys), "y_pred").agg(F.sum("n").alias("n")).withColumn("kind", F.lit("b")).drop("y_pred")
    both = cells.select(*map(col, keys), "n", F.lit("ab").alias("kind"))
    n = F.col("n").cast("double")
    pairs, entropy = n * (n - 1) / 2, n * F.log(n)

    def of(kind: str, value: Column) -> Column:
        return F.sum(F.when(F.col("kind") == kind, value))

    sums = both.unionByName(rows).unionByName(cols).groupBy(*map(col, keys)).agg(
        of("a", n).alias("total"),
        *(of(k, pairs).alias(f"pairs_{k}") for k in ("ab", "a", "b")),
        *(of(k, entropy).alias(f"nlogn_{k}") for k in ("ab", "a", "b")),
    )
    t = F.col("total")
    chance = F.col("pairs_a") * F.col("pairs_b") / F.when(t < 2, 1.0).otherwise(t * (t - 1) / 2)
    top, best = F.col("pairs_ab") - chance, (F.col("pairs_a") + F.col("pairs_b")) / 2 - chance
    ari = F.when(best == 0, 1.0).otherwise(top / F.when(best == 0, 1.0).otherwise(best))
    h_a, h_b = F.log(t) - F.col("nlogn_a") / t, F.log(t) - F.col("nlogn_b") / t
    mutual = F.log(t) + (F.col("nlogn_ab") - F.col("nlogn_a") - F.col("nlogn_b")) / t
    mean = (h_a + h_b) / 2
    tiny = F.lit(1e-12)
    nmi = F.when((h_a <= tiny) & (h_b <= tiny), 1.0).when(mutual <= tiny, 0.0).otherwise(mutual / F.when(mean <= tiny, 1.0).otherwise(mean))
    return sums.select(*map(col, keys), ari.alias("ari"), nmi.alias("nmi"))


def cluster_sizes(df: DataFrame, cluster: str) -> DataFrame:
    return df.groupBy(col(cluster)).agg(F.count("*").alias("count"))


def cluster_summary(df: DataFrame, cluster: str, by: Sequence[str] = ()) -> DataFrame:
    """Number of clusters, noise rows (-1) and rows."""
    sizes = df.groupBy(*map(col, by), col(cluster)).agg(F.count("*").alias("n"))
    noise = col(cluster) == -1
    return sizes.groupBy(*map(col, by)).agg(
        F.count_if(~noise).alias("clusters"), F.coalesce(F.sum(F.when(noise, F.col("n"))), F.lit(0)).alias("noise"), F.sum("n").alias("rows")
    )


def label_table(df: DataFrame, label: str, by: Sequence[str] = ("split",)) -> DataFrame:
    return df.groupBy(*map(col, by), col(label)).agg(F.count("*").alias("count"))
