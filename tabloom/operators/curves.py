"""ROC and precision-recall curves on distinct scores, exact for ties.

Rows are first counted per distinct score, so a hot score is one row; running totals over the ordered scores come
from range blocks. Areas are sums over the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.operators.clean import col
from tabloom.operators.ordered import running_totals
from tabloom.session import shuffle_partitions, small_side, stash


def score_table(df: DataFrame, score: str, positive: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by..., score, pos, neg) per distinct score."""
    hit = F.coalesce(positive, F.lit(False)).cast("bigint")
    return (
        df.filter(col(score).isNotNull())
        .select(*map(col, by), col(score).cast("double").alias("score"), hit.alias("_hit"))
        .groupBy(*map(col, by), "score")
        .agg(F.sum("_hit").alias("pos"), F.sum(1 - F.col("_hit")).alias("neg"))
    )


def one_vs_rest(df: DataFrame, label: str, scores: Column, classes: Sequence[str]) -> DataFrame:
    """One row per class and input row: (class, score, positive). scores is an array in class order."""
    pairs = F.array(*(F.struct(F.lit(str(k)).alias("class"), F.get(scores, F.lit(i)).cast("double").alias("score"), (col(label).cast("string") == str(k)).alias("positive")) for i, k in enumerate(classes)))
    return df.select(F.inline(pairs))


def cumulative(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """score_table with tp, fp at each threshold and the group totals p, n."""
    run = running_totals(table, [F.desc("score")], {"tp": "pos", "fp": "neg"}, within=by, carry_next=("pos", "neg"))
    sums = table.groupBy(*map(col, by)).agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    if not by:
        p, n = sums.first() or (0, 0)
        return run.withColumns({"p": F.lit(p).cast("bigint"), "n": F.lit(n).cast("bigint")})
    renamed = sums.select(*(col(b).alias(f"_t{i}") for i, b in enumerate(by)), "p", "n")
    on = F.lit(True)
    for i, b in enumerate(by):
        on = col(b).eqNullSafe(F.col(f"_t{i}")) if i == 0 else on & col(b).eqNullSafe(F.col(f"_t{i}"))
    return run.join(small_side(renamed), on).drop(*(f"_t{i}" for i in range(len(by))))


def _rate(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / F.when(bottom > 0, bottom))


def roc_points(df: DataFrame, score: str, positive: Column, by: Sequence[str] = (), *, drop_collinear: bool = True) -> DataFrame:
    """(by..., threshold, fpr, tpr) without the origin point; points on a straight run may be dropped."""
    run = cumulative(score_table(df, score, positive, by), by)
    if drop_collinear:
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        bend = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg")) | F.col("next_pos").isNull()
        run = run.filter(first | bend)
    return run.select(*map(col, by), F.col("score").alias("threshold"), _rate(F.col("fp"), F.col("n")).alias("fpr"), _rate(F.col("tp"), F.col("p")).alias("tpr"))


def pr_points(df: DataFrame, score: str, positive: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by..., threshold, precision, recall) without the end point (recall 0, precision 1)."""
    run = cumulative(score_table(df, score, positive, by), by)
    return run.select(
        *map(col, by), F.col("score").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), _rate(F.col("tp"), F.col("p")).alias("recall")
    )


def curve_areas(df: DataFrame, score: str, positive: Column, by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC, average precision (step sum) and the trapezoid area under the PR curve."""
    run = cumulative(score_table(df, score, positive, by), by)
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    was_tp, was_fp = tp - pos, fp - neg
    precision = tp / (tp + fp)
    start = (was_tp + was_fp) == 0
    was_precision = F.when(start, 1.0).otherwise(was_tp / F.when(start, 1.0).otherwise(was_tp + was_fp))
    out = run.groupBy(*map(col, by)).agg(
        F.sum(neg * (tp + was_tp) / 2).alias("_roc"),
        F.sum(pos * precision).alias("_ap"),
        F.sum(pos * (precision + was_precision) / 2).alias("_pr"),
        F.max("p").alias("positives"),
        F.max("n").alias("negatives"),
    )
    p, n = F.col("positives"), F.col("negatives")
    return out.select(
        *map(col, by), _rate(F.col("_roc"), p * n).alias("roc_auc"), _rate(F.col("_ap"), p).alias("average_precision"), _rate(F.col("_pr"), p).alias("pr_auc"), "positives", "negatives"
    )


def micro_areas(df: DataFrame, label: str, scores: Column, classes: Sequence[str]) -> DataFrame:
    """Areas over all class decisions taken together."""
    return curve_areas(one_vs_rest(df, label, scores, classes), "score", F.col("positive"))


def class_areas(df: DataFrame, label: str, scores: Column, classes: Sequence[str]) -> DataFrame:
    return curve_areas(one_vs_rest(df, label, scores, classes), "score", F.col("positive"), ["class"])


def macro_roc(df: DataFrame, label: str, scores: Column, classes: Sequence[str], *, blocks: int | None = None) -> DataFrame:
    """(fpr, tpr): mean over classes of the TPR interpolated on the union of all FPR values.

    The FPR axis is cut into equal blocks. Distinct FPR values are at least 1/negatives apart, so no block is hot;
    the nearest curve point before and after each block is carried in from a blocks x classes table.
    """
    spark = df.sparkSession
    long = one_vs_rest(df, label, scores, classes)
    curve = roc_points(long, "score", F.col("positive"), ["class"]).select("class", "fpr", "tpr")
    origin = spark.createDataFrame([(str(k), 0.0, 0.0) for k in classes], "class string, fpr double, tpr double")
    count = blocks or shuffle_partitions(df)
    points = stash(
        curve.unionByName(origin).groupBy("class", "fpr").agg(F.min("tpr").alias("enter"), F.max("tpr").alias("leave"))
    )
    block = F.least(F.floor(F.col("fpr") * count), F.lit(count - 1)).cast("int")
    names = F.explode(F.array(*(F.lit(str(k)) for k in classes)))
    grid = points.select("fpr").distinct().select(names.alias("class"), "fpr")
    marked = grid.join(points, ["class", "fpr"], "left").withColumn("block", block)
    known = F.col("leave").isNotNull()
    left, right = F.struct("fpr", F.col("leave").alias("y")), F.struct("fpr", F.col("enter").alias("y"))
    edges = marked.filter(known).groupBy("class", "block").agg(F.max_by(left, "fpr").alias("tail"), F.min_by(right, "fpr").alias("head"))
    every = spark.range(count).select(names.alias("class"), F.col("id").cast("int").alias("block"))
    along = Window.partitionBy("class").orderBy("block")
    carried = every.join(edges, ["class", "block"], "left").select(
        "class",
        "block",
        F.last("tail", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("carry_left"),
        F.first("head", ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing)).alias("carry_right"),
    )
    inside = Window.partitionBy("class", "block").orderBy("fpr")
    before = F.last(F.when(known, left), ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(F.when(known, right), ignorenulls=True).over(inside.rowsBetween(1, Window.unboundedFollowing))
    # classes x blocks rows
    placed = marked.withColumns({"_l": before, "_r": after}).join(F.broadcast(carried), ["class", "block"])
    lo, hi = F.coalesce("_l", "carry_left"), F.coalesce("_r", "carry_right")
    slope = (hi["y"] - lo["y"]) / (hi["fpr"] - lo["fpr"])
    value = F.when(known, F.col("leave")).when(hi.isNull(), lo["y"]).otherwise(lo["y"] + slope * (F.col("fpr") - lo["fpr"]))
    return placed.withColumn("_v", value).groupBy("fpr").agg(F.avg("_v").alias("tpr"))


def curve_area(points: DataFrame, x: str, y: str) -> DataFrame:
    """Trapezoid area under a table of points with distinct x."""
    table = points.select(col(x).alias("_x"), col(y).alias("_y"))
    one = F.lit(1)
    run = running_totals(table.withColumn("_one", one), ["_x"], {"_i": "_one"}, carry_next=("_x", "_y"))
    return run.agg(F.coalesce(F.sum((F.col("next__x") - F.col("_x")) * (F.col("next__y") + F.col("_y")) / 2), F.lit(0.0)).alias("area"))
