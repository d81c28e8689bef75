"""Imputation, one-hot, scaling, PCA and class weights as saved Spark ML stages with exact fitted constants."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, OneHotEncoder, PCAModel, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.operators.clean import col, numeric_and_categorical
from tabloom.operators.quantiles import quantiles

MISSING_CATEGORY = "(missing)"


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number_literal(value: float) -> str:
    return f"{float(value)!r}D"


def clean_number(c: Column) -> Column:
    """As double with NaN read as missing."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def medians(df: DataFrame, cols: Sequence[str], **options: int) -> dict[str, float]:
    """Exact median per column; columns without any value are left out."""
    if not cols:
        return {}
    return {r["column"]: r["q"][0] for r in quantiles(df, cols, [0.5], **options).collect()}


def category_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, value, count) of the non-null text values."""
    pairs = F.array(*(F.struct(F.lit(c).alias("feature"), col(c).cast("string").alias("value")) for c in cols))
    return df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count("*").alias("count"))


def modes(counts: DataFrame) -> DataFrame:
    """(feature, value): most frequent value, the smallest one on ties."""
    rank = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("count"), "value"))
    return counts.withColumn("_r", rank).filter("_r = 1").select("feature", "value")


def imputed(c: Column, value: float | str) -> Column:
    return F.coalesce(clean_number(c) if isinstance(value, float) else c.cast("string"), F.lit(value))


def scale_constants(df: DataFrame, fills: dict[str, float]) -> dict[str, tuple[float, float]]:
    """Mean and population std of each imputed column in one aggregate; a constant column gets std 1."""
    if not fills:
        return {}
    stats = []
    for i, (c, fill) in enumerate(fills.items()):
        filled = F.coalesce(clean_number(col(c)), F.lit(fill))
        stats += [F.avg(filled).alias(f"m{i}"), F.stddev_pop(filled).alias(f"s{i}")]
    row = df.agg(*stats).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(fills)}


@dataclass(frozen=True)
class Encoder:
    """Fitted preprocessing: numeric columns first, then one-hot blocks; other columns pass through."""

    model: PipelineModel
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    names: tuple[str, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


def fit_encoder(
    train: DataFrame,
    *,
    skip: Sequence[str] = (),
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    scale: bool = False,
    booleans_numeric: bool = True,
    missing_as_category: bool = False,
    output_col: str = "features",
) -> Encoder:
    """Median/mode imputation, optional standard scaling, one-hot with unknown values as all zeros.

    Columns are numeric or categorical by type unless listed. Columns without any train value are dropped.
    """
    by_type = numeric_and_categorical(train, skip=skip, booleans_numeric=booleans_numeric)
    num = list(by_type[0] if numeric is None else numeric)
    cat = list(by_type[1] if categorical is None else categorical)
    fills = medians(train, num)
    num = [c for c in num if c in fills]
    scaling = scale_constants(train, {c: fills[c] for c in num}) if scale else {}
    labels: dict[str, list[str]] = {}
    cat_fill: dict[str, str] = {}
    if cat:
        counts = category_counts(train, cat).persist()
        cat_fill = {r["feature"]: r["value"] for r in modes(counts).collect()}
        listed = counts.groupBy("feature").agg(F.sort_array(F.collect_list("value")).alias("values"))
        labels = {r["feature"]: list(r["values"]) for r in listed.collect()}
        counts.unpersist()
        if missing_as_category:
            cat_fill = dict.fromkeys(cat, MISSING_CATEGORY)
            labels = {c: sorted({*labels.get(c, []), MISSING_CATEGORY}) for c in cat}
        cat = [c for c in cat if c in labels]

    parts = []
    for i, c in enumerate(num):
        value = f"coalesce(nanvl(cast({_quote(c)} AS double), cast(null AS double)), {_number_literal(fills[c])})"
        if c in scaling:
            mean, std = scaling[c]
            value = f"({value} - {_number_literal(mean)}) / {_number_literal(std)}"
        parts.append(f"{value} AS {_quote(f'_num{i}')}")
    for i, c in enumerate(cat):
        parts.append(f"coalesce(cast({_quote(c)} AS string), {_text_literal(cat_fill[c])}) AS {_quote(f'_cat{i}')}")
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")]
    helper = [f"_num{i}" for i in range(len(num))] + [f"_cat{i}" for i in range(len(cat))]
    inputs = [f"_num{i}" for i in range(len(num))]
    if cat:
        raw, index, hot = ([f"{p}{i}" for i in range(len(cat))] for p in ("_cat", "_idx", "_hot"))
        # One stage per column: label arrays of unequal length are padded with nulls when passed together.
        stages += [StringIndexerModel.from_labels(labels[c], r, i, handleInvalid="keep") for c, r, i in zip(cat, raw, index)]
        probe = PipelineModel(stages).transform(train)
        stages.append(OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True).fit(probe))
        inputs += hot
        helper += [*index, *hot]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output_col))
    names = [*num, *(f"{c}_{v}" for c in cat for v in labels[c])]
    stages.append(SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(helper)}) FROM __THIS__"))
    return Encoder(PipelineModel(stages), tuple(num), tuple(cat), tuple(names))


def feature_names(df: DataFrame, vector: str = "features") -> list[str]:
    """Names kept in the vector column's metadata, in vector order."""
    groups = df.schema[vector].metadata.get("ml_attr", {}).get("attrs", {})
    return [a["name"] for a in sorted((a for g in groups.values() for a in g), key=lambda a: a["idx"])]


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, weight): n / (classes x rows of the class)."""
    counts = df.filter(col(label).isNotNull()).groupBy(col(label)).agg(F.count("*").alias("n"))
    every = Window.partitionBy()
    return counts.select(col(label), (F.sum("n").over(every) / (F.count("*").over(every) * F.col("n"))).alias("weight"))


def with_balanced_weights(df: DataFrame, label: str, *, name: str = "weight") -> DataFrame:
    """The weights of the few classes are folded into the plan, so no row is shuffled."""
    pairs = [F.lit(v) for r in balanced_weights(df, label).collect() for v in (r[0], r["weight"])]
    weight = F.element_at(F.create_map(*pairs), col(label)) if pairs else F.lit(None)
    return df.withColumn(name, weight.cast("double"))


@dataclass(frozen=True)
class Projection:
    """Centred principal components with a fixed sign: the largest loading of each is positive."""

    model: PCAModel
    shift: tuple[float, ...]
    sign: tuple[float, ...]
    explained: tuple[float, ...]
    output_col: str

    def transform(self, df: DataFrame) -> DataFrame:
        raw = self.model.transform(df)
        values = vector_to_array(F.col("_pca"))
        centred = F.array(*((F.get(values, F.lit(i)) - m) * s for i, (m, s) in enumerate(zip(self.shift, self.sign))))
        return raw.withColumn(self.output_col, array_to_vector(centred)).drop("_pca")

    def explained_variance(self, df: DataFrame) -> DataFrame:
        """(component, ratio, cumulative)."""
        rows = df.sparkSession.createDataFrame([(i + 1, float(v)) for i, v in enumerate(self.explained)], "component int, ratio double")
        upto = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn("cumulative", F.sum("ratio").over(upto))


def fit_pca(df: DataFrame, *, components: int = 50, features_col: str = "features", output_col: str = "pca") -> Projection:
    """Components are capped by the rows and columns at hand, as min(components, rows, columns)."""
    summary = df.select(Summarizer.metrics("mean", "count").summary(col(features_col)).alias("s")).select("s.mean", "s.count").first()
    mean = summary["mean"].toArray()
    k = max(1, min(components, len(mean), summary["count"]))
    model = PCA(k=k, inputCol=features_col, outputCol="_pca").fit(df)
    loadings = model.pc.toArray()
    sign = [1.0 if v[abs(v).argmax()] >= 0 else -1.0 for v in loadings.T]
    return Projection(model, tuple(map(float, mean @ loadings)), tuple(sign), tuple(map(float, model.explainedVariance.toArray())), output_col)
