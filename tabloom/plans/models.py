"""Model list as data: what each experiment fits, with its parameters and whether it needs scaling."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.labels import decode_label, l2_norm, mean_abs
from tabloom.operators.boosting import Boosting, fit_boosted
from tabloom.operators.clean import col
from tabloom.operators.dbscan import assign_clusters, dbscan, dbscan_vectors
from tabloom.operators.encode import balanced_weights, fit_pca, with_balanced_weights
from tabloom.operators.forest import Forest, columns_of, fit_trees, fits
from tabloom.operators.neighbours import nearest, neighbour_mean, vote
from tabloom.operators.pls import fit_pls
from tabloom.operators.selection import select_features
from tabloom.session import stash

SEED = 42
# Limits of Spark: deepest tree, and widest table solved by normal equations.
SPARK_MAX_DEPTH = 30
NORMAL_EQUATION_COLUMNS = 4096
# Trees times rows up to which Spark's own trees are fitted: their nodes stand on the driver as objects.
SPARK_TREE_ROWS = 1_000_000


class Fitted(Protocol):
    def transform(self, df: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class Training:
    """What a model may need to know about its train table, beside the table itself."""

    classes: tuple[str, ...] = ()
    features_col: str = "features"
    label_col: str = "label"
    id_col: str = "row_id"
    dims: tuple[str, ...] = ()


@dataclass(frozen=True)
class ModelSpec:
    slug: str
    title: str
    task: str
    needs_scaling: bool
    fit: Callable[..., Fitted]
    params: dict[str, Any] = field(default_factory=dict)

    def train(self, df: DataFrame, context: Training, **overrides: Any) -> Fitted:
        return self.fit(df, context, **{**self.params, **overrides})


def normalised_scores(raw: Column) -> Column:
    """Class shares from one-vs-rest margins: logistic of each margin, divided by their sum."""
    odds = F.transform(vector_to_array(raw), lambda m: 1 / (1 + F.exp(-m)))
    total = F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
    return F.transform(odds, lambda v: v / total)


def class_probabilities(predictions: DataFrame) -> Column:
    """Array of class probabilities of a prediction table; one-vs-rest margins are normalised."""
    if "probability" in predictions.columns:
        return vector_to_array(F.col("probability"))
    return normalised_scores(F.col("rawPrediction"))


def _weighted(df: DataFrame, c: Training, balanced: bool) -> DataFrame:
    return with_balanced_weights(df, c.label_col) if balanced else df.withColumn("weight", F.lit(1.0))


def _base(c: Training) -> dict[str, str]:
    return {"featuresCol": c.features_col, "labelCol": c.label_col}


def logistic(c: Training, rows: int, *, penalty: float = 0.0, strength: float = 1.0, max_iter: int = 2000, features_col: str | None = None) -> LogisticRegression:
    """Multinomial regression; an inverse strength of 1 over summed losses is 1/rows over their mean."""
    return LogisticRegression(
        featuresCol=features_col or c.features_col,
        labelCol=c.label_col,
        weightCol="weight",
        family="multinomial",
        standardization=False,
        regParam=1.0 / (strength * max(rows, 1)),
        elasticNetParam=penalty,
        maxIter=max_iter,
        tol=1e-6,
    )


def fit_logistic(df: DataFrame, c: Training, *, penalty: float = 0.0, balanced: bool = True, max_iter: int = 2000) -> Fitted:
    return logistic(c, df.count(), penalty=penalty, max_iter=max_iter).fit(_weighted(df, c, balanced))


def _large_trees(df: DataFrame, c: Training, *, trees: int, max_depth: int | None, seed: int, all_columns: bool, drawn: bool, balanced: bool = False, regression: bool = False) -> Fitted | None:
    """Trees grown in the tasks, for tables on which Spark's would flood the driver; None where Spark fits them."""
    label = col(c.label_col)
    facts = (F.count("*"), F.min(label), F.max(label), F.min((label == F.floor(label)).cast("int")), F.max((label.isNull() | F.isnan(label)).cast("int")))
    rows, low, top, whole, missing = df.agg(*facts).first()
    first = df.select(col(c.features_col)).first()
    if first is None or missing or rows * trees <= SPARK_TREE_ROWS:  # Spark refuses missing labels
        return None
    width, classes = first[0].size, 0 if regression else int(top) + 1
    if not fits(rows, width, classes) or (classes and (low < 0 or top > 255 or not whole)):
        return None
    weights = [1.0] * classes
    if balanced and classes:
        for r in balanced_weights(df, c.label_col).collect():
            weights[int(r[0])] = float(r["weight"])
    columns = width if all_columns or trees == 1 else columns_of(width)
    plan = Forest(trees, SPARK_MAX_DEPTH if max_depth is None else max_depth, columns, drawn, classes, tuple(weights), seed)
    return fit_trees(df, plan, features_col=c.features_col, label_col=c.label_col, id_col=c.id_col)


def fit_forest(df: DataFrame, c: Training, *, trees: int, max_depth: int | None = None, balanced: bool = False, seed: int = SEED) -> Fitted:
    """Unlimited depth is Spark's deepest tree."""
    if large := _large_trees(df, c, trees=trees, max_depth=max_depth, seed=seed, all_columns=False, drawn=trees > 1, balanced=balanced):
        return large
    forest = RandomForestClassifier(
        **_base(c), weightCol="weight", numTrees=trees, maxDepth=SPARK_MAX_DEPTH if max_depth is None else max_depth, featureSubsetStrategy="sqrt", seed=seed
    )
    return forest.fit(_weighted(df, c, balanced))


def fit_tree(df: DataFrame, c: Training, *, max_depth: int | None = None, balanced: bool = True, seed: int = SEED) -> Fitted:
    if large := _large_trees(df, c, trees=1, max_depth=max_depth, seed=seed, all_columns=True, drawn=False, balanced=balanced):
        return large
    tree = DecisionTreeClassifier(**_base(c), weightCol="weight", maxDepth=SPARK_MAX_DEPTH if max_depth is None else max_depth, seed=seed)
    return tree.fit(_weighted(df, c, balanced))


def fit_boosting(df: DataFrame, c: Training, **settings: Any) -> Fitted:
    """One softmax ensemble for all classes, or, without classes, one for the label's value."""
    return fit_boosted(df, Boosting(**settings), classes=len(c.classes), features_col=c.features_col, label_col=c.label_col, id_col=c.id_col)


def fit_linear_svm(df: DataFrame, c: Training, *, balanced: bool = True, max_iter: int = 1000, parallelism: int = 4) -> Fitted:
    svm = LinearSVC(regParam=1.0 / max(df.count(), 1), standardization=False, maxIter=max_iter)
    return OneVsRest(classifier=svm, weightCol="weight", parallelism=parallelism, **_base(c)).fit(_weighted(df, c, balanced))


@dataclass(frozen=True)
class LinearScores:
    """One least-squares fit per class; the class with the largest value wins."""

    models: tuple[Any, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for i, m in enumerate(self.models):
            out = m.copy({m.predictionCol: f"_score{i}"}).transform(out)
        names = [f"_score{i}" for i in range(len(self.models))]
        scores = F.array(*names)
        best = (F.array_position(scores, F.array_max(scores)) - 1).cast("double")
        return out.withColumns({"prediction": best, "rawPrediction": array_to_vector(scores)}).drop(*names)


def fit_linear_one_vs_rest(df: DataFrame, c: Training) -> Fitted:
    models = []
    for i in range(len(c.classes)):
        marked = df.withColumn("_mark", (col(c.label_col) == i).cast("double"))
        models.append(LinearRegression(featuresCol=c.features_col, labelCol="_mark", regParam=0.0).fit(marked))
    return LinearScores(tuple(models))


@dataclass(frozen=True)
class Neighbours:
    train: DataFrame
    context: Training
    k: int
    task: str
    weights: str

    def transform(self, df: DataFrame) -> DataFrame:
        c = self.context
        points = self.train.select(col(c.id_col).alias("_point"), col(c.features_col).alias("_v"), col(c.label_col))
        found = nearest(df, points, k=self.k, query_id=c.id_col, point_id="_point", query_vector=c.features_col, point_vector="_v")
        named = dict(query_id=c.id_col, point_id="_point")
        if self.task == "classification":
            pred = vote(found, points, label=c.label_col, **named)
        else:
            pred = neighbour_mean(found, points, value=c.label_col, weights=self.weights, **named)
        return df.join(pred.select(col(c.id_col), F.col("y_pred").cast("double").alias("prediction")), c.id_col)


def fit_neighbours(df: DataFrame, c: Training, *, k: int = 15, task: str = "classification", weights: str = "uniform") -> Fitted:
    return Neighbours(df, c, k, task, weights)


@dataclass(frozen=True)
class Chain:
    """A fitted projection followed by a fitted classifier."""

    first: Fitted
    then: Fitted

    def transform(self, df: DataFrame) -> DataFrame:
        return self.then.transform(self.first.transform(df))


def fit_pca_logistic(df: DataFrame, c: Training, *, components: int = 50, max_iter: int = 2000) -> Fitted:
    pca = fit_pca(df, components=components, features_col=c.features_col, output_col="pca")
    model = logistic(c, df.count(), features_col="pca", max_iter=max_iter).fit(_weighted(pca.transform(df), c, True))
    return Chain(pca, model)


def fit_pls_one_vs_rest(df: DataFrame, c: Training, *, components: int = 10, max_iter: int = 2000, parallelism: int = 4) -> Fitted:
    pls = fit_pls(df, label_col=c.label_col, classes=[str(float(i)) for i in range(len(c.classes))], components=components, features_col=c.features_col)
    part = LogisticRegression(regParam=1.0 / max(df.count(), 1), standardization=False, maxIter=max_iter)
    model = OneVsRest(classifier=part, featuresCol="pls", labelCol=c.label_col, weightCol="weight", parallelism=parallelism).fit(_weighted(pls.transform(df), c, True))
    return Chain(pls, model)


def fit_selected_logistic(df: DataFrame, c: Training, *, direction: str, keep: int | None = None, folds: int = 5, max_iter: int = 2000) -> Fitted:
    """Features are selected and the regression is fitted with balanced class weights."""
    weighted = _weighted(df, c, True)
    first = df.select(col(c.features_col)).first()
    chosen = select_features(
        weighted,
        id_col=c.id_col,
        label_col=c.label_col,
        classes=len(c.classes),
        width=first[0].size if first else 0,
        keep=keep,
        direction=direction,
        folds=folds,
        weight_col="weight",
        features_col=c.features_col,
    )
    model = logistic(c, df.count(), features_col="selected", max_iter=max_iter).fit(chosen.transform(weighted))
    return Chain(chosen, model)


def fit_kmeans(df: DataFrame, c: Training, *, seed: int = SEED) -> Fitted:
    return KMeans(k=max(2, len(c.classes)), seed=seed, featuresCol=c.features_col).fit(df)


def fit_hierarchical(df: DataFrame, c: Training, *, seed: int = SEED) -> Fitted:
    """Top-down hierarchy by bisection, as the bottom-up one needs all pairs."""
    return BisectingKMeans(k=max(2, len(c.classes)), seed=seed, featuresCol=c.features_col).fit(df)


@dataclass(frozen=True)
class DensityClusters:
    train: DataFrame
    fitted: DataFrame
    context: Training
    eps: float

    def transform(self, df: DataFrame) -> DataFrame:
        c = self.context
        found = assign_clusters(df, self.fitted, self.train, id_col=c.id_col, dims=c.dims, vector=c.features_col, eps=self.eps)
        return df.join(found.withColumnRenamed("cluster", "prediction"), c.id_col)


def fit_dbscan(df: DataFrame, c: Training, *, eps: float = 0.5, min_points: int = 10) -> DensityClusters:
    """On the grid when the context names a few columns, else on the feature vectors."""
    if c.dims:
        found = dbscan(df, id_col=c.id_col, dims=c.dims, eps=eps, min_points=min_points)
    else:
        found = dbscan_vectors(df, id_col=c.id_col, vector=c.features_col, eps=eps, min_points=min_points)
    return DensityClusters(df, stash(found), c, eps)


def fit_linear(df: DataFrame, c: Training, *, l1: float = 0.0, l2: float = 0.0, max_iter: int = 1000) -> Fitted:
    """Least squares with penalties l1 * |w| + l2 / 2 * w^2 on the mean loss.

    Spark scales the label to unit variance before it applies the quadratic penalty, so that part is given in
    units of the label's standard deviation: the population one where normal equations are solved, else the sample one.
    """
    first = df.select(col(c.features_col)).first()
    spread = F.stddev_pop if first is None or first[0].size <= NORMAL_EQUATION_COLUMNS else F.stddev_samp
    std = df.agg(spread(col(c.label_col))).first()[0] or 1.0
    total = l1 + l2 * std
    return LinearRegression(
        **_base(c), regParam=total, elasticNetParam=l1 / total if total else 0.0, standardization=False, maxIter=max_iter, tol=1e-9, solver="auto"
    ).fit(df)


def fit_ridge(df: DataFrame, c: Training, *, alpha: float = 1.0) -> Fitted:
    """alpha weighs the summed loss, hence alpha / rows on the mean loss."""
    return fit_linear(df, c, l2=alpha / max(df.count(), 1))


def fit_elastic_net(df: DataFrame, c: Training, *, alpha: float, l1_ratio: float) -> Fitted:
    return fit_linear(df, c, l1=alpha * l1_ratio, l2=alpha * (1 - l1_ratio))


def fit_forest_regressor(df: DataFrame, c: Training, *, trees: int = 300, max_depth: int | None = None, seed: int = SEED) -> Fitted:
    if large := _large_trees(df, c, trees=trees, max_depth=max_depth, seed=seed, all_columns=True, drawn=trees > 1, regression=True):
        return large
    return RandomForestRegressor(
        **_base(c), numTrees=trees, maxDepth=SPARK_MAX_DEPTH if max_depth is None else max_depth, featureSubsetStrategy="all", seed=seed
    ).fit(df)


CLASSIFIERS: tuple[ModelSpec, ...] = (
    ModelSpec("linear_regression", "Linear regression, one vs rest", "classification", True, fit_linear_one_vs_rest),
    ModelSpec("lasso_regression", "L1 logistic regression", "classification", True, fit_logistic, {"penalty": 1.0, "max_iter": 5000}),
    ModelSpec("ridge_regression", "L2 logistic regression", "classification", True, fit_logistic, {"penalty": 0.0, "max_iter": 2000}),
    ModelSpec("elasticnet_regression", "Elastic net logistic regression", "classification", True, fit_logistic, {"penalty": 0.5, "max_iter": 5000}),
    ModelSpec("forward_selection", "Forward selection and logistic regression", "classification", True, fit_selected_logistic, {"direction": "forward"}),
    ModelSpec("backward_selection", "Backward selection and logistic regression", "classification", True, fit_selected_logistic, {"direction": "backward"}),
    ModelSpec("pcr", "Principal components and logistic regression", "classification", True, fit_pca_logistic, {"components": 50}),
    ModelSpec("plsr", "Partial least squares and one-vs-rest logistic regression", "classification", True, fit_pls_one_vs_rest, {"components": 10}),
    ModelSpec("logistic_regression", "Balanced logistic regression", "classification", True, fit_logistic, {"penalty": 0.0, "balanced": True}),
    ModelSpec("svm", "Balanced linear support vector machine", "classification", True, fit_linear_svm),
    ModelSpec("decision_trees", "Balanced decision tree", "classification", False, fit_tree),
    ModelSpec("random_forests", "Balanced random forest", "classification", False, fit_forest, {"trees": 300, "balanced": True}),
    ModelSpec("knn", "Nearest neighbours", "classification", True, fit_neighbours, {"k": 15}),
    ModelSpec("gradient_boosting", "Histogram gradient boosting", "classification", False, fit_boosting, {"rounds": 100, "max_depth": 5, "rate": 0.1, "l2": 0.0}),
    ModelSpec("xgboost", "Boosted trees", "classification", False, fit_boosting, {"rounds": 500, "max_depth": 6, "rate": 0.1, "rows": 0.9, "columns": 0.9}),
)

CLUSTERERS: tuple[ModelSpec, ...] = (
    ModelSpec("k_means_clustering", "K-means", "clustering", True, fit_kmeans),
    ModelSpec("dbscan", "Density clustering", "clustering", True, fit_dbscan, {"eps": 0.5, "min_points": 10}),
    ModelSpec("hierarchical_agglomerative_clustering", "Hierarchical clustering", "clustering", True, fit_hierarchical),
)

# The two models of the training job.
JOB_CLASSIFIERS: tuple[ModelSpec, ...] = (
    ModelSpec("random_forest", "Random forest", "classification", False, fit_forest, {"trees": 500}),
    ModelSpec("xgboost", "Boosted trees", "classification", False, fit_boosting, {"rounds": 600, "max_depth": 6, "rate": 0.05, "rows": 0.9, "columns": 0.9}),
)

REGRESSORS: tuple[ModelSpec, ...] = (
    ModelSpec("linear_regression", "Linear regression", "regression", True, fit_linear),
    ModelSpec("ridge_regression", "Ridge regression", "regression", True, fit_ridge, {"alpha": 1.0}),
    ModelSpec("lasso_regression", "Lasso regression", "regression", True, fit_elastic_net, {"alpha": 0.001, "l1_ratio": 1.0}),
    ModelSpec("elasticnet_regression", "Elastic net regression", "regression", True, fit_elastic_net, {"alpha": 0.001, "l1_ratio": 0.5}),
    ModelSpec("knn_regression", "Nearest neighbour regression", "regression", True, fit_neighbours, {"k": 15, "task": "regression", "weights": "distance"}),
    ModelSpec("random_forest_regression", "Random forest regression", "regression", False, fit_forest_regressor, {"trees": 300}),
    ModelSpec("gradient_boosting_regression", "Gradient boosting regression", "regression", False, fit_boosting, {"rounds": 100, "max_depth": 3, "rate": 0.1, "l2": 0.0}),
    ModelSpec("xgboost_regression", "Boosted tree regression", "regression", False, fit_boosting, {"rounds": 500, "max_depth": 6, "rate": 0.05, "rows": 0.8, "columns": 0.8}),
)

# The summary report fits the same regressors with some other settings.
REPORT_REGRESSORS: tuple[ModelSpec, ...] = (
    ModelSpec("linear_regression", "Linear regression", "regression", False, fit_linear),
    *REGRESSORS[1:4],
    ModelSpec("knn_regression", "Nearest neighbour regression", "regression", True, fit_neighbours, {"k": 25, "task": "regression", "weights": "uniform"}),
    *REGRESSORS[5:7],
    ModelSpec("xgboost_regression", "Boosted tree regression", "regression", False, fit_boosting, {"rounds": 600, "max_depth": 6, "rate": 0.05, "rows": 0.9, "columns": 0.9}),
)


def model_spec(slug: str, specs: Sequence[ModelSpec]) -> ModelSpec:
    found = [s for s in specs if s.slug == slug]
    if not found:
        raise KeyError(f"Unknown model {slug}; known: {[s.slug for s in specs]}")
    return found[0]


def predictions_table(scored: DataFrame, *, row_id_col: str, classes: Sequence[str], truth_col: str | None = None) -> DataFrame:
    """(row id, y_pred, y_pred_label, pred_proba_max, y_true_label)."""
    cols: list[Column] = [col(row_id_col), F.col("prediction").cast("int").alias("y_pred"), decode_label(F.col("prediction"), classes).alias("y_pred_label")]
    if {"probability", "rawPrediction"} & set(scored.columns):
        cols.append(F.array_max(class_probabilities(scored)).alias("pred_proba_max"))
    if truth_col is not None and truth_col in scored.columns:
        cols.append(col(truth_col).cast("string").alias("y_true_label"))
    return scored.select(*cols)


def coefficient_table(df: DataFrame, names: Sequence[str], matrix: Sequence[Sequence[float]]) -> DataFrame:
    """(feature, mean_abs, l2, non_zero): strength of each feature over the classes' coefficients."""
    rows = [(n, [float(r[i]) for r in matrix]) for i, n in enumerate(names)]
    table = df.sparkSession.createDataFrame(rows, "feature string, coefficients array<double>")
    non_zero = F.size(F.filter("coefficients", lambda x: x != 0))
    return table.select("feature", mean_abs(F.col("coefficients")).alias("mean_abs"), l2_norm(F.col("coefficients")).alias("l2"), non_zero.alias("non_zero"))


def importance_table(df: DataFrame, names: Sequence[str], importances: Sequence[float]) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, importances)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def top_features(table: DataFrame, measure: str, k: int = 20) -> DataFrame:
    return table.orderBy(F.desc(measure), "feature").limit(k)
