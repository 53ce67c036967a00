"""Classifiers, training with a report per split, grid search and scoring."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.operators.evaluate import all_metrics
from wardflow.sources.shared import materialised

LABEL = "Label"

# fixed values: the tuned grid
REG_PARAMS = (1e-5, 5e-5, 1e-4, 5e-4, 1e-3, 5e-3, 1e-2)
MAX_ITERS = (10, 20)
ELASTIC_NETS = (0.0, 0.5, 1.0)


def logistic(max_iter: int = 20, reg: float = 1e-4, elastic_net: float = 0.0) -> LogisticRegression:
    return LogisticRegression(
        labelCol=LABEL, maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net
    )


def forest(
    trees: int = 100, depth: int = 20, subsample: float = 1.0, seed: int = 42
) -> RandomForestClassifier:
    """Spark's trees are at most 30 deep."""
    return RandomForestClassifier(
        labelCol=LABEL, numTrees=trees, maxDepth=depth, subsamplingRate=subsample, seed=seed
    )


def boosted_trees(
    iterations: int = 5, depth: int = 20, seed: int = 42, leaf_column: str = "leafId"
) -> GBTClassifier:
    return GBTClassifier(
        labelCol=LABEL, maxIter=iterations, maxDepth=depth, seed=seed, leafCol=leaf_column
    )


def naive_bayes(smoothing: float = 1.0) -> NaiveBayes:
    """Needs features that are not negative: term weights, not word vectors."""
    return NaiveBayes(labelCol=LABEL, smoothing=smoothing, modelType="multinomial")


def perceptron(
    inputs: int, hidden: tuple[int, ...] = (16,), epochs: int = 10, block: int = 12, seed: int = 42
) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(
        labelCol=LABEL,
        layers=[inputs, *hidden, 2],
        maxIter=epochs,
        blockSize=block,
        seed=seed,
    )


def choose_model(name: str) -> Estimator:
    """The three named models: ``lr``, ``rf`` and ``gb``."""
    models = {
        "lr": lambda: logistic(max_iter=100, reg=0.0),
        "rf": lambda: forest(trees=100, depth=30),
        "gb": lambda: boosted_trees(iterations=10, depth=30),
    }
    if name not in models:
        raise ValueError(f"unknown model {name!r}; choose one of {sorted(models)}")
    return models[name]()


def score(model: Model, rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, Label, ``score`` (probability of class 1) and ``prediction``."""
    return model.transform(rows).select(
        *keys,
        F.col(LABEL).cast("int").alias(LABEL),
        vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def fit_on_features(classifier: Estimator, features: DataFrame, stored: bool = False) -> Model:
    """Fit with the features kept in memory or on disk for the passes of the fit; those that are
    ``stored`` in a table already are read from there."""
    if stored:
        return classifier.fit(features.select(LABEL, "features"))
    cached = features.select(LABEL, "features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return classifier.fit(cached)
    finally:
        cached.unpersist()


def train(features: PipelineModel, classifier: Estimator, train_set: DataFrame) -> PipelineModel:
    """A fitted chain of the fitted ``features`` and the classifier."""
    model = fit_on_features(classifier, features.transform(train_set))
    return PipelineModel(stages=[features, model])


def split_metrics(scored: dict[str, DataFrame]) -> DataFrame:
    """One row per split: curve metrics next to the confusion metrics."""
    rows = [all_metrics(part).withColumn("split", F.lit(name)) for name, part in scored.items()]
    return reduce(DataFrame.unionByName, rows)


def train_and_report(
    features: PipelineModel,
    classifier: Estimator,
    splits: dict[str, DataFrame],
    keys: list[str],
) -> tuple[PipelineModel, DataFrame]:
    """Fit on ``train``, score every split, report metrics per split."""
    model = train(features, classifier, splits["train"])
    return model, split_metrics({n: score(model, rows, keys) for n, rows in splits.items()})


def regression_grid(
    classifier: LogisticRegression,
    reg_params=REG_PARAMS,
    max_iters=MAX_ITERS,
    elastic_nets=ELASTIC_NETS,
) -> list:
    return (
        ParamGridBuilder()
        .addGrid(classifier.regParam, list(reg_params))
        .addGrid(classifier.maxIter, list(max_iters))
        .addGrid(classifier.elasticNetParam, list(elastic_nets))
        .build()
    )


def cross_validate(
    estimator: Estimator,
    grid: list,
    train_set: DataFrame,
    folds: int = 5,
    parallelism: int = 4,
    seed: int = 1,
) -> CrossValidatorModel:
    """Cross-validation on the F1 of class 1.

    With a classifier as ``estimator`` the features of ``train_set`` are shared by all
    folds; pass ``Pipeline(stages=[features, classifier])`` to refit them per fold.
    """
    judge = MulticlassClassificationEvaluator(
        labelCol=LABEL, metricName="fMeasureByLabel", metricLabel=1.0, beta=1.0
    )
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=judge,
        numFolds=folds,
        parallelism=parallelism,
        seed=seed,
    )
    cached = train_set.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return search.fit(cached)
    finally:
        cached.unpersist()


def nested(features: PipelineModel, classifier: Estimator) -> Pipeline:
    """A fitted feature chain and a classifier still to be fitted."""
    return Pipeline(stages=[features, classifier])


def grid_metrics(spark: SparkSession, fitted: CrossValidatorModel) -> DataFrame:
    """One row per grid point, as many as the grid has points: parameters and metric."""
    rows = [
        {**{p.name: float(v) for p, v in point.items()}, "fMeasureByLabel": float(metric)}
        for point, metric in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics)
    ]
    names = sorted(rows[0])
    return spark.createDataFrame(
        [tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} double" for n in names)
    )


def best_point(metrics: DataFrame) -> DataFrame:
    others = [c for c in metrics.columns if c != "fMeasureByLabel"]
    return metrics.orderBy(F.desc("fMeasureByLabel"), *others).limit(1)


def naive_bayes_parameters(weights: DataFrame, documents: DataFrame, smoothing: float = 1.0):
    """Class priors and token likelihoods of multinomial naive Bayes, as two tables.

    ``weights`` has Label, token and tfidf; ``documents`` has Label. The number of
    distinct tokens in ``weights`` is the vocabulary size.
    """
    classes = documents.groupBy("Label").agg(F.count("*").alias("n"))
    n_classes = classes.agg(F.count("*")).scalar()
    n_documents = classes.agg(F.sum("n")).scalar()
    priors = classes.select(
        "Label",
        (F.log(F.col("n") + smoothing) - F.log(n_documents + smoothing * n_classes)).alias("log_prior"),
    )
    per_token = materialised(weights.groupBy("Label", "token").agg(F.sum("tfidf").alias("w")))
    n_tokens = per_token.agg(F.count_distinct("token")).scalar()
    per_class = per_token.groupBy("Label").agg(F.sum("w").alias("w_class"))
    likelihoods = per_token.join(per_class, "Label").select(
        "Label",
        "token",
        (
            F.log(F.col("w") + smoothing) - F.log(F.col("w_class") + smoothing * n_tokens)
        ).alias("log_likelihood"),
    )
    return priors, likelihoods
