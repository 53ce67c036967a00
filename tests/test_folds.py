"""Term counts, vocabularies and scores per fold against a refit from scratch."""

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import functions as F

from wardflow.operators import classify, folds


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(4)
    made = []
    for i in range(240):
        label = draw.randrange(2)
        words = draw.choices(["a", "b", "c", "d", "e", f"own{i % 40}"], weights=[3 + 2 * label, 3, 2, 2 - label, 1, 1], k=draw.randrange(12))
        made.append((i, label, words or None))
    df = spark.createDataFrame(made, "ID int, Label int, words array<string>")
    return folds.with_folds(df, F.col("ID")).withColumn("Label", F.col("Label").cast("double")).cache()


def test_counts_and_weights_are_those_of_a_refit(rows):
    counts = folds.fold_counts(rows, F.col("words"))
    got = folds.fold_vocabularies(counts, rows, size=30)
    by_fold = {}
    for r in got.collect():
        by_fold.setdefault(r.fold, {})[r.token] = (r.freq, r.df, r.idf)
    assert set(by_fold) == set(range(5))
    for fold in range(5):
        texts = [r.words or [] for r in rows.where(F.col("fold") != fold).collect()]
        freq, df = {}, {}
        for t in texts:
            for w in t:
                freq[w] = freq.get(w, 0) + 1
            for w in set(t):
                df[w] = df.get(w, 0) + 1
        top = sorted(freq, key=lambda w: (-freq[w], w))[:30]
        expected = {w: (freq[w], df[w], np.log((len(texts) + 1) / (df[w] + 1)) if df[w] >= 5 else 0.0) for w in top}
        assert set(by_fold[fold]) == set(expected)
        assert all(by_fold[fold][w] == pytest.approx(expected[w]) for w in top)


def test_scores_are_those_of_a_refit(spark, rows):
    classifier = classify.logistic()
    grid = classify.regression_grid(classifier, reg_params=(1e-3, 0.1), max_iters=(8,), elastic_nets=(0.0,))
    labelled = rows.where("words is not null")
    metrics, best = folds.refit_per_fold(rows, labelled, classifier, grid, size=1000)
    judge = MulticlassClassificationEvaluator(labelCol="Label", metricName="fMeasureByLabel", metricLabel=1.0)
    none = F.coalesce("words", F.array().cast("array<string>"))
    for fold in range(5):
        known = rows.where(F.col("fold") != fold).withColumn("words", none)
        counting = CountVectorizer(inputCol="words", outputCol="counts").fit(known)
        weighting = IDF(inputCol="counts", outputCol="features", minDocFreq=5).fit(counting.transform(known))

        def features(df):
            return weighting.transform(counting.transform(df))

        for i, point in enumerate(grid):
            model = classifier.copy(point).fit(features(labelled.where(F.col("fold") != fold)))
            naive = judge.evaluate(model.transform(features(labelled.where(F.col("fold") == fold))))
            assert metrics[fold][i] == pytest.approx(naive, abs=1e-6)
    means = np.mean(metrics, axis=0)
    chosen = best.stages[-1]
    assert chosen.getRegParam() == [1e-3, 0.1][int(np.argmax(means))]
    assert best.transform(labelled).count() == labelled.count()


def test_a_term_of_one_fold_is_unknown_where_it_judges(spark):
    df = spark.createDataFrame([(0, ["x"]), (1, ["y", "y"]), (1, None)], "fold int, words array<string>")
    got = folds.counts_without(folds.fold_counts(df, F.col("words")), 2).collect()
    assert sorted(map(tuple, got)) == [(0, "y", 1, 2), (1, "x", 1, 1)]
    assert folds.fold_vocabularies(folds.fold_counts(df.limit(0), F.col("words")), df.limit(0), 5).collect() == []


def test_fits_get_the_terms_of_the_labelled_rows_only(rows, monkeypatch):
    """What a fit sends to the driver follows the rows that are fitted, not the vocabulary."""
    sizes, whole = [], folds.weighting
    monkeypatch.setattr(folds, "weighting", lambda vocabulary, *a: sizes.append(len(vocabulary)) or whole(vocabulary, *a))
    labelled = rows.where("ID < 60 and words is not null")
    own = {w for r in labelled.collect() for w in r.words}
    grid = classify.regression_grid(classify.logistic(), reg_params=(1e-3,), max_iters=(2,), elastic_nets=(0.0,))
    folds.refit_per_fold(rows, labelled, classify.logistic(), grid, size=1000)
    assert max(sizes[:-1]) <= len(own) < sizes[-1]
