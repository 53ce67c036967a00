"""Cross-validation whose vocabulary and term weights never see the fold that judges them.

Terms are counted once, per fold. What a model may know when fold f judges it is the total
less the counts of f, so the features of all folds come from one pass over the text.
Vocabulary and weights of a fold are those that a fit on its training rows would give.

Defined cases: folds follow a hash of the key, so rows of one key share a fold; a NULL key
is a key of its own. Terms that occur in one fold only are unknown where it judges. Rows
without terms have no features set. Ties in the vocabulary go by token.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.operators.features import LARGE_VOCABULARY, MIN_DOCUMENTS, inverse_document_frequency, weighting
from wardflow.sources.shared import materialised

FOLDS = 5


def with_folds(rows: DataFrame, key: Column, folds: int = FOLDS) -> DataFrame:
    """``fold`` from 0, the same in every engine."""
    seeded = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":fold"))
    return rows.withColumn("fold", (F.conv(F.substring(F.md5(seeded), 1, 8), 16, 10).cast("bigint") % folds).cast("int"))


def fold_counts(rows: DataFrame, tokens: Column) -> DataFrame:
    """token, fold, ``df`` (rows that have it) and ``freq`` (its occurrences), in one pass."""
    once = F.transform(F.array_distinct(tokens), lambda t: F.struct(t.alias("token"), F.lit(1).alias("df"), F.lit(0).alias("freq")))
    every = F.transform(tokens, lambda t: F.struct(t.alias("token"), F.lit(0).alias("df"), F.lit(1).alias("freq")))
    counted = rows.select("fold", F.explode(F.concat(once, every)).alias("t"))
    return counted.groupBy("t.token", "fold").agg(F.sum("t.df").alias("df"), F.sum("t.freq").alias("freq"))


def counts_without(counts: DataFrame, folds: int = FOLDS) -> DataFrame:
    """fold, token, df and freq of the rows outside each fold: the total less the fold's own."""
    own = F.map_from_entries(F.collect_list(F.struct("fold", F.struct("df", "freq"))))
    total = counts.groupBy("token").agg(F.sum("df").alias("_df"), F.sum("freq").alias("_freq"), own.alias("_own"))
    each = total.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    held = F.try_element_at("_own", F.col("fold"))
    left = each.select(
        "fold",
        "token",
        (F.col("_df") - F.coalesce(held["df"], F.lit(0))).alias("df"),
        (F.col("_freq") - F.coalesce(held["freq"], F.lit(0))).alias("freq"),
    )
    return left.where("df > 0")


def fold_vocabularies(
    counts: DataFrame, rows: DataFrame, size: int = LARGE_VOCABULARY, folds: int = FOLDS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """fold, token, freq, df and idf of the ``size`` most frequent tokens outside each fold.

    ``rows`` are those that were counted, with their fold: rows without terms count as documents.
    """
    sizes = rows.groupBy("fold").agg(F.count("*").alias("n"))
    all_rows = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    order = W.partitionBy("fold").orderBy(F.desc("freq"), F.asc("token"))
    top = counts_without(counts, folds).withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= size)
    outside = top.join(sizes.withColumnRenamed("n", "_n"), "fold", "left")
    m = all_rows - F.coalesce(F.col("_n"), F.lit(0))
    return inverse_document_frequency(outside, m, min_documents).select("fold", "token", "freq", "df", "idf", "_place")


def refit_per_fold(
    counted: DataFrame,
    labelled: DataFrame,
    classifier: Estimator,
    grid: list,
    size: int = LARGE_VOCABULARY,
    folds: int = FOLDS,
    parallelism: int = 4,
) -> tuple[list[list[float]], PipelineModel]:
    """F1 of class 1 per fold and grid point, and the chain of the best point on all rows.

    ``counted`` (fold, words) gives the terms; ``labelled`` (fold, words, Label) are the rows
    that classifiers are fitted on and judged by. One vocabulary of ``size`` terms at most
    is on the driver at a time. The fits of a fold get the terms that ``labelled`` has: the
    weight of any other is zero in each of them, and what they send grows with ``labelled`` only.
    """
    judge = MulticlassClassificationEvaluator(labelCol="Label", metricName="fMeasureByLabel", metricLabel=1.0, beta=1.0)
    counts = materialised(fold_counts(counted, F.col("words")))
    vocabularies = materialised(fold_vocabularies(counts, counted, size, folds))
    # rows that are counted themselves have all terms
    heard = None if labelled is counted else materialised(labelled.select(F.explode("words").alias("token")).distinct())
    metrics = []
    for fold in range(folds):
        own = vocabularies.where(F.col("fold") == fold).orderBy("_place")
        met = own.join(heard, "token", "left_semi").orderBy("_place").collect() if heard else []
        chain = weighting(met or own.collect())
        weighted = chain.transform(labelled).select("fold", "Label", "features")
        train, held = (
            weighted.where(own).select("Label", "features").persist(StorageLevel.MEMORY_AND_DISK)
            for own in (F.col("fold") != fold, F.col("fold") == fold)
        )
        try:
            fits = classifier.fitMultiple(train, grid)
            with ThreadPool(parallelism) as pool:
                judged = pool.map(lambda _: _judge_next(fits, held, judge), range(len(grid)))
        finally:
            train.unpersist()
            held.unpersist()
        metrics.append([m for _, m in sorted(judged)])
    averages = [sum(m) / folds for m in zip(*metrics)]
    best = max(range(len(grid)), key=lambda i: (averages[i], -i))
    # the whole is what lies outside of a fold 0 that has no rows
    merged = counts.groupBy("token").agg(F.sum("df").alias("df"), F.sum("freq").alias("freq")).withColumn("fold", F.lit(1))
    whole = fold_vocabularies(merged, counted.withColumn("fold", F.lit(1)), size, 1)
    chain = weighting(whole.orderBy("_place").collect())
    fitted = classifier.copy(grid[best]).fit(chain.transform(labelled).select("Label", "features"))
    return metrics, PipelineModel(stages=[chain, fitted])


def _judge_next(fits, held: DataFrame, judge: MulticlassClassificationEvaluator) -> tuple[int, float]:
    index, model = next(fits)
    return index, judge.evaluate(model.transform(held))
