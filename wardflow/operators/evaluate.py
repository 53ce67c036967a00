"""Scores to votes, curves and metrics.

Input frames have ``score`` (probability of class 1), ``Label`` (0/1) and, for the
confusion metrics, ``prediction`` (0/1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.labels import log_loss
from wardflow.operators.ordering import running_sums

# fixed value: the precision that counts as 80 percent
PRECISION_80 = 0.799999


def vote_scores(chunk_scores: DataFrame) -> DataFrame:
    """One score per admission: (max + sum/2) / (1 + n/2); its label is the smallest."""
    score = F.col("score")
    vote = (F.max(score) + F.sum(score) / 2) / (1 + F.count("*") / 2)
    return chunk_scores.groupBy("ID").agg(vote.alias("score"), F.min("Label").alias("Label"))


def _cells() -> dict[str, Column]:
    label, prediction = F.col("Label"), F.col("prediction")
    return {
        "tn": F.count_if((prediction == 0) & (label == prediction)),
        "tp": F.count_if((prediction == 1) & (label == prediction)),
        "fn": F.count_if((prediction == 0) & (label != prediction)),
        "fp": F.count_if((prediction == 1) & (label != prediction)),
    }


def threshold_counts(scored: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """Per distinct score: its positives and negatives, and tp / fp at this threshold."""
    per_score = scored.groupBy("score").agg(
        F.count_if(F.col("Label") == 1).alias("pos"),
        F.count_if(F.col("Label") == 0).alias("neg"),
        *[e.alias(n) for n, e in (extra or {}).items()],
    )
    return running_sums(
        per_score,
        [F.col("score").desc()],
        {"tp": F.col("pos"), "fp": F.col("neg")},
        totals=True,
    )


def _precision(tp: Column, fp: Column) -> Column:
    return F.try_divide(tp, tp + fp)


def roc_points(scored: DataFrame) -> DataFrame:
    """threshold, fpr, tpr from (0, 0), which has no threshold, down the scores."""
    point = F.struct(
        F.col("score").cast("double").alias("threshold"),
        F.try_divide("fp", "total_fp").alias("fpr"),
        F.try_divide("tp", "total_tp").alias("tpr"),
    )
    start = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    highest = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    points = F.when(highest, F.array(start, point)).otherwise(F.array(point))
    return threshold_counts(scored).select(F.inline(points))


def pr_points(scored: DataFrame) -> DataFrame:
    """threshold, precision, recall per distinct score."""
    return threshold_counts(scored).select(
        F.col("score").alias("threshold"),
        _precision(F.col("tp"), F.col("fp")).alias("precision"),
        F.try_divide("tp", "total_tp").alias("recall"),
    )


def _curve_aggregates() -> list[Column]:
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    here = _precision(tp, fp)
    before = _precision(tp - pos, fp - neg)
    n_pos, n_neg = F.sum(pos), F.sum(neg)
    precise = F.when(here > PRECISION_80, F.col("score"))
    return [
        F.try_divide(F.sum(neg * (tp - pos / 2)), n_pos * n_neg).alias("auroc"),
        F.try_divide(F.sum(pos * (here + F.coalesce(before, F.lit(1.0))) / 2), n_pos).alias("auprc"),
        F.try_divide(F.sum(pos * (here + F.coalesce(before, here)) / 2), n_pos).alias("auprc_flat"),
        F.coalesce(F.try_divide(F.min_by(tp, precise), n_pos), F.lit(0.0)).alias("rp80"),
        F.min(precise).alias("rp80_threshold"),
    ]


def curve_metrics(scored: DataFrame) -> DataFrame:
    """One row: auroc, two forms of auprc, rp80 and its threshold.

    ``auprc`` starts the curve at (recall 0, precision 1), ``auprc_flat`` at the first
    precision. Both areas need only the step before each point, which the running
    counts give without looking back.
    """
    return threshold_counts(scored).agg(*_curve_aggregates())


def confusion_pairs(scored: DataFrame) -> DataFrame:
    return scored.groupBy("Label", "prediction").agg(F.count("*").alias("n"))


def confusion(scored: DataFrame) -> DataFrame:
    """One row: tn, tp, fn, fp."""
    return scored.agg(*[e.alias(n) for n, e in _cells().items()])


def _with_rates(cells: DataFrame) -> DataFrame:
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    rates = cells.withColumns(
        {
            "accuracy": F.try_divide(tp + tn, tp + tn + fp + fn),
            "precision": F.try_divide(tp, tp + fp),
            "recall": F.try_divide(tp, tp + fn),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1", F.try_divide(2 * p * r, p + r))


def binary_metrics(scored: DataFrame) -> DataFrame:
    """The confusion counts with accuracy, precision, recall, f1; NULL where undefined."""
    return _with_rates(confusion(scored))


def all_metrics(scored: DataFrame) -> DataFrame:
    """``curve_metrics`` and ``binary_metrics`` in one row from one pass over the scores."""
    cells = {f"cell_{n}": e for n, e in _cells().items()}
    sums = [F.sum(f"cell_{n}").alias(n) for n in _cells()]
    return _with_rates(threshold_counts(scored, cells).agg(*_curve_aggregates(), *sums))


def f_measure_by_label(scored: DataFrame, label: int = 1, beta: float = 1.0) -> DataFrame:
    hit = (F.col("Label") == label) & (F.col("prediction") == label)
    tp = F.count_if(hit)
    predicted = F.count_if(F.col("prediction") == label)
    actual = F.count_if(F.col("Label") == label)
    weight = beta * beta
    value = F.try_divide((1 + weight) * tp, weight * actual + predicted)
    return scored.agg(value.alias("f_measure"))


def classification_report(scored: DataFrame) -> DataFrame:
    """Per class and averaged precision, recall, f1 and support; undefined rates are 0."""
    pairs = confusion_pairs(scored)
    none = F.lit(0).cast("bigint")
    hit = F.when(F.col("Label") == F.col("prediction"), F.col("n")).otherwise(none)
    as_actual = F.struct(
        F.col("Label").cast("int").alias("cls"),
        F.col("n").alias("support"),
        none.alias("predicted"),
        hit.alias("tp"),
    )
    as_predicted = F.struct(
        F.col("prediction").cast("int").alias("cls"),
        none.alias("support"),
        F.col("n").alias("predicted"),
        none.alias("tp"),
    )
    sums = (
        pairs.select(F.inline(F.array(as_actual, as_predicted)))
        .groupBy("cls")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    )
    zero = F.lit(0.0)
    classes = sums.withColumns(
        {
            "precision": F.coalesce(F.try_divide("tp", "predicted"), zero),
            "recall": F.coalesce(F.try_divide("tp", "support"), zero),
            "f1": F.coalesce(
                F.try_divide(2 * F.col("tp"), F.col("support") + F.col("predicted")), zero
            ),
        }
    )
    rates = ["precision", "recall", "f1"]
    support = F.sum("support")
    averages = classes.agg(
        *[F.avg(c).alias(f"macro_{c}") for c in rates],
        *[(F.sum(F.col(c) * F.col("support")) / support).alias(f"weighted_{c}") for c in rates],
        (F.sum("tp") / support).alias("accuracy"),
        support.alias("support"),
    )
    unset = F.lit(None).cast("double")
    summary = [
        F.struct(
            F.lit(name).alias("class"),
            *[e.alias(c) for c, e in zip(rates, values)],
            F.col("support"),
        )
        for name, values in (
            ("accuracy", [unset, unset, F.col("accuracy")]),
            ("macro avg", [F.col(f"macro_{c}") for c in rates]),
            ("weighted avg", [F.col(f"weighted_{c}") for c in rates]),
        )
    ]
    return classes.select(F.col("cls").cast("string").alias("class"), *rates, "support").unionByName(
        averages.select(F.inline(F.array(*summary)))
    )


def chunk_evaluation(scored: DataFrame) -> DataFrame:
    """Mean log loss and accuracy over the chunks that have a score and a label."""
    right = F.col("prediction") == F.col("Label")
    known = scored.where(F.col("score").isNotNull() & F.col("Label").isNotNull())
    return known.agg(
        F.avg(log_loss(F.col("Label"), F.col("score"))).alias("eval_loss"),
        F.avg(F.when(right, 1.0).otherwise(0.0)).alias("eval_accuracy"),
    )


def with_scores(rows: DataFrame, scores: DataFrame, keys: list[str]) -> DataFrame:
    """Attach scores by key, never by position."""
    return rows.join(scores, keys)
