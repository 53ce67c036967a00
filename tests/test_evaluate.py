import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from wardflow.operators import evaluate


def frame(spark, rows):
    df = spark.createDataFrame(rows, "ID int, Label int, score double")
    return df.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


@pytest.fixture(scope="module")
def scored(spark):
    random.seed(5)
    rows = [(i % 40, int(random.random() < 0.4), round(random.random(), 2)) for i in range(400)]
    # a mixed top score tells the two starts of the precision-recall curve apart
    return frame(spark, [*rows, (41, 0, 1.5), (42, 1, 1.5)])


def test_areas_match_the_library(spark, scored):
    ours = evaluate.curve_metrics(scored).first()
    judge = BinaryClassificationEvaluator(
        labelCol="Label", rawPredictionCol="score", numBins=0, metricName="areaUnderROC"
    )
    assert ours.auroc == pytest.approx(judge.evaluate(scored), abs=1e-12)
    judge.setMetricName("areaUnderPR")
    assert ours.auprc_flat == pytest.approx(judge.evaluate(scored), abs=1e-12)
    assert ours.auprc != pytest.approx(ours.auprc_flat)


def test_reversed_scores_mirror_the_area(spark, scored):
    flipped = scored.withColumn("score", -F.col("score"))
    a, b = (evaluate.curve_metrics(s).first().auroc for s in (scored, flipped))
    assert a == pytest.approx(1 - b)


def test_curves_end_where_they_should(spark, scored):
    roc = evaluate.roc_points(scored).orderBy("fpr", "tpr").collect()
    assert (roc[0].threshold, roc[0].fpr, roc[0].tpr) == (None, 0.0, 0.0)
    assert (roc[-1].fpr, roc[-1].tpr) == (1.0, 1.0)
    assert len(roc) == scored.select("score").distinct().count() + 1
    lowest = evaluate.pr_points(scored).orderBy("threshold").first()
    assert lowest.recall == 1.0


def test_rp80_takes_the_lowest_threshold(spark):
    rows = [(i, 1, 0.9 - i / 100) for i in range(8)] + [(9, 0, 0.85), (10, 0, 0.1), (11, 1, 0.05)]
    got = evaluate.curve_metrics(frame(spark, rows)).first()
    assert got.rp80 == pytest.approx(9 / 9)
    none = evaluate.curve_metrics(frame(spark, [(1, 0, 0.9), (2, 1, 0.1)])).first()
    assert none.rp80 == 0.0 and none.rp80_threshold is None


def test_degenerate_inputs(spark):
    one_class = evaluate.curve_metrics(frame(spark, [(1, 0, 0.2), (2, 0, 0.4)])).first()
    assert one_class.auroc is None and one_class.auprc is None
    equal = evaluate.curve_metrics(frame(spark, [(1, 0, 0.3), (2, 1, 0.3)])).first()
    assert equal.auroc == 0.5
    silent = evaluate.binary_metrics(frame(spark, [(1, 1, 0.2), (2, 0, 0.4)])).first()
    assert silent.precision is None and silent.f1 is None and silent.recall == 0.0


def test_confusion_metrics_match_the_library(spark, scored):
    ours = evaluate.binary_metrics(scored).first()
    typed = scored.select(F.col("Label").cast("double"), F.col("prediction").cast("double"))
    judge = MulticlassClassificationEvaluator(
        labelCol="Label", metricName="fMeasureByLabel", metricLabel=1.0, beta=1.0
    )
    assert ours.f1 == pytest.approx(judge.evaluate(typed))
    assert evaluate.f_measure_by_label(scored).first()[0] == pytest.approx(ours.f1)
    judge.setMetricName("accuracy")
    assert ours.accuracy == pytest.approx(judge.evaluate(typed))
    report = {r["class"]: r for r in evaluate.classification_report(scored).collect()}
    judge.setMetricName("f1")
    assert report["weighted avg"].f1 == pytest.approx(judge.evaluate(typed))
    assert report["1"].precision == pytest.approx(ours.precision)
    assert report["accuracy"].f1 == pytest.approx(ours.accuracy)


def test_vote(spark):
    rows = frame(spark, [(1, 1, 0.2), (1, 0, 0.8), (2, 1, 0.5)])
    got = {r.ID: (r.score, r.Label) for r in evaluate.vote_scores(rows).collect()}
    assert got[1] == (pytest.approx((0.8 + 0.5) / 2), 0)
    assert got[2] == (pytest.approx(0.75 / 1.5), 1)


def test_chunks_without_score_or_label_do_not_count(spark):
    rows = [(1, 1, None, None), (1, 1, 0.5, 1), (1, None, 0.9, 1)]
    df = spark.createDataFrame(rows, "ID int, Label int, score double, prediction int")
    got = evaluate.chunk_evaluation(df).first()
    assert got.eval_loss == pytest.approx(0.6931472) and got.eval_accuracy == 1.0
