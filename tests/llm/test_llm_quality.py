import numpy as np
from edge_cases import clashing, documents

from wardflow.llm import quality
from wardflow.llm.common import fold
from wardflow.llm.queries import op2_quality


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_edge_cases(spark):
    docs = clashing(documents(spark))
    known = labels(spark, [(i, i % 2, 0) for i in range(8)] + [(99, 1, 0), (5, None, 0), (None, 1, 0)])
    model, figures = quality.fit(docs, known)
    scores = [r.score for r in quality.score_figures(figures, model).collect()]
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(s >= 0.3 for s in scores)


def test_without_labels_or_rows(spark):
    docs = documents(spark)
    model, figures = quality.fit(docs, labels(spark, []))
    assert {r.score for r in quality.score_figures(figures, model).collect()} == {0.5}
    model, figures = quality.fit(docs, labels(spark, [(i, 1, 0) for i in range(8)]))
    assert all(r.score > 0.99 for r in quality.score_figures(figures, model).collect())
    model, figures = quality.fit(documents(spark, []), labels(spark, [(1, 1, 0)]))
    assert quality.score_figures(figures, model).collect() == []


def test_held_out_accuracy_and_calibration(spark):
    folder = "/root/testdata/sf0.1"
    scored = op2_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = [r for r in scored.collect() if r.held_out]
    score, label = np.array([r.score for r in rows]), np.array([r.quality for r in rows])
    good, bad = score[label == 1], score[label == 0]
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert (good >= 0.3).mean() > 0.98 and (bad < 0.3).mean() > 0.85
    assert abs(score.mean() - label.mean()) < 0.02


def test_held_out_labels_are_not_used(spark):
    folder = "/root/testdata/sf0.001"
    docs, known = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    turned = known.withColumn("quality", (fold() != 0).cast("int") * known.quality)
    one, two = (quality.score_figures(f, m).collect() for m, f in (quality.fit(docs, known), quality.fit(docs, turned)))
    assert sorted(one) == sorted(two)


def test_word_vectors_are_the_sum_of_neighbours(spark):
    s = quality.Settings(buckets=2048, size=8)
    text = "red green blue red"
    docs = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string").repartition(3)
    got = quality.word_vectors(docs, s)
    place, sign = quality.index_vectors(s)
    hashes = quality.WordHashes()
    at = hashes([w.encode() for w in text.split()]) & (s.buckets - 1)
    table = np.zeros((s.buckets, s.size))
    for i in range(4):
        for j in range(4):
            if 0 < abs(i - j) <= 2:
                for k in range(2):
                    table[at[i], place[at[j], k]] += 3 * sign[at[j], k]
    length = np.sqrt((table**2).sum(1, keepdims=True))
    assert np.allclose(got, table / np.where(length > 0, length, 1))
