"""Mini-batch training and scoring from outside against plain numpy."""

import json

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from wardflow.operators import classify, external, minibatch
from wardflow.sources import shared

SETTINGS = minibatch.Settings(hidden=4, epochs=4, batch=5, rows_per_replica=40, seed=7)


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(0)
    x = draw.normal(0, 1, (300, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0.1).astype(int)
    made = [(i, int(y[i]), x[i].tolist()) for i in range(300)]
    made += [(300, None, [1.0, 2.0, 3.0]), (301, 1, None), (5, 0, [0.0, 0.0, 0.0])]
    return spark.createDataFrame(made, "ID long, Label int, features array<double>").cache()


def test_weights_by_brute_force(spark, rows):
    weights, history = minibatch.fit(rows, ["ID"], settings=SETTINGS)
    known = rows.where("Label is not null and features is not null")
    replicas = -(-known.count() // 40)
    place = F.pmod(F.xxhash64("ID", F.lit("replica")), F.lit(replicas))
    dealt = {}
    for r in known.withColumn("r", place).collect():
        dealt.setdefault(r.r, []).append((json.dumps({"ID": r.ID}, separators=(",", ":")), r.Label, r.features[3 - 1], r.features))
    expected = minibatch.start(3, SETTINGS)
    for epoch in range(4):
        total, loss = 0, 0.0
        rate = 0.2 * (1 - epoch / 4)
        for number, own in dealt.items():
            own.sort(key=lambda o: (o[0], o[1]))
            w1, b1, w2, b2 = (p.copy() for p in minibatch._parts(expected, 4))
            order = np.random.default_rng([7, epoch, int(number)]).permutation(len(own))
            for at in range(0, len(order), 5):
                batch = [own[i] for i in order[at : at + 5]]
                g1, gb1, g2, gb2 = np.zeros_like(w1), np.zeros_like(b1), np.zeros_like(w2), 0.0
                for _, y, _, x in batch:
                    h = [np.tanh(sum(x[i] * w1[i, j] for i in range(3)) + b1[j]) for j in range(4)]
                    p = 1 / (1 + np.exp(-(sum(h[j] * w2[j] for j in range(4)) + b2[0])))
                    loss -= np.log(p if y else 1 - p)
                    e = (p - y) / len(batch)
                    gb2 += e
                    for j in range(4):
                        g2[j] += e * h[j]
                        gb1[j] += e * w2[j] * (1 - h[j] ** 2)
                        for i in range(3):
                            g1[i, j] += e * w2[j] * (1 - h[j] ** 2) * x[i]
                w1, b1, w2, b2 = w1 - rate * g1, b1 - rate * gb1, w2 - rate * g2, b2 - rate * gb2
            total = total + len(own) * np.concatenate([w1.ravel(), b1, w2, b2])
        expected = total / known.count()
        assert history[epoch] == pytest.approx(loss / known.count())
    assert np.allclose(weights, expected, atol=1e-9)


def test_same_weights_in_any_partitioning(rows):
    one, other = (minibatch.fit(r, ["ID"], settings=SETTINGS)[0] for r in (rows.coalesce(1), rows.repartition(9)))
    assert (one == other).all()


def test_it_learns_and_scores(spark, rows):
    settings = minibatch.Settings(hidden=8, epochs=12, rows_per_replica=100)
    weights, history = minibatch.fit(rows, ["ID"], settings=settings)
    assert history[-1] < 0.45 < history[0]
    scored = rows.withColumn("score", minibatch.score(weights, F.col("features"), settings)).collect()
    for r in scored:
        if r.features is None:
            assert r.score is None
        else:
            assert r.score == pytest.approx(minibatch.predict(weights, np.array([r.features]), 8)[0])
    right = [(r.score > 0.5) == (r.Label == 1) for r in scored if r.Label is not None and r.features is not None]
    assert np.mean(right) > 0.85
    none, history = minibatch.fit(rows.limit(0), ["ID"], settings=settings)
    assert history == [] and len(none) == 17


def test_scores_from_outside_are_those_of_the_model(spark):
    draw = np.random.default_rng(1)
    made = []
    for i in range(120):
        at = sorted(draw.choice(30, draw.integers(0, 6), replace=False).tolist())
        made.append((i, float(i % 2), Vectors.sparse(30, at, [float(x) + (3 * (i % 2)) for x in draw.random(len(at))])))
    df = spark.createDataFrame(made, ["k", "Label", "features"])
    model = classify.logistic(20, 0.01, 0.5).fit(df)
    path = external.export_linear(spark, model, shared.shared_path(spark, "linear"))
    table = spark.read.parquet(path)
    assert table.count() <= 31
    places, values = external.sparse_pairs(F.col("features"))
    got = classify.score(model, df, ["k", "features"]).withColumn("outside", external.scorer(table, places, values))
    assert all(abs(r.score - r.outside) < 1e-12 for r in got.collect())
    odd = spark.createDataFrame([(None, None), ([], []), ([99], [1.0])], "at array<int>, x array<double>")
    alone = 1 / (1 + np.exp(-model.intercept))
    said = [r.s for r in odd.select(external.scorer(table, F.col("at"), F.col("x")).alias("s")).collect()]
    assert said[0] is None and said[1:] == pytest.approx([alone, alone])
