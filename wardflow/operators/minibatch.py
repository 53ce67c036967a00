"""A perceptron trained in mini-batches: replicas train side by side, each round averages them.

Rows are dealt to replicas by a hash of their key, so many rows to a replica that none is
large; the number of replicas follows the number of rows. In a round every replica starts
from the same weights and goes once over its rows in batches; the new weights are the mean
of the replicas', weighted by their rows. Replicas are added up in groups of neighbours, so
about root(replicas) rows of weights reach the driver, in a fixed order. Order of rows,
batches and sums depend on keys and seed alone: the weights are the same in any partitioning.

Rows stay where their replica is between rounds; weights, bounded by the size of the
network, are what travels. A lost executor's rows are dealt again from the input.

Defined cases: rows without label or features do not train; rows without features have no
score. Without rows the weights stay as they were drawn. A key on several rows is several
rows, ordered by label and features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

WEIGHTS = "part int, n long, loss double, weights array<double>"


@dataclass(frozen=True)
class Settings:
    hidden: int = 16
    epochs: int = 10
    batch: int = 12
    learning_rate: float = 0.2
    rows_per_replica: int = 16_384
    seed: int = 42


def start(inputs: int, settings: Settings) -> np.ndarray:
    """Weights and offsets of both layers in one row."""
    draw = np.random.default_rng(settings.seed)
    first = draw.normal(0, 1 / np.sqrt(inputs), (inputs, settings.hidden))
    second = draw.normal(0, 1 / np.sqrt(settings.hidden), settings.hidden)
    return np.concatenate([first.ravel(), np.zeros(settings.hidden), second, [0.0]])


def _parts(weights: np.ndarray, hidden: int) -> tuple[np.ndarray, ...]:
    inputs = (len(weights) - 2 * hidden - 1) // hidden
    cut = np.split(weights, np.cumsum([inputs * hidden, hidden, hidden]))
    return cut[0].reshape(inputs, hidden), *cut[1:]


def predict(weights: np.ndarray, x: np.ndarray, hidden: int) -> np.ndarray:
    """Probability of class 1 of each row."""
    first, offset, second, last = _parts(weights, hidden)
    return 1 / (1 + np.exp(-(np.tanh(x @ first + offset) @ second + last)))


def train_once(weights: np.ndarray, x: np.ndarray, y: np.ndarray, rate: float, settings: Settings, draw) -> tuple:
    """Weights after one pass in batches, and the summed log loss met on the way."""
    weights, loss = weights.copy(), 0.0
    first, offset, second, last = _parts(weights, settings.hidden)  # views: steps change ``weights``
    order = draw.permutation(len(x))
    for at in range(0, len(order), settings.batch):
        rows = order[at : at + settings.batch]
        xb, yb = x[rows], y[rows]
        held = np.tanh(xb @ first + offset)
        p = 1 / (1 + np.exp(-(held @ second + last)))
        loss -= np.log(np.clip(np.where(yb == 1, p, 1 - p), 1e-12, None)).sum()
        wrong = (p - yb) / len(rows)
        back = np.outer(wrong, second) * (1 - held * held)
        second -= rate * held.T @ wrong
        last -= rate * wrong.sum()
        first -= rate * xb.T @ back
        offset -= rate * back.sum(axis=0)
    return weights, loss


def _dealt(rows: DataFrame, keys: list[str], features: str, label: str, replicas: int) -> DataFrame:
    known = rows.where(F.col(label).isNotNull() & F.col(features).isNotNull())
    place = F.pmod(F.xxhash64(*keys, F.lit("replica")), F.lit(replicas)).cast("int")
    key = F.to_json(F.struct(*keys)).alias("key")
    return known.select(
        place.alias("replica"), key, F.col(label).cast("double").alias("y"), F.col(features).cast("array<double>").alias("x")
    )


def _sorted(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    y = group["y"].to_numpy()
    x = group["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
    order = np.lexsort([*x.T[:4], y, np.array(group["key"].to_pylist())])
    return x[order], y[order]


def _row(part: int, n: int, loss: float, weights: np.ndarray) -> pa.Table:
    kinds = [("part", pa.int32()), ("n", pa.int64()), ("loss", pa.float64()), ("weights", pa.list_(pa.float64()))]
    return pa.table([pa.array([v], t) for v, (_, t) in zip((part, n, loss, weights), kinds)], pa.schema(kinds))


def fit(
    rows: DataFrame, keys: list[str], features: str = "features", label: str = "Label", settings: Settings = Settings()
) -> tuple[np.ndarray, list[float]]:
    """The weights, and the mean loss of each round."""
    spark = rows.sparkSession
    known = rows.where(F.col(label).isNotNull() & F.col(features).isNotNull())
    n, inputs = known.agg(F.count("*"), F.max(F.size(features))).collect()[0]
    weights, history = start(inputs or 0, settings), []
    if not n:
        return weights, history
    replicas = -(-n // settings.rows_per_replica)
    width = int(np.ceil(np.sqrt(replicas)))
    dealt = _dealt(rows, keys, features, label, replicas).repartition("replica").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for epoch in range(settings.epochs):
            sent = spark.sparkContext.broadcast(weights)
            rate = settings.learning_rate * (1 - epoch / settings.epochs)

            def replica(group: pa.Table) -> pa.Table:
                number = group["replica"][0].as_py()
                draw = np.random.default_rng([settings.seed, epoch, number])
                trained, loss = train_once(sent.value, *_sorted(group), rate, settings, draw)
                return _row(number, len(group), loss, trained)

            def added(group: pa.Table) -> pa.Table:
                ordered = group.sort_by("part")
                total = sum(n.as_py() * np.array(w.as_py()) for n, w in zip(ordered["n"], ordered["weights"]))
                part = ordered["part"][0].as_py() // width
                return _row(part, sum(ordered["n"].to_pylist()), sum(ordered["loss"].to_pylist()), total)

            trained = dealt.groupBy("replica").applyInArrow(replica, WEIGHTS)
            sums = trained.groupBy(F.expr(f"part div {width}").alias("_group")).applyInArrow(added, WEIGHTS)
            met = sorted(sums.collect(), key=lambda r: r["part"])
            weights = sum(np.array(r["weights"]) for r in met) / n
            history.append(sum(r["loss"] for r in met) / n)
            sent.unpersist()
    finally:
        dealt.unpersist()
    return weights, history


def score(weights: np.ndarray, features: Column, settings: Settings = Settings()) -> Column:
    """Probability of class 1; the weights are unpacked once per worker."""

    def loaded():
        return lambda x: predict(weights, x, settings.hidden)

    inputs = (len(weights) - 2 * settings.hidden - 1) // settings.hidden
    judged = predict_batch_udf(loaded, return_type=DoubleType(), batch_size=1024, input_tensor_shapes=[[inputs]])
    blank = F.array_repeat(F.lit(0.0), inputs)
    return F.when(features.isNotNull(), judged(F.coalesce(features.cast("array<double>"), blank)))
