"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

Every word has a row in a table of ``buckets`` rows (by its hash) and a fixed sparse random
index vector. Over all documents, a word's context vector sums the index vectors of its
neighbours; these sums are counts, so they add up the same in any order. A document is
pooled from the vectors of its words: mean, deviation, and a few figures of the same pool.
A two-layer network in numpy learns the labels; a temperature fitted on rows that the
weights have not seen makes its scores probabilities.

Word vectors gather from all documents. The network is fitted on at most ``max_fit_rows``
labelled rows, those with the smallest hash of their id.

Defined cases: NULL and empty texts have a vector of zeros and get a score like all
others. Labels that are NULL, or whose document has no row, are not learned from. Without
rows of both classes the score is the share of label 1, or 0.5 without any label. Extra
columns are kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm.common import WordHashes, fold, mix, rows_of, text_of
from wardflow.sources.shared import materialised

NEIGHBOURS = (1, 2)
SLICE = 1024  # buckets that travel together
SALTS = 64


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 16
    size: int = 32
    hidden: int = 32
    epochs: int = 30
    max_fit_rows: int = 20_000
    seed: int = 7


@dataclass(frozen=True)
class Network:
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        hidden = np.tanh(np.clip((x - self.centre) / self.scale, -8, 8) @ self.w1 + self.b1)
        return 1 / (1 + np.exp(-np.clip((hidden @ self.w2 + self.b2) / self.temperature, -60, 60)))


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray
    network: Network
    settings: Settings


def index_vectors(s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Two places and two signs per bucket: the sparse random index vectors."""
    draws = mix(np.arange(2 * s.buckets, dtype=np.uint64) + np.uint64(s.seed << 32)).reshape(-1, 2)
    return (draws % np.uint64(s.size)).astype(np.int64), np.where(draws >> np.uint64(63), 1, -1)


def _buckets(hashes: WordHashes, texts: list[bytes], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every word of every text, and the number of words of each text."""
    words = [t.split() for t in texts]
    flat = [w for ws in words for w in ws]
    return hashes(flat) & (s.buckets - 1), np.array([len(ws) for ws in words], np.int64)


def word_vectors(docs: DataFrame, s: Settings) -> np.ndarray:
    """The context vectors of all documents, one row of unit length per bucket.

    A task adds up its own documents and sends slices of the table; their sums are of fixed
    size at any input, and come to the driver as buckets x size integers.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (place, sign) = WordHashes(), index_vectors(s)
        table = np.zeros(s.buckets * s.size, np.int64)
        for batch in rows_of(batches, 500):
            bucket, n = _buckets(hashes, batch.column(0).to_pylist(), s)
            doc = np.repeat(np.arange(len(n)), n)
            for step in NEIGHBOURS:
                together = doc[step:] == doc[:-step]
                left, right = bucket[:-step][together], bucket[step:][together]
                for word, other in ((left, right), (right, left)):
                    for j in range(place.shape[1]):
                        np.add.at(table, word * s.size + place[other, j], sign[other, j])
        slices = table.reshape(-1, SLICE * s.size)
        some = np.flatnonzero(slices.any(1))
        raw = [zlib.compress(slices[i].tobytes(), 1) for i in some]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(raw, pa.binary())], ["slice", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # at most one entry per slice
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(raw), np.int64)
                sums[i] = sums[i] + part if i in sums else part
        raw = [zlib.compress(v.tobytes(), 1) for v in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(raw, pa.binary())], ["slice", "sums"])

    kind = "slice bigint, sums binary"
    slices = -(-s.buckets // SLICE)
    parts = docs.select(text_of().cast("binary").alias("text")).mapInArrow(gather, kind)
    # in two steps: the tasks' tables of one slice first meet in SALTS groups
    salted = parts.withColumn("salt", F.spark_partition_id() % SALTS).repartition("slice", "salt")
    some = salted.select("slice", "sums").mapInArrow(add, kind)
    summed = some.repartition(slices, "slice").mapInArrow(add, kind)
    vectors = np.zeros((slices, SLICE * s.size))
    for row in summed.collect():
        vectors[row["slice"]] = np.frombuffer(zlib.decompress(row["sums"]), np.int64)
    vectors = vectors.reshape(-1, s.size)
    length = np.sqrt((vectors**2).sum(1, keepdims=True))
    return (vectors / np.where(length > 0, length, 1)).astype(np.float32)


def pool(bucket: np.ndarray, n: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """One row per document: mean and deviation of its word vectors, length of the mean,
    likeness of neighbours, share of distinct words, log of the number of words."""
    size = vectors.shape[1]
    out = np.zeros((len(n), 2 * size + 4), np.float64)
    ends = np.cumsum(n)
    for i, (end, k) in enumerate(zip(ends.tolist(), n.tolist())):
        if not k:
            continue
        ids = bucket[end - k : end]
        rows = vectors[ids]
        mean = rows.mean(0, dtype=np.float64)
        out[i, :size] = mean
        out[i, size : 2 * size] = rows.std(0, dtype=np.float64)
        out[i, -4] = np.sqrt(mean @ mean)
        out[i, -3] = (ids[1:] == ids[:-1]).mean() if k > 1 else 0
        out[i, -2] = len(np.unique(ids)) / k
        out[i, -1] = np.log1p(k)
    return out


def _shared(df: DataFrame, vectors: np.ndarray):
    """The table of vectors for all tasks; its size is fixed by the settings."""
    return df.sparkSession.sparkContext.broadcast(vectors)


def pooled(docs: DataFrame, vectors, s: Settings) -> DataFrame:
    """doc_id and the pooled figures as 32-bit floats."""

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in rows_of(batches, 500):
            bucket, n = _buckets(hashes, batch.column(1).to_pylist(), s)
            x = pool(bucket, n, vectors.value).astype(np.float32)
            raw = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), raw], ["doc_id", "figures"])

    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("figures", T.BinaryType())]
    )
    return docs.select("doc_id", text_of().cast("binary").alias("text")).mapInArrow(figures, schema)


def fit_network(x: np.ndarray, y: np.ndarray, held: np.ndarray, s: Settings) -> Network:
    """Adam on cross entropy; the temperature comes from the rows in ``held``."""
    width = x.shape[1]
    zero = Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), 0.0, 1.0)
    if len(y) == 0 or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
        return Network(*list(vars(zero).values())[:5], float(np.log(share / (1 - share))), 1.0)
    rng = np.random.default_rng(s.seed)
    if held.all() or not held.any():
        held = np.arange(len(y)) % 8 == 7
    train = ~held if (~held).any() else held
    centre, scale = x[train].mean(0), x[train].std(0) + 1e-6
    z, t = np.clip((x - centre) / scale, -8, 8), y.astype(np.float64)
    p = [rng.normal(0, 1 / np.sqrt(width), (width, s.hidden)), np.zeros(s.hidden), rng.normal(0, 0.1, s.hidden), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    rows, step = np.flatnonzero(train), 0
    for epoch in range(s.epochs):
        rate = 0.005 * (1 - epoch / s.epochs)
        for at in np.array_split(rng.permutation(rows), max(1, len(rows) // 128)):
            hidden = np.tanh(z[at] @ p[0] + p[1])
            off = (1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3], -60, 60))) - t[at]) / len(at)
            back = np.outer(off, p[2]) * (1 - hidden**2)
            grads = [z[at].T @ back + 1e-4 * p[0], back.sum(0), hidden.T @ off + 1e-4 * p[2], np.array([off.sum()])]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    logits = np.tanh(z[held] @ p[0] + p[1]) @ p[2] + p[3]

    def loss(temperature: float) -> float:
        return float(np.mean(np.logaddexp(0, logits / temperature) - t[held] * logits / temperature))

    temperature = min(np.geomspace(0.25, 8, 101), key=loss)
    return Network(centre, scale, p[0], p[1], p[2], float(p[3][0]), float(temperature))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings | None = None) -> tuple[Model, DataFrame]:
    """The model, and the pooled figures of all documents as a written table.

    Rows whose crc32(doc_id) mod 5 is 0 are not learned from. An eighth of the others
    serves for the temperature.
    """
    s = settings or Settings()
    vectors = word_vectors(docs, s)
    figures = materialised(pooled(docs, _shared(docs, vectors), s))
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
    rank = F.md5(F.col("doc_id").cast("string"))
    rows = (
        figures.join(known.where("_y in (0, 1)"), F.col("doc_id") == F.col("_id"))
        .where(fold() != 0)
        .select("figures", "_y", rank.alias("rank"))
        .orderBy("rank", "_y", "figures")
        .limit(s.max_fit_rows)
        .toArrow()
    )
    width = 2 * s.size + 4
    x = np.frombuffer(b"".join(rows["figures"].to_pylist()), np.float32).reshape(-1, width).astype(np.float64)
    held = np.array([int(r[:4], 16) % 8 == 7 for r in rows["rank"].to_pylist()], bool)
    network = fit_network(x, rows["_y"].to_numpy(), held, s)
    return Model(vectors, network, s), figures


def score_figures(figures: DataFrame, model: Model) -> DataFrame:
    """doc_id and score from pooled figures."""
    network = model.network

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32)
            p = network.score(x.reshape(batch.num_rows, -1).astype(np.float64)) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], ["doc_id", "score"])

    schema = T.StructType([figures.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return figures.select("doc_id", "figures").mapInArrow(score, schema)


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The documents with a score of ``threshold`` or more, all columns as they are."""
    s, network, shared = model.settings, model.network, _shared(docs, model.vectors)
    text_at = docs.columns.index("text")

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in rows_of(batches, 500):
            texts = [(t or "").encode() for t in batch.column(text_at).to_pylist()]
            bucket, n = _buckets(hashes, texts, s)
            x = pool(bucket, n, shared.value).astype(np.float32).astype(np.float64)
            yield batch.filter(pa.array(network.score(x) >= threshold))

    return docs.mapInArrow(good, docs.schema)
