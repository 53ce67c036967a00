"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words that a task remembers; those that come later are hashed whenever they occur.
KEPT_WORDS = 150_000


#: Bytes of rows that go to a Python worker at once.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound what an executor and its Python workers hold of long texts, unless the session does."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(setting, None) is None:
        spark.conf.set(setting, BATCH_BYTES)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, NULL as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5. A NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def int_list(arrays: list[np.ndarray]) -> pa.Array:
    """Arrays of int64 as one Arrow list column."""
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int64, copy=False)))


def rows_of(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most n rows, so that what is built from one stays small.

    At the end the task's memory goes back: the worker lives on.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, n):
            yield batch.slice(at, n)
    pa.default_memory_pool().release_unused()


class WordHashes:
    """64-bit hashes of words, with a bounded memory."""

    def __init__(self, limit: int = KEPT_WORDS) -> None:
        self.limit = limit
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        new = set(words).difference(known)
        for w in new:
            known[w] = xxhash.xxh3_64_intdigest(w) - (1 << 63)
        hashes = np.array(list(map(known.__getitem__, words)), np.int64)
        if len(known) > self.limit:
            for w in new:
                del known[w]
        return hashes


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 on an array of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
