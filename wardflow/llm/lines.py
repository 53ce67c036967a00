"""Line dedup with a reversible index: exact reference counts behind sharded cuckoo filters.

The index has three tables. ``holders`` has one row per document and distinct line key,
``refs`` the exact number of documents and the largest doc_id per key, ``filters`` one
cuckoo filter per shard of the keys that are common (held by ``min_docs`` documents or
more). A document's lines are first held against the filter of their shard; only the few
that pass go to the exact table. Filters have no false negatives, so the result is exact.
Inserting and deleting documents changes the counts, and fingerprints enter or leave the
filters as keys become common or stop being so: a deletion undoes an insertion.

Defined cases: NULL or empty text is one empty line. Each row counts as a document; rows
with one doc_id share the place of the largest. A NULL doc_id is below all others. Extra
columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm.common import mix, rows_of, text_of
from wardflow.sources.shared import materialised

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Common keys per filter on average, and copies of a filter that share its probes.
SHARD_KEYS, SALTS = 50_000, 8
SLOTS = 4


def line_key(line: str) -> str:
    return line.strip(BLANKS).translate(LOWER)


def key_hash(key: str) -> bytes:
    return xxhash.xxh3_128_digest(key.encode())


class CuckooFilter:
    """16-bit fingerprints in buckets of four; two possible buckets per key.

    Keys are pairs of 64-bit hashes. A key that finds no room goes to an exact stash.
    """

    def __init__(self, buckets: np.ndarray, stash: set[tuple[int, int]]) -> None:
        self.buckets, self.stash = buckets, stash

    @staticmethod
    def sized(n: int) -> CuckooFilter:
        rows = 1 << max(4, int(np.ceil(np.log2(max(1, n) / SLOTS / 0.8))))
        return CuckooFilter(np.zeros((rows, SLOTS), np.uint16), set())

    def _places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.buckets) - 1)
        print_ = (k2.view(np.uint64) & np.uint64(0xFFFF)).astype(np.uint16)
        print_[print_ == 0] = 1
        first = mix(k1.view(np.uint64)) & mask
        return print_, first.astype(np.int64), (first ^ (mix(print_.astype(np.uint64)) & mask)).astype(np.int64)

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        print_, one, two = self._places(k1, k2)
        found = (self.buckets[one] == print_[:, None]).any(1) | (self.buckets[two] == print_[:, None]).any(1)
        if self.stash:
            found |= np.fromiter(((a, b) in self.stash for a, b in zip(k1.tolist(), k2.tolist())), bool, len(k1))
        return found

    def insert(self, k1: np.ndarray, k2: np.ndarray, kicks: int = 200) -> None:
        mask = np.uint64(len(self.buckets) - 1)
        prints, ones, twos = self._places(k1, k2)
        jump = (mix(np.arange(1 << 16, dtype=np.uint64)) & mask).astype(np.int64)
        for n, (print_, one, two) in enumerate(zip(prints.tolist(), ones.tolist(), twos.tolist())):
            trail, at = [], one
            for kick in range(kicks):
                free = np.flatnonzero(self.buckets[at] == 0)
                if not len(free) and kick == 0:
                    at = two
                    free = np.flatnonzero(self.buckets[at] == 0)
                if len(free):
                    self.buckets[at, free[0]] = print_
                    break
                slot = kick % SLOTS
                trail.append((at, slot, print_))
                print_, self.buckets[at, slot] = int(self.buckets[at, slot]), print_
                at ^= int(jump[print_])
            else:  # undo, so that no other key is lost
                for at, slot, moved in reversed(trail):
                    print_, self.buckets[at, slot] = int(self.buckets[at, slot]), print_
                self.stash.add((int(k1[n]), int(k2[n])))

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Only keys that were inserted may be deleted."""
        prints, ones, twos = self._places(k1, k2)
        for a, b, print_, one, two in zip(k1.tolist(), k2.tolist(), prints.tolist(), ones.tolist(), twos.tolist()):
            if (a, b) in self.stash:
                self.stash.remove((a, b))
                continue
            for at in (one, two):
                slots = np.flatnonzero(self.buckets[at] == print_)
                if len(slots):
                    self.buckets[at, slots[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        stash = np.array(sorted(self.stash), np.int64).reshape(-1, 2)
        return np.int64(len(self.buckets)).tobytes() + self.buckets.tobytes() + stash.tobytes()

    @staticmethod
    def from_bytes(raw: bytes) -> CuckooFilter:
        rows = int(np.frombuffer(raw, np.int64, 1)[0])
        buckets = np.frombuffer(raw, np.uint16, rows * SLOTS, 8).reshape(rows, SLOTS).copy()
        stash = np.frombuffer(raw, np.int64, offset=8 + rows * SLOTS * 2).reshape(-1, 2)
        return CuckooFilter(buckets, {(a, b) for a, b in stash.tolist()})


@dataclass(frozen=True)
class LineIndex:
    holders: DataFrame  # doc_id, k1, k2
    refs: DataFrame  # k1, k2, n_docs, last
    filters: DataFrame  # shard, filter
    shards: int
    min_docs: int
    min_chars: int


def _holders(docs: DataFrame, min_chars: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 500):
            lines_of = [
                {k for line in text.split("\n") if len(k := line_key(line)) >= min_chars}
                for text in batch.column(1).to_pylist()
            ]
            digests = np.frombuffer(b"".join(key_hash(k) for ks in lines_of for k in ks), "<i8")
            where = np.repeat(np.arange(len(lines_of)), [len(ks) for ks in lines_of])
            ids = batch.column(0).take(pa.array(where))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(digests[0::2]), pa.array(digests[1::2])], ["doc_id", "k1", "k2"]
            )

    schema = T.StructType(
        [T.StructField("doc_id", kind), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType())]
    )
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(keys, schema)


def _counted(holders: DataFrame) -> DataFrame:
    return holders.groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last")
    )


def _shard(shards: int):
    return F.expr(f"pmod(k1, {shards})").cast("int").alias("shard")


def _changed_filters(index: LineIndex, changes: DataFrame) -> DataFrame:
    """``changes``: k1, k2 and up (enters) or not (leaves), at most one row per key."""

    def change(key: tuple, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        up = new["up"].to_numpy(bool)
        k1, k2 = new["k1"].to_numpy(np.int64), new["k2"].to_numpy(np.int64)
        one = CuckooFilter.from_bytes(old["filter"].iloc[0]) if len(old) else CuckooFilter.sized(int(up.sum()))
        one.delete(k1[~up], k2[~up])
        one.insert(k1[up], k2[up])
        return pd.DataFrame({"shard": [key[0]], "filter": [one.to_bytes()]})

    sharded = changes.select(_shard(index.shards), "k1", "k2", "up")
    return (
        index.filters.groupBy("shard")
        .cogroup(sharded.groupBy("shard"))
        .applyInPandas(change, "shard int, filter binary")
    )


def build(docs: DataFrame, min_docs: int = 3, min_chars: int = 20) -> LineIndex:
    """The index of all documents. One shard has about SHARD_KEYS common keys at any size."""
    holders = materialised(_holders(docs, min_chars))
    refs = materialised(_counted(holders))
    common = refs.where(F.col("n_docs") >= min_docs)
    shards = 1 + common.count() // SHARD_KEYS
    none = docs.sparkSession.createDataFrame([], "shard int, filter binary")
    index = LineIndex(holders, refs, none, shards, min_docs, min_chars)
    changes = common.select("k1", "k2", F.lit(True).alias("up"))
    return replace(index, filters=materialised(_changed_filters(index, changes)))


def _update(index: LineIndex, holders: DataFrame, touched: DataFrame) -> LineIndex:
    """Counts again for the touched keys alone; only keys that cross the bound reach a filter."""
    keys = ["k1", "k2"]
    holders = materialised(holders)
    fresh = _counted(holders.join(touched, keys, "left_semi"))
    refs = materialised(index.refs.join(touched, keys, "left_anti").unionByName(fresh))
    was = index.refs.where(F.col("n_docs") >= index.min_docs).select(*keys, F.lit(True).alias("was"))
    now = refs.where(F.col("n_docs") >= index.min_docs).select(*keys, F.lit(True).alias("now"))
    changes = (
        touched.join(was, keys, "left")
        .join(now, keys, "left")
        .where(F.col("was").isNull() != F.col("now").isNull())
        .select(*keys, F.col("now").isNotNull().alias("up"))
    )
    filters = materialised(_changed_filters(index, changes))
    return replace(index, holders=holders, refs=refs, filters=filters)


def insert(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with more documents; doc_ids must be new ones."""
    new = materialised(_holders(docs, index.min_chars))
    return _update(index, index.holders.unionByName(new), new.select("k1", "k2").distinct())


def delete(index: LineIndex, doc_ids: DataFrame) -> LineIndex:
    """The index without the documents whose ``doc_id`` is listed."""
    gone = index.holders.join(doc_ids, "doc_id", "left_semi").select("k1", "k2").distinct()
    return _update(index, index.holders.join(doc_ids, "doc_id", "left_anti"), materialised(gone))


def _passing(index: LineIndex) -> DataFrame:
    """Holders whose key passes the filter of its shard, in one stream per shard and salt."""
    kind = index.holders.schema["doc_id"].dataType
    salt = F.expr(f"pmod(xxhash64(doc_id), {SALTS})").cast("int").alias("salt")
    nothing = F.lit(None)
    probes = index.holders.select(
        _shard(index.shards), salt, F.lit(1).alias("kind"), "doc_id", "k1", "k2", nothing.cast("binary").alias("filter")
    )
    filters = index.filters.select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
        F.lit(0).alias("kind"),
        nothing.cast(kind).alias("doc_id"),
        nothing.cast("bigint").alias("k1"),
        nothing.cast("bigint").alias("k2"),
        "filter",
    )
    dealt = (
        probes.unionByName(filters).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, of = None, None
        for batch in batches:
            at = 0
            cell = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64) * SALTS
            cell = cell + batch.column(1).to_numpy(zero_copy_only=False)
            is_filter = batch.column(2).to_numpy(zero_copy_only=False) == 0
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else []
            for at, end in zip(starts, [*starts[1:], len(cell)]):
                if is_filter[at]:
                    one, of = CuckooFilter.from_bytes(batch.column(6)[int(at)].as_py()), cell[at]
                    at += 1
                if of != cell[at - 1 if at == end else at] or at == end:
                    continue
                rows = batch.slice(at, end - at)
                k1 = rows.column(4).to_numpy(zero_copy_only=False)
                k2 = rows.column(5).to_numpy(zero_copy_only=False)
                keep = np.flatnonzero(one.contains(k1, k2))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c).take(pa.array(keep)) for c in (3, 4, 5)], ["doc_id", "k1", "k2"]
                )

    return dealt.mapInArrow(probe, index.holders.schema)


def dropped_keys(index: LineIndex) -> DataFrame:
    """doc_id and the keys whose lines this document loses."""
    common = index.refs.where(F.col("n_docs") >= index.min_docs)
    lost = (
        _passing(index)
        .join(common, ["k1", "k2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("last")))
        .select("doc_id", F.struct("k1", "k2").alias("key"))
    )
    return lost.groupBy("doc_id").agg(
        F.collect_set("key")["k1"].alias("k1s"), F.collect_set("key")["k2"].alias("k2s")
    )


def apply(docs: DataFrame, index: LineIndex) -> DataFrame:
    """``docs`` with the text that stays, ``n_lines`` and ``n_dropped``.

    The index must hold these documents. A NULL text stays NULL.
    """
    lost = dropped_keys(index).withColumnRenamed("doc_id", "_lost_id")
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    joined = (
        docs.select(*keep)
        .join(lost, F.col("doc_id").eqNullSafe(F.col("_lost_id")), "left")
        .select(*keep, F.col("k1s").alias("_k1s"), F.col("k2s").alias("_k2s"))
    )
    text_at, min_chars = keep.index("text"), index.min_chars

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 500):
            texts, n_lines, n_dropped = [], [], []
            firsts, seconds = batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist()
            for text, k1s, k2s in zip(batch.column(text_at).to_pylist(), firsts, seconds):
                lines = (text or "").split("\n")
                n_lines.append(len(lines))
                if k1s:
                    raw = np.column_stack([np.array(k1s, "<i8"), np.array(k2s, "<i8")]).tobytes()
                    lose = {raw[i : i + 16] for i in range(0, len(raw), 16)}
                    stay = [x for x in lines if len(k := line_key(x)) < min_chars or key_hash(k) not in lose]
                    text = "\n".join(stay)
                    n_dropped.append(len(lines) - len(stay))
                else:
                    n_dropped.append(0)
                texts.append(text)
            columns = [batch.column(i) for i in range(len(keep))]
            columns[text_at] = pa.array(texts, pa.string())
            columns += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "n_lines", "n_dropped"])

    fields = [docs.schema[c] for c in keep]
    schema = T.StructType(
        [*fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    )
    return joined.mapInArrow(cut, schema)


def dedup_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """Each key of ``min_chars`` code points or more in ``min_docs`` documents or more keeps
    its lines only in the document with the largest doc_id."""
    return apply(docs, build(docs, min_docs, min_chars))
