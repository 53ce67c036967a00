"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document's set holds its distinct shingles of ``words`` words. Its sketch has
``bands * rows`` coordinates. In round i, every element of the set is hashed to one
coordinate and a value in [0, 1); the coordinate keeps the smallest i + value. Rounds go on
until every coordinate is filled; from round ``coordinates`` on, all elements are put into
one coordinate per round, so that all are filled after twice as many rounds at most. Two
coordinates agree with the probability of the sets' Jaccard similarity, and sums over
coordinates concentrate as with independent ones.

Equal sets count once. Bands of equal coordinates give buckets; a pair is linked only after
its full sets were compared. Buckets are never expanded into all pairs: members are
compared with the first of their bucket, linked members become one component, and only
buckets that still hold several components are compared further, in tiles of TILE members,
without the pairs inside one component. What is compared is exact; only a pair whose
sketches agree in no band is missed: at similarity s, (1 - s^rows)^bands, 7e-9 at 0.85.

Defined cases: fewer words than a shingle make one shingle of all words. NULL, empty and
blank texts have an empty set and no links; their component is their doc_id. Rows with one
doc_id are one node. A NULL doc_id takes no part in links and has a NULL component. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import WordHashes, int_list, mix, rows_of, text_of
from wardflow.sources.shared import materialised

TILE = 256
#: Shingles of a tile pair that are held against each other at once.
COLUMNS = 8192
#: Streams over which the comparisons with one pivot are spread.
SALTS = 16


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a document, given its words' hashes."""
    words = words.view(np.uint64)
    size = min(size, len(words))
    if not size:
        return np.empty(0, np.uint64)
    n = len(words) - size + 1
    state = np.full(n, size, np.uint64)
    for i in range(size):
        state = mix(state * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n])
    return np.unique(state)


def sketch(items: np.ndarray, coordinates: int) -> np.ndarray:
    """The fast similarity sketch of a set of 64-bit hashes that is not empty."""
    out = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    t, at = np.uint64(coordinates), 0
    while at < 2 * coordinates:
        # several rounds at once: those after the last needed one cannot lower a coordinate
        rounds = np.arange(at, min(2 * coordinates, at + max(1, 2048 // len(items))), dtype=np.uint64)
        h = mix(items[None, :] ^ mix(rounds * np.uint64(2) + np.uint64(1))[:, None])
        place = np.where(rounds[:, None] < t, (h >> np.uint64(32)) * t >> np.uint64(32), rounds[:, None] - t)
        value = (rounds[:, None] << np.uint64(52)) | (mix(h) >> np.uint64(12))
        np.minimum.at(out, place.ravel().astype(np.int64), value.ravel())
        at += len(rounds)
        if out.max() != np.iinfo(np.uint64).max:
            break
    return out


def band_keys(coordinates: np.ndarray, bands: int) -> np.ndarray:
    state = np.arange(bands, dtype=np.uint64)
    for column in coordinates.reshape(bands, -1).T:
        state = mix(state * np.uint64(0x9E3779B97F4A7C15) + column)
    return state.view(np.int64)


def sketches(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit hash of the set (s1, s2), and its band keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in rows_of(batches, 500):
            n, s1, s2, keys = [], [], [], []
            for text in batch.column(1).to_pylist():
                items = shingle_set(hashes(text.lower().split()), words)
                n.append(len(items))
                s1.append(int(mix(items).sum(dtype=np.uint64)) - (1 << 63))
                s2.append(int(mix(items ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)) - (1 << 63))
                keys.append(band_keys(sketch(items, bands * rows), bands) if len(items) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), int_list(keys)],
                ["doc_id", "n_shingles", "s1", "s2", "keys"],
            )

    source = docs.select(F.col("doc_id").cast("bigint"), text_of().cast("binary").alias("text"))
    return source.mapInArrow(work, "doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint, keys array<bigint>")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id and its sorted shingle hashes as bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in rows_of(batches, 500):
            sets = [shingle_set(hashes(t.lower().split()), words).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["doc_id", "items"])

    return docs.mapInArrow(work, "doc_id bigint, items binary")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted distinct hashes."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum()) if len(large) else 0
    return 100 * both >= percent * (len(a) + len(b) - both)


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node that it reaches; ``edges`` has columns a and b."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    links = materialised(both.where("a <> b").distinct())
    labels = materialised(
        links.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("node"), F.least("a", "label").alias("label"))
    )
    while True:
        near = (
            links.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        hooked = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label")
        )
        up = labels.select(F.col("node").alias("_up"), F.col("label").alias("_up_label"))
        new = materialised(
            hooked.join(up, F.col("label") == F.col("_up"), "left").select(
                "node", "was", F.least("label", "_up_label").alias("label")
            )
        )
        labels = new.select("node", "label")
        if new.where("was <> label").isEmpty():
            return labels


def _relabel(members: DataFrame, found: DataFrame) -> DataFrame:
    """``members`` (rep, label) after links between labels were found."""
    merged = components(found).select("node", F.col("label").alias("merged"))
    return materialised(
        members.join(merged, F.col("label") == F.col("node"), "left").select(
            "rep", F.coalesce("merged", "label").alias("label")
        )
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (pivot, rep, ...) whose sets are linked.

    Each pivot's set goes once to each of its salts, each member's set to its pivot; sets
    then meet in a stream, and none is gathered.
    """
    salted = pairs.withColumn("salt", F.expr(f"pmod(xxhash64(rep), {SALTS})").cast("int"))
    members = salted.join(sets, F.col("rep") == F.col("doc_id")).select(
        "pivot", "salt", F.lit(1).alias("kind"), "rep", "items"
    )
    heads = (
        salted.select("pivot", "salt").distinct().join(sets, F.col("pivot") == F.col("doc_id"))
    ).select("pivot", "salt", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("rep"), "items")
    met = members.union(heads).repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "kind")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, of = [], None  # one set, or one for each row with the pivot's doc_id
        for batch in rows_of(batches, 500):
            a, b = [], []
            pivots, kinds, reps = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for pivot, kind, rep, raw in zip(pivots, kinds, reps, batch.column(4)):
                items = np.frombuffer(raw.as_buffer(), np.uint64)
                if kind == 0:
                    heads = [*heads, items.copy()] if of == pivot else [items.copy()]
                    of = pivot
                elif any(linked(head, items, percent) for head in heads):
                    a.append(pivot)
                    b.append(rep)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return met.mapInArrow(compare, "a bigint, b bigint")


def _tiles(open_members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of a bucket (key, rep, label) with different labels.

    A label with many members in a bucket has tiles of its own, the others share tiles by a
    hash of the label. Tile pairs that hold one label are left out.
    """
    sizes = open_members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    own = F.col("n") >= TILE // 2
    shared = sizes.where(~own).groupBy("key").agg(F.sum("n").alias("n_shared"))
    own_part = F.expr(f"pmod(xxhash64(rep), cast(ceil(n / {TILE}) as bigint))")
    shared_part = F.expr(f"pmod(xxhash64(label), cast(ceil(n_shared / {TILE}) as bigint))")
    tile = (
        open_members.join(sizes, ["key", "label"])
        .join(shared, "key", "left")
        .withColumn("tile", F.when(own, F.xxhash64("label", own_part)).otherwise(F.xxhash64(shared_part)))
        .select("key", "rep", "label", "tile")
    )
    spans = tile.groupBy("key", "tile").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    left = spans.select("key", F.col("tile").alias("i"), F.col("low").alias("low_i"), F.col("high").alias("high_i"))
    right = spans.select(F.col("key"), F.col("tile").alias("j"), F.col("low").alias("low_j"), F.col("high").alias("high_j"))
    mixed = F.least("low_i", "low_j") != F.greatest("high_i", "high_j")
    cells = left.join(right, "key").where((F.col("i") <= F.col("j")) & mixed).select("key", "i", "j")
    sides = cells.select("key", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("tile"))
    rows = (
        sides.join(tile, ["key", "tile"])
        .join(sets, F.col("rep") == F.col("doc_id"))
        .select("key", "i", "j", "tile", "rep", "label", "items")
    )

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        sets_ = [np.frombuffer(x, np.uint64) for x in group["items"]]
        n = np.array([len(x) for x in sets_], np.float64)
        _, column, times = np.unique(np.concatenate(sets_), return_inverse=True, return_counts=True)
        shared = times > 1  # a shingle of one set is in no intersection
        row, column = np.repeat(np.arange(len(n)), n.astype(np.int64))[shared[column]], (np.cumsum(shared) - 1)[column[shared[column]]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros((len(n), len(n)), np.float64)
        for at in range(0, int(shared.sum()), COLUMNS):
            lo, hi = np.searchsorted(column, [at, at + COLUMNS])
            grid = np.zeros((len(n), COLUMNS), np.float32)
            grid[row[lo:hi], column[lo:hi] - at] = 1
            both += grid @ grid.T
        label, tile_of = (group[c].to_numpy() for c in ("label", "tile"))
        near = 100 * both >= percent * (n[:, None] + n[None, :] - both)
        near &= label[:, None] < label[None, :]
        if key[1] != key[2]:
            near &= tile_of[:, None] != tile_of[None, :]
        a, b = np.nonzero(near)
        return pd.DataFrame({"a": label[a], "b": label[b]}).drop_duplicates()

    return rows.groupBy("key", "i", "j").applyInPandas(compare, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, words: int = 3, percent: int = 85, bands: int = 32, rows: int = 5
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    The component is the smallest doc_id reached over links of ``percent`` similarity.
    """
    drawn = materialised(sketches(docs, words, bands, rows))
    filled = drawn.where("n_shingles > 0 and doc_id is not null")
    classes = filled.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"))
    first = classes.select("rep", "s1", "s2")
    reps = filled.join(first.withColumnRenamed("rep", "doc_id"), ["s1", "s2", "doc_id"], "left_semi")
    keyed = reps.select(F.col("doc_id").alias("rep"), "n_shingles", F.explode("keys").alias("key")).distinct()
    buckets = keyed.groupBy("key").agg(
        F.min("rep").alias("pivot"), F.max("rep").alias("last"),
    ).where("pivot < last").select("key", "pivot")
    cells = materialised(keyed.join(buckets, "key").select("key", "pivot", "rep", "n_shingles"))
    met = cells.select(F.col("rep").alias("doc_id")).distinct()
    source = docs.select(F.col("doc_id").cast("bigint"), text_of().cast("binary").alias("text"))
    sets = materialised(shingle_sets(source.join(met, "doc_id", "left_semi"), words))

    # every member against one pivot, then members of open buckets against all their pivots
    members = cells.select("rep").distinct().select("rep", F.col("rep").alias("label"))
    once = cells.where("rep <> pivot").groupBy("rep").agg(F.min("pivot").alias("pivot"))
    members = _relabel(members, _verified(once, sets, percent))

    labelled = cells.select("key", "pivot", "rep").join(members, "rep")
    ends = members.select(F.col("rep").alias("pivot"), F.col("label").alias("pivot_label"))
    across = labelled.join(ends, "pivot").where("label <> pivot_label")
    tried = once.select("rep", "pivot")
    pairs = across.select("pivot", "rep").distinct().join(tried, ["pivot", "rep"], "left_anti")
    found = _verified(pairs, sets, percent)
    to_label = members.select(F.col("rep"), F.col("label"))
    by_label = (
        found.join(to_label.withColumnRenamed("rep", "a").withColumnRenamed("label", "la"), "a")
        .join(to_label.withColumnRenamed("rep", "b").withColumnRenamed("label", "lb"), "b")
        .select(F.col("la").alias("a"), F.col("lb").alias("b"))
    )
    members = _relabel(members, by_label)

    # what is left: members that are not their bucket's pivot, with several labels
    rest = cells.where("rep <> pivot").select("key", "rep").join(members, "rep")
    still = rest.groupBy("key").agg(
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        F.struct(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("rep")), F.bit_xor(F.xxhash64("rep", F.lit(1)))
        ).alias("same"),
    ).where("low < high")
    still = still.groupBy("same").agg(F.min("key").alias("key")).select("key")  # equal members once
    opened = materialised(rest.join(still, "key"))
    members = _relabel(members, _tiles(opened, sets, percent))

    to_class = classes.join(members.withColumnRenamed("label", "_label"), "rep", "left").select(
        F.col("s1"), F.col("s2"), F.coalesce("_label", "rep").alias("_class")
    )
    known = drawn.select("doc_id", "n_shingles", "s1", "s2")
    # a doc_id on several rows joins the classes of all of them
    whole = known.join(to_class, ["s1", "s2"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("_class")).alias("_class")
    )
    return whole.select(
        "doc_id", "n_shingles", F.coalesce("_class", "doc_id").alias("component_id")
    )
