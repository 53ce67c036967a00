"""Skip-gram word vectors in blocks, with no vocabulary or vector table on one machine.

Words are dealt to blocks by hash. Co-occurrences are counted first, as (centre, context)
pairs with weights, and a pair belongs to the cell (block of the centre, block of the
context). They are counted in numbers: a task counts the pairs of a slice of its sentences,
and what moves is one row per slice and group of pairs, with the words once and the counts
as bytes; a group sums its slices and learns there which of its words are known.

One epoch is as many rounds as there are blocks: in round r the cells (i, i + r) meet their
block of centre vectors and their block of context vectors, each block in one cell only, so
all cells of a round train side by side without a conflict. Between rounds the blocks lie in
a table in the shared folder.

The loss is that of negative sampling. A pair at distance d in a window w weighs
(w + 1 - d) / w, what a random window gives on average. Negatives come from the cell's
block of contexts by their frequency to the power 3/4. Steps are scaled per word by the
root of its summed squared gradients, so heavy pairs do not overshoot.

A cell has at most (words of a block)^2 pairs however often they occur, and two blocks of
vectors; both are bounded by ``block_words``. Everything drawn depends on seed, cell and
epoch alone: the same input gives the same vectors in any partitioning.

Defined cases: NULL and empty token lists have no words. Words below ``min_count`` get no
vector; they still keep others apart. A text without known words has the zero vector. Lists
longer than ``max_sentence_length`` are cut into sentences of that length. Without words
there are no vectors.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.operators.encode import LEAST_ROWS, SLICE_TASKS, row_numbers, row_tokens
from wardflow.sources.shared import drop_table, materialised

#: Pairs per step, negatives that they share, and the part of a step that is kept for seldom words.
STEP_PAIRS, SHARED_NEGATIVES, DAMPING = 256, 64, 1e-6
#: Tasks of a round for each of its cells, which a hash deals to them.
CELL_TASKS = 32
#: Vectors that are multiplied at a time, and counted words and texts of a slice at most, where texts are
#: pooled; pooled texts that leave a slice at a time.
POOLED_WORDS, POOLED_ROWS, POOLED_TEXTS, TEXTS_AT_ONCE = 1 << 14, 1 << 20, 1 << 14, 1 << 10
#: Pairs of a slice that is counted at once, pairs that a group of them sums, and the least parts of the words
#: (each two parts are a group), so that small tables keep all cores busy. Rows that leave a group at a time.
SLICE_PAIRS, GROUP_PAIRS, LEAST_PARTS, ROWS_AT_ONCE = 1 << 23, 1 << 22, 12, 1 << 16
COUNTED = "_group int, left array<string>, right array<string>, n int, x binary, y binary, weight binary"
#: Vectors lie in the state as the bytes of their floats, which move without a conversion per number.
STATE = "kind string, block int, word string, share double, vector binary"


@dataclass(frozen=True)
class Settings:
    vector_size: int = 1000
    window: int = 5
    min_count: int = 10
    max_sentence_length: int = 1000
    epochs: int = 1
    #: Times that a cell goes over its pairs in a round.
    passes: int = 1
    negatives: int = 5
    learning_rate: float = 0.05
    #: Words of a block, and the least number of blocks.
    block_words: int = 4096
    least_blocks: int = 4
    seed: int = 1


def sentences(docs: DataFrame, tokens: Column, longest: int) -> DataFrame:
    """``words`` of at most ``longest``; a longer text is several rows.

    The outer form and the filter after it keep Catalyst from making the tokens once more below.
    """
    size = F.size("_t")
    starts = F.explode_outer(F.when(size > 0, F.sequence(F.lit(1), size, F.lit(longest))))
    cut = docs.select(tokens.alias("_t")).select("_t", starts.alias("_from")).where(F.col("_from").isNotNull())
    return cut.select(F.slice("_t", F.col("_from"), longest).alias("words"))


def vocabulary(rows: DataFrame, settings: Settings) -> DataFrame:
    """word, ``n`` and ``block`` of the words that get a vector."""
    counts = rows.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    known = materialised(counts.where(F.col("n") >= settings.min_count))
    blocks = max(settings.least_blocks, -(-known.count() // settings.block_words))
    return known.withColumn("block", F.pmod(F.xxhash64("word", F.lit(settings.seed)), F.lit(blocks)).cast("int"))


def _parts(words: pa.Array, parts: int) -> np.ndarray:
    """As ``_part_column``; a missing word is in the first part."""
    names = words.cast(pa.binary()).to_pylist()
    return np.array([0 if w is None else zlib.crc32(w) % parts for w in names], np.int64)


def _part_column(word: str, parts: int) -> Column:
    return (F.crc32(F.col(word)) % parts).cast("int")


def _runs(key: np.ndarray) -> np.ndarray:
    """Where each run of equal values of the sorted ``key`` starts."""
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)


def _slice_pairs(texts: list[pa.Array], window: int, parts: int) -> tuple[pa.Array, np.ndarray, tuple[np.ndarray, ...]]:
    """The distinct words of some sentences in the order of their parts, the first place of each part
    and the end, and the pairs in order: two places in the words, the lesser first, and the weight."""
    lengths = np.concatenate([t.value_lengths().to_numpy(zero_copy_only=False) for t in texts])
    coded = pa.concat_arrays([t.flatten() for t in texts]).dictionary_encode(null_encoding="encode")
    words = coded.dictionary
    own = _parts(words, parts)
    order = np.argsort(own, kind="stable")
    words, firsts = words.take(pa.array(order)), np.searchsorted(own[order], np.arange(parts + 1))
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    code = place[coded.indices.to_numpy()]
    # places that are left in the own sentence, the own one included
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(code))
    missing = np.flatnonzero(words.is_null().to_numpy(zero_copy_only=False))
    # a pair and its weight are one number; sorted, equal pairs lie side by side
    word_bits, weight_bits = len(words).bit_length(), window.bit_length()
    keys = [np.zeros(0, np.int64)]
    for distance in range(1, min(window, len(code) - 1) + 1):
        near = left[:-distance] > distance
        one, other = code[:-distance][near], code[distance:][near]
        for none in missing:
            # next to a missing word, a word is its own neighbour
            one, other = np.where(one == none, other, one), np.where(other == none, one, other)
        pair = np.minimum(one, other) << word_bits | np.maximum(one, other)
        keys.append(pair << weight_bits | (window + 1 - distance))
    key = np.concatenate(keys)
    key.sort()
    pair = key >> weight_bits
    starts = _runs(pair)
    weight = np.add.reduceat(key & (1 << weight_bits) - 1, starts) if len(key) else key
    pair = pair[starts]
    return words, firsts, (pair >> word_bits, pair & (1 << word_bits) - 1, weight)


def _used(place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of so many places occur, and each one's number among them."""
    seen = np.zeros(size, bool)
    seen[place] = True
    return np.flatnonzero(seen), (np.cumsum(seen, dtype=np.int32) - 1)[place]


def _narrow(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0, each in as few bytes as the largest needs."""
    return numbers.astype(np.min_scalar_type(numbers.max())).tobytes()


def _wide(blobs: pa.ChunkedArray, n: pa.ChunkedArray) -> list[np.ndarray]:
    """The numbers of each row of bytes, of which it holds ``n``."""
    return [np.frombuffer(b, f"u{len(b) // m}").astype(np.int64) for b, m in zip(blobs.to_pylist(), n.to_pylist())]


def _counted(rows: DataFrame, window: int, parts: int) -> DataFrame:
    """The counted pairs of each slice of sentences, a row per group: the words of both sides, and of its
    ``n`` pairs the places of their words and the weight as bytes."""

    def grouped(texts: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        words, firsts, (x, y, weight) = _slice_pairs(texts, window, parts)
        of_part = np.repeat(np.arange(parts, dtype=np.int32), np.diff(firsts))
        bounds = np.searchsorted(x, firsts)
        for i in range(parts):
            here = slice(bounds[i], bounds[i + 1])
            mate = of_part[y[here]]
            order = np.argsort(mate.astype(np.uint16) if parts < 1 << 16 else mate, kind="stable")
            ends = np.searchsorted(mate[order], np.arange(parts + 1))
            for j in range(i, parts):
                own = here.start + order[ends[j] : ends[j + 1]]
                if not len(own):
                    continue
                (left, at_left), (right, at_right) = (
                    _used(at[own] - firsts[part], firsts[part + 1] - firsts[part]) for at, part in ((x, i), (y, j))
                )
                sides = [words.take(pa.array(firsts[p] + k)) for p, k in ((i, left), (j, right))]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(k)], pa.int32()), k) for k in sides]
                numbers = [pa.array([_narrow(k)]) for k in (at_left, at_right, weight[own])]
                columns = [pa.array([i * parts + j], pa.int32()), *lists, pa.array([len(own)], pa.int32()), *numbers]
                yield pa.RecordBatch.from_arrays(columns, ["_group", "left", "right", "n", "x", "y", "weight"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            texts = batch.column("words")
            ends = np.cumsum(texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64) * window
            start = 0
            while start < len(texts):
                # whole sentences, until the slice is full
                before = ends[start - 1] if start else 0
                end = min(len(texts), int(np.searchsorted(ends, before + SLICE_PAIRS - n)) + 1)
                held.append(texts.slice(start, end - start).drop_null())
                n += int(ends[end - 1] - before)
                start = end
                if n >= SLICE_PAIRS:
                    yield from grouped(held)
                    held, n = [], 0
        if held:
            yield from grouped(held)

    return rows.select("words").mapInArrow(count, COUNTED)


def _summed_pairs(slices: pa.Table, known: pa.Table | None, window: int) -> pa.Table:
    """a, b and weight of the pairs of a group, from its slices; of the known words, with their blocks, where given."""
    sides = [slices[k].combine_chunks() for k in ("left", "right")]
    if known is None:
        names = pc.unique(pa.concat_arrays([k.flatten() for k in sides]))
        known = pa.table({"word": names})
    # in the order of the bytes, so that the lesser place is the lesser word
    known = known.sort_by("word")
    names = known["word"].combine_chunks()
    at = []
    for words, places in zip(sides, ("x", "y")):
        place = pc.fill_null(pc.index_in(words.flatten(), names), -1).to_numpy().astype(np.int64)
        firsts = np.concatenate([[0], np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False))])
        own = [v + first for v, first in zip(_wide(slices[places], slices["n"]), firsts)]
        at.append(place[np.concatenate(own)] if own else np.zeros(0, np.int64))
    weight = np.concatenate([np.zeros(0, np.int64), *_wide(slices["weight"], slices["n"])])
    both = (at[0] >= 0) & (at[1] >= 0)
    x, y, weight = at[0][both], at[1][both], weight[both]
    bits = len(names).bit_length()
    key = np.minimum(x, y) << bits | np.maximum(x, y)
    order = np.argsort(key)
    key, weight = key[order], weight[order]
    starts = _runs(key)
    total = (np.add.reduceat(weight, starts) if len(key) else weight) / window
    a, b = key[starts] >> bits, key[starts] & (1 << bits) - 1
    out = []
    for start in range(0, max(1, len(a)), ROWS_AT_ONCE):
        here = slice(start, start + ROWS_AT_ONCE)
        one, other = (known.take(pa.array(k[here])) for k in (a, b))
        piece = {"a": one["word"], "b": other["word"], "weight": pa.array(total[here], pa.float64())}
        if "block" in known.column_names:
            piece |= {"a_block": one["block"], "b_block": other["block"]}
        out.append(pa.table(piece))
    return pa.concat_tables(out)


def co_occurrences(rows: DataFrame, window: int, words: DataFrame | None = None) -> DataFrame:
    """a, b (a <= b) and ``weight`` of the words within a window of each other, each two once.

    With ``words`` only those of them, with ``a_block`` and ``b_block``. ``rows`` are read twice.
    """
    pairs = window * (rows.agg(F.sum(F.size("words"))).first()[0] or 0)
    # parts * (parts + 1) / 2 groups
    parts = max(LEAST_PARTS, int(np.ceil(np.sqrt(2 * pairs / GROUP_PAIRS))))
    counted = _counted(rows, window, parts).groupBy("_group")
    schema = "a string, b string, weight double"
    if words is None:
        return counted.applyInArrow(lambda slices: _summed_pairs(slices, None, window), schema)
    own = words.where(F.col("word").isNotNull()).select("word", "block", _part_column("word", parts).alias("_own"))
    mates = own.withColumn("_mate", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    given = mates.select("word", "block", (F.least("_own", "_mate") * parts + F.greatest("_own", "_mate")).alias("_group"))
    met = counted.cogroup(given.groupBy("_group"))
    return met.applyInArrow(
        lambda slices, known: _summed_pairs(slices, known.select(["word", "block"]), window),
        schema + ", a_block int, b_block int",
    )


def cells(pairs: DataFrame, words: DataFrame, blocks: int) -> DataFrame:
    """centre, context, weight, ``block`` of the centre and ``round`` in which the cell is trained.

    Pairs that bring the blocks of their words do not meet ``words`` again.
    """
    if "a_block" in pairs.columns:
        known = pairs.withColumnsRenamed({"a_block": "_a", "b_block": "_b"})
    else:
        found = words.select("word", "block")
        known = pairs.join(found.withColumnsRenamed({"word": "a", "block": "_a"}), "a").join(
            found.withColumnsRenamed({"word": "b", "block": "_b"}), "b"
        )
    # a word next to itself is one pair of the cell, with both directions' weight
    twice = F.col("a") == F.col("b")
    ways = F.when(twice, F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    weight = F.when(twice, 2 * F.col("weight")).otherwise(F.col("weight"))
    directed = known.select("a", "b", "_a", "_b", weight.alias("weight"), F.explode(ways).alias("_back"))

    def side(here: str, there: str) -> Column:
        return F.when(F.col("_back"), F.col(there)).otherwise(F.col(here))

    return directed.select(
        side("a", "b").alias("centre"),
        side("b", "a").alias("context"),
        "weight",
        side("_a", "_b").alias("block"),
        F.pmod(side("_b", "_a") - side("_a", "_b"), F.lit(blocks)).alias("round"),
    )


def _start(words: list[str], size: int, seed: int) -> np.ndarray:
    """First vectors, each drawn from its word; one more place sums the squared gradients."""
    out = np.zeros((len(words), size + 1), np.float32)
    for i, w in enumerate(words):
        drawn = np.random.default_rng([seed, *w.encode()]).random(size, np.float32)
        out[i, :size] = (drawn - 0.5) / size
    return out


def _packed(vectors: np.ndarray) -> pa.Array:
    """A row of floats as bytes."""
    ends = np.arange(len(vectors) + 1, dtype=np.int32) * (4 * vectors.shape[1])
    return pa.Array.from_buffers(
        pa.binary(), len(vectors), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(vectors, np.float32))]
    )


def _unpacked(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float32).reshape(len(rows), -1).copy() if rows else np.zeros((0, 1), np.float32)


def _summed(at: np.ndarray, gradient: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of ``at``, which may repeat, and the sum of each one's gradients."""
    order = np.argsort(at, kind="stable")
    placed = at[order]
    starts = np.flatnonzero(np.concatenate([[True], placed[1:] != placed[:-1]]))
    ends = np.append(starts[1:], len(at))
    # most rows come once or twice: whole runs are added up only where a row comes more often
    summed = gradient[order[starts]]
    again = np.flatnonzero(ends - starts > 1)
    summed[again] += gradient[order[starts[again] + 1]]
    for i in np.flatnonzero(ends - starts > 2):
        summed[i] += gradient[order[starts[i] + 2 : ends[i]]].sum(axis=0)
    return placed[starts], summed


def _descend(vectors: np.ndarray, squares: np.ndarray, at: np.ndarray, gradient: np.ndarray, rate: float) -> None:
    """One step for the rows ``at``, which may repeat."""
    rows, step = _summed(at, gradient)
    squares[rows] += np.einsum("ij,ij->i", step, step) / np.float32(step.shape[1])
    step *= (np.float32(rate) / np.sqrt(squares[rows] + np.float32(DAMPING)))[:, None]
    vectors[rows] -= step


def train_cell(
    centre: np.ndarray, context: np.ndarray, share: np.ndarray, pairs: tuple[np.ndarray, ...], settings: Settings, draw
) -> None:
    """Train both blocks in place on ``pairs`` (place of centre, place of context, weight)."""
    x, y, weight = pairs
    weight = (weight / weight.mean()).astype(np.float32)
    order = np.concatenate([draw.permutation(len(x)) for _ in range(settings.passes)])
    # rows without their last place lie one after the other, as the products want them
    us, vs = (np.ascontiguousarray(block[:, :-1]) for block in (centre, context))
    u_squares, v_squares = centre[:, -1].copy(), context[:, -1].copy()
    chance = np.cumsum(share / share.sum())
    chance /= chance[-1]
    shared = min(SHARED_NEGATIVES, 4 * len(chance))
    for start in range(0, len(order), STEP_PAIRS):
        at = order[start : start + STEP_PAIRS]
        u, v = us[x[at]], vs[y[at]]
        negative = chance.searchsorted(draw.random(shared), side="right")
        z = vs[negative]
        w = weight[at][:, None]
        # a negative that is the pair's own context is none
        other = (negative[None, :] != y[at][:, None]) * np.float32(settings.negatives / shared)
        pull = w * (_sigmoid(np.einsum("ij,ij->i", u, v)[:, None]) - 1)
        push = w * other * _sigmoid(u @ z.T)
        to_centre = push @ z
        v *= pull
        to_centre += v
        to_context = np.empty((len(at) + shared, u.shape[1]), np.float32)
        np.matmul(push.T, u, out=to_context[len(at) :])
        np.multiply(u, pull, out=to_context[: len(at)])
        _descend(us, u_squares, x[at], to_centre, settings.learning_rate)
        _descend(vs, v_squares, np.concatenate([y[at], negative]), to_context, settings.learning_rate)
    centre[:, :-1], centre[:, -1] = us, u_squares
    context[:, :-1], context[:, -1] = vs, v_squares


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _round(state: DataFrame, pairs: DataFrame, number: int, blocks: int, epoch: int, settings: Settings) -> DataFrame:
    """All cells of one round; the state after it."""
    home = F.when(F.col("kind") == "context", F.pmod(F.col("block") - number, F.lit(blocks))).otherwise(F.col("block"))
    blank = [F.lit(None).cast(t).alias(n) for n, t in (("centre", "string"), ("context", "string"), ("weight", "double"))]
    own = state.select(home.alias("_cell"), "kind", "block", "word", "share", "vector", *blank)
    empty = [F.lit(None).cast(t).alias(n) for n, t in (("word", "string"), ("share", "double"), ("vector", "binary"))]
    dealt = pairs.where(F.col("round") == number).select(
        F.col("block").alias("_cell"), F.lit("pair").alias("kind"), "block", *empty, "centre", "context", "weight"
    )

    def train(cell: pa.Table) -> pa.Table:
        parts = {}
        for kind in ("centre", "context"):
            rows = cell.filter(pc.equal(cell["kind"], kind)).sort_by("word")
            parts[kind] = (rows, _unpacked(rows["vector"]))
        met = cell.filter(pc.equal(cell["kind"], "pair"))
        if len(met):
            x, y = (pc.index_in(met[k], parts[k][0]["word"].combine_chunks()).to_numpy() for k in ("centre", "context"))
            # words lie in their order, so this is the order of the pairs' words
            order = np.lexsort((y, x))
            draw = np.random.default_rng([settings.seed, epoch, number, int(cell["_cell"][0].as_py())])
            share = parts["context"][0]["share"].to_numpy()
            pairs = (x[order], y[order], met["weight"].to_numpy()[order])
            train_cell(parts["centre"][1], parts["context"][1], share, pairs, settings, draw)
        out = []
        for rows, vectors in parts.values():
            out.append(rows.select(["kind", "block", "word", "share"]).append_column("vector", _packed(vectors)))
        return pa.concat_tables(out)

    # so many tasks that few get two cells, and never merged: a cell takes long however small it is
    placed = own.unionByName(dealt).repartition(CELL_TASKS * blocks, "_cell")
    return placed.groupBy("_cell").applyInArrow(train, STATE)


def fit(docs: DataFrame, tokens: Column, settings: Settings = Settings()) -> DataFrame:
    """word, ``n`` and ``vector`` (float, ``vector_size`` long) of every word that is frequent enough."""
    rows = materialised(sentences(docs, tokens, settings.max_sentence_length))
    words = materialised(vocabulary(rows, settings))
    blocks = words.agg(F.max("block")).collect()[0][0]
    if blocks is None:
        return words.select("word", "n", F.lit(None).cast("array<float>").alias("vector"))
    # the last blocks may be empty; all rounds of those that are not are run
    blocks += 1
    # in the order of the rounds, so that a round skips the pages of all others
    dealt = cells(co_occurrences(rows, settings.window, words), words, blocks)
    pairs = materialised(dealt.sortWithinPartitions("round", "block"))
    drop_table(rows)

    def first(batches):
        for batch in batches:
            vectors = _start(batch.column("word").to_pylist(), settings.vector_size, settings.seed)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("kind", "block", "word", "share")), _packed(vectors)],
                ["kind", "block", "word", "share", "vector"],
            )

    kinds = words.withColumn("kind", F.explode(F.array(F.lit("centre"), F.lit("context"))))
    named = kinds.select("kind", "block", "word", F.pow("n", F.lit(0.75)).alias("share"))
    state = materialised(named.repartition(2 * blocks, "kind", "block").mapInArrow(first, STATE))
    for epoch in range(settings.epochs):
        for number in range(blocks):
            before, state = state, materialised(_round(state, pairs, number, blocks, epoch, settings))
            drop_table(before)
    drop_table(pairs)

    def as_lists(batches):
        for batch in batches:
            vectors = _unpacked(batch.column("vector"))[:, : settings.vector_size]
            ends = pa.array(np.arange(len(vectors) + 1) * vectors.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(vectors.ravel(), pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("word"), lists], ["word", "vector"])

    centres = state.where("kind = 'centre'").select("word", "vector")
    trained = centres.mapInArrow(as_lists, "word string, vector array<float>")
    return words.select("word", "n").join(trained, "word")


def mean_vectors(docs: DataFrame, keys: list[str], tokens: Column, vectors: DataFrame, size: int) -> DataFrame:
    """keys and ``features``: the sum of the vectors of a row's known words over its number of words.

    Words are counted where a row lies. Rows are dealt to slices by a hash of their keys; a
    slice gets the vector of each word that it has once and pools its rows whole, so no sum
    of a part of a row moves. Rows with equal keys share the sum of all of them.
    """
    counted = materialised(row_tokens(docs, keys, tokens))
    n_rows, n_words = counted.agg(F.count("*"), F.coalesce(F.sum(F.size("tokens")), F.lit(0))).first()
    # as many slices as there are cores, unless they would be small or large
    rows = min(max(-(-n_words // docs.sparkSession.sparkContext.defaultParallelism), LEAST_ROWS), POOLED_ROWS)
    slices = max(1, -(-n_words // rows), -(-n_rows // POOLED_TEXTS))
    asked = counted.withColumn("_slice", F.pmod(F.xxhash64(*keys, F.lit(0)), F.lit(slices)).cast("int"))
    wanted = asked.select(F.col("_slice").alias("_of"), F.explode("tokens").alias("word")).distinct()
    given = wanted.join(vectors.select("word", "vector"), "word")
    types = dict(docs.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", features array<double>"

    def pool(left: pa.Table, right: pa.Table) -> pa.Table:
        owner, firsts = row_numbers(left, keys)
        lists = left["tokens"].combine_chunks()
        of = np.repeat(owner, lists.value_lengths().to_numpy(zero_copy_only=False))
        order = np.argsort(of, kind="stable")
        words, of = lists.flatten().take(pa.array(order)), of[order]
        tf = left["tfs"].combine_chunks().flatten().to_numpy()[order].astype(np.float64)
        out = np.zeros((len(firsts), size))
        for start in range(0, len(right), POOLED_WORDS):
            some = right.slice(start, POOLED_WORDS)
            table = some["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(some), size)
            place = pc.index_in(words, some["word"].combine_chunks())
            met = np.flatnonzero(place.is_valid().to_numpy(zero_copy_only=False))
            place, weighted = place.drop_null().to_numpy(), tf[met]
            bounds = np.searchsorted(of[met], np.arange(len(firsts) + 1))
            # a product of counts and vectors per row
            for row in np.flatnonzero(np.diff(bounds)):
                here = slice(bounds[row], bounds[row + 1])
                out[row] += np.dot(weighted[here], table[place[here]])
        n = np.maximum(left["n_words"].to_numpy(), 1)[:, None]
        pieces = []
        for start in range(0, len(left), TEXTS_AT_ONCE):
            here = slice(start, start + TEXTS_AT_ONCE)
            means = out[owner[here]] / n[here]
            ends = pa.array(np.arange(len(means) + 1) * size, pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(means.ravel()))
            pieces.append(left.select(keys).slice(start, len(means)).append_column("features", lists))
        return pa.concat_tables(pieces)

    dealt = asked.repartition(SLICE_TASKS * slices, "_slice").groupBy("_slice")
    met = given.repartition(SLICE_TASKS * slices, "_of").groupBy("_of")
    return dealt.cogroup(met).applyInArrow(pool, schema)
