"""Language-model scores by a probabilistic suffix tree over words, with a spelling layer.

Texts are words (ASCII letters in lower case) and one end per document. As in the base
score, the symbols are the training words, the end, and one symbol for all unknown words.
Contexts count the end like a word.
A state is a context of 0, 1 or 2 words. Candidates grow from what was kept: all words that
make up at least ``pair_share`` of all tokens, then the pairs kept at these. Next words that
make up as much in a context are counted; they are kept if they diverge from what the suffix
predicts (count times log ratio above ``least_gain`` nats), and a context is kept if it
keeps any. No candidate is left out by a number of words: neither word of a pair is seldomer
than the pair. A word is scored in the state of the longest kept suffix.

Smoothing: each state takes a discount off its counts and leaves that mass to its suffix,
spread over the words that it does not list; the root leaves it to the unknown word.

Unknown words can also be spelt. A second tree over bytes, counted from the table of words,
has contexts of up to DEPTH symbols back to the blank before the word, candidates from
``least_share`` of all symbols, the same divergence test, and Witten and Bell's smoothing.
``score`` is the probability over the symbols, ``spelt_score`` adds the spelling.

Everything is counted from all training documents. The ``hot_words`` most frequent words,
and all that can be part of a pair, are looked up inside the tasks; the others meet their
counts in a join. The number of states in both trees is bounded by the shares at any input.
``first_words`` is the least number of words that are tried as contexts.

Defined cases: NULL, empty and blank texts are one end. Rows with one doc_id are scored as
documents of their own. Without training documents every word is unknown. Extra columns are
not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm.common import fold, rows_of, text_of
from wardflow.sources.shared import materialised

DEPTH = 6
BLANK = 0x20
#: Distinct words that a task counts before it sends them on.
HELD_WORDS = 1_000_000
#: Words in contexts that a task holds before it counts them.
HELD_KEYS = 4_000_000
END = b""  # stands for the end in the table of counts
#: Taken off every count of a word, and of a word in a context.
DISCOUNT, CONTEXT_DISCOUNT = 0.7, 1.0


@dataclass(frozen=True)
class Settings:
    least_share: float = 4e-6
    least_gain: float = 3.0
    hot_words: int = 200_000
    first_words: int = 5_000
    pair_share: float = 1e-7


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """word (bytes) and c, over all documents; the end is the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"]
            )

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(words_of(text))
                counts[END] += 1
                if len(counts) > HELD_WORDS:
                    yield sent()
                    counts.clear()
        yield sent()

    parts = docs.select(text_of().cast("binary").alias("text")).mapInArrow(count, "word binary, c bigint")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


def positions(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every symbol of every word: the word's number, the symbol, the symbols before it
    (the latest in the lowest byte) and how many of those there are, DEPTH at most."""
    symbols = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.int64)
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    before, padded = np.zeros(len(symbols), np.int64), np.r_[np.full(DEPTH, BLANK), symbols]
    depth = np.minimum(place + 1, DEPTH)
    for back in range(DEPTH):
        there = back < depth
        before[there] |= padded[DEPTH - 1 - back : len(padded) - 1 - back][there] << (8 * back)
    return word, symbols, before, depth


def context_counts(counts: DataFrame) -> DataFrame:
    """depth, context, symbol and n of every context of up to DEPTH symbols."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 200_000):
            words, c = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
            if not words:
                continue
            word, symbol, before, depth = positions(words)
            for d in range(DEPTH + 1):
                deep = depth >= d
                key = ((before[deep] & ((1 << (8 * d)) - 1)) << 8) | symbol[deep]
                keys, at = np.unique(key, return_inverse=True)
                n = np.bincount(at, c[word[deep]].astype(np.float64), len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), d), pa.int32()), pa.array(keys >> 8), pa.array(keys & 255), pa.array(n)],
                    ["depth", "context", "symbol", "n"],
                )

    rows = counts.where(F.length("word") > 0).select("word", "c")
    parts = rows.mapInArrow(count, "depth int, context bigint, symbol bigint, n bigint")
    return parts.groupBy("depth", "context", "symbol").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Tree:
    """Per depth the kept contexts in rising order, the log10 weight that each leaves to its
    suffix, and the log10 probability of each (state, symbol) that was seen."""

    contexts: list[np.ndarray]
    left: list[np.ndarray]
    pairs: list[np.ndarray]
    log_p: list[np.ndarray]

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """log10 probability of each word with the blank that ends it."""
        if not words:
            return np.empty(0)
        word, symbol, before, depth = positions(words)
        score, open_ = np.zeros(len(symbol)), np.arange(len(symbol))
        for d in range(DEPTH, -1, -1):
            contexts = self.contexts[d]
            if not len(contexts) or not len(open_):
                continue
            deep = open_[depth[open_] >= d]
            context = before[deep] & ((1 << (8 * d)) - 1)
            state = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            here = contexts[state] == context
            deep, state = deep[here], state[here]
            pair = (state << 8) | symbol[deep]
            at = np.minimum(np.searchsorted(self.pairs[d], pair), max(0, len(self.pairs[d]) - 1))
            seen = self.pairs[d][at] == pair if len(self.pairs[d]) else np.zeros(len(pair), bool)
            score[deep[seen]] += self.log_p[d][at[seen]]
            score[deep[~seen]] += self.left[d][state[~seen]]
            closed = np.zeros(len(symbol), bool)
            closed[deep[seen]] = True
            open_ = open_[~closed[open_]]
        score[open_] -= np.log10(256)  # below the root: all symbols alike
        return np.bincount(word, score, len(words))


def grow(depth: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray, least_gain: float) -> Tree:
    """The tree of the candidate contexts, given their next-symbol counts."""
    contexts, sizes, rows = [], [], []
    for d in range(DEPTH + 1):
        mine = np.flatnonzero(depth == d)
        mine = mine[np.lexsort((symbol[mine], context[mine]))]
        found, state = np.unique(context[mine], return_inverse=True)
        contexts.append(found)
        sizes.append(np.bincount(state, n[mine], len(found)))
        rows.append((state, symbol[mine], n[mine].astype(np.float64)))
    keep = [np.zeros(len(c), bool) for c in contexts]
    keep[0][:] = True
    for d in range(DEPTH, 0, -1):
        state, sym, count = rows[d]
        up = np.searchsorted(contexts[d - 1], contexts[d] & ((1 << (8 * (d - 1))) - 1))
        up_pairs = (rows[d - 1][0] << 8) | rows[d - 1][1]
        at = np.searchsorted(up_pairs, (up[state] << 8) | sym)  # what follows a context follows its suffix
        p, q = count / sizes[d][state], rows[d - 1][2][at] / sizes[d - 1][up[state]]
        gain = np.bincount(state, count * np.log(p / q), len(contexts[d]))
        keep[d] |= gain > least_gain
        keep[d - 1][up[keep[d]]] = True
    kept, left, pairs, log_p, full = [], [], [], [], None
    for d in range(DEPTH + 1):
        state, sym, count = rows[d]
        kinds = np.bincount(state, minlength=len(contexts[d])).astype(np.float64)
        whole = sizes[d] + kinds
        number = np.cumsum(keep[d]) - 1
        mine = keep[d][state]
        state_, sym_, count_ = state[mine], sym[mine], count[mine]
        if d:
            up = np.searchsorted(kept[d - 1], contexts[d][state_] & ((1 << (8 * (d - 1))) - 1))
            lower = 10 ** full[d - 1][np.searchsorted(pairs[d - 1], (up << 8) | sym_)]
        else:
            full, lower = [], 1 / 256
        p = (count_ + kinds[state_] * lower) / whole[state_]
        kept.append(contexts[d][keep[d]])
        with np.errstate(divide="ignore"):
            left.append(np.log10(kinds / whole)[keep[d]])
        pairs.append((number[state_] << 8) | sym_)
        log_p.append(np.log10(p))
        full.append(log_p[-1])
    return Tree(kept, left, pairs, log_p)


def log_words(tokens: int, distinct: int, c: np.ndarray) -> np.ndarray:
    """log10 probability of words without context; of the unknown word where c is 0."""
    if not tokens:
        return np.zeros(len(c))
    known = np.log10(np.maximum(c - DISCOUNT, 1e-300) / tokens)
    return np.where(c > 0, known, np.log10(DISCOUNT * distinct / tokens))


@dataclass(frozen=True)
class Level:
    """States of one length: (state, word) as state * words + word, rising, the log10
    probability of each, and by state the log10 factor on all words that it does not list."""

    keys: np.ndarray
    log_p: np.ndarray
    log_left: np.ndarray

    def find(self, state: np.ndarray, word: np.ndarray, words: int) -> np.ndarray:
        """The entry of each (state, word), -1 if there is none."""
        if not len(self.keys):
            return np.full(len(state), -1)
        key = state * words + word
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((state >= 0) & (word >= 0) & (self.keys[at] == key), at, -1)

    def left(self, state: np.ndarray) -> np.ndarray:
        if not len(self.log_left):
            return np.zeros(len(state))
        return np.where(state >= 0, self.log_left[np.maximum(state, 0)], 0.0)


@dataclass(frozen=True)
class Words:
    """The hot words by falling count (numbers in a text are places here, the end comes after
    them, -1 stands for all others) and the levels of contexts of one and two words."""

    hot: list[bytes]
    log_word: np.ndarray
    log_base: np.ndarray
    first_words: int
    levels: tuple[Level, ...] = ()

    @property
    def symbols(self) -> int:
        return len(self.hot) + 1

    def states(self, at: np.ndarray, first: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level the state before each word and the entry that the word meets there.

        ``first`` marks the words that begin a text. The end precedes none.
        """
        before = np.where(first, -1, np.roll(at, 1))
        state, found = np.where(before < self.first_words, before, -1), []
        for level in self.levels:
            entry = level.find(state, at, self.symbols)
            found.append((state, entry))
            state = np.where(first, -1, np.roll(entry, 1))
        return found

    def scores(self, at: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 of each word's probability; of words that are not hot only the factor that
        their contexts leave them."""
        score, open_ = np.zeros(len(at)), np.ones(len(at), bool)
        for level, (state, entry) in reversed(list(zip(self.levels, self.states(at, first)))):
            hit = open_ & (entry >= 0)
            score[hit] += level.log_p[entry[hit]]
            open_ &= ~hit
            score[open_] += level.left(state)[open_]
        known = open_ & (at >= 0)
        score[known] += self.log_word[at[known]]
        return score

    def suffix_score(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 probability of hot words in the suffix of states of the level to come."""
        if not self.levels:
            return self.log_word[word]
        last = self.levels[0].keys[state] % self.symbols
        last = np.where(last < self.first_words, last, -1)
        entry = self.levels[0].find(last, word, self.symbols)
        listed = self.levels[0].log_p[np.maximum(entry, 0)]
        return np.where(entry >= 0, listed, self.levels[0].left(last) + self.log_word[word])

    def grown(self, keys: np.ndarray, n: np.ndarray, sizes: np.ndarray, least_gain: float) -> Words:
        """With one more level: counts n of ``keys``, and how often each state occurs."""
        order = np.argsort(keys)
        keys, n = keys[order], n[order].astype(np.float64)
        state, word = keys // self.symbols, keys % self.symbols
        p = (n - CONTEXT_DISCOUNT) / np.maximum(sizes[state], 1)
        lower = 10 ** self.suffix_score(state, word)
        keep = (p > 0) & (n * np.log(np.maximum(p, 1e-300) / lower) > least_gain)
        keys, state, p, lower = keys[keep], state[keep], p[keep], lower[keep]
        rest, rest_lower = 1 - np.bincount(state, p, len(sizes)), 1 - np.bincount(state, lower, len(sizes))
        left = np.log10(np.maximum(rest, 1e-12) / np.maximum(rest_lower, 1e-12))
        return replace(self, levels=(*self.levels, Level(keys, np.log10(p), left)))


class Places:
    """The words of many texts, and the end of each, as places among the hot words."""

    def __init__(self, hot: list[bytes]) -> None:
        self.place = {w: i for i, w in enumerate([*hot, END])}

    def of(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """All words and ends, their places, which of them begin a text, and how many each text has."""
        split = [[*words_of(text), END] for text in texts]
        n = np.array([len(own) for own in split], np.int64)
        words = [w for own in split for w in own]
        get = self.place.get
        first = np.zeros(len(words), bool)
        first[np.cumsum(n) - n] = True
        return words, np.array([get(w, -1) for w in words], np.int64), first, n


def context_words(docs: DataFrame, words: Words) -> DataFrame:
    """key and n: how often a hot word or the end follows a state of the level to come, over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layer = shared.value
        places, held = Places(layer.hot), [np.empty(0, np.int64)]

        def sent() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], ["key", "n"])

        for batch in rows_of(batches, 500):
            _, at, first, _ = places.of(batch.column(0).to_pylist())
            if layer.levels:
                state = np.where(first, -1, np.roll(layer.states(at, first)[-1][1], 1))
            else:
                state = np.where(first, -1, np.roll(at, 1))
                state = np.where(state < layer.first_words, state, -1)
            known = (state >= 0) & (at >= 0)
            held.append(state[known] * layer.symbols + at[known])
            if sum(map(len, held)) > HELD_KEYS:
                yield sent()
                held = [held[0]]
        yield sent()

    parts = docs.select(text_of().cast("binary").alias("text")).mapInArrow(count, "key bigint, n bigint")
    return parts.groupBy("key").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    counts: DataFrame  # word, c
    tokens: int
    distinct: int
    ends: int
    tree: Tree
    words: Words
    settings: Settings

def fit(training: DataFrame, settings: Settings | None = None) -> Model:
    s = settings or Settings()
    counts = materialised(word_counts(training))
    row = counts.agg(
        F.sum("c"),
        F.count(F.lit(1)),
        F.sum(F.when(F.length("word") == 0, F.col("c"))),
        F.sum(F.when(F.length("word") > 0, F.col("c") * (F.length("word") + 1))),
    ).collect()[0]
    tokens, distinct, ends, symbols = (int(x or 0) for x in row)
    entries = materialised(context_counts(counts))
    sizes = entries.groupBy("depth", "context").agg(F.sum("n").alias("whole"))
    large = sizes.where(F.col("whole") >= max(2, s.least_share * symbols)).select("depth", "context")
    got = entries.join(large, ["depth", "context"], "left_semi").toArrow()
    arrays = [got[c].to_numpy().astype(np.int64) for c in ("depth", "context", "symbol", "n")]
    tree = grow(*arrays, s.least_gain)

    least = max(2, s.pair_share * tokens)
    named = counts.where(F.length("word") > 0)
    paired = max(s.first_words, named.where(F.col("c") >= least).count())
    frequent = named.orderBy(F.desc("c"), "word").limit(max(s.hot_words, paired)).toArrow()
    hot, hot_c = frequent["word"].to_pylist(), frequent["c"].to_numpy().astype(np.int64)
    symbol_c = np.r_[hot_c, ends]
    log_base = np.log10(symbol_c + 0.5) - base_log(tokens, distinct)
    words = Words(hot, log_words(tokens, distinct, symbol_c), log_base, paired)
    sizes = hot_c[:paired].astype(np.float64)
    for _ in range(2):
        many = context_words(training, words).where(F.col("n") >= least).toArrow()
        key, n = (many[c].to_numpy().astype(np.int64) for c in ("key", "n"))
        words = words.grown(key, n, sizes, s.least_gain)
        order = np.argsort(key)
        sizes = n[order][np.searchsorted(key[order], words.levels[-1].keys)].astype(np.float64)
    return Model(counts, tokens, distinct, ends, tree, words, s)


def base_log(tokens: int, distinct: int) -> float:
    return float(np.log10(tokens + 0.5 * (distinct + 1)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score and spelt_score of every row."""
    context = docs.sparkSession.sparkContext
    tree, layer = context.broadcast(model.tree), context.broadcast(model.words)
    tokens, distinct, ends = model.tokens, model.distinct, model.ends
    log_all = base_log(tokens, distinct)
    kind = docs.schema["doc_id"].dataType
    fields = [T.StructField("row", T.LongType()), T.StructField("doc_id", kind)]
    fields += [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")]
    fields += [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]
    fields += [T.StructField("word", T.BinaryType())]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = layer.value
        places, base_of = Places(words.hot), np.r_[words.log_base, 0.0]
        row = TaskContext.get().partitionId() << 40
        for batch in rows_of(batches, 500):
            own, at, first, n = places.of(batch.column(1).to_pylist())
            doc = np.repeat(np.arange(len(n)), n)

            def summed(x: np.ndarray) -> np.ndarray:
                return np.bincount(doc, x, len(n))

            rare = np.flatnonzero(at < 0)
            ids, k = batch.column(0), len(rare)
            columns = [
                (n, pa.int64()),
                (summed(at >= 0).astype(np.int64) - (ends == 0), pa.int64()),
                (summed(base_of[at]), pa.float64()),
                (summed(words.scores(at, first)), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[row + np.arange(len(n)), row + doc[rare]]),
                    pa.concat_arrays([ids, pa.nulls(k, ids.type)]),
                    *[pa.array(np.r_[x, np.zeros(k, x.dtype)], t) for x, t in columns],
                    pa.array([None] * len(n) + [own[j] for j in rare.tolist()], pa.binary()),
                ],
                [f.name for f in fields],
            )
            row += len(n)

    source = docs.select("doc_id", text_of().cast("binary").alias("text"))
    looked = materialised(source.mapInArrow(look_up, T.StructType(fields)))
    rare = looked.where("word is not null").select("row", "word").join(model.counts, "word", "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 50_000):
            c = np.nan_to_num(batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64))
            words = batch.column(0).filter(pa.array(c == 0)).dictionary_encode()
            spelt = np.zeros(len(c))
            if len(words):
                number = words.indices.to_numpy(zero_copy_only=False)
                spelt[c == 0] = tree.value.word_scores(words.dictionary.to_pylist())[number]
            known = (c > 0).astype(np.int64)
            columns = [known, np.log10(c + 0.5) - log_all, log_words(tokens, distinct, c), spelt]
            yield pa.RecordBatch.from_arrays([batch.column(1), *map(pa.array, columns)], ["row", "k", "b", "s", "l"])

    done = rare.select("word", "row", "c").mapInArrow(
        finish, "row bigint, k bigint, b double, s double, l double"
    )
    sums = done.groupBy("row").agg(*[F.sum(c).alias(c) for c in "kbsl"])

    def with_rest(whole: str, *parts: str):
        return sum([F.coalesce(F.col(p), F.lit(0)) for p in parts], F.col(whole))

    return (
        looked.where("word is null")
        .join(sums, "row", "left")
        .select(
            "doc_id",
            "n_tokens",
            with_rest("n_known", "k").alias("n_known"),
            with_rest("base_score", "b").alias("base_score"),
            with_rest("score", "s").alias("score"),
            with_rest("score", "s", "l").alias("spelt_score"),
        )
    )


def fit_and_score(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """All documents scored by the model of those whose crc32(doc_id) mod 5 is not 1."""
    model = fit(docs.where(fold() != 1), settings)
    return score(docs, model).select(
        "doc_id",
        (fold() == 1).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
        "spelt_score",
    )
