"""Phrases of two and three words that stick together, from depth-truncated suffix subtrees.

Every word starts a suffix of up to three words of its piece. Vertical partitioning: words
are counted first; suffixes are grouped by their first word, so many prefixes to a group
that no group has over ``budget`` suffixes. A prefix that alone has over 1 / SHARE of that
is extended by its next word (then a pair has at most as many as the rarer of its words),
and a pair of two such words by the third. Each group builds its subtree alone: sorted leaves, nodes of pairs
above them, and counts as totals of leaves. Equal leaves of a task are added up before they
move, in blocks that name each word once.

A phrase as frequent as ``least`` has only words that are, so suffixes end before rarer
words. Which words those are is known from one bit per hash in a table of FILTER_BITS bits:
two words that share a bit only let a suffix grow that no result needs.

Words travel as 64-bit hashes of language and word. If two words of the corpus share one,
hashes are drawn anew with another seed, so counts are exact.

Counts go into decimals of 38 digits, exact for phrases of up to 10^15 occurrences.

Defined cases: a NULL text has no words, a NULL lang is ``und``. Documents of any length are
cut at pieces only. Repeated rows count as often as they occur. Equal scores are ordered
by occurrences, then by the UTF-8 bytes of the phrase. Without candidates there are no rows.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.llm.common import text_of
from wardflow.sources.shared import materialised

ENDS, BREAK = r"[.,;:!?\n\x0b\x0c\r]+", "\n"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST, TOP = 10, 2000
#: Suffixes of a group, the part of it that one prefix may take, and the most prefixes that are extended.
BUDGET, SHARE, MAX_EXTENDED = 1 << 20, 16, 1 << 18
FILTER_BITS = 1 << 26
#: Words that a task adds up at once.
BLOCK_WORDS = 1 << 20
#: Parts of a language that are ranked by themselves first.
SALTS = 64

LEAVES = "_group int, leaves binary"
NODES = "h1 long, h2 long, h3 long, a long"


def tokens(docs: DataFrame) -> DataFrame:
    """``lang`` and ``w``, the words of each text with BREAK between pieces."""
    lowered = F.translate(text_of(), CAPITALS, SMALL)
    parted = F.regexp_replace(lowered, ENDS, f" {BREAK} ")
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.split(parted, "[ \t]+").alias("w"))


def word_hash(seed: int, lang: Column, word: Column) -> Column:
    return F.xxhash64(F.lit(seed), lang, word)


def count_words(parted: DataFrame) -> tuple[DataFrame, int]:
    """lang, word, ``h`` and ``f``, and the seed with which every word has its own ``h``."""
    words = parted.select("lang", F.explode("w").alias("word")).where(~F.col("word").isin("", BREAK))
    counted = materialised(words.groupBy("lang", "word").agg(F.count("*").alias("f")))
    for seed in range(100):
        hashed = counted.withColumn("h", word_hash(seed, F.col("lang"), F.col("word")))
        # 0 stands for no word
        if hashed.groupBy("h").agg(F.count("*").alias("n")).where("n > 1 or h = 0").isEmpty():
            return hashed, seed
    raise ValueError("no seed gives every word its own hash")


def frequent_bits(frequent: DataFrame) -> np.ndarray:
    """FILTER_BITS bits as bytes, those of the hashes set; so many bytes at most reach the driver."""
    at = F.pmod("h", F.lit(FILTER_BITS)) + 1  # blocks and their bits are counted from 1
    blocks = frequent.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in blocks.collect():
        part = np.frombuffer(bytes(row["bits"]), np.uint8)
        start = (row["b"] - 1) * len(part)
        out[start : start + len(part)] = part
    return out


class Subtree:
    """Suffixes of three words (0: none) with counts: distinct leaves in order, and their pairs."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray, h3: np.ndarray, n: np.ndarray) -> None:
        known, place = np.unique(np.concatenate([h1, h2, h3]), return_inverse=True)
        i1, i2, i3 = np.split(place.astype(np.uint64), 3)
        pairs, at = np.unique(i1 << np.uint64(32) | i2, return_inverse=True)
        key = at.astype(np.uint64) << np.uint64(32) | i3
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        self.words = known
        self.leaf_total = np.add.reduceat(n[order], starts) if len(starts) else np.empty(0, np.int64)
        self.leaf_pair = (key[starts] >> np.uint64(32)).astype(np.int64)
        self.leaf_word = (key[starts] & np.uint64((1 << 32) - 1)).astype(np.int64)
        self.pair_first = (pairs >> np.uint64(32)).astype(np.int64)
        self.pair_second = (pairs & np.uint64((1 << 32) - 1)).astype(np.int64)
        nodes = np.flatnonzero(np.r_[True, self.leaf_pair[1:] != self.leaf_pair[:-1]][: len(self.leaf_pair)])
        self.pair_total = np.add.reduceat(self.leaf_total, nodes) if len(nodes) else np.empty(0, np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.words[self.pair_first], self.words[self.pair_second], self.pair_total

    def leaves(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        first, second, _ = self.pairs()
        return first[self.leaf_pair], second[self.leaf_pair], self.words[self.leaf_word], self.leaf_total


def pack(h1: np.ndarray, h2: np.ndarray, h3: np.ndarray, n: np.ndarray) -> bytes:
    """Leaves as bytes: each word once, places in 2 or 4 bytes, counts in as few as they need."""
    words, place = np.unique(np.concatenate([h1, h2, h3]), return_inverse=True)
    wide = np.uint16 if len(words) <= 1 << 16 else np.uint32
    count = next(t for t in (np.uint8, np.uint16, np.uint32, np.int64) if int(n.max()) <= np.iinfo(t).max)
    head = np.array([len(n), len(words), np.dtype(wide).itemsize, np.dtype(count).itemsize], np.int64)
    return b"".join(x.tobytes() for x in (head, words, place.astype(wide), n.astype(count)))


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n, n_words, wide, count = np.frombuffer(data, np.int64, 4)
    words = np.frombuffer(data, np.int64, n_words, 32)
    at = 32 + 8 * n_words
    places = np.frombuffer(data, f"u{wide}", 3 * n, at)
    counts = np.frombuffer(data, f"u{count}", n, at + 3 * n * wide).astype(np.int64)
    return (*np.split(words[places], 3), counts)


def _dealt(h: np.ndarray, groups: int) -> np.ndarray:
    """A group per prefix, by bits of its hash that the filter and the join do not use."""
    return ((h.view(np.uint64) >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)


def _groups_of(h1, h2, h3, extended: np.ndarray, light: int, more: int) -> np.ndarray:
    """The group of each suffix: ``light`` groups of first words, then ``more`` of extended prefixes."""
    group = _dealt(h1, light)
    if len(extended):

        def is_in(h: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(extended, h), len(extended) - 1)
            return extended[at] == h

        long_ = is_in(h1)
        prefix = h1[long_] * np.int64(-7046029254386353131) + h2[long_]
        both = is_in(h2[long_])
        prefix[both] = prefix[both] * np.int64(-7046029254386353131) + h3[long_][both]
        prefix ^= prefix << np.int64(29)
        group[long_] = light + _dealt(prefix * np.int64(-4658895280553007687), more)
    return group


def _suffixes(flat: np.ndarray, is_end: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, ...]:
    """All suffixes of two and three frequent words in a row; ``is_end`` marks the last word of a text."""
    at = flat & (FILTER_BITS - 1)
    frequent = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    pair = np.zeros(len(flat), bool)
    pair[:-1] = frequent[:-1] & frequent[1:] & ~is_end[:-1]
    starts = np.flatnonzero(pair)
    third = np.zeros(len(starts), np.int64)
    longer = pair[np.minimum(starts + 1, len(flat) - 1)]
    third[longer] = flat[starts[longer] + 2]
    return flat[starts], flat[starts + 1], third, np.ones(len(starts), np.int64)


def leaf_blocks(parted: DataFrame, seed: int, bits, extended, light: int, more: int) -> DataFrame:
    """The leaves of each task by group, in blocks of bytes. ``bits`` and ``extended`` are broadcasts."""
    hashes = F.transform("w", lambda x: F.when(~x.isin("", BREAK), word_hash(seed, F.col("lang"), x)).otherwise(0))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(flats: list[np.ndarray], ends: list[np.ndarray]) -> pa.RecordBatch:
            tree = Subtree(*_suffixes(np.concatenate(flats), np.concatenate(ends), bits.value))
            leaves = tree.leaves()
            group = _groups_of(*leaves[:3], extended.value, light, more)
            order = np.argsort(group, kind="stable")
            leaves, group = [x[order] for x in leaves], group[order]
            cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][: len(group)])
            data = [pack(*[x[a:b] for x in leaves]) for a, b in zip(cuts, [*cuts[1:], len(group)])]
            return pa.RecordBatch.from_arrays([pa.array(group[cuts], pa.int32()), pa.array(data, pa.binary())], ["_group", "leaves"])

        flats, ends, held = [], [], 0
        for batch in batches:
            lists = batch.column(0)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            end = np.zeros(len(flat), bool)
            last = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)) - 1
            end[last[last >= 0]] = True
            flats, ends, held = [*flats, flat], [*ends, end], held + len(flat)
            if held >= BLOCK_WORDS:
                yield of(flats, ends)
                flats, ends, held = [], [], 0
        if held:
            yield of(flats, ends)
        pa.default_memory_pool().release_unused()

    return parted.select(hashes.alias("w")).mapInArrow(blocks, LEAVES)


def nodes(leaf_table: DataFrame, least: int, extended) -> DataFrame:
    """Pairs (h3 = 0) and triples of the subtrees with their totals. Pairs of two extended
    words lie in several groups; theirs come in parts, all others from ``least`` on."""

    def grown(group: pa.Table) -> pa.Table:
        tree = Subtree(*map(np.concatenate, zip(*[unpack(x.as_py()) for x in group["leaves"]])))
        first, second, total = tree.pairs()
        parts = np.isin(first, extended.value) & np.isin(second, extended.value)
        kept = parts | (total >= least)
        h1, h2, h3, leaf = tree.leaves()
        full = (h3 != 0) & (leaf >= least)
        return pa.table(
            {
                "h1": np.concatenate([first[kept], h1[full]]),
                "h2": np.concatenate([second[kept], h2[full]]),
                "h3": np.concatenate([np.zeros(kept.sum(), np.int64), h3[full]]),
                "a": np.concatenate([total[kept], leaf[full]]),
            }
        )

    found = leaf_table.groupBy("_group").applyInArrow(grown, NODES)
    return found.groupBy("h1", "h2", "h3").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def phrase_counts(parted: DataFrame, words: DataFrame, seed: int, least: int, budget: int) -> DataFrame:
    """h1, h2, h3 (0: none) and ``a`` of all phrases of two and three words with a >= least."""
    spark = parted.sparkSession
    frequent = words.where(F.col("f") >= least).select("h", "f")
    total = frequent.agg(F.sum("f")).collect()[0][0] or 0
    budget = max(budget, SHARE * total // MAX_EXTENDED)
    # at most SHARE * total / budget words, so MAX_EXTENDED
    is_long = F.col("f") * SHARE > budget
    long_ = frequent.where(is_long).collect()
    extended = np.sort(np.array([row["h"] for row in long_], np.int64))
    rest, light = frequent.where(~is_long), 1
    while True:
        group = F.shiftrightunsigned("h", 32) % light
        largest = rest.groupBy(group.alias("_group")).agg(F.sum("f").alias("s")).agg(F.max("s")).collect()[0][0] or 0
        if largest <= budget:
            break
        light *= max(2, largest // budget)
    more = 1 + 2 * sum(row["f"] for row in long_) // budget
    sent = [spark.sparkContext.broadcast(x) for x in (frequent_bits(frequent), extended)]
    blocks = leaf_blocks(parted, seed, *sent, light, more)
    return nodes(blocks, least, sent[1])



def collocations(
    docs: DataFrame, least: int = LEAST, percent: int = 50, top: int = TOP, budget: int = BUDGET
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first ``top`` phrases of each language."""
    parted = tokens(docs)
    words, seed = count_words(parted)
    counts = materialised(phrase_counts(parted, words, seed, least, budget))
    known = materialised(words.where(F.col("f") >= least).select("h", "lang", "word", "f"))
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))

    def word(i: int) -> DataFrame:
        return known.select(F.col("h").alias(f"h{i}"), F.col("word").alias(f"w{i}"), F.col("f").alias(f"f{i}"))

    two = counts.where("h3 = 0").select("h1", "h2", "a")
    three = counts.where("h3 <> 0")
    inside = three.select("h1", "h2", "a").unionByName(three.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
    longest = inside.groupBy("h1", "h2").agg(F.max("a").alias("_longer"))
    covered = 100 * F.col("_longer") >= percent * F.col("a")
    left = two.join(longest, ["h1", "h2"], "left").where(~F.coalesce(covered, F.lit(False))).drop("_longer")
    langs = known.select(F.col("h").alias("h1"), "lang")

    def score(l: str, r: str) -> Column:
        return F.expr(
            f"(1000000 * cast(a as decimal(16,0)) * cast(a as decimal(16,0)))"
            f" div (cast({l} as decimal(19,0)) * cast({r} as decimal(19,0)))"
        )

    pairs = (
        left.join(word(1), "h1")
        .join(word(2), "h2")
        .select("h1", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), score("f1", "f2").alias("score"))
    )
    heads = two.select("h1", "h2", F.col("a").alias("f12"))
    tails = two.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"))
    cut = (
        three.join(heads, ["h1", "h2"])
        .join(tails, ["h2", "h3"])
        .join(word(1), "h1")
        .join(word(2), "h2")
        .join(word(3), "h3")
        .withColumns({"_one": score("f1", "f23"), "_two": score("f12", "f3")})
    )
    second = F.col("_two") < F.col("_one")
    triples = cut.select(
        "h1",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        F.when(second, F.col("f12")).otherwise(F.col("f1")).alias("l"),
        F.when(second, F.col("f3")).otherwise(F.col("f23")).alias("r"),
        F.least("_one", "_two").alias("score"),
    )
    found = pairs.unionByName(triples).join(langs, "h1")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = F.row_number().over(W.partitionBy("lang", "_salt").orderBy(*order))
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    short = salted.withColumn("_first", first).where(F.col("_first") <= top)
    ranked = short.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).join(sizes, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
