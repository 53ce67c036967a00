"""Mixing sources to target weights by Poisson replication.

A source with n documents and target share w of ``total`` expected rows has the mean
repetition rate w * total / n. Each document draws a uniform number from a hash of its id
and the seed, the inverse Poisson distribution turns it into a number of copies, and the
document is exploded by it. A rate above MOST_RATE is drawn as a sum of equal smaller ones,
each with a number of its own. Rates need one count per source, nothing else is gathered;
each draw depends on its row alone, so that a lost task draws the same again. The copies
are then dealt to partitions and ordered inside them by a hash of id, copy and seed.

Defined cases: a NULL source is a source of its own. Documents with one id draw the same
number. A source with target 0 or outside the given weights loses its documents. NULL and
empty texts are documents like all others; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.sources.shared import materialised

#: Hex digits of a hash that make a uniform number; 13 digits are 52 bits, exact in a double.
DIGITS = 13
#: So many sources, one short row each, may go to all tasks; with more the rows are joined.
MAX_SOURCES = 100_000
#: The largest rate of one draw; exp(-rate) is a normal double up to 708.
MOST_RATE = 700.0
ADDED = ["copy", "n_copies", "rate", "shuffle_key"]


def _hash(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def uniform(seed: int, *parts: Column) -> Column:
    digits = F.substring(_hash(F.lit(seed), *parts), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(16**DIGITS))


def poisson_count(u: Column, rate: Column) -> Column:
    """The smallest k whose cumulative Poisson probability exceeds u, for rates up to MOST_RATE.

    Steps of the sum over k run to mean + 12 deviations + 30; beyond lies less than 2^-52.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct(
        F.lit(0).alias("k"), F.exp(-rate).alias("p"), F.exp(-rate).alias("sum")
    )

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        more = state["sum"] <= u
        return F.struct(
            F.when(more, k).otherwise(state["k"]).alias("k"),
            F.when(more, p).otherwise(state["p"]).alias("p"),
            F.when(more, state["sum"] + p).otherwise(state["sum"]).alias("sum"),
        )

    drawn = F.aggregate(F.sequence(F.lit(1), last), start, step, lambda state: state["k"])
    return F.when(rate > 0, drawn).otherwise(0)


def copies_drawn(seed: int, doc_id: Column, rate: Column) -> Column:
    """A Poisson number for each document; the sum of Poisson numbers is one of their summed rates."""
    n = F.ceil(rate / MOST_RATE).cast("int")

    def add(total: Column, part: Column) -> Column:
        return total + poisson_count(uniform(seed, doc_id, part, F.lit("part")), rate / n)

    split = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)
    return F.when(rate > MOST_RATE, split).otherwise(poisson_count(uniform(seed, doc_id), rate))


def source_rates(
    docs: DataFrame, weights: dict[str, float] | None, power: float, total: float | None
) -> DataFrame:
    """source, n and rate. Without weights a source weighs its size to ``power``."""
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighed = sizes.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        pairs = docs.sparkSession.createDataFrame([(s, float(w)) for s, w in weights.items()], "_s string, w double")
        weighed = sizes.join(pairs, F.col("source").cast("string").eqNullSafe(F.col("_s")), "left")
        weighed = weighed.select("source", "n", F.coalesce("w", F.lit(0.0)).alias("w"))
    # decimals add up the same in any order, doubles do not
    exact = F.sum(F.col("w").cast("decimal(28,12)")).cast("double")
    all_w, all_n = weighed.agg(exact).scalar(), weighed.agg(F.sum("n")).scalar()
    rows = F.lit(total) if total is not None else all_n.cast("double")
    rate = F.when(all_w > 0, F.col("w") / all_w * rows / F.col("n")).otherwise(0.0)
    return weighed.select(F.col("source").alias("_source"), rate.alias("rate"))


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    power: float = 0.5,
    total: float | None = None,
    seed: int = 20,
) -> DataFrame:
    """The documents with ``copy`` (from 0), ``n_copies``, ``rate`` and ``shuffle_key``.

    ``weights`` are target shares by source; without them shares follow the sizes of the
    sources to ``power`` (1: as they are, 0: all equal). ``total`` is the expected number
    of rows, by default that of the documents. A partition of the result is ordered by
    shuffle_key and holds a random part of all copies.
    """
    keep = [c for c in docs.columns if c not in ADDED]
    rates = materialised(source_rates(docs, weights, power, total))
    if rates.count() <= MAX_SOURCES:
        rates = F.broadcast(rates)
    drawn = (
        docs.select(*keep)
        .join(rates, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("n_copies", copies_drawn(seed, F.col("doc_id"), F.col("rate")))
        .where("n_copies > 0")
    )
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)))
    keyed = copies.withColumn("shuffle_key", _hash(F.lit(seed), F.col("doc_id"), F.col("copy"), F.lit("place")))
    return (
        keyed.select(*keep, *ADDED)
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key", "doc_id")
    )
