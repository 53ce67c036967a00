"""Shards of near-equal bytes by histogram sort, in DataFrame operations only.

Rows are ordered by a hash of the text and, within equal texts, by doc_id. Splitters of
that order are found by counting: each round counts the exact bytes between candidate key
boundaries over all partitions, one small sum per boundary comes back, and the next round
puts its boundaries only into the ranges that still hold a splitter, between the smallest
and the largest key really found there. It ends when every splitter is known to
``tolerance`` of a shard. Rows then move once. A hot text is many rows with one hash; its
range is refined by doc_id, so it may be cut between shards like any other range.

Defined cases: a NULL text has no bytes and hashes as an empty one. A NULL doc_id comes
first within its text. Equal rows share a place in the order and so a shard. With fewer
rows than shards, some shards are empty. Extra columns are kept by ``shard``.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.llm.common import text_of
from wardflow.sources.shared import materialised

LEAST = -(1 << 63)
#: Boundaries per range: in the first round, and later.
FIRST, LATER = 4096, 64
#: Boundaries of all ranges together after the first round, unless there are more ranges.
SUMS = 1 << 19
#: Rows of a shard that are numbered together.
CELL_ROWS = 1_000_000

Key = tuple[int, int]


@dataclass(frozen=True)
class Range:
    low: Key
    high: Key
    below: int  # weight of all smaller keys
    after: Key | None  # the next larger key
    targets: tuple[int, ...]


def longs(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def at_or_below(a: Column, b: Column, keys: list[Key]) -> Column:
    """How many of the rising ``keys`` are (a, b) or less, by binary search."""
    if not keys:
        return F.lit(0)
    firsts, seconds = longs([k[0] for k in keys]), longs([k[1] for k in keys])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(keys).bit_length()))])

    def step(place: Column, by: Column) -> Column:
        x, y = F.get(firsts, place + by - 1), F.get(seconds, place + by - 1)
        up = (place + by <= len(keys)) & ((x < a) | ((x == a) & (y <= b)))
        return F.when(up, place + by).otherwise(place)

    return F.aggregate(steps, F.lit(0), step)


def _histogram(keys: DataFrame, ranges: list[Range], bins: int) -> dict[int, list]:
    """Per range its bins in order: weight, smallest and largest key.

    What tells ranges apart lies in arrays, so the expression is as deep for one range as for
    many thousands.
    """
    a, b = F.col("a"), F.col("b")
    by_a = [r.low[0] < r.high[0] for r in ranges]  # else all have one a, and b tells them apart
    lows = [r.low[0] if x else r.low[1] for r, x in zip(ranges, by_a)]
    spans = [(r.high[0] if x else r.high[1]) - low + 1 for r, x, low in zip(ranges, by_a, lows)]

    def of_range(values: list[int]) -> Column:
        return F.get(longs(values), F.col("_range"))

    high_a, high_b = of_range([r.high[0] for r in ranges]), of_range([r.high[1] for r in ranges])
    value = F.when(of_range([int(x) for x in by_a]) == 1, a).otherwise(b)
    low = of_range(lows)
    # never falls as the value rises; the difference of a wide range may not fit into a long
    wide = of_range([int(span >= 1 << 62) for span in spans]) == 1
    offset = F.when(wide, value.cast("double") - low.cast("double")).otherwise((value - low).cast("double"))
    number = F.floor(offset / of_range([max(1, -(-span // bins)) for span in spans]).cast("double"))
    within = (a < high_a) | ((a == high_a) & (b <= high_b))
    inside = at_or_below(a, b, [r.low for r in ranges]) - 1
    key = F.struct("a", "b")
    rows = (
        keys.withColumn("_range", inside)
        .where("_range >= 0")
        .where(within)
        .withColumn("_bin", number)
        .groupBy("_range", "_bin")
        .agg(F.sum("w").alias("w"), F.min(key).alias("low"), F.max(key).alias("high"))
        .collect()
    )
    found: dict[int, list] = {i: [] for i in range(len(ranges))}
    for row in sorted(rows, key=lambda x: (x["_range"], x["_bin"])):
        found[row["_range"]].append((int(row["w"]), tuple(row["low"]), tuple(row["high"])))
    return found


def splitters(keys: DataFrame, parts: int, tolerance: float = 0.0) -> tuple[list[Key | None], int]:
    """The ``parts - 1`` splitters of ``keys`` (a, b, w), w > 0, and the whole weight.

    Splitter j is the smallest key with at least j / parts of the weight below it; None if
    there is none. It is off by less than ``tolerance`` of a part. At most
    max(SUMS, 2 * parts) sums come to the driver in a round.
    """
    key = F.struct("a", "b")
    low, high, total = keys.agg(F.min(key), F.max(key), F.sum("w")).collect()[0]
    cuts: list[Key | None] = [None] * (parts - 1)
    if low is None:
        return cuts, 0
    total = int(total)
    ranges = [Range(tuple(low), tuple(high), 0, None, tuple(range(1, parts)))]
    bins = FIRST
    while ranges:
        found, open_ranges = _histogram(keys, ranges, bins), []
        for i, r in enumerate(ranges):
            below, marks = r.below, []
            for w, first, last in found[i]:
                marks.append((below, w, first, last))
                below += w
            held: dict[int, list[int]] = {}
            starts = [mark[0] * parts for mark in marks]
            for j in r.targets:
                # the last bin that starts below the target holds the splitter, or comes before it
                held.setdefault(bisect_left(starts, j * total) - 1, []).append(j)
            for m, targets in held.items():
                start, w, first, last = marks[m]
                after = marks[m + 1][2] if m + 1 < len(marks) else r.after
                if first == last or w * parts <= tolerance * total:
                    for j in targets:
                        cuts[j - 1] = after
                else:
                    inside = [j for j in targets if j * total < (start + w) * parts]
                    for j in set(targets) - set(inside):
                        cuts[j - 1] = after
                    if inside:
                        open_ranges.append(Range(first, last, start, after, tuple(inside)))
        ranges, bins = open_ranges, max(2, min(LATER, SUMS // max(1, len(open_ranges))))
    return cuts, total


def text_hash(text: Column) -> Column:
    """60 bits of the text's MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_of()
    return docs.select(
        "*",
        text_hash(text).alias("a"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST)).alias("b"),
        (F.octet_length(text).cast("bigint") + 16).alias("w"),
    )


def assign(keyed: DataFrame, shards: int, tolerance: float) -> DataFrame:
    """``keyed`` (with a, b, w) with ``shard`` and ``slot``, the place in the shard's order.

    Shards are numbered in cells of about CELL_ROWS rows; each cell is one task's work. One
    count per cell comes to the driver.
    """
    narrow = materialised(keyed.select("a", "b", "w"))
    cells = 1 + narrow.count() // (shards * CELL_ROWS)
    cuts, _ = splitters(narrow, shards * cells, tolerance)
    known = [c for c in cuts if c is not None]
    a, b = F.col("a"), F.col("b")
    held = narrow.select(at_or_below(a, b, known).alias("_cell")).groupBy("_cell").count().collect()
    sizes, before = {row["_cell"]: row["count"] for row in held}, []
    for cell in range(shards * cells):  # rows of the shard in earlier cells
        before.append(before[-1] + sizes.get(cell - 1, 0) if cell % cells else 0)
    row = F.row_number().over(W.partitionBy("_cell").orderBy("a", "b"))
    return (
        keyed.withColumn("_cell", at_or_below(a, b, known))
        .withColumn("_row", row)
        .withColumn("shard", F.expr(f"_cell div {cells}").cast("int"))
        .withColumn("slot", F.get(longs(before), F.col("_cell")) + F.col("_row") - 1)
        .drop("_cell", "_row")
    )


def shard(docs: DataFrame, shards: int = 40, tolerance: float = 0.0001) -> DataFrame:
    """The documents with ``shard`` and ``slot``; existing columns of these names give way."""
    kept = docs.drop("shard", "slot")
    names = {c: f"_own_{c}" for c in kept.columns if c in ("a", "b", "w")}
    keyed = _keyed(kept.select("*", *[F.col(c).alias(n) for c, n in names.items()]).drop(*names))
    back = [F.col(names.get(c, c)).alias(c) for c in kept.columns]
    return assign(keyed, shards, tolerance).select(*back, "shard", "slot")


def shard_digests(docs: DataFrame, shards: int = 40, tolerance: float = 0.0001) -> DataFrame:
    """The same assignment with what describes a row in place of its text: nothing wide moves."""
    crc = F.crc32(text_of().cast("binary")).alias("text_crc32")
    narrow = materialised(_keyed(docs.select("doc_id", "text")).select("doc_id", "a", "b", "w", crc))
    placed = assign(narrow, shards, tolerance)
    return placed.select(
        "doc_id",
        F.col("w").alias("size"),
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
