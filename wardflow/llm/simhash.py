"""SimHash fingerprints and search by permuted block tables, in DataFrame operations only.

Terms are pairs of neighbouring words in lower case (a single word is its own term), and
weigh as often as they occur. Every occurrence of a term votes with the signed bits of its
64-bit hash; a bit of the fingerprint is set if more than half of the votes say so.
Likeness of two fingerprints is the share of equal bits.

Votes are counted 32 at a time: bit i and bit i + 32 share one sum, in its low and its high
half, so that a document may have up to 2^31 terms.

Fingerprints within a Hamming radius r: 64 bits are cut into ``blocks`` > r blocks, and for
every choice of blocks - r of them there is one table keyed by these blocks. Two
fingerprints within the radius agree on all blocks of at least one choice. Candidates of
equal keys are compared by their bits; only distinct fingerprints meet.

Defined cases: NULL text is an empty one; a text without words has the fingerprint 0. Rows
are in order of doc_id, NULL first, rows with one id by a hash of the text. Extra columns
are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.llm.common import text_of
from wardflow.llm.sharding import LEAST, at_or_below, longs, splitters
from wardflow.sources.shared import materialised

BITS = 64
BLANKS = " \t\n\x0b\x0c\r"
#: Bytes of text per slice of neighbouring documents. Beyond 1 TB slices grow, to 0.8 GB at
#: 100 TB, so that their ends stay literals of a few MB; a slice is sorted and read once, on disk if need be.
SLICE_BYTES, MAX_SLICES = 8 << 20, 1 << 17


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``fp`` for rows with ``keys`` and ``text``; keys tell rows apart."""
    trimmed = F.btrim(F.lower("text"), F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{BLANKS}]+"))
    follower = F.when(F.size("w") > 1, F.slice("w", 2, F.size("w") - 1)).otherwise(F.transform("w", lambda _: F.lit("")))
    terms = (
        texts.select(*keys, words.alias("w"))
        .select(*keys, "w", follower.alias("v"))
        .select(*keys, F.explode_outer(F.arrays_zip("w", "v")).alias("t"))
    )
    # the last of several words has no follower and is no term
    hashed = terms.select(*keys, F.when(F.col("t.v").isNotNull(), F.xxhash64("t.w", "t.v")).alias("h"))
    lanes = F.lit((1 << 32) | 1)
    half = BITS // 2
    votes = hashed.groupBy(*keys).agg(
        F.count("h").alias("n"),
        *[F.sum(F.shiftrightunsigned("h", i).bitwiseAND(lanes)).alias(f"v{i}") for i in range(half)],
    )
    bits = F.lit(0).cast("bigint")
    for i in range(half):
        low, high = F.col(f"v{i}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"v{i}", half)
        for bit, votes_for in ((i, low), (i + half, high)):
            mask = (1 << bit) - (1 << BITS if bit == BITS - 1 else 0)
            bits = bits.bitwiseOR(F.when(2 * votes_for > F.col("n"), F.lit(mask).cast("bigint")).otherwise(F.lit(0)))
    return votes.select(*keys, bits.alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_text(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), BITS // 4, "0")


def within_radius(queries: DataFrame, fps: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """query_fp, fp and distance of all distinct pairs within ``radius``.

    Both inputs have a column fp; equal fingerprints are a pair at distance 0.
    """
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    tables = list(combinations(range(blocks), blocks - radius))

    def keyed(df: DataFrame, name: str) -> DataFrame:
        def key(choice: tuple[int, ...]) -> Column:
            mask = sum((1 << edges[i + 1]) - (1 << edges[i]) for i in choice)
            signed = mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask
            return F.col(name).bitwiseAND(F.lit(signed).cast("bigint"))

        distinct = df.select(F.col("fp").alias(name)).distinct()
        return distinct.select(name, F.posexplode(F.array(*[key(c) for c in tables])).alias("_table", "_key"))

    met = keyed(queries, "query_fp").join(keyed(fps, "fp"), ["_table", "_key"])
    distance = F.bit_count(F.col("query_fp").bitwiseXOR(F.col("fp"))).cast("int")
    near = met.select("query_fp", "fp", distance.alias("distance")).where(F.col("distance") <= radius)
    return near.distinct()


def _with_next(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """Documents in slices of neighbouring ids with the text of the next one.

    Each text moves once. The first document of a slice also goes to the end of the slice
    before, as a ghost (of the first slice: to the last), so that no slice needs another.
    """
    a = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST))
    keyed = docs.select("doc_id", text_of().alias("text")).withColumn("a", a).withColumn("b", F.xxhash64("text"))
    narrow = materialised(keyed.select("a", "b", (F.octet_length("text").cast("bigint") + 64).alias("w")))
    first, total = narrow.agg(F.min(F.struct("a", "b")), F.sum("w")).collect()[0]
    slices = min(MAX_SLICES, 1 + (total or 0) // SLICE_BYTES)
    cuts, _ = splitters(narrow, slices, tolerance=0.1)
    cuts = sorted({c for c in cuts if c is not None})
    slice_ = at_or_below(F.col("a"), F.col("b"), cuts).cast("int")
    heads = [tuple(first) if first else (0, 0), *cuts]
    firsts, seconds = longs([h[0] for h in heads]), longs([h[1] for h in heads])
    is_head = (F.get(firsts, F.col("_slice")) == F.col("a")) & (F.get(seconds, F.col("_slice")) == F.col("b"))
    before = F.when(F.col("_slice") == 0, len(heads) - 1).otherwise(F.col("_slice") - 1)
    own = F.struct(F.col("_slice").alias("s"), F.lit(False).alias("g"))
    ghost = F.struct(before.alias("s"), F.lit(True).alias("g"))
    placed = (
        keyed.withColumn("_slice", slice_)
        .withColumn("_to", F.explode(F.when(is_head, F.array(own, ghost)).otherwise(F.array(own))))
        .select("doc_id", "text", "a", "b", F.col("_to.s").alias("_slice"), F.col("_to.g").alias("_ghost"))
    )
    # doc_id in the order: both uses of the result then ask for the same columns of one exchange
    order = W.partitionBy("_slice").orderBy("_ghost", "a", "b", "doc_id")
    return (
        placed.withColumn("_next", F.lead("text").over(order)).withColumn("_row", F.row_number().over(order)),
        ["_slice", "_row"],
    )


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its text with the last quarter replaced by the
    start of the next document, and how like they are to each other and to the next one's."""
    ordered, place = _with_next(docs)
    n = F.length("text")
    quarter = F.expr("length(text) div 4")
    following = F.coalesce(F.col("_next"), F.lit(""))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(following, F.lit(1), quarter))
    both = ordered.select(*place, "_ghost", "text", edited.alias("_edited"))
    kinds = F.when(F.col("_ghost"), F.array("text")).otherwise(F.array("text", "_edited"))
    texts = both.select(*place, F.posexplode(kinds).alias("_kind", "text"))
    # grouped by slice and row: the rows already are where their slice is, nothing moves
    fps = fingerprints(texts, [*place, "_kind"])
    paired = fps.groupBy(*place).agg(
        F.max(F.when(F.col("_kind") == 0, F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("_kind") == 1, F.col("fp"))).alias("edited_fp"),
    )
    step = W.partitionBy("_slice").orderBy("_row")
    stepped = paired.withColumn("next_fp", F.lead("fp").over(step))
    about = ordered.where("not _ghost").select(
        *place, "doc_id", n.cast("bigint").alias("n_chars"), F.sha2(edited.cast("binary"), 256).alias("edited_sha256")
    )
    return about.join(stepped, place).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fp",
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
