"""Deterministic sampling and splitting.

A row's place in the sample is the rank of ``md5(ID:seed)`` in its class. That does not
depend on partitioning or run, and any SQL engine can repeat it. Ranks are taken inside
4096 hash buckets per class and shifted by the bucket totals, so no class is sorted in
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HELD_OUT = 0.2
VALIDATION_SHARE = 0.5
EXTRA_NEGATIVES_30 = 500
EXTRA_NEGATIVES_OTHER = 1000
BUCKET_DIGITS = 3


def seeded_hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def class_ids(rows: DataFrame) -> DataFrame:
    """The distinct (ID, Label) pairs of the two classes."""
    return rows.select("ID", "Label").where(F.col("Label").isin(0, 1)).distinct()


def ranked_ids(rows: DataFrame, seed: int = 1) -> DataFrame:
    """``rank`` from 1 within Label, ``n_label`` and ``n_pos`` for each distinct id.

    Bucket totals and ranks both start from the shuffle of the distinct ids, so the rows
    are read once.
    """
    hashed = class_ids(rows).withColumn("_hash", seeded_hash(F.col("ID"), seed)).withColumn(
        "_bucket", F.substring("_hash", 1, BUCKET_DIGITS)
    )
    per_label = W.partitionBy("Label")
    earlier = per_label.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    # two labels times 4096 buckets: at most 8192 rows, safe to window and to broadcast
    buckets = (
        hashed.groupBy("Label", "_bucket")
        .agg(F.count("*").alias("_n"))
        .select(
            "Label",
            "_bucket",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_n").over(per_label).alias("n_label"),
            F.coalesce(
                F.sum(F.when(F.col("Label") == 1, F.col("_n"))).over(W.partitionBy()), F.lit(0)
            ).alias("n_pos"),
        )
    )
    inside = W.partitionBy("Label", "_bucket").orderBy("_hash", "ID")
    return (
        hashed.join(F.broadcast(buckets), ["Label", "_bucket"])
        .withColumn("rank", F.col("_before") + F.row_number().over(inside))
        .select("ID", "Label", "rank", "n_label", "n_pos")
    )


def used_in_balance() -> Column:
    """Ids of a class that enter the balanced sample: all positives, as many negatives."""
    return F.when(F.col("Label") == 1, F.col("n_label")).otherwise(F.least("n_label", "n_pos"))


def assign_splits(
    rows: DataFrame, n_days: int = 30, seed: int = 1, extra: int | None = None
) -> DataFrame:
    """ID, Label and ``split``: val, test, train, extra (more negatives) or unused.

    A fifth of each class is held out, half of it for validation; halves round to even.
    ``extra`` more negatives join, by default EXTRA_NEGATIVES_30 at the 30-day horizon and
    EXTRA_NEGATIVES_OTHER else, clamped to those left.
    """
    if extra is None:
        extra = EXTRA_NEGATIVES_30 if n_days == 30 else EXTRA_NEGATIVES_OTHER
    sized = (
        ranked_ids(rows, seed)
        .withColumn("_used", used_in_balance())
        .withColumn("_held", F.bround(F.col("_used") * F.lit(HELD_OUT)).cast("bigint"))
        .withColumn("_val", F.bround(F.col("_held") * F.lit(VALIDATION_SHARE)).cast("bigint"))
    )
    rank = F.col("rank")
    split = (
        F.when(rank <= F.col("_val"), "val")
        .when(rank <= F.col("_held"), "test")
        .when(rank <= F.col("_used"), "train")
        .when((F.col("Label") == 0) & (rank <= F.col("_used") + extra), "extra")
        .otherwise("unused")
    )
    return sized.select("ID", "Label", "rank", split.alias("split"))


def down_sample(rows: DataFrame, n: int | Column, seed: int = 1) -> DataFrame:
    """Exactly ``n`` ids of each class, or all where fewer exist."""
    return ranked_ids(rows, seed).where(F.col("rank") <= n).select("ID", "Label", "rank")


def balanced_negatives(rows: DataFrame, seed: int = 1) -> DataFrame:
    """As many negatives as there are positives."""
    negatives = ranked_ids(rows, seed).where(F.col("Label") == 0)
    return negatives.where(F.col("rank") <= F.col("n_pos")).select("ID", "rank")


def rows_of_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    return rows.join(ids.select("ID"), "ID", "left_semi")


def rows_without_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    return rows.join(ids.select("ID"), "ID", "left_anti")


def once_only(first: DataFrame, second: DataFrame) -> DataFrame:
    """Values that occur exactly once over both one-column frames."""
    column = first.columns[0]
    both = first.unionByName(second)
    return both.groupBy(column).agg(F.count("*").alias("_n")).where(F.col("_n") == 1).drop("_n")


def overlap(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.intersect(second)


def class_balance(
    chunks: DataFrame, n_days: int = 30, seed: int = 1, extra: int | None = None, by: str = "ID"
) -> DataFrame:
    """Chunk rows of the used ids with ``split`` = train, val or test; no SUBJECT_ID.

    Splits are disjoint by id. With ``by="SUBJECT_ID"`` they are disjoint by subject: all
    used rows of a subject follow the first split, val before test before train, that one
    of its ids was given.
    """
    used = assign_splits(chunks, n_days, seed, extra).where(F.col("split") != "unused")
    place = F.when(F.col("split") == "val", 0).when(F.col("split") == "test", 1).otherwise(2)
    parts = used.select("ID", place.alias("_place")).distinct()
    rows = chunks.join(parts, "ID")
    if by != "ID":
        least = rows.groupBy(by).agg(F.min("_place").alias("_least"))
        rows = rows.join(least, by).withColumn("_place", F.col("_least")).drop("_least")
    names = F.array(F.lit("val"), F.lit("test"), F.lit("train"))
    return rows.withColumn("split", F.get(names, "_place")).drop("SUBJECT_ID", "_place")


def shuffled(rows: DataFrame, key: Column, seed: int = 1) -> DataFrame:
    """All rows in a seeded random order, the same on every run."""
    return rows.orderBy(seeded_hash(key, seed), key)


def hash_share(key: Column) -> Column:
    """A number in [0, 1) from the key, the same in every engine."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") / (2**32)


def hash_split(rows: DataFrame, key: Column, train_share: float = 0.8) -> DataFrame:
    part = F.when(hash_share(key) < train_share, "train").otherwise("test")
    return rows.withColumn("split", part)


def random_split(rows: DataFrame, train_share: float = 0.8, seed: int = 1234567):
    """Two Bernoulli samples. They depend on the partitioning; ``hash_split`` does not."""
    return rows.randomSplit([train_share, 1 - train_share], seed=seed)


def split_audit(splits: DataFrame) -> DataFrame:
    """Per split and Label: rows, ids, and ids that also occur in another split.

    One row per id, label and split is counted before the shuffle by id.
    """
    per_id = splits.groupBy("ID", "Label", "split").agg(F.count("*").alias("n"))
    same = W.partitionBy("ID")
    several = F.min("split").over(same) != F.max("split").over(same)
    return (
        per_id.withColumn("_several", several)
        .groupBy("split", "Label")
        .agg(
            F.sum("n").alias("rows"),
            F.count("ID").alias("ids"),
            F.count_if("_several").alias("overlapping_ids"),
        )
    )
