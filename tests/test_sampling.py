import hashlib

import pytest
from pyspark.sql import functions as F

from wardflow.operators import sampling


def frame(spark, positives, negatives):
    return spark.range(positives + negatives).select(
        F.col("id").alias("ID"), (F.col("id") < positives).cast("int").alias("Label")
    )


def counts(splits):
    rows = splits.groupBy("split", "Label").count().collect()
    return {(r["split"], r["Label"]): r["count"] for r in rows}


def test_published_sizes(spark):
    got = counts(sampling.assign_splits(frame(spark, 1232, 9432), 30))
    assert got == {
        ("train", 1): 986,
        ("val", 1): 123,
        ("test", 1): 123,
        ("train", 0): 986,
        ("val", 0): 123,
        ("test", 0): 123,
        ("extra", 0): 500,
        ("unused", 0): 9432 - 1232 - 500,
    }
    assert counts(sampling.assign_splits(frame(spark, 10, 5000), 180))[("extra", 0)] == 1000


def test_clamps(spark):
    few = counts(sampling.assign_splits(frame(spark, 50, 20), 30))
    assert few[("train", 1)] == 40 and few[("train", 0)] == 16
    assert ("extra", 0) not in few and ("unused", 0) not in few
    short = counts(sampling.assign_splits(frame(spark, 50, 60), 30))
    assert short[("extra", 0)] == 10


@pytest.mark.parametrize("held", [1, 3, 5, 7])
def test_halves_round_to_even(spark, held):
    got = counts(sampling.assign_splits(frame(spark, held * 5, held * 5), 30))
    assert got.get(("val", 1), 0) == round(held * 0.5)
    assert got.get(("val", 1), 0) + got.get(("test", 1), 0) == held


def test_order_is_the_hash_order(spark):
    ids = frame(spark, 0, 40).select("ID", F.lit(0).alias("Label"))
    got = [r.ID for r in sampling.ranked_ids(ids, seed=9).orderBy("rank").collect()]
    assert got == sorted(range(40), key=lambda i: hashlib.md5(f"{i}:9".encode()).hexdigest())


def test_splits_do_not_share_ids_and_keep_all_chunks(spark):
    chunks = frame(spark, 30, 90).crossJoin(spark.range(3).withColumnRenamed("id", "chunk_no"))
    chunks = chunks.withColumn("SUBJECT_ID", F.col("ID") % 7)
    splits = sampling.class_balance(chunks, 30)
    assert "SUBJECT_ID" not in splits.columns
    audit = sampling.split_audit(splits).collect()
    assert sum(r.overlapping_ids for r in audit) == 0
    assert all(r["rows"] == 3 * r.ids for r in audit)
    assert sum(r.ids for r in audit) == 120


def test_repeated_ids_count_once(spark):
    doubled = frame(spark, 20, 40).union(frame(spark, 20, 40))
    once = sampling.assign_splits(frame(spark, 20, 40)).orderBy("ID").collect()
    assert sampling.assign_splits(doubled).orderBy("ID").collect() == once


def test_set_operations(spark):
    a, b = spark.range(0, 10).toDF("ID"), spark.range(5, 12).toDF("ID")
    assert sorted(r.ID for r in sampling.once_only(a, b).collect()) == [0, 1, 2, 3, 4, 10, 11]
    assert sorted(r.ID for r in sampling.overlap(a, b).collect()) == [5, 6, 7, 8, 9]
    assert sampling.rows_of_ids(a, b).count() == 5
    assert sampling.rows_without_ids(a, b).count() == 5


def test_hash_split_and_shuffle_repeat(spark):
    rows = spark.range(2000).toDF("ID")
    first = sampling.hash_split(rows, F.col("ID"))
    share = first.where("split = 'train'").count() / 2000
    assert 0.75 < share < 0.85
    again = sampling.hash_split(rows.repartition(5), F.col("ID"))
    assert first.exceptAll(again).count() == 0
    order = [r.ID for r in sampling.shuffled(rows, F.col("ID"), 3).collect()]
    assert order == [r.ID for r in sampling.shuffled(rows.repartition(3), F.col("ID"), 3).collect()]
    assert order != sorted(order) and sorted(order) == list(range(2000))


def test_splits_by_subject(spark):
    rows = spark.range(400).select(
        F.col("id").alias("ID"),
        (F.col("id") % 40).alias("SUBJECT_ID"),
        (F.col("id") % 2).cast("int").alias("Label"),
    )
    by_id = sampling.class_balance(rows, extra=0)
    assert by_id.groupBy("ID").agg(F.countDistinct("split").alias("n")).where("n > 1").isEmpty()
    by_subject = sampling.class_balance(rows, extra=0, by="SUBJECT_ID").select("ID", "split")
    subjects = by_subject.join(rows, "ID").groupBy("SUBJECT_ID").agg(F.countDistinct("split").alias("n"))
    assert by_subject.count() == 400 and subjects.where("n > 1").isEmpty()


def test_extra_negatives_are_an_argument(spark):
    got = counts(sampling.assign_splits(frame(spark, 10, 500), 30, extra=7))
    assert got[("extra", 0)] == 7


def test_audit_sees_ids_in_two_splits(spark):
    rows = [(1, 0, "train"), (1, 0, "test"), (2, 0, "train"), (2, 0, "train"), (3, 1, "val")]
    df = spark.createDataFrame(rows, "ID int, Label int, split string")
    got = {(r["split"], r["Label"]): (r["rows"], r["ids"], r["overlapping_ids"]) for r in sampling.split_audit(df).collect()}
    assert got == {("train", 0): (3, 2, 1), ("test", 0): (1, 1, 1), ("val", 1): (1, 1, 0)}
