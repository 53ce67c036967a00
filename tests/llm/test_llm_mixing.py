import math
from collections import Counter

import pytest
from edge_cases import clashing, documents, rows_of
from pyspark.sql import functions as F

from wardflow.llm import mixing


def test_edge_cases_and_repeatability(spark):
    docs = clashing(documents(spark))
    first = rows_of(mixing.mix(docs, total=40).drop("shuffle_key"))
    assert first == rows_of(mixing.mix(docs.repartition(5), total=40).drop("shuffle_key"))
    assert {r[0] for r in first} <= {r.doc_id for r in docs.collect()}
    assert mixing.mix(documents(spark, [])).collect() == []


def test_counts_follow_the_inverse_poisson_distribution(spark):
    rows = [(i, "t", "en", "big" if i % 3 else "small", 1) for i in range(3000)]
    mixed = mixing.mix(documents(spark, rows), weights={"big": 1, "small": 3}, total=8000).collect()
    rate = {"big": 8000 * 0.25 / 2000, "small": 8000 * 0.75 / 1000}
    drawn = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select(
        "doc_id", "source", mixing.uniform(20, F.col("doc_id")).alias("u")
    )
    got, total = Counter(r.doc_id for r in mixed), 0
    for r in drawn.collect():
        k, p = 0, math.exp(-rate[r.source])
        upto = p
        while upto <= r.u:
            k += 1
            p *= rate[r.source] / k
            upto += p
        assert got[r.doc_id] == k
        total += k
    assert total == len(mixed) and abs(total - 8000) < 4 * math.sqrt(8000)
    assert all(r.copy < r.n_copies for r in mixed)


def test_join_beyond_the_bound(spark, monkeypatch):
    small = rows_of(mixing.mix(documents(spark), total=40))
    monkeypatch.setattr(mixing, "MAX_SOURCES", 1)
    assert rows_of(mixing.mix(documents(spark), total=40)) == small


def test_sources_without_weight_go(spark):
    mixed = mixing.mix(documents(spark), weights={"s1": 1.0, "absent": 2.0}, total=30).collect()
    assert {r.source for r in mixed} <= {"s1"}


def test_order_is_a_shuffle(spark):
    rows = [(i, "t", "en", "s", 1) for i in range(2000)]
    keys = mixing.mix(documents(spark, rows)).select(F.spark_partition_id().alias("p"), "shuffle_key", "doc_id").collect()
    for p in {r.p for r in keys}:
        own = [r for r in keys if r.p == p]
        assert [r.shuffle_key for r in own] == sorted(r.shuffle_key for r in own)


@pytest.mark.parametrize("rate", [700, 750, 5000])
def test_large_rates(spark, rate):
    rows = [(i, "t", "en", "s", 1) for i in range(60)]
    drawn = mixing.mix(documents(spark, rows), total=60.0 * rate).groupBy("doc_id").agg(F.max("n_copies").alias("k"))
    k = [r.k for r in drawn.collect()]
    mean = sum(k) / 60
    assert len(k) == 60 and abs(mean - rate) < 5 * math.sqrt(rate / 60)
    assert 0.4 * rate < sum((x - mean) ** 2 for x in k) / 59 < 2 * rate
