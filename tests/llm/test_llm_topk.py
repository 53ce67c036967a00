import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.llm import topk

SCHEMA = "vec_id long, embedding array<double>, rank int, v string"


def brute_force(rows, k=5, every=50, scale=256.0):
    whole = []
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole.append((vec_id, [int(np.floor(scale * x)) for x in vector]))
    out = []
    for query, a in whole:
        if query % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != query)
            out += [(query, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (1, [0.5, -0.25]), (2, [0.5, -0.25]), (50, [1.0]), (100, []), (3, None)]
    rows += [(4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (-50, [-1.0, 3.0, 2.0]), (150, None)]
    assert found(topk.search(table(spark, rows), F.col("vec_id") % 50 == 0)) == brute_force(rows)
    assert topk.search(table(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    alone = [(0, [1.0, 2.0])]
    assert topk.search(table(spark, alone), F.col("vec_id") % 50 == 0).collect() == []


@pytest.mark.parametrize("size", [1.0, 3e5])  # the second needs more than 53 bits
def test_many_cells_and_ties(spark, size):
    rng = np.random.default_rng(1)
    rows = [(i, (np.round(rng.normal(size=24) * size, 1)).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(30)]  # one vector many times
    df = table(spark, rows)
    got = topk.search(df, F.col("vec_id") % 10 == 0, query_block=8, candidate_block=40, block=7)
    assert found(got) == brute_force(rows, every=10)


def test_all_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    assert found(topk.search(df, F.col("vec_id") % 50 == 0)) == brute_force(rows)
