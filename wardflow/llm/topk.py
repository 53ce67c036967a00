"""Exact top-k search by inner product: columnar branch and bound.

Vectors become integers, floor(scale * x). Queries and candidates are dealt into cells of
one block of queries and one block of candidates each; a cell never holds more rows on
average at any input. Inside a cell candidates stand in vertical layout, one row per
dimension. Partial scores are added up dimension block by block; after each block the rest
of a score is bounded by the product of the remaining lengths (Cauchy-Schwarz), and
candidates that cannot reach the k-th best lower bound are compacted away. The best k of
every cell are merged by a window per query.

Defined cases: vectors that are NULL or hold NULL or non-finite components, and rows
without an id, take no part. A shorter vector counts as padded with zeros. Rows with the
query's own id are not candidates. Ties go to the smaller id; equal rows with other ids
count each. Extra columns are not read. Scores that need more than 53 bits are added up as
whole Python numbers; components beyond 64 bits and scores beyond them are not supported.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.sources.shared import materialised

QUERIES, CANDIDATES, DIMENSIONS = 2048, 8192, 16
#: Queries whose first block is multiplied at once.
TOGETHER = 64


def quantised(vectors: DataFrame, scale: float) -> DataFrame:
    """vec_id and the vector as an array of bigint, without rows that take no part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint"))
    return vectors.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col("vec_id").cast("bigint"), whole.alias("v")
    )


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def best(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, block: int
) -> list[tuple[int, int, int]]:
    """(query_id, vec_id, score) of the k best of each query; ids rise."""
    width = queries.shape[1]
    if not len(ids) or not width:
        zero = np.zeros(len(ids), np.int64)
        return [(int(q), int(i), 0) for q in query_ids for i, _ in zip(ids[ids != q][:k], zero)]
    cast = np.float64
    if float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max()) * width >= 2.0**53:
        cast = object
    mass = (vectors.astype(np.float64) ** 2).sum(0)
    order = np.argsort(-mass, kind="stable")  # heavy dimensions first
    q, columns = queries[:, order].astype(cast), np.ascontiguousarray(vectors[:, order].T).astype(cast)
    starts = [*range(0, width, block), width]
    squares = np.vstack([(columns[a:b].astype(np.float64) ** 2).sum(0) for a, b in zip(starts, starts[1:])])
    after = np.sqrt(np.vstack([squares[::-1].cumsum(0)[::-1][1:], np.zeros((1, len(ids)))]))
    q_squares = np.column_stack([(q[:, a:b].astype(np.float64) ** 2).sum(1) for a, b in zip(starts, starts[1:])])
    q_after = np.sqrt(np.column_stack([q_squares[:, ::-1].cumsum(1)[:, ::-1][:, 1:], np.zeros(len(q))]))
    found = []
    for at in range(0, len(q), TOGETHER):
        first = q[at : at + TOGETHER, : starts[1]] @ columns[: starts[1]]
        for i, partial in enumerate(first, at):
            alive = np.flatnonzero(ids != query_ids[i])
            partial = partial[alive]
            for b in range(len(starts) - 1):
                if b:
                    lo, hi = starts[b], starts[b + 1]
                    partial = partial + q[i, lo:hi] @ columns[lo:hi, alive]
                if b + 2 < len(starts) and len(alive) > k:
                    size = partial.astype(np.float64)
                    rest = q_after[i, b] * after[b, alive] * (1 + 1e-9) + 1 + 1e-12 * np.abs(size).max()
                    floor = np.partition(size - rest, len(alive) - k)[len(alive) - k]
                    keep = size + rest >= floor
                    alive, partial = alive[keep], partial[keep]
            top = sorted(zip((-partial).tolist(), ids[alive].tolist()))[:k] if cast is object else [
                (-partial[j], ids[alive[j]]) for j in np.lexsort((ids[alive], -partial))[:k]
            ]
            found.extend((int(query_ids[i]), int(vec), -int(score)) for score, vec in top)
    return found


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: float = 256.0,
    query_block: int = QUERIES,
    candidate_block: int = CANDIDATES,
    block: int = DIMENSIONS,
) -> DataFrame:
    """query_id, rank, vec_id and score; ``is_query`` tells by vec_id which rows are queries."""
    whole = materialised(quantised(vectors, scale))
    n, n_queries, width = whole.agg(
        F.count(F.lit(1)), F.count_if(is_query), F.max(F.size("v"))
    ).collect()[0]
    width, query_cells, cells = int(width or 0), 1 + n_queries // query_block, 1 + n // candidate_block

    def dealt(parts: int) -> Column:
        return F.expr(f"pmod(xxhash64(vec_id), {parts})").cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    queries = whole.where(is_query).select("vec_id", "v", dealt(query_cells).alias("i"), every(cells).alias("j"))
    candidates = whole.select("vec_id", "v", every(query_cells).alias("i"), dealt(cells).alias("j"))

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("vec_id")
        found = best(
            left["vec_id"].to_numpy(np.int64),
            _matrix(left["v"], width),
            right["vec_id"].to_numpy(np.int64),
            _matrix(right["v"], width),
            k,
            block,
        )
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(np.int64)

    best_of_cells = (
        queries.groupBy("i", "j")
        .cogroup(candidates.groupBy("i", "j"))
        .applyInPandas(cell, "query_id bigint, vec_id bigint, score bigint")
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best_of_cells.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
