"""Scoring by a model from outside: weights in a table, applied in batches by its own code.

``export_linear`` writes what a linear classifier knows, one row per weight that is not
zero, to a table any program can read. ``scorer`` builds a column from such a table: the
weights go to each worker once, and batches of texts' features are scored in numpy, with no
Spark ML model in the session.

Features come as the sparse pairs (places, values) of a row, so a vector of 65,536 places is
as long as the text needs. Defined cases: no features gives the score of the offset alone;
places that the model does not know weigh nothing; a NULL list has no score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OFFSET = -1


def export_linear(spark: SparkSession, model, path: str) -> str:
    """place and weight of a binary linear model; the offset is at place -1."""
    known = model.coefficients.toArray()
    places = np.flatnonzero(known)
    rows = pd.DataFrame({"place": np.r_[OFFSET, places], "weight": np.r_[model.intercept, known[places]]})
    spark.createDataFrame(rows, "place long, weight double").write.mode("overwrite").parquet(path)
    return path


def sparse_pairs(vector: Column) -> tuple[Column, Column]:
    """Places and values of a Spark ML vector, those that are zero left out."""
    from pyspark.ml.functions import vector_to_array

    dense = vector_to_array(vector)
    held = F.filter(F.transform(dense, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda p: p["x"] != 0)
    return held["i"], held["x"]


def scorer(weights: DataFrame, places: Column, values: Column) -> Column:
    """Probability of class 1 from a table of ``export_linear``; as many rows as the model has weights."""
    rows = weights.toPandas()
    size = int(rows["place"].max()) + 1
    flat = np.zeros(size)
    inner = rows[rows["place"] >= 0]
    flat[inner["place"].to_numpy()] = inner["weight"].to_numpy()
    offset = float(rows.loc[rows["place"] == OFFSET, "weight"].sum())
    sent = weights.sparkSession.sparkContext.broadcast((flat, offset))

    @F.pandas_udf("double")
    def judged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known, start = sent.value  # once per worker and task
        for at, x in batches:
            held = (at.notna() & x.notna()).to_numpy()
            lengths = np.array([len(p) for p in at[held]], int)
            flat_at = np.concatenate([*at[held], np.empty(0)]).astype(np.int64)
            flat_x = np.concatenate([*x[held], np.empty(0)])
            inside = (flat_at >= 0) & (flat_at < len(known))
            terms = np.where(inside, known[np.where(inside, flat_at, 0)] if len(known) else 0.0, 0.0) * flat_x
            owner = np.repeat(np.arange(len(lengths)), lengths)
            z = np.bincount(owner, terms, len(lengths)) + start
            out = np.full(len(at), np.nan)
            out[held] = 1 / (1 + np.exp(-z))
            yield pd.Series(out).where(held, None).astype("Float64")

    return judged(places, values)
