"""Parquet, CSV, score, report, history and model sinks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.sources.readers import null_guard

CSV_ROWS_PER_FILE = 100_000
LABELLED_COLUMNS = {"SUBJECT_ID": "int", "HADM_ID": "int", "LABEL": "int", "TEXT": "string"}


def write_labelled_notes(notes: DataFrame, folder: str, n_days: int) -> str:
    """Four non-null columns to ``readmit_{n_days}.parquet``; returns the path."""
    typed = notes.select(*[F.col(c).cast(t).alias(c) for c, t in LABELLED_COLUMNS.items()])
    path = os.path.join(folder, f"readmit_{n_days}.parquet")
    null_guard(typed, list(LABELLED_COLUMNS)).write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str, sep: str = ",", partition: str | None = None) -> str:
    """CSV with header and doubled quotes, readable by ``csv_table`` and by pandas.

    Fields may hold line breaks. ``csv_table`` reads a file by byte ranges all the same; the
    rows per file are bounded for other readers.
    """
    writer = (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("maxRecordsPerFile", CSV_ROWS_PER_FILE)
    )
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.csv(path)
    return path


def write_splits(splits: DataFrame, folder: str) -> dict[str, str]:
    """CSV per split, written in one pass; returns the path of each split."""
    columns = splits.select("ID", "Label", "TEXT", "split")
    write_csv(columns, folder, partition="split")
    return {name: os.path.join(folder, f"split={name}") for name in ("train", "val", "test")}


def write_chunk_scores(scored: DataFrame, path: str, keys: list[str]) -> str:
    """Scores with the key of their chunk, by which they are joined later."""
    out = scored.select(
        *keys,
        F.col("score").alias("logits"),
        F.col("prediction").cast("int").alias("pred_label"),
        F.col("Label").cast("int").alias("label"),
    )
    out.write.mode("overwrite").parquet(path)
    return path


def write_admission_scores(votes: DataFrame, path: str) -> str:
    out = votes.select(
        "ID", F.col("score").alias("logits"), F.col("label").cast("int").alias("label")
    )
    out.write.mode("overwrite").parquet(path)
    return path


def report_lines(metrics: DataFrame) -> DataFrame:
    """A one-row frame of numbers as ``key = value`` lines (columns ``key`` and ``line``)."""
    as_double = metrics.select(*[F.col(c).cast("double").alias(c) for c in metrics.columns])
    long = as_double.unpivot([], as_double.columns, "key", "value")
    return long.select(
        "key", F.concat(F.col("key"), F.lit(" = "), F.format_string("%.6f", "value")).alias("line")
    )


def write_report(lines: DataFrame, path: str) -> str:
    """Lines sorted by key; one line per metric, so one output file."""
    lines.coalesce(1).sortWithinPartitions("key").select("line").write.mode("overwrite").text(path)
    return path


def loss_history(spark: SparkSession, model) -> DataFrame:
    """One row per iteration; ``objectiveHistory`` has at most maxIter + 1 numbers."""
    rows = [(i, float(v)) for i, v in enumerate(model.summary.objectiveHistory)]
    return spark.createDataFrame(rows, "step int, loss double")


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path
