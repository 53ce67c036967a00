"""Row-level note operators; they work on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.text import CHUNK_WORDS, clean_note, word_chunks


def fill_text(notes: DataFrame) -> DataFrame:
    return notes.fillna(" ", subset=["TEXT"])


def clean_notes(notes: DataFrame) -> DataFrame:
    return notes.withColumn("TEXT", clean_note(F.col("TEXT")))


def chunk_notes(notes: DataFrame, size: int = CHUNK_WORDS, text: str = "TEXT") -> DataFrame:
    """One row per chunk, numbered by ``chunk_no`` from 0; all other columns repeat.

    The outer form and the filter after it keep Catalyst from testing the array size,
    and with it the whole text chain, once more below.
    """
    others = [c for c in notes.columns if c != text]
    pieces = word_chunks(F.col(text), size)
    numbered = notes.select(*others, F.posexplode_outer(pieces).alias("chunk_no", text))
    return numbered.where(F.col("chunk_no").isNotNull())


def explode_tokens(docs: DataFrame, keys: list[str], tokens: Column) -> DataFrame:
    """One row per token; outer for the same reason as in ``chunk_notes``."""
    rows = docs.select(*keys, F.explode_outer(tokens).alias("token"))
    return rows.where(F.col("token").isNotNull())


def segment_labelled_notes(notes: DataFrame, size: int = CHUNK_WORDS) -> DataFrame:
    """SUBJECT_ID, ID, Label, chunk_no, TEXT from SUBJECT_ID, HADM_ID, LABEL, TEXT."""
    renamed = notes.select(
        F.col("SUBJECT_ID").cast("bigint").alias("SUBJECT_ID"),
        F.col("HADM_ID").cast("bigint").alias("ID"),
        F.col("LABEL").cast("int").alias("Label"),
        "TEXT",
    )
    return chunk_notes(renamed, size)
