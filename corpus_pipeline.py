"""From raw documents to packed windows: five stages, each on what the one before kept.

Each stage is written as Parquet to the shared folder and read again. All but the last
return the columns of ``documents``; extra columns of the input end with the first stage.
The last returns the pieces of all documents with their token ids, so that windows can be
filled from its rows alone.

Defined cases: a NULL text is an empty one. Rows without a doc_id or with one that repeats
are documents of their own in every stage but near-dedup, which decides by doc_id: rows of
one doc_id stay or go together, and those without one stay. Texts of any length are taken
whole. Ties go to the smallest doc_id (near-dedup) or the largest (line dedup). An empty
table gives an empty table in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import lines, minhash, mixing, packing, quality
from wardflow.llm.common import bound_batches, table
from wardflow.llm.queries import THRESHOLD, tokenizer_path
from wardflow.sources.shared import materialised

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    bound_batches(spark)
    model, _ = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs.select(*COLUMNS), model, THRESHOLD)


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines that other documents hold too; n_chars follows the text."""
    bound_batches(spark)
    kept = lines.dedup_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    bound_batches(spark)
    found = minhash.near_duplicates(docs, words=5, percent=80)
    lost = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(lost, "doc_id", "left_anti").select(*COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn and repeated so that sources weigh as the root of their size."""
    bound_batches(spark)
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS)


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 1024 tokens, with their ids. ``copy`` tells the
    rows of one doc_id apart, which mixing has drawn several times."""
    bound_batches(spark)
    numbered = docs.select(F.struct("doc_id", F.monotonically_increasing_id().alias("copy")).alias("doc_id"), "text")
    pieces = materialised(packing.token_pieces(numbered, tokenizer_path()))
    # dealt and ordered by copy, so the copies of one document meet in no group
    by_copy = pieces.select(F.col("doc_id.doc_id").alias("_doc_id"), F.col("doc_id.copy").alias("doc_id"), *pieces.columns[1:])
    packed = packing.pack_pieces(by_copy)
    return packed.withColumnsRenamed({"doc_id": "copy", "_doc_id": "doc_id"})


STAGES = [
    ("quality", good_documents),
    ("line_dedup", unique_lines),
    ("near_dedup", distinct_documents),
    ("mixing", mixed_sources),
    ("packing", packed_windows),
]

#: A trained network decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
