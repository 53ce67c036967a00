"""Stand-in tables: admissions, notes, demographics and scores from a sales schema.

Clinical tables are access controlled. These views give the operators the same columns,
types and NULLs from ``orders``, ``customer``, ``documents``, ``labels`` and
``embeddings``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.text import space_tokens
from wardflow.operators.notes import chunk_notes, clean_notes, explode_tokens


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


def _admissions(orders: DataFrame) -> DataFrame:
    discharged = F.col("o_orderdate") + _days(1 + F.col("o_orderkey") % 14)
    died = (F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 3 == 0)
    priority = F.col("o_orderpriority")
    kind = (
        F.when(priority == "5-LOW", "NEWBORN")
        .when(priority == "4-NOT SPECIFIED", "ELECTIVE")
        .when(priority == "1-URGENT", "URGENT")
        .otherwise("EMERGENCY")
    )
    return orders.select(
        F.col("o_custkey").alias("SUBJECT_ID"),
        F.col("o_orderkey").alias("HADM_ID"),
        F.col("o_orderdate").alias("ADMITTIME"),
        discharged.alias("DISCHTIME"),
        F.when(died, discharged).alias("DEATHTIME"),
        kind.alias("ADMISSION_TYPE"),
    )


def admission_notes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per admission and note; admissions without a note have NULL TEXT."""
    admissions = _admissions(table(spark, folder, "orders"))
    first = admissions.groupBy("SUBJECT_ID").agg(F.min("ADMITTIME").alias("FIRST_ADMITTIME"))
    notes = documents(spark, folder).select(
        F.expr("doc_id div 2").alias("HADM_ID"), "doc_id", F.col("text").alias("TEXT")
    )
    return (
        admissions.join(first, "SUBJECT_ID")
        .join(notes, "HADM_ID", "left")
        .select(
            "SUBJECT_ID",
            "HADM_ID",
            "FIRST_ADMITTIME",
            "ADMITTIME",
            "DISCHTIME",
            "DEATHTIME",
            "ADMISSION_TYPE",
            (F.col("ADMITTIME") + _days(F.col("doc_id") % 7)).alias("CHARTDATE"),
            "TEXT",
        )
    )


def demographics(spark: SparkSession, folder: str) -> DataFrame:
    """One row per admission with age, gender, stay and expiry columns."""
    admissions = _admissions(table(spark, folder, "orders"))
    customers = table(spark, folder, "customer")
    marital = F.array(*[F.lit(m) for m in ("SINGLE", "MARRIED", "WIDOWED", "DIVORCED")])
    key = F.col("c_custkey")
    expired = F.col("DEATHTIME").isNotNull().cast("int")
    return admissions.join(customers, F.col("SUBJECT_ID") == key).select(
        "SUBJECT_ID",
        "HADM_ID",
        F.when(key % 50 == 0, 300).otherwise(18 + key % 73).cast("double").alias("AGE"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("GENDER"),
        ((F.col("HADM_ID") % 140) / 10).alias("LOS"),
        F.get(marital, F.col("c_nationkey") % 4).alias("MARITAL_STATUS"),
        F.col("c_mktsegment").alias("ETHNICITY"),
        F.when(F.col("ADMISSION_TYPE") == "NEWBORN", "neonate")
        .otherwise("adult")
        .alias("ICUSTAY_AGE_GROUP"),
        expired.alias("HOSPITAL_EXPIRE_FLAG"),
        expired.alias("ICUSTAY_EXPIRE_FLAG"),
    )


def labelled_docs(spark: SparkSession, folder: str, label: str = "quality") -> DataFrame:
    """doc_id, TEXT and Label of the documents with a label."""
    docs = documents(spark, folder)
    labels = table(spark, folder, "labels")
    return docs.join(labels, "doc_id").select(
        "doc_id", F.col("text").alias("TEXT"), F.col(label).alias("Label")
    )


def labelled_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """ID, doc_id, chunk_no, Label and TEXT of the cleaned and cut documents."""
    docs = clean_notes(labelled_docs(spark, folder))
    return chunk_notes(docs).withColumn("ID", F.expr("doc_id div 2"))


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk scores that need no model; scores repeat and an ID can have two labels."""
    raw = (F.col("doc_id") * 7919 + F.col("chunk_no") * 104729) % 1000
    return (
        labelled_chunks(spark, folder)
        .withColumn("score", raw / 1000.0)
        .select(
            "ID",
            "doc_id",
            "chunk_no",
            "Label",
            "score",
            (F.col("score") >= 0.5).cast("int").alias("prediction"),
        )
    )


def vector_table(spark: SparkSession, folder: str, counted: DataFrame | None = None) -> DataFrame:
    """token and vector for every token of the cleaned labelled documents.

    Tokens of one character have no vector. ``counted`` gives the tokens of these documents
    where a caller has written them already.
    """
    if counted is None:
        counted = explode_tokens(clean_notes(labelled_docs(spark, folder)), [], space_tokens(F.col("TEXT")))
    tokens = counted.select("token").distinct()
    embeddings = table(spark, folder, "embeddings")
    place = F.conv(F.substring(F.md5("token"), 1, 8), 16, 10).cast("bigint")
    known = tokens.where(F.length("token") > 1).withColumn(
        "vec_id", place % embeddings.select(F.count("*")).scalar()
    )
    return known.join(embeddings, "vec_id").select("token", F.col("embedding").alias("vector"))
