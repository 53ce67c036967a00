"""Readers for parquet, SQL, CSV and TSV inputs, and frame-level source helpers."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.operators.ordering import running_sums
from wardflow.sources.split_csv import split_csv_table


def parquet_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sql_over(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run ``query`` over the given frames, named in it as ``{name}``."""
    return spark.sql(query, **tables)


#: CSV with a header, doubled quotes and line breaks inside fields, by byte ranges of a file.
csv_table = split_csv_table


def whole_csv_table(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    sep: str = ",",
    quote: str = '"',
    infer: bool = True,
) -> DataFrame:
    """The same with one task per file, for files with stray quotes inside unquoted fields.

    Without ``schema`` the types are inferred, at the price of a second pass over the
    files; with ``infer=False`` all columns are strings.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("quote", quote)
        .option("escape", quote)
        .option("multiLine", True)
    )
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def chunk_csv(spark: SparkSession, path: str) -> DataFrame:
    """ID, TEXT and Label of a split, by column name."""
    raw = csv_table(spark, path, infer=False)
    return raw.select(F.col("ID").cast("bigint"), "TEXT", F.col("Label").cast("int"))


def tsv_table(
    spark: SparkSession, path: str, schema: str | None = None, quote: str = '"'
) -> DataFrame:
    return csv_table(spark, path, schema=schema, sep="\t", quote=quote)


def upper_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def with_index(df: DataFrame, order: list[Column], name: str = "index") -> DataFrame:
    """A contiguous index from 0 in the given total order.

    Pass key columns only and join the wide columns by key afterwards: the frame is
    shuffled to number it.
    """
    numbered = running_sums(df, order, {name: F.lit(1).cast("bigint")})
    return numbered.withColumn(name, F.col(name) - 1)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def null_guard(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail the job on the first NULL in one of ``columns``."""
    checked = [
        F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NULL in column {c}")))
        .otherwise(F.col(c))
        .alias(c)
        if c in columns
        else F.col(c)
        for c in df.columns
    ]
    return df.select(*checked)
