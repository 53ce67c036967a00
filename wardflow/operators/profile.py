"""Cohort profile: counts, shares, distributions and the data behind the plots.

Distributions start from value counts (one row per distinct value, combined before the
shuffle). Quartiles are read off the running sums of the counts at their ranks, so no task
holds all values of a group. Figures of a group reach its rows by a join with one row per
group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.operators.ordering import running_sums

QUARTILES = [0.25, 0.5, 0.75]
MAX_AGE = 200


def schema_and_shape(df: DataFrame) -> DataFrame:
    """One row per column: name, type, non-null values and all rows, in one pass."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(f"_n_{c}") for c in df.columns]
    )
    per_column = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"_n_{f.name}").alias("non_null"),
            F.col("_rows").alias("rows"),
        )
        for f in df.schema.fields
    ]
    return counts.select(F.inline(F.array(*per_column)))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def key_counts(df: DataFrame, *keys: str, drop_null: bool = False) -> DataFrame:
    rows = df.dropna(subset=list(keys)) if drop_null else df
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def key_shares(df: DataFrame, key: str) -> DataFrame:
    counts = key_counts(df, key, drop_null=True)
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def distinct_counts(
    df: DataFrame, keys: list[str], columns: dict[str, Column], error: float | None = None
) -> DataFrame:
    """Distinct counts; give long texts as their hash to keep the shuffle narrow.

    Exact by default; with ``error`` they are estimated to that relative deviation from
    sketches of fixed size.
    """

    def count(column: Column) -> Column:
        return F.count_distinct(column) if error is None else F.approx_count_distinct(column, error)

    return df.groupBy(*keys).agg(*[count(e).alias(n) for n, e in columns.items()])


def length_by_label(
    notes: DataFrame, label: str = "OUTPUT_LABEL", length: str = "note_len"
) -> DataFrame:
    size = F.col(length)
    return notes.groupBy(label).agg(
        F.min(size).alias("min_len"), F.max(size).alias("max_len"), F.avg(size).alias("mean_len")
    )


def notes_per_admission(source: DataFrame) -> DataFrame:
    """Rows per admission, rows without text included; rows without a key are left out."""
    known = source.dropna(subset=["SUBJECT_ID", "HADM_ID"])
    return known.groupBy("SUBJECT_ID", "HADM_ID").agg(F.count("*").alias("notecnt"))


def multi_note_ratio(source: DataFrame) -> DataFrame:
    """Admissions with more than one row, divided by all raw rows."""
    several = notes_per_admission(source).agg(F.count_if(F.col("notecnt") > 1).alias("several"))
    return several.select((F.col("several") / source.agg(F.count("*")).scalar()).alias("ratio"))


def value_counts(df: DataFrame, value: str, groups: list[str] | None = None) -> DataFrame:
    """Groups, ``value`` as double and its number of rows ``n``; NULL values are dropped."""
    kept = df.where(F.col(value).isNotNull())
    as_double = F.col(value).cast("double").alias("value")
    return kept.groupBy(*(groups or []), as_double).agg(F.count("*").alias("n"))


def moments(df: DataFrame, value: str, groups: list[str] | None = None) -> DataFrame:
    """Groups, count, mean, std (of a sample), min and max of the values that are not NULL."""
    x = F.col(value).cast("double")
    kept = df.where(F.col(value).isNotNull()) if groups else df
    return kept.groupBy(*(groups or [])).agg(
        F.count(value).alias("count"),
        F.avg(x).alias("mean"),
        F.when(F.count(value) > 1, F.stddev_samp(x)).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    )


def _of_group(rows: DataFrame, figures: DataFrame, groups: list[str]) -> DataFrame:
    """``rows`` with the figures of their group. No hint: at run time few figures are broadcast,
    and many are joined with hot groups split."""
    return rows.join(figures, groups)


def quartiles(counts: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Groups and q25, q50, q75 with linear interpolation, from (groups, value, n) rows."""
    groups = groups or []
    order = [*map(F.col, groups), F.col("value")]
    placed = running_sums(counts, order, {"_upto": F.col("n")}, totals=not groups)
    if groups:
        sizes = placed.groupBy(*groups).agg(
            F.sum("n").alias("_total"), F.min(F.col("_upto") - F.col("n")).alias("_base")
        )
        placed = _of_group(placed, sizes, groups)
    else:
        placed = placed.withColumnRenamed("total__upto", "_total").withColumn("_base", F.lit(0))
    end = F.col("_upto") - F.col("_base")  # ranks of a value: end - n to end - 1
    found = []
    for i, q in enumerate(QUARTILES):
        rank = (F.col("_total") - 1) * F.lit(q)
        for side, at in (("low", F.floor(rank)), ("high", F.ceil(rank))):
            holds = (at >= end - F.col("n")) & (at < end)
            found.append(F.max(F.when(holds, F.col("value"))).alias(f"_{side}{i}"))
    picked = placed.groupBy(*groups).agg(F.max("_total").alias("_total"), *found)

    def between(i: int) -> Column:
        rank = (F.col("_total") - 1) * F.lit(QUARTILES[i])
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        return low + (high - low) * (rank - F.floor(rank))

    return picked.select(*groups, *[between(i).alias(f"q{int(100 * q)}") for i, q in enumerate(QUARTILES)])


def describe(df: DataFrame, value: str, groups: list[str] | None = None) -> DataFrame:
    """count, mean, sample deviation, min, quartiles with linear interpolation, max."""
    groups = groups or []
    parts = quartiles(value_counts(df, value, groups), groups)
    figures = moments(df, value, groups)
    names = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    both = figures.unionByName(parts, allowMissingColumns=True)
    return both.groupBy(*groups).agg(*[F.max(n).alias(n) for n in names])


def cross_table(
    df: DataFrame, rows: str, columns: str, values: list[str], other: str = "other"
) -> DataFrame:
    """Counts of pairs without NULLs; absent pairs are 0, unlisted values count as ``other``."""
    listed = F.when(F.col(columns).isin(values), F.col(columns)).otherwise(other)
    pairs = df.dropna(subset=[rows, columns]).withColumn(columns, listed).groupBy(rows, columns)
    names = [*values, other]
    table = pairs.agg(F.count("*").alias("_n")).groupBy(rows).pivot(columns, names).sum("_n")
    return table.fillna(0, subset=names)


def long_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Value counts of several columns as (Target, Readmission_label, Count)."""
    as_text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = as_text.unpivot([], columns, "Target", "Readmission_label")
    counts = long.dropna().groupBy("Target", "Readmission_label")
    return counts.agg(F.count("*").alias("Count"))


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges and the number of outliers."""
    counts = value_counts(df, value, [group])
    boxes = quartiles(counts, [group])
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    inside = F.col("value").between(F.col("q25") - reach, F.col("q75") + reach)
    return (
        _of_group(counts, boxes, [group])
        .groupBy(group)
        .agg(
            F.max("q25").alias("q1"),
            F.max("q50").alias("median"),
            F.max("q75").alias("q3"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        )
    )


def kernel_density(
    df: DataFrame, group: str, value: str, grid_size: int = 200, cut: float = 3.0
) -> DataFrame:
    """Gaussian kernel density per group on its own grid, with Scott's bandwidth.

    Each distinct value adds to the grid points of its own group only; the work is
    ``grid_size`` terms per distinct value, summed before the shuffle.
    """
    size = F.col("count").cast("double")
    figures = moments(df, value, [group]).select(
        group,
        size.alias("_total"),
        (F.col("std") * F.pow(size, F.lit(-0.2))).alias("_h"),
        F.col("min").alias("_low"),
        F.col("max").alias("_high"),
    )
    low = F.col("_low") - cut * F.col("_h")
    high = F.col("_high") + cut * F.col("_h")
    grid = low + (high - low) * F.col("point") / (grid_size - 1)
    offset = (F.col("x") - F.col("value")) / F.col("_h")
    term = F.col("n") * F.exp(-0.5 * offset * offset)
    scale = F.max("_total") * F.max("_h") * math.sqrt(2 * math.pi)
    return (
        _of_group(value_counts(df, value, [group]), figures.where(F.col("_h") > 0), [group])
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1))))
        .withColumn("x", grid)
        .groupBy(group, "point")
        .agg(F.max("x").alias("x"), (F.sum(term) / scale).alias("density"))
    )


def demographic_columns(source: DataFrame) -> DataFrame:
    """The distinct demographic rows; several ICU stays give several rows."""
    return source.select(
        "SUBJECT_ID",
        "HADM_ID",
        "AGE",
        "GENDER",
        "LOS",
        "MARITAL_STATUS",
        "ETHNICITY",
        "ICUSTAY_AGE_GROUP",
        "ICUSTAY_EXPIRE_FLAG",
    ).distinct()


def with_demographics(cohort: DataFrame, demographics: DataFrame) -> DataFrame:
    return cohort.join(demographics, ["SUBJECT_ID", "HADM_ID"], "left")


def plausible_age(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("AGE") < MAX_AGE)


def plausible_age_share(rows: DataFrame) -> DataFrame:
    return rows.agg((F.count_if(F.col("AGE") < MAX_AGE) / F.count("*")).alias("kept_share"))
