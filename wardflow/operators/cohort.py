"""Admission cohorts: next admission, latest note, horizon and month labels.

The source is one row per admission and note. Keys and times are worked on without
the text; the text joins last, one note per admission.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.functions.labels import day_gap, horizon_label, mask_elective, month_label
from wardflow.functions.text import blank_non_words
from wardflow.operators.ordering import SLICE, lead_within, slice_in_order

ADMISSION_COLUMNS = [
    "SUBJECT_ID",
    "HADM_ID",
    "FIRST_ADMITTIME",
    "ADMITTIME",
    "DISCHTIME",
    "DEATHTIME",
    "ADMISSION_TYPE",
]
ADMISSION_KEY = ["SUBJECT_ID", "HADM_ID"]
ADMISSION_ORDER = ["ADMITTIME", "HADM_ID"]


def distinct_admissions(source: DataFrame) -> DataFrame:
    """One row per admission; the notes of an admission collapse."""
    return source.select(*ADMISSION_COLUMNS).distinct()


def stays_discharged_alive(admissions: DataFrame) -> DataFrame:
    """No newborns, no deaths in hospital; an unknown admission type falls out too."""
    return admissions.where((F.col("ADMISSION_TYPE") != "NEWBORN") & F.col("DEATHTIME").isNull())


def discharged_alive(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("DEATHTIME").isNull())


def with_text(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("TEXT").isNotNull())


def in_admission_order(admissions: DataFrame) -> DataFrame:
    return slice_in_order(admissions, ["SUBJECT_ID", *ADMISSION_ORDER])


def with_next_admission(sliced: DataFrame) -> DataFrame:
    """NEXT_ADMITTIME and NEXT_ADMISSION_TYPE over all admissions of a subject."""
    return lead_within(
        sliced,
        ["SUBJECT_ID"],
        ADMISSION_ORDER,
        {"NEXT_ADMITTIME": F.col("ADMITTIME"), "NEXT_ADMISSION_TYPE": F.col("ADMISSION_TYPE")},
    )


def mask_planned_next(admissions: DataFrame) -> DataFrame:
    """Forget the next admission when it is elective."""
    next_type = F.col("NEXT_ADMISSION_TYPE")
    return admissions.withColumns(
        {
            "NEXT_ADMITTIME": mask_elective(next_type, F.col("NEXT_ADMITTIME")),
            "NEXT_ADMISSION_TYPE": mask_elective(next_type, next_type),
        }
    )


def backfill_next(sliced: DataFrame) -> DataFrame:
    """Fill each empty NEXT_* from the following remaining admission, one step only."""
    stepped = lead_within(
        sliced,
        ["SUBJECT_ID"],
        ADMISSION_ORDER,
        {"_time": F.col("NEXT_ADMITTIME"), "_type": F.col("NEXT_ADMISSION_TYPE")},
    )
    return stepped.withColumns(
        {
            "NEXT_ADMITTIME": F.coalesce("NEXT_ADMITTIME", "_time"),
            "NEXT_ADMISSION_TYPE": F.coalesce("NEXT_ADMISSION_TYPE", "_type"),
        }
    ).drop("_time", "_type")


def admission_gaps(source: DataFrame) -> DataFrame:
    """Cohort admissions with DURATION, NEXT_* and DAYS_NEXT_ADMIT, without text.

    The look-ahead sees deaths and newborns; the backfill, after the exclusion, does not.
    """
    ordered = in_admission_order(distinct_admissions(source))
    kept = stays_discharged_alive(mask_planned_next(with_next_admission(ordered)))
    return (
        backfill_next(kept)
        .drop(SLICE)
        .withColumn("DURATION", day_gap(F.col("DISCHTIME"), F.col("ADMITTIME")))
        .withColumn("DAYS_NEXT_ADMIT", day_gap(F.col("NEXT_ADMITTIME"), F.col("DISCHTIME")))
    )


def with_label(gaps: DataFrame, n_days: int = 30, inclusive: bool = False) -> DataFrame:
    label = horizon_label(F.col("DAYS_NEXT_ADMIT"), n_days, inclusive)
    return gaps.withColumn("OUTPUT_LABEL", label)


def latest_notes(source: DataFrame) -> DataFrame:
    """The note with the latest CHARTDATE per admission; equal dates go by text.

    Ranking keeps one row per admission and map task before the shuffle, so even an
    admission with a third of all notes reaches its reducer as a few rows.
    """
    newest = W.partitionBy(*ADMISSION_KEY).orderBy(
        F.col("CHARTDATE").desc_nulls_last(), F.col("TEXT").asc_nulls_last()
    )
    return (
        source.select(*ADMISSION_KEY, "CHARTDATE", "TEXT")
        .withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def cohort_with_notes(admissions: DataFrame, notes: DataFrame) -> DataFrame:
    """Admissions that have a latest note with text."""
    text = notes.select(*ADMISSION_KEY, "TEXT")
    return with_text(admissions.join(text, ADMISSION_KEY, "left"))


NOTE_ROW = [*ADMISSION_KEY, "ADMITTIME", "CHARTDATE"]
COPY_BLOCK = 10_000


def _last_note_rows(rows: DataFrame) -> DataFrame:
    """Per admission its last note row, the copies of it, and the next admission time."""
    counted = rows.groupBy(*NOTE_ROW, "_hash").agg(F.count("*").alias("_copies"))
    last = (
        counted.groupBy(*ADMISSION_KEY, "ADMITTIME")
        .agg(F.max(F.struct("CHARTDATE", "_hash", "_copies")).alias("_last"))
        .select(*ADMISSION_KEY, "ADMITTIME", "_last.*")
    )
    ordered = slice_in_order(last, ["SUBJECT_ID", *ADMISSION_ORDER])
    return lead_within(
        ordered, ["SUBJECT_ID"], ADMISSION_ORDER, {"_after": F.col("ADMITTIME")}
    ).drop(SLICE)


def with_next_note_row(rows: DataFrame) -> DataFrame:
    """Add ``lead(ADMITTIME) over (partition by SUBJECT_ID order by ADMITTIME)``, on note rows.

    Rows are ordered by ADMITTIME, HADM_ID, CHARTDATE and the hash of the text. All rows
    of an admission but the last are followed by their own ADMITTIME, so only the last
    one is looked up, and the text crosses the network once, in the join. Of several
    equal last rows exactly one gets the look-up value; they are rebuilt from their
    number, in blocks, so that no task holds them all.
    """
    keyed = rows.select(*NOTE_ROW, "TEXT").withColumn("_hash", F.md5("TEXT"))
    last = _last_note_rows(keyed).alias("last")
    same = [F.col(f"row.{c}").eqNullSafe(F.col(f"last.{c}")) for c in [*NOTE_ROW, "_hash"]]
    joined = keyed.alias("row").join(last, same, "left").select("row.*", "_copies", "_after")
    single = joined.where(F.col("_copies").isNull() | (F.col("_copies") == 1)).withColumn(
        "next_admission",
        F.when(F.col("_copies").isNull(), F.col("ADMITTIME")).otherwise(F.col("_after")),
    )
    first_of_block = F.col("_block") * COPY_BLOCK
    several = (
        joined.where(F.col("_copies") > 1)
        .dropDuplicates([*NOTE_ROW, "_hash"])
        .withColumn(
            "_block",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_copies - 1) div {COPY_BLOCK}"))),
        )
        .repartition(*ADMISSION_KEY, "_hash", "_block")
        .withColumn(
            "_copy",
            F.explode(
                F.sequence(first_of_block, F.least("_copies", first_of_block + COPY_BLOCK) - 1)
            ),
        )
        .withColumn(
            "next_admission",
            F.when(F.col("_copy") == 0, F.col("_after")).otherwise(F.col("ADMITTIME")),
        )
    )
    columns = [*NOTE_ROW, "TEXT", "next_admission"]
    return single.select(*columns).unionByName(several.select(*columns))


def with_month_label(source: DataFrame, months: int = 6) -> DataFrame:
    """``text_new`` and ``readmitted`` per note row; deaths are excluded."""
    rows = with_next_note_row(discharged_alive(source))
    label = month_label(F.col("next_admission"), F.col("ADMITTIME"), months)
    return rows.withColumns({"text_new": blank_non_words(F.col("TEXT")), "readmitted": label})
