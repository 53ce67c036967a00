"""User-level jobs: from the admissions-and-notes table to cohorts, splits and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions import text
from wardflow.functions.labels import horizon_label
from wardflow.operators import classify, cohort, encode, profile, sampling
from wardflow.operators.classify import train_and_report
from wardflow.operators.evaluate import chunk_evaluation, curve_metrics, vote_scores
from wardflow.operators.notes import clean_notes, segment_labelled_notes
from wardflow.operators.sampling import class_balance
from wardflow.sources.shared import materialised
from wardflow.sources.sinks import report_lines

ADMISSION_TYPES = ["ELECTIVE", "EMERGENCY", "NEWBORN", "URGENT"]


def extract_readmission(source: DataFrame, n_days: int = 30) -> DataFrame:
    """Labelled cohort admissions with their latest note."""
    admissions = cohort.with_label(cohort.admission_gaps(source), n_days)
    return cohort.cohort_with_notes(admissions, cohort.latest_notes(source))


def labelled_notes(source: DataFrame, n_days: int = 30, inclusive: bool = False) -> DataFrame:
    """SUBJECT_ID, HADM_ID, LABEL, TEXT."""
    rows = extract_readmission(source, n_days)
    label = horizon_label(F.col("DAYS_NEXT_ADMIT"), n_days, inclusive).alias("LABEL")
    return rows.select("SUBJECT_ID", "HADM_ID", label, "TEXT")


def readmission_etl(source: DataFrame, n_days: int = 30) -> DataFrame:
    """Labelled notes with clean text."""
    return clean_notes(labelled_notes(source, n_days))


def training_data(
    source: DataFrame, n_days: int = 30, seed: int = 1, by: str = "ID", folder: str | None = None
) -> DataFrame:
    """Chunks with ``split`` = train, val or test, balanced by class, disjoint in ``by``.

    The chunks are written once, to ``folder``: ranking the ids then reads two columns of
    them, and the text is cleaned only once.
    """
    chunks = materialised(segment_labelled_notes(readmission_etl(source, n_days)), folder)
    return class_balance(chunks, n_days, seed, by=by)


def train_and_evaluate(
    features: Pipeline | PipelineModel,
    classifier: Estimator,
    splits: dict[str, DataFrame],
    keys: list[str],
) -> tuple[PipelineModel, DataFrame]:
    """Fit the features on ``train`` unless they are fitted, then train and report."""
    fitted = features.fit(splits["train"]) if isinstance(features, Pipeline) else features
    return train_and_report(fitted, classifier, splits, keys)


def month_labelled_set(source: DataFrame, months: int = 6) -> DataFrame:
    rows = cohort.with_month_label(source, months)
    return rows.select(*cohort.ADMISSION_KEY, "CHARTDATE", "text_new", "readmitted")


def clinical_tokens(note: Column) -> Column:
    """Lower-cased words of letters without the default stop words."""
    words = text.letters_only(text.space_tokens(text.shrink_spaces(note)))
    return text.without_stop_words(words, text.default_stop_words())


def embedding_classifier(
    source: DataFrame, vectors: DataFrame, months: int = 6, epochs: int = 10, folder: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Scores of all month-labelled notes, and the report of each split.

    Notes are pooled from the vectors of their words; four fifths of the admissions, by a
    hash, train the perceptron. Notes without a known word have no score.
    """
    rows = month_labelled_set(source, months).select(
        F.xxhash64("SUBJECT_ID", "HADM_ID", "CHARTDATE", "text_new").alias("note"),
        "HADM_ID",
        F.col("readmitted").alias("Label"),
        clinical_tokens(F.col("text_new")).alias("_tokens"),
    )
    keys = ["note", "HADM_ID", "Label"]
    pooled = encode.mean_pool(rows, keys, F.col("_tokens"), vectors)
    split = sampling.hash_split(pooled, F.col("HADM_ID")).withColumnRenamed("pooled", "features")
    # the perceptron's blocks follow the places of the rows: these depend on the keys alone
    noted = materialised(split.repartition(*keys).sortWithinPartitions(*keys), folder)
    width = len(noted.first()["features"])
    model = classify.fit_on_features(
        classify.perceptron(inputs=width, epochs=epochs), noted.where("split = 'train'")
    )
    scored = classify.score(model, noted, ["note", "HADM_ID", "split"])
    report = {n: scored.where(F.col("split") == n) for n in ("train", "test")}
    return scored, classify.split_metrics(report)


def vote_report(chunk_scores: DataFrame) -> DataFrame:
    """Chunk loss and accuracy with the curve metrics of the admission votes."""
    curves = curve_metrics(vote_scores(chunk_scores))
    votes = curves.select("auroc", "auprc", F.col("rp80").alias("RP80"))
    return report_lines(chunk_evaluation(chunk_scores)).unionByName(report_lines(votes))


def cohort_profile(
    source: DataFrame, demographics: DataFrame, folder: str | None = None
) -> dict[str, DataFrame]:
    """The frames of the exploratory report, by name.

    The cohort is written once, to ``folder``, with the length of each note in place of its
    text.
    """
    half_year = horizon_label(F.col("DAYS_NEXT_ADMIT"), 180)
    noted = extract_readmission(source, 30).withColumns(
        {"note_len": F.length("TEXT"), "OUTPUT_LABEL_180": half_year}
    )
    rows = materialised(noted.drop("TEXT"), folder)
    people = profile.with_demographics(rows, profile.demographic_columns(demographics))
    adults = profile.plausible_age(people)
    return {
        "type_shares": profile.key_shares(source, "ADMISSION_TYPE"),
        "gap_summary": profile.describe(rows, "DAYS_NEXT_ADMIT"),
        "label_counts": profile.long_counts(rows, ["OUTPUT_LABEL", "OUTPUT_LABEL_180"]),
        "transitions": profile.cross_table(
            rows, "ADMISSION_TYPE", "NEXT_ADMISSION_TYPE", ADMISSION_TYPES
        ),
        "note_length": profile.describe(rows, "note_len"),
        "note_length_by_label": profile.length_by_label(rows),
        "notes_per_admission": profile.describe(profile.notes_per_admission(source), "notecnt"),
        "multi_note_ratio": profile.multi_note_ratio(source),
        "note_length_boxes": profile.box_stats(rows, "OUTPUT_LABEL", "note_len"),
        "note_length_boxes_180": profile.box_stats(rows, "OUTPUT_LABEL_180", "note_len"),
        "note_length_density": profile.kernel_density(rows, "OUTPUT_LABEL", "note_len"),
        "age_kept": profile.plausible_age_share(people),
        "age_summary": profile.describe(people, "AGE"),
        "age_boxes": profile.box_stats(adults, "OUTPUT_LABEL", "AGE"),
        "age_density": profile.kernel_density(adults, "OUTPUT_LABEL", "AGE"),
        "gender_counts": profile.key_counts(adults, "OUTPUT_LABEL", "GENDER"),
    }


# the columns that name a row of a frame; all others are measures
PROFILE_KEYS = {
    "type_shares": ["ADMISSION_TYPE"],
    "gap_summary": [],
    "label_counts": ["Target", "Readmission_label"],
    "transitions": ["ADMISSION_TYPE"],
    "note_length": [],
    "note_length_by_label": ["OUTPUT_LABEL"],
    "notes_per_admission": [],
    "multi_note_ratio": [],
    "note_length_boxes": ["OUTPUT_LABEL"],
    "note_length_boxes_180": ["OUTPUT_LABEL_180"],
    "note_length_density": ["OUTPUT_LABEL", "point"],
    "age_kept": [],
    "age_summary": [],
    "age_boxes": ["OUTPUT_LABEL"],
    "age_density": ["OUTPUT_LABEL", "point"],
    "gender_counts": ["OUTPUT_LABEL", "GENDER"],
}


def profile_rows(frames: dict[str, DataFrame]) -> DataFrame:
    """All frames of ``cohort_profile`` as one table: section, key, measure, value."""

    def long(name: str, frame: DataFrame) -> DataFrame:
        keys = PROFILE_KEYS[name]
        measures = [c for c in frame.columns if c not in keys]
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key")
        numbers = frame.select(key, *[F.col(c).cast("double").alias(c) for c in measures])
        return numbers.unpivot(["key"], measures, "measure", "value").select(
            F.lit(name).alias("section"), "key", "measure", "value"
        )

    return reduce(DataFrame.unionByName, [long(n, f) for n, f in frames.items()])
