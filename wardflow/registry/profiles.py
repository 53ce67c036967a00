"""Aggregations of the cohort profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardflow.functions.text import space_tokens
from wardflow.operators import cohort, encode, evaluate, profile
from wardflow.plans import jobs
from wardflow.registry.query import Query
from wardflow.registry.relational import (
    clean_docs,
    cohort_chunks,
    gaps,
    labelled,
    noted_cohort,
    src,
)
from wardflow.sources import shared, standin

SUMMARY = "count:i, mean:d, std:d, min:d, q25:d, q50:d, q75:d, max:d"


def describe_sql(value: str, table: str) -> str:
    return f"""SELECT count({value}) AS count, avg({value}) AS mean, stddev_samp({value}) AS std,
                      min({value}) AS min, quantile_cont({value}, 0.25) AS q25,
                      quantile_cont({value}, 0.5) AS q50, quantile_cont({value}, 0.75) AS q75,
                      max({value}) AS max FROM {table}"""


def box_sql(group: str, value: str, table: str) -> str:
    return f"""
    WITH q AS (
        SELECT "{group}", quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
               quantile_cont({value}, 0.75) AS q3
        FROM {table} GROUP BY "{group}"),
    r AS (
        SELECT t."{group}", t.{value} AS v, q1, median, q3,
               t.{value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
        FROM {table} t JOIN q ON t."{group}" = q."{group}" WHERE t.{value} IS NOT NULL)
    SELECT "{group}", q1, median, q3, min(v) FILTER (inside) AS whisker_low,
           max(v) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
    FROM r GROUP BY "{group}", q1, median, q3"""


def density_sql(group: str, value: str, table: str) -> str:
    return f"""
    WITH s AS (
        SELECT "{group}", count({value}) AS n, min({value}) AS lo, max({value}) AS hi,
               stddev_samp({value}) * pow(count({value}), -0.2) AS h
        FROM {table} GROUP BY "{group}"),
    g AS (
        SELECT "{group}", n, h, p AS point,
               lo - 3 * h + (hi - lo + 6 * h) * p / 199.0 AS x
        FROM (SELECT *, unnest(range(200)) AS p FROM s))
    SELECT g."{group}", point, x,
           sum(exp(-0.5 * ((x - {value}) / h) ** 2)) / (n * h * sqrt(2 * pi())) AS density
    FROM g JOIN {table} t ON g."{group}" = t."{group}"
    WHERE {value} IS NOT NULL
    GROUP BY g."{group}", point, x, n, h"""


BOX = "q1:d, median:d, q3:d, whisker_low:d, whisker_high:d, outliers:i"


def people(spark, d):
    demo = profile.demographic_columns(standin.demographics(spark, d))
    return profile.with_demographics(labelled(spark, d), demo)


def ag7(spark, d):
    columns = {
        "subjects": F.col("SUBJECT_ID"),
        "admissions": F.col("HADM_ID"),
        "texts": F.md5("TEXT"),
    }
    return profile.distinct_counts(src(spark, d), [], columns)


def ag8_flag(spark, d):
    columns = {"subjects": F.col("SUBJECT_ID"), "admissions": F.col("HADM_ID")}
    return profile.distinct_counts(
        standin.demographics(spark, d), ["HOSPITAL_EXPIRE_FLAG"], columns
    )


def ag8_types(spark, d):
    rows = gaps(spark, d).dropna(subset=["ADMISSION_TYPE", "NEXT_ADMISSION_TYPE"])
    return profile.distinct_counts(
        rows, ["ADMISSION_TYPE", "NEXT_ADMISSION_TYPE"], {"admissions": F.col("HADM_ID")}
    )


def ag19(spark, d):
    tokens = space_tokens(F.col("TEXT"))
    # text is cleaned and counted once, for the vectors and for what is pooled
    counted = shared.materialised(encode.document_tokens(clean_docs(spark, d), ["doc_id"], tokens))
    vectors = shared.materialised(standin.vector_table(spark, d, counted))
    pooled = encode.pool_counts(counted, vectors, ["doc_id"])
    return encode.pooled_values(pooled, ["doc_id"])


QUERIES = [
    Query(
        "ag1_row_count",
        "total:i",
        lambda s, d: profile.row_count(src(s, d)),
        "SELECT count(*) AS total FROM source",
        ("source",),
    ),
    Query(
        "ag2_distinct_admissions",
        "SUBJECT_ID:i, HADM_ID:i, FIRST_ADMITTIME:t, ADMITTIME:t, DISCHTIME:t, DEATHTIME:t,"
        " ADMISSION_TYPE:s",
        lambda s, d: cohort.distinct_admissions(src(s, d)),
        "SELECT * FROM admissions",
        ("admissions",),
    ),
    Query(
        "ag3_distinct_notes",
        "SUBJECT_ID:i, HADM_ID:i, CHARTDATE:t, text_md5:s",
        lambda s, d: src(s, d)
        .select("SUBJECT_ID", "HADM_ID", "CHARTDATE", F.md5("TEXT").alias("text_md5"))
        .distinct(),
        """SELECT DISTINCT "SUBJECT_ID", "HADM_ID", "CHARTDATE", md5("TEXT") AS text_md5
           FROM source""",
        ("source",),
    ),
    Query(
        "ag4_distinct_ids",
        "ID:i, Label:i",
        lambda s, d: cohort_chunks(s, d).select("ID", "Label").dropDuplicates(),
        'SELECT DISTINCT "ID", "Label" FROM cohort_chunks',
        ("cohort_chunks",),
    ),
    Query(
        "ag4_distinct_demographics",
        "SUBJECT_ID:i, HADM_ID:i, AGE:d, GENDER:s, LOS:d, MARITAL_STATUS:s, ETHNICITY:s,"
        " ICUSTAY_AGE_GROUP:s, ICUSTAY_EXPIRE_FLAG:i",
        lambda s, d: profile.demographic_columns(standin.demographics(s, d)),
        "SELECT * FROM people",
        ("people",),
    ),
    Query(
        "ag5_type_counts",
        "NEXT_ADMISSION_TYPE:s, n:i",
        lambda s, d: profile.key_counts(gaps(s, d), "NEXT_ADMISSION_TYPE"),
        'SELECT "NEXT_ADMISSION_TYPE", count(*) AS n FROM gaps GROUP BY 1',
        ("gaps",),
    ),
    Query(
        "ag5_type_counts_without_null",
        "NEXT_ADMISSION_TYPE:s, n:i",
        lambda s, d: profile.key_counts(gaps(s, d), "NEXT_ADMISSION_TYPE", drop_null=True),
        """SELECT "NEXT_ADMISSION_TYPE", count(*) AS n FROM gaps
           WHERE "NEXT_ADMISSION_TYPE" IS NOT NULL GROUP BY 1""",
        ("gaps",),
    ),
    Query(
        "ag6_type_shares",
        "ADMISSION_TYPE:s, n:i, share:d",
        lambda s, d: profile.key_shares(src(s, d), "ADMISSION_TYPE"),
        """SELECT "ADMISSION_TYPE", count(*) AS n,
                  count(*) / (sum(count(*)) OVER ())::DOUBLE AS share
           FROM source GROUP BY 1""",
        ("source",),
    ),
    Query(
        "ag7_distinct_counts",
        "subjects:i, admissions:i, texts:i",
        ag7,
        """SELECT count(DISTINCT "SUBJECT_ID") AS subjects, count(DISTINCT "HADM_ID") AS admissions,
                  count(DISTINCT "TEXT") AS texts FROM source""",
        ("source",),
    ),
    Query(
        "ag8_distinct_by_expire_flag",
        "HOSPITAL_EXPIRE_FLAG:i, subjects:i, admissions:i",
        ag8_flag,
        """SELECT "HOSPITAL_EXPIRE_FLAG", count(DISTINCT "SUBJECT_ID") AS subjects,
                  count(DISTINCT "HADM_ID") AS admissions FROM people GROUP BY 1""",
        ("people",),
    ),
    Query(
        "ag8_distinct_by_types",
        "ADMISSION_TYPE:s, NEXT_ADMISSION_TYPE:s, admissions:i",
        ag8_types,
        """SELECT "ADMISSION_TYPE", "NEXT_ADMISSION_TYPE", count(DISTINCT "HADM_ID") AS admissions
           FROM gaps WHERE "ADMISSION_TYPE" IS NOT NULL AND "NEXT_ADMISSION_TYPE" IS NOT NULL
           GROUP BY 1, 2""",
        ("gaps",),
    ),
    Query(
        "ag8_distinct_by_label",
        "Label:i, admissions:i",
        lambda s, d: profile.distinct_counts(
            cohort_chunks(s, d), ["Label"], {"admissions": F.col("ID")}
        ),
        'SELECT "Label", count(DISTINCT "ID") AS admissions FROM cohort_chunks GROUP BY 1',
        ("cohort_chunks",),
    ),
    Query(
        "ag9_note_length_by_label",
        "OUTPUT_LABEL:i, min_len:i, max_len:i, mean_len:d",
        lambda s, d: profile.length_by_label(noted_cohort(s, d)),
        """SELECT "OUTPUT_LABEL", min(note_len) AS min_len, max(note_len) AS max_len,
                  avg(note_len) AS mean_len FROM cohort GROUP BY 1""",
        ("cohort",),
    ),
    Query(
        "ag10_notes_per_admission",
        "SUBJECT_ID:i, HADM_ID:i, notecnt:i",
        lambda s, d: profile.notes_per_admission(src(s, d)),
        'SELECT "SUBJECT_ID", "HADM_ID", count(*) AS notecnt FROM source GROUP BY 1, 2',
        ("source",),
    ),
    Query(
        "ag11_multi_note_ratio",
        "ratio:d",
        lambda s, d: profile.multi_note_ratio(src(s, d)),
        """SELECT count(*) FILTER (n > 1) / (SELECT count(*) FROM source)::DOUBLE AS ratio
           FROM (SELECT count(*) AS n FROM source GROUP BY "SUBJECT_ID", "HADM_ID")""",
        ("source",),
    ),
    Query(
        "ag12_describe_gap",
        SUMMARY,
        lambda s, d: profile.describe(gaps(s, d), "DAYS_NEXT_ADMIT"),
        describe_sql('"DAYS_NEXT_ADMIT"', "gaps"),
        ("gaps",),
    ),
    Query(
        "ag12_describe_note_length",
        SUMMARY,
        lambda s, d: profile.describe(noted_cohort(s, d), "note_len"),
        describe_sql("note_len", "cohort"),
        ("cohort",),
    ),
    Query(
        "ag12_describe_notes_per_admission",
        SUMMARY,
        lambda s, d: profile.describe(profile.notes_per_admission(src(s, d)), "notecnt"),
        'WITH c AS (SELECT count(*) AS notecnt FROM source GROUP BY "SUBJECT_ID", "HADM_ID") '
        + describe_sql("notecnt", "c"),
        ("source",),
    ),
    Query(
        "ag12_describe_age",
        SUMMARY,
        lambda s, d: profile.describe(people(s, d), "AGE"),
        describe_sql('"AGE"', "labelled_people"),
        ("labelled_people",),
    ),
    Query(
        "ag13_type_transitions",
        "ADMISSION_TYPE:s, " + ", ".join(f"{t}:i" for t in [*jobs.ADMISSION_TYPES, "other"]),
        lambda s, d: profile.cross_table(
            gaps(s, d), "ADMISSION_TYPE", "NEXT_ADMISSION_TYPE", jobs.ADMISSION_TYPES
        ),
        'SELECT "ADMISSION_TYPE", '
        + ", ".join(
            f"""count(*) FILTER ("NEXT_ADMISSION_TYPE" = '{t}') AS "{t}" """
            for t in jobs.ADMISSION_TYPES
        )
        + f""", count(*) FILTER ("NEXT_ADMISSION_TYPE" NOT IN {tuple(jobs.ADMISSION_TYPES)}) AS other """
        + """FROM gaps WHERE "ADMISSION_TYPE" IS NOT NULL AND "NEXT_ADMISSION_TYPE" IS NOT NULL
             GROUP BY 1""",
        ("gaps",),
    ),
    Query(
        "ag14_long_label_counts",
        "Target:s, Readmission_label:s, Count:i",
        lambda s, d: profile.long_counts(labelled(s, d), ["OUTPUT_LABEL", "OUTPUT_LABEL_180"]),
        """SELECT 'OUTPUT_LABEL' AS "Target", "OUTPUT_LABEL"::VARCHAR AS "Readmission_label",
                  count(*) AS "Count" FROM labelled GROUP BY 2
           UNION ALL
           SELECT 'OUTPUT_LABEL_180', "OUTPUT_LABEL_180"::VARCHAR, count(*) FROM labelled
           GROUP BY 2""",
        ("labelled",),
    ),
    Query(
        "ag15_note_length_boxes",
        "OUTPUT_LABEL:i, " + BOX,
        lambda s, d: profile.box_stats(noted_cohort(s, d), "OUTPUT_LABEL", "note_len"),
        box_sql("OUTPUT_LABEL", "note_len", "cohort"),
        ("cohort",),
    ),
    Query(
        "ag15_age_boxes",
        "OUTPUT_LABEL:i, " + BOX,
        lambda s, d: profile.box_stats(
            profile.plausible_age(people(s, d)), "OUTPUT_LABEL", "AGE"
        ),
        "WITH adults AS (SELECT * FROM labelled_people WHERE \"AGE\" < 200) SELECT * FROM ("
        + box_sql("OUTPUT_LABEL", '"AGE"', "adults")
        + ")",
        ("labelled_people",),
    ),
    Query(
        "ag16_note_length_density",
        "OUTPUT_LABEL:i, point:i, x:d, density:d",
        lambda s, d: profile.kernel_density(noted_cohort(s, d), "OUTPUT_LABEL", "note_len"),
        density_sql("OUTPUT_LABEL", "note_len", "cohort"),
        ("cohort",),
    ),
    Query(
        "ag16_age_density",
        "OUTPUT_LABEL:i, point:i, x:d, density:d",
        lambda s, d: profile.kernel_density(
            profile.plausible_age(people(s, d)), "OUTPUT_LABEL", "AGE"
        ),
        "WITH adults AS (SELECT * FROM labelled_people WHERE \"AGE\" < 200) SELECT * FROM ("
        + density_sql("OUTPUT_LABEL", '"AGE"', "adults")
        + ")",
        ("labelled_people",),
    ),
    Query(
        "ag17_gender_by_label",
        "OUTPUT_LABEL:i, GENDER:s, n:i",
        lambda s, d: profile.key_counts(
            profile.plausible_age(people(s, d)), "OUTPUT_LABEL", "GENDER"
        ),
        """SELECT "OUTPUT_LABEL", "GENDER", count(*) AS n FROM labelled_people
           WHERE "AGE" < 200 GROUP BY 1, 2""",
        ("labelled_people",),
    ),
    Query(
        "ag18_vote_scores",
        "ID:i, score:d, Label:i",
        lambda s, d: evaluate.vote_scores(standin.scores(s, d)),
        "SELECT * FROM votes",
        ("votes",),
    ),
    Query(
        "ag19_mean_pooled_vectors",
        "doc_id:i, dim:i, value:d",
        ag19,
        """SELECT doc_id, dim, sum(v * tf) / sum(tf) AS value
           FROM (SELECT doc_id, tf, unnest(vector)::DOUBLE AS v, unnest(range(len(vector))) AS dim
                 FROM doc_terms JOIN vectors USING (token))
           GROUP BY doc_id, dim""",
        ("doc_terms", "vectors"),
    ),
]
