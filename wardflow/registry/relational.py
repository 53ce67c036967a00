"""Sources, sinks, projections, filters, conditionals, joins, windows, sorts, set operations."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from wardflow.functions import labels as L
from wardflow.functions import text as T
from wardflow.operators import classify, cohort, encode, evaluate, features, profile, sampling
from wardflow.operators.notes import fill_text, segment_labelled_notes
from wardflow.operators.ordering import SLICE
from wardflow.plans import jobs
from wardflow.registry.query import Query
from wardflow.registry.tables import gap_label
from wardflow.sources import readers, shared, sinks, standin

TYPES = jobs.ADMISSION_TYPES


def src(spark, d):
    return standin.admission_notes(spark, d)


def gaps(spark, d):
    return cohort.admission_gaps(src(spark, d))


def labelled(spark, d):
    days = F.col("DAYS_NEXT_ADMIT")
    return gaps(spark, d).select(
        "*",
        L.horizon_label(days, 30).alias("OUTPUT_LABEL"),
        L.horizon_label(days, 180).alias("OUTPUT_LABEL_180"),
    )


def noted_cohort(spark, d):
    rows = jobs.extract_readmission(src(spark, d), 30)
    half_year = L.horizon_label(F.col("DAYS_NEXT_ADMIT"), 180)
    return rows.withColumns({"note_len": F.length("TEXT"), "OUTPUT_LABEL_180": half_year})


def id_labels(spark, d):
    label = L.horizon_label(F.col("DAYS_NEXT_ADMIT"), 30)
    return gaps(spark, d).select(F.col("HADM_ID").alias("ID"), label.alias("Label"))


def cohort_chunks(spark, d):
    return segment_labelled_notes(jobs.readmission_etl(src(spark, d), 30))


def digest(df, text="TEXT"):
    """The text as length and hash."""
    return df.withColumns({"text_len": F.length(text), "text_md5": F.md5(text)})


def docs(spark, d):
    return standin.labelled_docs(spark, d)


# sources and sinks -------------------------------------------------------------------


def src1(spark, d):
    return readers.sql_over(
        spark,
        """SELECT ADMISSION_TYPE, count(*) AS n_rows, count(TEXT) AS n_notes,
                  count(DISTINCT HADM_ID) AS n_admissions
           FROM {cleaned_dataset} GROUP BY ADMISSION_TYPE""",
        cleaned_dataset=src(spark, d),
    )


def _csv_copy(spark, d, name, sep=","):
    rows = docs(spark, d).select(F.col("doc_id").alias("ID"), "TEXT", "Label")
    return sinks.write_csv(rows, shared.shared_path(spark, name), sep)


def src2(spark, d):
    return digest(readers.csv_table(spark, _csv_copy(spark, d, "src2")))


def src3(spark, d):
    return digest(readers.chunk_csv(spark, _csv_copy(spark, d, "src3")))


def src5(spark, d):
    path = _csv_copy(spark, d, "src5", sep="\t")
    return digest(readers.tsv_table(spark, path, schema="ID bigint, TEXT string, Label int"))


def src4(spark, d):
    return readers.upper_case_columns(standin.table(spark, d, "orders"))


def src6(spark, d):
    docs_table = readers.parquet_table(spark, os.path.join(d, "documents.parquet"))
    return docs_table.select("doc_id", "lang", F.length("text").alias("text_len"))


def src7(spark, d):
    keys = standin.table(spark, d, "documents").select("doc_id", "lang")
    return readers.with_index(keys, [F.col("lang"), F.col("doc_id")])


def src8(spark, d):
    """The planned admissions and all others, types that are NULL or unheard of included."""
    admissions = cohort.distinct_admissions(src(spark, d))
    planned = F.col("ADMISSION_TYPE").eqNullSafe("ELECTIVE")
    parts = [admissions.where(planned), admissions.where(~planned)]
    return readers.union_all(parts).select("SUBJECT_ID", "HADM_ID", "ADMISSION_TYPE")


def snk1(spark, d):
    folder = shared.shared_path(spark, "snk1")
    path = sinks.write_labelled_notes(jobs.readmission_etl(src(spark, d), 30), folder, 30)
    return digest(readers.parquet_table(spark, path))


def snk2(spark, d):
    paths = sinks.write_splits(
        sampling.class_balance(cohort_chunks(spark, d)), shared.shared_path(spark, "snk2")
    )
    parts = [readers.chunk_csv(spark, p).withColumn("split", F.lit(n)) for n, p in paths.items()]
    return digest(readers.union_all(parts))


def snk3(spark, d):
    votes = evaluate.vote_scores(standin.scores(spark, d)).withColumnRenamed("Label", "label")
    path = sinks.write_admission_scores(votes, shared.shared_path(spark, "snk3"))
    return readers.parquet_table(spark, path)


def snk3_chunks(spark, d):
    path = sinks.write_chunk_scores(
        standin.scores(spark, d), shared.shared_path(spark, "snk3c"), ["ID", "doc_id", "chunk_no"]
    )
    return readers.parquet_table(spark, path)


def snk4(spark, d):
    lines = sinks.report_lines(evaluate.chunk_evaluation(standin.scores(spark, d)))
    path = sinks.write_report(lines, shared.shared_path(spark, "snk4"))
    return spark.read.text(path).select(
        F.substring_index("value", " = ", 1).alias("key"), F.col("value").alias("line")
    )


def _small_model(spark, d):
    chunks = shared.materialised(standin.labelled_chunks(spark, d))
    fitted = features.tfidf_stages(features.SMALL_VOCABULARY, drop_stop_words=False).fit(chunks)
    return chunks, fitted, classify.logistic(max_iter=20, reg=0.01)


def snk5(spark, d):
    chunks, fitted, classifier = _small_model(spark, d)
    model = classify.train(fitted, classifier, chunks)
    path = shared.shared_path(spark, "snk5")
    sinks.write_json(sinks.loss_history(spark, model.stages[-1]), path)
    return spark.read.schema("step int, loss double").json(path)


def snk6(spark, d):
    from pyspark.ml import PipelineModel

    chunks, fitted, classifier = _small_model(spark, d)
    model = classify.train(fitted, classifier, chunks)
    path = sinks.save_model(model, shared.shared_path(spark, "snk6"))
    keys = ["doc_id", "chunk_no"]
    before = classify.score(model, chunks, keys).select(*keys, F.col("score").alias("_before"))
    after = classify.score(PipelineModel.load(path), chunks, keys)
    same = (F.col("score") == F.col("_before")).cast("int")
    return after.join(before, keys).withColumn("same", same)


DOC_COPY = """SELECT doc_id AS "ID", "TEXT", "Label", length("TEXT") AS text_len,
                     md5("TEXT") AS text_md5 FROM docs"""

SOURCES = [
    Query(
        "src1_warehouse_sql",
        "ADMISSION_TYPE:s, n_rows:i, n_notes:i, n_admissions:i",
        src1,
        """SELECT "ADMISSION_TYPE", count(*) AS n_rows, count("TEXT") AS n_notes,
                  count(DISTINCT "HADM_ID") AS n_admissions FROM source GROUP BY 1""",
        ("source",),
    ),
    Query("src2_csv_inferred", "ID:i, Label:i, text_len:i, text_md5:s", src2, DOC_COPY, ("docs",)),
    Query("src3_csv_chunks", "ID:i, Label:i, text_len:i, text_md5:s", src3, DOC_COPY, ("docs",)),
    Query(
        "src4_upper_case_columns",
        "O_ORDERKEY:i, O_CUSTKEY:i, O_ORDERSTATUS:s, O_TOTALPRICE:d, O_ORDERDATE:t,"
        " O_ORDERPRIORITY:s",
        src4,
        """SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY",
                  o_orderstatus AS "O_ORDERSTATUS", o_totalprice AS "O_TOTALPRICE",
                  o_orderdate AS "O_ORDERDATE", o_orderpriority AS "O_ORDERPRIORITY"
           FROM orders""",
    ),
    Query("src5_tsv", "ID:i, Label:i, text_len:i, text_md5:s", src5, DOC_COPY, ("docs",)),
    Query(
        "src6_parquet",
        "doc_id:i, lang:s, text_len:i",
        src6,
        "SELECT doc_id, lang, length(text) AS text_len FROM documents",
    ),
    Query(
        "src7_explicit_index",
        "index:i, doc_id:i, lang:s",
        src7,
        """SELECT row_number() OVER (ORDER BY lang, doc_id) - 1 AS index, doc_id, lang
           FROM documents""",
    ),
    Query(
        "src8_union_of_parts",
        "SUBJECT_ID:i, HADM_ID:i, ADMISSION_TYPE:s",
        src8,
        "SELECT * FROM admissions",
        ("admissions",),
    ),
    Query(
        "snk1_labelled_parquet",
        "SUBJECT_ID:i, HADM_ID:i, LABEL:i, text_len:i, text_md5:s",
        snk1,
        'SELECT *, length("TEXT") AS text_len, md5("TEXT") AS text_md5 FROM clean_cohort',
        ("clean_cohort",),
    ),
    Query(
        "snk2_split_csv",
        "split:s, ID:i, Label:i, text_len:i, text_md5:s",
        snk2,
        'SELECT *, length("TEXT") AS text_len, md5("TEXT") AS text_md5 FROM chunk_splits',
        ("chunk_splits",),
    ),
    Query(
        "snk3_admission_scores",
        "ID:i, logits:d, label:i",
        snk3,
        'SELECT "ID", score AS logits, "Label" AS label FROM votes',
        ("votes",),
    ),
    Query(
        "snk3_chunk_scores",
        "ID:i, doc_id:i, chunk_no:i, logits:d, pred_label:i, label:i",
        snk3_chunks,
        """SELECT "ID", doc_id, chunk_no, score AS logits, prediction AS pred_label,
                  "Label" AS label FROM scores""",
        ("scores",),
    ),
    Query(
        "snk4_metric_report",
        "key:s, line:s",
        snk4,
        """WITH m AS (
               SELECT avg(CASE WHEN prediction = "Label" THEN 1.0 ELSE 0.0 END) AS eval_accuracy,
                      avg(-CASE WHEN "Label" = 1 THEN ln(greatest(score, 1e-12))
                                ELSE ln(1 - least(score, 1 - 1e-12)) END) AS eval_loss
               FROM scores)
           SELECT 'eval_accuracy' AS key, printf('eval_accuracy = %.6f', eval_accuracy) AS line FROM m
           UNION ALL
           SELECT 'eval_loss', printf('eval_loss = %.6f', eval_loss) FROM m""",
        ("scores",),
    ),
    Query("snk5_loss_history", "step:i, loss:d", snk5),
    Query(
        "snk6_saved_model_scores",
        "doc_id:i, chunk_no:i, Label:i, same:i",
        snk6,
        'SELECT doc_id, chunk_no, "Label", 1 AS same FROM doc_chunks',
        ("doc_chunks",),
    ),
]

# projections, filters, conditionals --------------------------------------------------

COHORT_COLUMNS = (
    "SUBJECT_ID:i, HADM_ID:i, FIRST_ADMITTIME:t, ADMITTIME:t, DISCHTIME:t, DEATHTIME:t,"
    " ADMISSION_TYPE:s, DURATION:i, NEXT_ADMITTIME:t, NEXT_ADMISSION_TYPE:s, DAYS_NEXT_ADMIT:i"
)


def prj3(spark, d):
    return noted_cohort(spark, d).withColumnsRenamed(
        {"OUTPUT_LABEL": "readmit_30_days", "OUTPUT_LABEL_180": "readmit_6_months"}
    )


def prj4(spark, d):
    return gaps(spark, d).select(
        F.col("HADM_ID").cast("int").alias("hadm_int"),
        F.col("DURATION").cast("string").alias("duration_text"),
    )


def prj6(spark, d):
    ids = id_labels(spark, d)
    ones = ids.where(F.col("Label") == 1).select("ID").withColumn("label", F.lit(1))
    zeros = ids.where(F.col("Label") == 0).select("ID").withColumn("label", F.lit(0))
    return ones.unionByName(zeros)


def prj7(spark, d):
    return profile.schema_and_shape(src(spark, d))


def flt5(spark, d):
    scored = standin.scores(spark, d)
    return scored.where("prediction = 0 AND Label = prediction").select("doc_id", "chunk_no")


def cnd1(spark, d):
    ordered = cohort.in_admission_order(cohort.distinct_admissions(src(spark, d)))
    return cohort.mask_planned_next(cohort.with_next_admission(ordered))


def cnd4(spark, d):
    return gaps(spark, d).select("HADM_ID", *L.horizon_labels(F.col("DAYS_NEXT_ADMIT")))


def cnd5(spark, d):
    rows = cohort.with_next_note_row(cohort.discharged_alive(src(spark, d)))
    return rows.withColumn(
        "readmitted", L.month_label(F.col("next_admission"), F.col("ADMITTIME"))
    )


MONTH_LABEL = """CASE WHEN next_admission <> "ADMITTIME"
                      AND date_diff('month', "ADMITTIME", next_admission) <= 6
                 THEN 1 ELSE 0 END"""
SOURCE_TYPES = {
    "SUBJECT_ID": "bigint",
    "HADM_ID": "bigint",
    "FIRST_ADMITTIME": "timestamp_ntz",
    "ADMITTIME": "timestamp_ntz",
    "DISCHTIME": "timestamp_ntz",
    "DEATHTIME": "timestamp_ntz",
    "ADMISSION_TYPE": "string",
    "CHARTDATE": "timestamp_ntz",
    "TEXT": "string",
}

PROJECTIONS = [
    Query(
        "prj1_column_subset",
        "SUBJECT_ID:i, HADM_ID:i, LABEL:i, text_len:i",
        lambda s, d: jobs.labelled_notes(src(s, d)).withColumn("text_len", F.length("TEXT")),
        'SELECT "SUBJECT_ID", "HADM_ID", "OUTPUT_LABEL" AS "LABEL", note_len AS text_len FROM cohort',
        ("cohort",),
    ),
    Query(
        "prj2_all_but_text",
        "SUBJECT_ID:i, HADM_ID:i, FIRST_ADMITTIME:t, ADMITTIME:t, DISCHTIME:t, DEATHTIME:t,"
        " ADMISSION_TYPE:s, CHARTDATE:t",
        lambda s, d: readers.sql_over(s, "SELECT * EXCEPT (TEXT) FROM {rows}", rows=src(s, d)),
        'SELECT * EXCLUDE ("TEXT") FROM source',
        ("source",),
    ),
    Query(
        "prj3_renamed",
        "HADM_ID:i, readmit_30_days:i, readmit_6_months:i",
        prj3,
        """SELECT "HADM_ID", "OUTPUT_LABEL" AS readmit_30_days,
                  "OUTPUT_LABEL_180" AS readmit_6_months FROM cohort""",
        ("cohort",),
    ),
    Query(
        "prj4_cast",
        "hadm_int:i, duration_text:s",
        prj4,
        """SELECT "HADM_ID"::INTEGER AS hadm_int, "DURATION"::VARCHAR AS duration_text
           FROM gaps""",
        ("gaps",),
    ),
    Query(
        "prj5_fill_text",
        "HADM_ID:i, CHARTDATE:t, text_len:i, text_md5:s",
        lambda s, d: digest(fill_text(src(s, d))),
        """SELECT *, length(coalesce("TEXT", ' ')) AS text_len,
                  md5(coalesce("TEXT", ' ')) AS text_md5 FROM source""",
        ("source",),
    ),
    Query(
        "prj6_constant_label",
        "ID:i, label:i",
        prj6,
        """SELECT "ID", 1 AS label FROM ids WHERE "Label" = 1
           UNION ALL SELECT "ID", 0 FROM ids WHERE "Label" = 0""",
        ("ids",),
    ),
    Query(
        "prj7_schema_and_shape",
        "column:s, type:s, non_null:i, rows:i",
        prj7,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", '{t}' AS type, count("{c}") AS non_null,
                       count(*) AS rows FROM source"""
            for c, t in SOURCE_TYPES.items()
        ),
        ("source",),
    ),
    Query(
        "flt1_no_newborns_or_deaths",
        "SUBJECT_ID:i, HADM_ID:i, ADMISSION_TYPE:s",
        lambda s, d: cohort.stays_discharged_alive(cohort.distinct_admissions(src(s, d))),
        """SELECT * FROM admissions
           WHERE "ADMISSION_TYPE" <> 'NEWBORN' AND "DEATHTIME" IS NULL""",
        ("admissions",),
    ),
    Query(
        "flt2_no_deaths",
        "SUBJECT_ID:i, HADM_ID:i, ADMISSION_TYPE:s, CHARTDATE:t",
        lambda s, d: cohort.discharged_alive(src(s, d)),
        'SELECT * FROM source WHERE "DEATHTIME" IS NULL',
        ("source",),
    ),
    Query(
        "flt3_with_note",
        "SUBJECT_ID:i, HADM_ID:i, CHARTDATE:t, text_len:i, text_md5:s",
        lambda s, d: digest(cohort.with_text(src(s, d))),
        """SELECT *, length("TEXT") AS text_len, md5("TEXT") AS text_md5
           FROM source WHERE "TEXT" IS NOT NULL""",
        ("source",),
    ),
    Query(
        "flt4_plausible_age",
        "HADM_ID:i, AGE:d",
        lambda s, d: profile.plausible_age(
            profile.with_demographics(labelled(s, d), standin.demographics(s, d))
        ),
        'SELECT * FROM labelled_people WHERE "AGE" < 200',
        ("labelled_people",),
    ),
    Query(
        "flt4_plausible_age_share",
        "kept_share:d",
        lambda s, d: profile.plausible_age_share(
            profile.with_demographics(labelled(s, d), standin.demographics(s, d))
        ),
        'SELECT count(*) FILTER ("AGE" < 200) / count(*)::DOUBLE AS kept_share FROM labelled_people',
        ("labelled_people",),
    ),
    Query(
        "flt5_true_negatives",
        "doc_id:i, chunk_no:i",
        flt5,
        'SELECT doc_id, chunk_no FROM scores WHERE prediction = 0 AND "Label" = prediction',
        ("scores",),
    ),
    Query(
        "cnd1_elective_mask",
        "SUBJECT_ID:i, HADM_ID:i, NEXT_ADMITTIME:t, NEXT_ADMISSION_TYPE:s",
        cnd1,
        "SELECT * FROM masked",
        ("masked",),
    ),
    Query(
        "cnd2_label_30_days",
        "HADM_ID:i, DAYS_NEXT_ADMIT:i, OUTPUT_LABEL:i",
        lambda s, d: cohort.with_label(gaps(s, d), 30),
        f'SELECT *, {gap_label(30)} AS "OUTPUT_LABEL" FROM gaps',
        ("gaps",),
    ),
    Query(
        "cnd3_inclusive_label",
        "HADM_ID:i, DAYS_NEXT_ADMIT:i, OUTPUT_LABEL:i",
        lambda s, d: cohort.with_label(gaps(s, d), 30, inclusive=True),
        f'SELECT *, {gap_label(30, "<=")} AS "OUTPUT_LABEL" FROM gaps',
        ("gaps",),
    ),
    Query(
        "cnd4_multi_horizon_labels",
        "HADM_ID:i, " + ", ".join(f"OUTPUT_LABEL_{n}:i" for n in L.HORIZONS),
        cnd4,
        'SELECT "HADM_ID", '
        + ", ".join(f'{gap_label(n)} AS "OUTPUT_LABEL_{n}"' for n in L.HORIZONS)
        + " FROM gaps",
        ("gaps",),
    ),
    Query(
        "cnd5_month_label",
        "HADM_ID:i, CHARTDATE:t, next_admission:t, readmitted:i",
        cnd5,
        f"SELECT *, {MONTH_LABEL} AS readmitted FROM note_rows",
        ("note_rows",),
    ),
]

# joins -------------------------------------------------------------------------------


def jn1(spark, d):
    source = src(spark, d)
    return digest(cohort.cohort_with_notes(cohort.admission_gaps(source), cohort.latest_notes(source)))


def jn2(spark, d):
    people = profile.demographic_columns(standin.demographics(spark, d))
    return profile.with_demographics(labelled(spark, d), people)


def _negatives(spark, d):
    ids = id_labels(spark, d)
    return ids.where(F.col("Label") == 0).select("ID"), sampling.balanced_negatives(ids)


def jn3(spark, d):
    ids = id_labels(spark, d)
    val = sampling.assign_splits(ids).where(F.col("split") == "val")
    return sampling.rows_of_ids(ids, val)


def jn4(spark, d):
    negatives, used = _negatives(spark, d)
    return sampling.rows_without_ids(negatives, used)


def clean_docs(spark, d):
    return docs(spark, d).withColumn("TEXT", T.clean_note(F.col("TEXT")))


def doc_terms(spark, d):
    return encode.document_tokens(
        clean_docs(spark, d), ["doc_id", "Label"], T.space_tokens(F.col("TEXT"))
    )


def vocabulary(spark, d, frequencies=None):
    """``frequencies`` gives the counts of the tokens where a caller has written them already."""
    if frequencies is None:
        frequencies = encode.token_frequencies(clean_docs(spark, d), T.space_tokens(F.col("TEXT")))
    return encode.top_vocabulary(frequencies, features.SMALL_VOCABULARY)


def jn5(spark, d):
    joined = encode.token_vectors(doc_terms(spark, d), standin.vector_table(spark, d))
    return joined.withColumn("first_value", F.try_element_at("vector", F.lit(1)))


def jn6(spark, d):
    return encode.token_ids(doc_terms(spark, d), vocabulary(spark, d))


def jn7(spark, d):
    rows = standin.labelled_chunks(spark, d).select("doc_id", "chunk_no", F.length("TEXT").alias("text_len"))
    scores = standin.scores(spark, d).select("doc_id", "chunk_no", "score")
    return evaluate.with_scores(rows, scores, ["doc_id", "chunk_no"])


JOINS = [
    Query(
        "jn1_cohort_with_latest_note",
        "SUBJECT_ID:i, HADM_ID:i, DAYS_NEXT_ADMIT:i, text_len:i, text_md5:s",
        jn1,
        'SELECT *, note_len AS text_len, md5("TEXT") AS text_md5 FROM cohort',
        ("cohort",),
    ),
    Query(
        "jn2_demographics",
        "SUBJECT_ID:i, HADM_ID:i, OUTPUT_LABEL:i, AGE:d, GENDER:s, LOS:d, MARITAL_STATUS:s,"
        " ETHNICITY:s, ICUSTAY_AGE_GROUP:s, ICUSTAY_EXPIRE_FLAG:i",
        jn2,
        "SELECT * FROM labelled_people",
        ("labelled_people",),
    ),
    Query(
        "jn3_rows_of_split_ids",
        "ID:i, Label:i",
        jn3,
        """SELECT * FROM ids WHERE "ID" IN (SELECT "ID" FROM split_ids WHERE split = 'val')""",
        ("ids", "split_ids"),
    ),
    Query(
        "jn4_ids_not_sampled",
        "ID:i",
        jn4,
        """SELECT "ID" FROM ids WHERE "Label" = 0 AND "ID" NOT IN (
               SELECT "ID" FROM split_ids WHERE "Label" = 0 AND rank <= used)""",
        ("ids", "split_ids"),
    ),
    Query(
        "jn5_token_vectors",
        "doc_id:i, token:s, tf:i, first_value:d",
        jn5,
        """SELECT doc_id, token, tf, vector[1] AS first_value
           FROM doc_terms LEFT JOIN vectors USING (token)""",
        ("doc_terms", "vectors"),
    ),
    Query(
        "jn6_token_ids",
        "doc_id:i, token:s, tf:i, token_id:i",
        jn6,
        """SELECT doc_id, token, tf, coalesce(token_id, 1) AS token_id
           FROM doc_terms LEFT JOIN vocabulary USING (token)""",
        ("doc_terms", "vocabulary"),
    ),
    Query(
        "jn7_scores_by_key",
        "doc_id:i, chunk_no:i, text_len:i, score:d",
        jn7,
        """SELECT c.doc_id, c.chunk_no, length(c."TEXT") AS text_len, s.score
           FROM doc_chunks c JOIN scores s ON c.doc_id = s.doc_id AND c.chunk_no = s.chunk_no""",
        ("doc_chunks", "scores"),
    ),
]

# windows, dates ----------------------------------------------------------------------


def wn1(spark, d):
    return cohort.with_next_admission(
        cohort.in_admission_order(cohort.distinct_admissions(src(spark, d)))
    ).drop(SLICE)


def dt2(spark, d):
    gap = L.month_gap(F.col("NEXT_ADMITTIME"), F.col("DISCHTIME"))
    return gaps(spark, d).select("HADM_ID", gap.alias("months"))


WINDOWS = [
    Query(
        "wn1_next_admission",
        "SUBJECT_ID:i, HADM_ID:i, ADMITTIME:t, NEXT_ADMITTIME:t, NEXT_ADMISSION_TYPE:s",
        wn1,
        "SELECT * FROM followed",
        ("followed",),
    ),
    Query("wn2_backfilled_next", COHORT_COLUMNS, gaps, "SELECT * FROM gaps", ("gaps",)),
    Query(
        "wn3_latest_note",
        "SUBJECT_ID:i, HADM_ID:i, CHARTDATE:t, text_len:i, text_md5:s",
        lambda s, d: digest(cohort.latest_notes(src(s, d))),
        'SELECT *, length("TEXT") AS text_len, md5("TEXT") AS text_md5 FROM latest',
        ("latest",),
    ),
    Query(
        "wn4_next_note_row",
        "SUBJECT_ID:i, HADM_ID:i, ADMITTIME:t, CHARTDATE:t, next_admission:t",
        lambda s, d: cohort.with_next_note_row(cohort.discharged_alive(src(s, d))),
        "SELECT * FROM note_rows",
        ("note_rows",),
    ),
    Query(
        "wn5_running_counts",
        "score:d, pos:i, neg:i, tp:i, fp:i",
        lambda s, d: evaluate.threshold_counts(standin.scores(s, d)),
        "SELECT * FROM scores_curve",
        ("scores_curve",),
    ),
    Query(
        "dt1_stay_duration",
        "HADM_ID:i, DURATION:i, DAYS_NEXT_ADMIT:i",
        gaps,
        "SELECT * FROM gaps",
        ("gaps",),
    ),
    Query(
        "dt2_month_gap",
        "HADM_ID:i, months:i",
        dt2,
        """SELECT "HADM_ID", date_diff('month', "DISCHTIME", "NEXT_ADMITTIME") AS months
           FROM gaps""",
        ("gaps",),
    ),
]

# sorts and sets ----------------------------------------------------------------------


def so2(spark, d):
    key = F.col("HADM_ID")
    order = [sampling.seeded_hash(key, 1), key]
    keys = gaps(spark, d).select("HADM_ID")
    return readers.with_index(keys, order, "place")


def so3(spark, d):
    return cohort.distinct_admissions(src(spark, d)).orderBy("HADM_ID").limit(5)


def st2(spark, d):
    return sampling.once_only(*[f.select("ID") for f in _negatives(spark, d)])


def st3(spark, d):
    parts = sampling.assign_splits(id_labels(spark, d))
    train = parts.where(F.col("split") == "train").select("ID")
    test = parts.where(F.col("split") == "test").select("ID")
    return sampling.overlap(train, test).agg(F.count("*").alias("n"))


SORTS_AND_SETS = [
    Query(
        "so1_sorted_scores",
        "ID:i, doc_id:i, chunk_no:i, score:d",
        lambda s, d: standin.scores(s, d).orderBy("ID", "doc_id", "chunk_no"),
        'SELECT * FROM scores ORDER BY "ID", doc_id, chunk_no',
        ("scores",),
    ),
    Query(
        "so2_seeded_shuffle",
        "place:i, HADM_ID:i",
        so2,
        """SELECT row_number() OVER (ORDER BY md5(concat("HADM_ID", ':1')), "HADM_ID") - 1 AS place,
                  "HADM_ID" FROM gaps""",
        ("gaps",),
    ),
    Query(
        "so3_preview",
        "SUBJECT_ID:i, HADM_ID:i, ADMITTIME:t, ADMISSION_TYPE:s",
        so3,
        'SELECT * FROM admissions ORDER BY "HADM_ID" LIMIT 5',
        ("admissions",),
    ),
    Query(
        "so5_top_vocabulary",
        "token:s, freq:i, token_id:i",
        vocabulary,
        "SELECT * FROM vocabulary",
        ("vocabulary",),
    ),
    Query(
        "so6_recall_at_precision_80",
        "rp80:d, rp80_threshold:d",
        lambda s, d: evaluate.curve_metrics(standin.scores(s, d)),
        """SELECT coalesce(arg_min(tpr, threshold), 0) AS rp80, min(threshold) AS rp80_threshold
           FROM scores_points WHERE place > 0 AND prec > 0.799999""",
        ("scores_points",),
    ),
    Query(
        "st1_union_all",
        "HADM_ID:i, ADMISSION_TYPE:s",
        lambda s, d: readers.union_all(
            [
                cohort.stays_discharged_alive(src(s, d)).select("HADM_ID", "ADMISSION_TYPE"),
                cohort.with_text(src(s, d)).select("HADM_ID", "ADMISSION_TYPE"),
            ]
        ),
        """SELECT "HADM_ID", "ADMISSION_TYPE" FROM source
           WHERE "ADMISSION_TYPE" <> 'NEWBORN' AND "DEATHTIME" IS NULL
           UNION ALL
           SELECT "HADM_ID", "ADMISSION_TYPE" FROM source WHERE "TEXT" IS NOT NULL""",
        ("source",),
    ),
    Query(
        "st2_unused_negatives",
        "ID:i",
        st2,
        'SELECT "ID" FROM split_ids WHERE "Label" = 0 AND rank > used',
        ("split_ids",),
    ),
    Query(
        "st3_split_overlap",
        "n:i",
        st3,
        """SELECT count(*) AS n FROM (
               SELECT "ID" FROM split_ids WHERE split = 'train'
               INTERSECT SELECT "ID" FROM split_ids WHERE split = 'test')""",
        ("split_ids",),
    ),
]

# sampling ----------------------------------------------------------------------------


def sp1(spark, d):
    return sampling.balanced_negatives(id_labels(spark, d))


def sp2(spark, d):
    return sampling.assign_splits(id_labels(spark, d)).where(
        F.col("split").isin("train", "val", "test")
    )


def sp3(spark, d):
    return sampling.assign_splits(id_labels(spark, d)).where(F.col("split") == "extra")


def sp4(spark, d):
    return digest(sampling.class_balance(cohort_chunks(spark, d)))


def sp5_random(spark, d):
    """Every id with the number of parts of the random split that hold it."""
    ids = shared.materialised(gaps(spark, d).select("HADM_ID"))
    train, test = sampling.random_split(ids)
    share = train.count() / max(1, ids.count())
    held = readers.union_all([train, test]).groupBy("HADM_ID").agg(F.count("*").alias("parts"))
    near = F.lit(int(abs(share - 0.8) < 0.1)).alias("share_is_near")
    return ids.join(held, "HADM_ID", "left").select("HADM_ID", "parts", near)


SAMPLING = [
    Query(
        "sp1_down_sampled_negatives",
        "ID:i, rank:i",
        sp1,
        'SELECT "ID", rank FROM split_ids WHERE "Label" = 0 AND rank <= n_pos',
        ("split_ids",),
    ),
    Query(
        "sp2_stratified_split",
        "ID:i, Label:i, split:s",
        sp2,
        "SELECT * FROM split_ids WHERE split IN ('train', 'val', 'test')",
        ("split_ids",),
    ),
    Query(
        "sp3_extra_negatives",
        "ID:i, Label:i",
        sp3,
        "SELECT * FROM split_ids WHERE split = 'extra'",
        ("split_ids",),
    ),
    Query(
        "sp4_class_balance",
        "split:s, ID:i, Label:i, chunk_no:i, text_len:i, text_md5:s",
        sp4,
        'SELECT *, length("TEXT") AS text_len, md5("TEXT") AS text_md5 FROM chunk_splits',
        ("chunk_splits",),
    ),
    Query(
        "sp5_random_split",
        "HADM_ID:i, parts:i, share_is_near:i",
        sp5_random,
        'SELECT "HADM_ID", 1 AS parts, 1 AS share_is_near FROM gaps',
        ("gaps",),
    ),
    Query(
        "sp5_hash_split",
        "HADM_ID:i, split:s",
        lambda s, d: sampling.hash_split(gaps(s, d), F.col("HADM_ID")),
        """SELECT "HADM_ID",
                  CASE WHEN ('0x' || substr(md5("HADM_ID"::VARCHAR), 1, 8))::BIGINT
                            / 4294967296.0::DOUBLE < 0.8
                       THEN 'train' ELSE 'test' END AS split FROM gaps""",
        ("gaps",),
    ),
]

QUERIES = SOURCES + PROJECTIONS + JOINS + WINDOWS + SORTS_AND_SETS + SAMPLING
