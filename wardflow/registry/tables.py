"""SQL forms of the tables that the oracle queries share: name -> (needs, SELECT)."""

from __future__ import annotations


def clean_sql(text: str) -> str:
    flat = f"replace(replace(replace(coalesce({text}, ' '), chr(10), ' '), chr(13), ' '), '/', ' ')"
    steps = [
        (r"\[(.*?)\]", ""),
        (r"[0-9]+\.", ""),
        (r"dr\.", "doctor"),
        (r"m\.d\.", "md"),
        ("admission date:", ""),
        ("discharge date:", ""),
        ("--|__|==", ""),
    ]
    out = f"lower(trim({flat}))"
    for pattern, replacement in steps:
        out = f"regexp_replace({out}, '{pattern}', '{replacement}', 'g')"
    return rf"regexp_replace(trim({out}), '\s+', ' ', 'g')"


def chunk_sql(table: str, keys: str) -> str:
    return f"""
        SELECT {keys}, chunk_no,
               array_to_string(words[chunk_no * 318 + 1 : (chunk_no + 1) * 318], ' ') AS "TEXT"
        FROM (
            SELECT *, unnest(range(n_chunks)) AS chunk_no
            FROM (
                SELECT *, len(words) // 318
                          + CASE WHEN len(words) % 318 > 10 THEN 1 ELSE 0 END AS n_chunks
                FROM (SELECT {keys}, string_split("TEXT", ' ') AS words FROM {table})
            )
        )"""


def gap_label(n_days: int, operator: str = "<") -> str:
    return f"CASE WHEN DAYS_NEXT_ADMIT {operator} {n_days} THEN 1 ELSE 0 END"


def ids_sql(table: str) -> str:
    """Balanced split of the (ID, Label) rows of ``table``, horizon 30, seed 1."""
    return f"""
        SELECT *, CASE WHEN rank <= val THEN 'val' WHEN rank <= held THEN 'test'
                       WHEN rank <= used THEN 'train'
                       WHEN "Label" = 0 AND rank <= used + 500 THEN 'extra'
                       ELSE 'unused' END AS split
        FROM (
            SELECT *, round_even(0.5 * held, 0) AS val
            FROM (
                SELECT *, round_even(0.2 * used, 0) AS held
                FROM (
                    SELECT *, CASE WHEN "Label" = 1 THEN n_label
                                   ELSE least(n_label, n_pos) END AS used
                    FROM (
                        SELECT "ID", "Label", md5(concat("ID", ':1')) AS h,
                               row_number() OVER (PARTITION BY "Label"
                                                  ORDER BY md5(concat("ID", ':1')), "ID") AS rank,
                               count(*) OVER (PARTITION BY "Label") AS n_label,
                               count(*) FILTER ("Label" = 1) OVER () AS n_pos
                        FROM (SELECT DISTINCT "ID", "Label" FROM {table})
                    )
                )
            )
        )"""


TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "source": (
        (),
        """
        SELECT o_custkey AS "SUBJECT_ID", o_orderkey AS "HADM_ID",
               min(o_orderdate) OVER (PARTITION BY o_custkey) AS "FIRST_ADMITTIME",
               o_orderdate AS "ADMITTIME",
               o_orderdate + to_days(CAST(1 + o_orderkey % 14 AS INTEGER)) AS "DISCHTIME",
               CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0
                    THEN o_orderdate + to_days(CAST(1 + o_orderkey % 14 AS INTEGER))
               END AS "DEATHTIME",
               CASE o_orderpriority WHEN '5-LOW' THEN 'NEWBORN'
                    WHEN '4-NOT SPECIFIED' THEN 'ELECTIVE' WHEN '1-URGENT' THEN 'URGENT'
                    ELSE 'EMERGENCY' END AS "ADMISSION_TYPE",
               o_orderdate + to_days(CAST(doc_id % 7 AS INTEGER)) AS "CHARTDATE",
               text AS "TEXT"
        FROM orders LEFT JOIN documents ON o_orderkey = doc_id // 2
        """,
    ),
    "admissions": (
        ("source",),
        """
        SELECT DISTINCT "SUBJECT_ID", "HADM_ID", "FIRST_ADMITTIME", "ADMITTIME", "DISCHTIME",
               "DEATHTIME", "ADMISSION_TYPE"
        FROM source
        """,
    ),
    "followed": (
        ("admissions",),
        """
        SELECT *, lead("ADMITTIME") OVER w AS "NEXT_ADMITTIME",
               lead("ADMISSION_TYPE") OVER w AS "NEXT_ADMISSION_TYPE"
        FROM admissions
        WINDOW w AS (PARTITION BY "SUBJECT_ID" ORDER BY "ADMITTIME", "HADM_ID")
        """,
    ),
    "masked": (
        ("followed",),
        """
        SELECT * REPLACE (
            CASE WHEN "NEXT_ADMISSION_TYPE" = 'ELECTIVE' THEN NULL
                 ELSE "NEXT_ADMITTIME" END AS "NEXT_ADMITTIME",
            CASE WHEN "NEXT_ADMISSION_TYPE" = 'ELECTIVE' THEN NULL
                 ELSE "NEXT_ADMISSION_TYPE" END AS "NEXT_ADMISSION_TYPE")
        FROM followed
        """,
    ),
    "filled": (
        ("masked",),
        """
        SELECT * REPLACE (
            coalesce("NEXT_ADMITTIME", lead("NEXT_ADMITTIME") OVER w) AS "NEXT_ADMITTIME",
            coalesce("NEXT_ADMISSION_TYPE", lead("NEXT_ADMISSION_TYPE") OVER w)
                AS "NEXT_ADMISSION_TYPE")
        FROM masked
        WHERE "ADMISSION_TYPE" <> 'NEWBORN' AND "DEATHTIME" IS NULL
        WINDOW w AS (PARTITION BY "SUBJECT_ID" ORDER BY "ADMITTIME", "HADM_ID")
        """,
    ),
    "gaps": (
        ("filled",),
        """
        SELECT *, date_diff('day', "ADMITTIME", "DISCHTIME") AS "DURATION",
               date_diff('day', "DISCHTIME", "NEXT_ADMITTIME") AS "DAYS_NEXT_ADMIT"
        FROM filled
        """,
    ),
    "latest": (
        ("source",),
        """
        SELECT "SUBJECT_ID", "HADM_ID", "CHARTDATE", "TEXT"
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY "SUBJECT_ID", "HADM_ID"
                  ORDER BY "CHARTDATE" DESC NULLS LAST, "TEXT" NULLS LAST) AS rk
              FROM (SELECT DISTINCT "SUBJECT_ID", "HADM_ID", "CHARTDATE", "TEXT" FROM source))
        WHERE rk = 1
        """,
    ),
    "cohort": (
        ("gaps", "latest"),
        f"""
        SELECT gaps.*, {gap_label(30)} AS "OUTPUT_LABEL", {gap_label(180)} AS "OUTPUT_LABEL_180",
               latest."TEXT", length(latest."TEXT") AS note_len
        FROM gaps LEFT JOIN latest USING ("SUBJECT_ID", "HADM_ID")
        WHERE latest."TEXT" IS NOT NULL
        """,
    ),
    "labelled": (
        ("gaps",),
        f"""SELECT *, {gap_label(30)} AS "OUTPUT_LABEL", {gap_label(180)} AS "OUTPUT_LABEL_180"
            FROM gaps""",
    ),
    "ids": (("gaps",), f'SELECT "HADM_ID" AS "ID", {gap_label(30)} AS "Label" FROM gaps'),
    "split_ids": (("ids",), ids_sql("ids")),
    "clean_cohort": (
        ("cohort",),
        f"""SELECT "SUBJECT_ID", "HADM_ID", "OUTPUT_LABEL" AS "LABEL", {clean_sql('"TEXT"')} AS "TEXT"
            FROM cohort""",
    ),
    "cohort_words": (
        ("clean_cohort",),
        'SELECT "SUBJECT_ID", "HADM_ID" AS "ID", "LABEL" AS "Label", "TEXT" FROM clean_cohort',
    ),
    "cohort_chunks": (
        ("cohort_words",),
        chunk_sql("cohort_words", '"SUBJECT_ID", "ID", "Label"'),
    ),
    "chunk_split_ids": (("cohort_chunks",), ids_sql("cohort_chunks")),
    "chunk_splits": (
        ("cohort_chunks", "chunk_split_ids"),
        """
        SELECT c."ID", c."Label", c.chunk_no, c."TEXT",
               CASE WHEN s.split = 'extra' THEN 'train' ELSE s.split END AS split
        FROM cohort_chunks c JOIN chunk_split_ids s ON c."ID" = s."ID"
        WHERE s.split <> 'unused'
        """,
    ),
    "people": (
        ("source",),
        """
        SELECT DISTINCT "SUBJECT_ID", "HADM_ID",
               CAST(CASE WHEN c_custkey % 50 = 0 THEN 300 ELSE 18 + c_custkey % 73 END AS DOUBLE)
                   AS "AGE",
               CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS "GENDER",
               ("HADM_ID" % 140) / 10.0 AS "LOS",
               CASE c_nationkey % 4 WHEN 0 THEN 'SINGLE' WHEN 1 THEN 'MARRIED'
                    WHEN 2 THEN 'WIDOWED' ELSE 'DIVORCED' END AS "MARITAL_STATUS",
               c_mktsegment AS "ETHNICITY",
               CASE WHEN "ADMISSION_TYPE" = 'NEWBORN' THEN 'neonate' ELSE 'adult' END
                   AS "ICUSTAY_AGE_GROUP",
               CASE WHEN "DEATHTIME" IS NOT NULL THEN 1 ELSE 0 END AS "HOSPITAL_EXPIRE_FLAG",
               CASE WHEN "DEATHTIME" IS NOT NULL THEN 1 ELSE 0 END AS "ICUSTAY_EXPIRE_FLAG"
        FROM source JOIN customer ON "SUBJECT_ID" = c_custkey
        """,
    ),
    "labelled_people": (
        ("labelled", "people"),
        'SELECT * FROM labelled LEFT JOIN people USING ("SUBJECT_ID", "HADM_ID")',
    ),
    "note_rows": (
        ("source",),
        """
        SELECT *, lead("ADMITTIME") OVER (
                   PARTITION BY "SUBJECT_ID"
                   ORDER BY "ADMITTIME", "HADM_ID", "CHARTDATE" NULLS FIRST,
                            md5("TEXT") NULLS FIRST) AS next_admission
        FROM source WHERE "DEATHTIME" IS NULL
        """,
    ),
    "docs": (
        (),
        """SELECT doc_id, text AS "TEXT", quality AS "Label"
           FROM documents JOIN labels USING (doc_id)""",
    ),
    "clean_docs": (
        ("docs",),
        f'SELECT doc_id, "Label", {clean_sql(chr(34) + "TEXT" + chr(34))} AS "TEXT" FROM docs',
    ),
    "doc_chunks": (
        ("doc_word_rows",),
        f"""SELECT doc_id // 2 AS "ID", * FROM ({chunk_sql("doc_word_rows", 'doc_id, "Label"')})""",
    ),
    "doc_word_rows": (("clean_docs",), "SELECT * FROM clean_docs"),
    "scores": (
        ("doc_chunks",),
        """
        SELECT "ID", doc_id, chunk_no, "Label", score,
               CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction
        FROM (SELECT *, ((doc_id * 7919 + chunk_no * 104729) % 1000) / 1000.0::DOUBLE AS score
              FROM doc_chunks)
        """,
    ),
    "votes": (
        ("scores",),
        """
        SELECT "ID", (max(score) + sum(score) / 2) / (1 + count(*) / 2.0::DOUBLE) AS score,
               min("Label") AS "Label"
        FROM scores GROUP BY "ID"
        """,
    ),
    "doc_terms": (
        ("clean_docs",),
        r"""
        SELECT doc_id, "Label", token, count(*) AS tf
        FROM (SELECT doc_id, "Label", unnest(regexp_split_to_array(lower("TEXT"), '\s')) AS token
              FROM clean_docs)
        GROUP BY ALL
        """,
    ),
    "token_idf": (
        ("doc_terms",),
        """
        SELECT token, df,
               CASE WHEN df >= 5 THEN ln(((SELECT count(*) FROM clean_docs) + 1.0) / (df + 1.0))
                    ELSE 0 END AS idf
        FROM (SELECT token, count(*) AS df FROM doc_terms GROUP BY token)
        """,
    ),
    "vocabulary": (
        ("doc_terms",),
        """
        SELECT token, freq, row_number() OVER (ORDER BY freq DESC, token) + 3 AS token_id
        FROM (SELECT token, sum(tf) AS freq FROM doc_terms GROUP BY token
              ORDER BY freq DESC, token LIMIT 3000)
        """,
    ),
    "vectors": (
        ("doc_terms",),
        """
        SELECT token, embedding AS vector
        FROM (SELECT token, ('0x' || substr(md5(token), 1, 8))::BIGINT
                            % (SELECT count(*) FROM embeddings) AS vec_id
              FROM (SELECT DISTINCT token FROM doc_terms WHERE length(token) > 1))
        JOIN embeddings USING (vec_id)
        """,
    ),
}


def curve_tables(scored: str) -> dict[str, tuple[tuple[str, ...], str]]:
    """Running counts over the distinct scores of ``scored``."""
    return {
        f"{scored}_curve": (
            (scored,),
            f"""
            SELECT score, pos, neg,
                   sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
                   sum(pos) OVER () AS n_pos, sum(neg) OVER () AS n_neg
            FROM (SELECT score, count(*) FILTER ("Label" = 1) AS pos,
                         count(*) FILTER ("Label" = 0) AS neg
                  FROM {scored} GROUP BY score)
            WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            """,
        ),
        f"{scored}_points": (
            (f"{scored}_curve",),
            f"""
            SELECT 0 AS place, NULL AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr,
                   1.0::DOUBLE AS prec
            UNION ALL
            SELECT row_number() OVER (ORDER BY score DESC), score, fp / n_neg::DOUBLE,
                   tp / n_pos::DOUBLE, tp / (tp + fp)::DOUBLE
            FROM {scored}_curve
            """,
        ),
    }


TABLES |= curve_tables("scores") | curve_tables("votes")
